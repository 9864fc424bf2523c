"""Rows that must not be lost, and outputs that must not be mixed up."""

import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fareloom import catalog, jobs
from fareloom.operators.quality import QualityError, keep_report, read_report, require_quality, satisfies
from fareloom.operators.silver import to_silver
from fareloom.operators.zones import add_zone_names
from fareloom.schemas import UNENRICHED
from fareloom.session import _shared_root
from fareloom.sources.readers import read_bronze, read_silver, read_zones, stream_trips
from fareloom.streaming.sinks import ONCE_OVER_ALL_INPUT
from tests.conftest import raw_trips, zone_table
from tests.test_streaming import DAY_ONE, DAY_TWO, NOW, TRIPS, Lake, _trip


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder)


def _age(folder, known):
    for file in set(Path(folder).rglob("*.parquet")) - known:
        os.utime(file, (0, 10**9))


def test_old_time_stamps_hide_no_trip_file(spark, lake):
    for part in (TRIPS[:7], TRIPS[7:]):
        known = set(Path(lake.folder("raw")).rglob("*.parquet"))
        lake.add_trips(part)
        if known:
            _age(lake.folder("raw"), known)
        written = {name: set(Path(lake.folder(name)).rglob("*.parquet")) for name in ("bronze", "silver")}
        lake.bronze()
        if known:
            _age(lake.folder("bronze"), written["bronze"])
        lake.silver()
        if known:
            _age(lake.folder("silver"), written["silver"])
        lake.add_weather(DAY_ONE) if not known else lake.add_weather(DAY_TWO)
        gold = lake.gold("table")
        name = jobs.run_catalog(
            spark, lake.folder("bronze"), lake.folder("cat"), lake.folder("cat-c"), "aged", "trips", lake.folder("db")
        )
    assert read_bronze(spark, lake.folder("bronze")).count() == len(TRIPS)
    assert read_silver(spark, lake.folder("silver")).count() == len(TRIPS)
    assert gold == lake.batch_gold()
    assert spark.table(name).count() == len(TRIPS)


def test_gold_of_another_checkpoint_is_refused(spark, lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE)
    lake.gold("table")
    lake.gold("table")
    run = lambda out: jobs.run_gold(spark, lake.folder("silver"), lake.folder("weather"), out, lake.folder("other-c"), **NOW)
    run(lake.folder("other"))
    with pytest.raises(ValueError, match="does not know"):
        run(lake.folder("gold-table"))


def test_an_unfinished_gold_batch_is_not_read(spark, lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE)
    lake.gold("table")
    lake.add_weather(DAY_TWO)
    whole = lake.gold("table")
    published = sorted(Path(lake.folder("gold-table", "_parts")).glob("*.json"))
    published.pop().unlink()
    assert 0 < len(lake.gold_rows("table")) < len(whole)
    published.pop().unlink()
    assert lake.gold_rows("table") == []


def test_enrichment_feeds_bronze(spark, folder):
    whole = ("passenger_count", "RatecodeID", "VendorID", "PULocationID", "DOLocationID")
    trips = raw_trips(spark, [_trip("2024-01-01", 1, PULocationID=1), _trip("2024-01-01", 2, passenger_count=None)])
    typed = trips.select(*UNENRICHED.fieldNames()).withColumns({c: F.col(c).cast("long") for c in whole})
    typed.write.parquet(folder("raw"))
    zone_table(spark, [(1, "A")]).write.option("header", True).csv(folder("zones"))
    jobs.run_enrich(spark, folder("raw"), folder("zones"), folder("named"))
    with pytest.raises(Exception, match="(?i)already exists"):
        jobs.run_enrich(spark, folder("raw"), folder("zones"), folder("named"))
    jobs.run_enrich(spark, folder("raw"), folder("zones"), folder("named"), mode="append")
    jobs.run_bronze(spark, folder("named"), folder("bronze"), folder("c"), **NOW)
    rows = read_bronze(spark, folder("bronze"))
    assert sorted((r["passenger_count"], r["pickup_location"]) for r in rows.where("passenger_count = 1").collect()) == [(1.0, "A")] * 2
    assert rows.count() == 4
    typed.withColumn("VendorID", F.lit(2**40)).write.parquet(folder("large"))
    with pytest.raises(Exception, match="does not fit"):
        jobs.run_enrich(spark, folder("large"), folder("zones"), folder("fails"))


def test_zones_are_found_by_name(spark, folder):
    with open(folder("z.csv"), "w") as file:
        file.write('Zone,more,LocationID,service_zone,Borough\n"A",1,7,s,b\n"",1,8,s,b\nNA,1,9,s,b\n"N/A",1,10,s,b\n')
    rows = {r["LocationID"]: r["Zone"] for r in read_zones(spark, folder("z.csv")).collect()}
    assert rows == {7: "A", 8: None, 9: None, 10: None}
    with open(folder("bad.csv"), "w") as file:
        file.write("LocationID,Borough,Zone\n1,b,A\n")
    with pytest.raises(ValueError, match="service_zone"):
        read_zones(spark, folder("bad.csv"))


def test_repeated_zone_ids_work_for_streaming_trips(spark, folder):
    raw_trips(spark, [_trip("2024-01-01", 1, PULocationID=1)]).select(*UNENRICHED.fieldNames()).write.parquet(folder("raw"))
    zones = zone_table(spark, [(1, "A"), (1, "B"), (2, "C")]).coalesce(1)
    named = add_zone_names(stream_trips(spark, folder("raw"), UNENRICHED), zones)
    query = named.writeStream.option("checkpointLocation", folder("c")).trigger(**ONCE_OVER_ALL_INPUT)
    query.start(folder("out")).awaitTermination()
    assert [r["pickup_location"] for r in spark.read.parquet(folder("out")).collect()] == ["B"]


def test_the_report_is_kept_for_each_batch_once(spark, lake):
    for part in (TRIPS[:5], TRIPS[5:]):
        lake.add_trips(part, "bronze")
        lake.silver(validation="report", report=lake.folder("report"))
    rows = read_report(spark, lake.folder("report"))
    assert rows.count() == 2 * 3
    sums = {r["constraint"]: (r["p"], r["t"]) for r in rows.groupBy("constraint").agg(F.sum("passed").alias("p"), F.sum("total").alias("t")).collect()}
    assert sums["isComplete(vendor_id)"] == (14, 19) and sums["isNonNegative(fare_amount)"] == (19, 19)
    again = to_silver(raw_trips(spark, TRIPS[:5]))
    keep_report(again, lake.folder("report"), 0)
    assert read_report(spark, lake.folder("report")).count() == 2 * 3


def test_the_report_has_the_batches_of_the_writing_query(spark, lake):
    for part in (TRIPS[:5], TRIPS[5:9], TRIPS[9:]):
        lake.add_trips(part, "bronze")
    query = lake.silver(report=lake.folder("report"), source_options={"maxFilesPerTrigger": 1})
    totals = {r["batch_id"]: r["total"] for r in read_report(spark, lake.folder("report")).collect()}
    assert totals == {p.batchId: p.numInputRows for p in query.recentProgress if p.numInputRows} and len(totals) == 3
    assert sum(totals.values()) == len(TRIPS) == read_silver(spark, lake.folder("silver")).count()
    # Lost with the driver: the next start says that the counts of this batch are not known.
    for file in Path(lake.folder("report", "batch_id=1")).glob("*"):
        file.unlink()
    Path(lake.folder("report", "batch_id=1")).rmdir()
    lake.silver(report=lake.folder("report"))
    status = {(r["batch_id"], r["constraint_status"]) for r in read_report(spark, lake.folder("report")).where("batch_id = 1").collect()}
    assert status == {(1, "Unknown")}


def test_a_report_that_cannot_be_kept_stops_the_job(spark, lake):
    Path(lake.folder("report")).write_text("a file, not a folder")
    lake.add_trips(TRIPS[:5], "bronze")
    with pytest.raises(RuntimeError, match="report could not be kept"):
        lake.silver(report=lake.folder("report"))
    running = jobs.run_silver(
        spark, lake.folder("bronze"), lake.folder("other"), lake.folder("other-c"), report=lake.folder("report"),
        trigger={"processingTime": "1 second"}, wait=False,
    )
    with pytest.raises(RuntimeError, match="report could not be kept"):
        running.report.finish(running)
    assert not running.isActive


def test_values_that_do_not_fit_stop_the_enrichment(spark, folder):
    zone_table(spark, [(1, "A")]).write.option("header", True).csv(folder("zones"))
    trips = raw_trips(spark, [_trip("2024-01-01", 1, PULocationID=1)]).select(*UNENRICHED.fieldNames())
    good = {"PULocationID": F.lit(1.0), "payment_type": F.lit("2"), "passenger_count": F.lit(3)}
    trips.withColumns(good).write.parquet(folder("good"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            jobs.run_enrich(spark, folder("good"), folder("zones"), folder(f"named-{ansi}"))
            row = spark.read.parquet(folder(f"named-{ansi}")).first()
            assert (row["PULocationID"], row["payment_type"], row["passenger_count"]) == (1, 2, 3.0)
            for k, bad in enumerate((F.lit(1.7), F.lit("1.7"), F.lit("x"), F.lit(2**40), F.lit(3e18))):
                trips.withColumn("PULocationID", bad).write.mode("overwrite").parquet(folder(f"bad-{k}"))
                with pytest.raises(Exception, match="does not fit"):
                    jobs.run_enrich(spark, folder(f"bad-{k}"), folder("zones"), folder(f"fails-{ansi}-{k}"))
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_the_gate_names_all_constraints(spark, lake):
    bad = _trip("2024-01-01", 1, vendor=None, fare=-1.0)
    with pytest.raises(QualityError, match=r"isComplete.*isNonNegative"):
        require_quality(to_silver(raw_trips(spark, [bad])))
    lake.add_trips([bad], "bronze")
    with pytest.raises(StreamingQueryException, match=r"isComplete\(vendor_id\); isNonNegative"):
        lake.silver(validation="fail")


def test_a_gate_that_holds_lets_all_rows_through(lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver(validation="fail", constraints=(satisfies("fare_amount > 1", "paid"),))
    assert read_silver(lake.spark, lake.folder("silver")).count() == len(TRIPS)


def test_bounded_mode_refuses_batch_limits(spark, lake):
    with pytest.raises(ValueError, match="bounded"):
        jobs.run_gold(spark, "a", "b", "c", "d", mode="bounded", source_options={"maxFilesPerTrigger": 1})


def test_the_catalog_follows_a_moved_location(spark, folder):
    rows = raw_trips(spark, TRIPS[:3])
    for name in ("one", "two"):
        part = rows if name == "one" else rows.union(rows)
        catalog.to_catalog_layout(part).write.partitionBy(catalog.PARTITION_COLUMN).parquet(folder(name))
        table = catalog.register_bronze(spark, folder(name), "moved", "trips", folder("db"))
        assert spark.table(table).count() == part.count()
    # A run that was cut off after the table was made over no folder.
    spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in catalog.DATA_COLUMNS)
    spark.sql(f"CREATE TABLE {table} ({columns}, vendorid string) USING PARQUET PARTITIONED BY (vendorid) LOCATION '{folder('two')}/_none'")
    catalog.register_bronze(spark, folder("two"), "moved", "trips", folder("db"))
    assert spark.table(table).count() == 6


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    def session(master):
        unset = SimpleNamespace(isDefined=lambda: False)
        context = SimpleNamespace(getCheckpointDir=lambda: unset)
        spark_context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: context))
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=spark_context)

    assert Path(_shared_root(session("local[2]"))).is_dir()
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _shared_root(session(master))

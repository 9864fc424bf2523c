"""Streaming jobs: the same rows as batch, across restarts, late data and failures."""

import os
import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fareloom import jobs
from fareloom.operators.quality import OBSERVATION_NAME
from fareloom.operators.silver import to_silver
from fareloom.operators.weather import WEATHER_SIDE, join_weather, to_gold
from fareloom.schemas import RAW, UNENRICHED
from fareloom.sources.readers import read_bronze, read_gold, read_silver, read_weather, stream_silver, stream_weather
from fareloom.session import isolated_session
from fareloom.streaming import remembered
from fareloom.streaming.joins import (
    BUNDLED_TRIPS,
    FEWEST_SHARES,
    bundle_trips,
    day_salts,
    join_streams,
    join_streams_bounded,
    pinned_bundles,
    pinned_day_salts,
    pinned_salts,
)
from fareloom.streaming.parts import MERGED_AT_ONCE, read_ledger
from fareloom.streaming.remembered import TRIP, Memory, read_late, read_remembered, start_remembered_join
from fareloom.streaming.sinks import ONCE_OVER_ALL_INPUT
from tests.conftest import at, plan_of, raw_trips, rows_of, silver_trips, weather_rows

NOW = {"trigger": ONCE_OVER_ALL_INPUT}
FOREVER = ("table", "stream")


def _trip(day, number, vendor=1, fare=10.0, **changes):
    start = at(f"{day}T10:00:00")
    return {
        "VendorID": vendor,
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + timedelta(minutes=10 + number),
        "passenger_count": float(number),
        "fare_amount": fare,
        **changes,
    }


TRIPS = [
    *(_trip("2024-01-01", i, vendor=1 + i % 3) for i in range(12)),
    *(_trip("2024-01-02", i, vendor=None) for i in range(5)),
    _trip("2024-01-03", 1),
    _trip("2024-01-01", 3, tpep_dropoff_datetime=None),
]
DAY_ONE, DAY_TWO = ("NYC", "2024-01-01", "1.0", "0.5"), ("NYC", "2024-01-02", "2.0", "1.5")
DAY_ONE_AGAIN = ("LGA", "2024-01-01", "1.1", "0.6")


class Lake:
    """Folders of one pipeline, and the steps that move rows through it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def add_trips(self, rows, name="raw"):
        raw_trips(self.spark, rows).coalesce(1).write.mode("append").parquet(self.folder(name))

    def add_weather(self, *rows):
        df = weather_rows(self.spark, rows).coalesce(1)
        df.write.mode("append").option("header", True).csv(self.folder("weather"))

    def bronze(self, **options):
        return jobs.run_bronze(
            self.spark, self.folder("raw"), self.folder("bronze"), self.folder("bronze-c"), **NOW, **options
        )

    def silver(self, source="bronze", **options):
        return jobs.run_silver(
            self.spark, self.folder(source), self.folder("silver"), self.folder("silver-c"), **NOW, **options
        )

    def gold(self, mode, **options):
        jobs.run_gold(
            self.spark,
            self.folder("silver"),
            self.folder("weather"),
            self.folder(f"gold-{mode}"),
            self.folder(f"gold-{mode}-c"),
            mode=mode,
            **NOW,
            **options,
        )
        return self.gold_rows(mode)

    def gold_rows(self, mode):
        return rows_of(read_gold(self.spark, self.folder(f"gold-{mode}")))

    def batch_gold(self):
        weather = read_weather(self.spark, self.folder("weather"))
        return rows_of(to_gold(join_weather(read_silver(self.spark, self.folder("silver")), weather)))


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder)


def test_chain_equals_batch(spark, lake):
    lake.add_trips(TRIPS)
    lake.add_weather(DAY_ONE, DAY_TWO, DAY_ONE_AGAIN)
    lake.bronze()
    assert rows_of(read_bronze(spark, lake.folder("bronze"))) == rows_of(raw_trips(spark, TRIPS))
    lake.silver()
    expected = to_silver(raw_trips(spark, TRIPS)).withColumn("vendor_id", F.col("vendor_id").cast("string"))
    assert rows_of(read_silver(spark, lake.folder("silver"))) == rows_of(expected)
    assert len(lake.batch_gold()) == 12 * 2 + 5
    for mode in jobs.GOLD_MODES:
        assert lake.gold(mode) == lake.batch_gold(), mode


def test_restart_takes_only_new_files(lake):
    lake.add_trips(TRIPS[:4])
    lake.bronze()
    lake.silver()
    lake.add_trips(TRIPS[4:])
    lake.bronze()
    lake.silver()
    assert read_silver(lake.spark, lake.folder("silver")).count() == len(TRIPS)


@pytest.mark.parametrize("mode", FOREVER)
def test_late_weather_finds_earlier_trips(lake, mode):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_TWO)
    assert len(lake.gold(mode)) == 5
    lake.add_weather(DAY_ONE)
    assert len(lake.gold(mode)) == 5 + 12
    lake.add_trips(TRIPS[:2], "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE_AGAIN)
    assert lake.gold(mode) == lake.batch_gold()
    assert lake.gold(mode) == lake.batch_gold()  # a run without news adds nothing


def test_any_order_of_arrival_gives_the_batch_rows(lake):
    draw = random.Random(7)
    trips, weather = list(TRIPS), [DAY_ONE, DAY_TWO, DAY_ONE_AGAIN]
    draw.shuffle(trips)
    draw.shuffle(weather)
    while trips or weather:
        share = draw.randint(1, 9)
        if trips:
            lake.add_trips(trips[:share], "bronze")
        if weather and (not trips or draw.random() < 0.6):
            lake.add_weather(weather.pop())
        trips = trips[share:]
        lake.silver()
        if Path(lake.folder("weather")).exists():
            for mode in FOREVER:
                lake.gold(mode)
    assert lake.gold("table") == lake.gold("stream") == lake.batch_gold()


@pytest.mark.parametrize("mode", FOREVER)
def test_trips_and_weather_may_come_in_either_order(lake, mode):
    lake.add_weather(DAY_ONE, DAY_TWO)
    lake.add_trips(TRIPS[-2:-1], "bronze")
    lake.silver()
    assert lake.gold(mode) == []
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    assert lake.gold(mode) == lake.batch_gold() != []


def test_small_batches_give_the_same_rows(lake):
    for start in range(0, len(TRIPS), 5):
        lake.add_trips(TRIPS[start : start + 5], "bronze")
    lake.silver(source_options={"maxBytesPerTrigger": 10_000})
    lake.add_weather(DAY_ONE, DAY_TWO)
    for mode in ("table", "stream", "static"):
        assert lake.gold(mode, source_options={"maxBytesPerTrigger": 10_000}) == lake.batch_gold(), mode


def test_default_triggers_keep_running_and_pick_up_new_files(spark, lake):
    lake.add_trips(TRIPS[:2])
    bronze = jobs.run_bronze(spark, lake.folder("raw"), lake.folder("bronze"), lake.folder("bronze-c"), wait=False)
    try:
        bronze.processAllAvailable()
        lake.add_trips(TRIPS[2:5])
        bronze.processAllAvailable()
        assert bronze.isActive
    finally:
        bronze.stop()
    silver = jobs.run_silver(spark, lake.folder("bronze"), lake.folder("silver"), lake.folder("silver-c"), wait=False)
    try:
        silver.processAllAvailable()
    finally:
        silver.stop()
    assert read_silver(spark, lake.folder("silver")).count() == 5


def test_old_time_stamps_do_not_hide_late_weather(lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_TWO)
    known = set(Path(lake.folder("weather")).glob("*.csv"))
    lake.gold("table")
    lake.add_weather(DAY_ONE)
    for file in set(Path(lake.folder("weather")).glob("*.csv")) - known:
        os.utime(file, (0, 10**9))
    assert lake.gold("table") == lake.batch_gold()


def test_static_mode_misses_weather_that_comes_later(lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_TWO)
    assert len(lake.gold("static")) == 5
    lake.add_weather(DAY_ONE)
    assert len(lake.gold("static")) == 5


def test_bounded_mode_forgets_and_the_others_do_not(spark, lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE, DAY_TWO)
    trips, weather = stream_silver(spark, lake.folder("silver")), stream_weather(spark, lake.folder("weather"))
    cleanup = {}
    for name, join in {"bounded": join_streams_bounded, "stream": join_streams}.items():
        df = to_gold(join(trips, weather, 2))
        query = df.writeStream.format("noop").option("checkpointLocation", lake.folder(name)).trigger(**ONCE_OVER_ALL_INPUT).start()
        query.awaitTermination()
        cleanup[name] = query._jsq.explainInternal(False)
    assert "state cleanup [ left = null, right = null ]" in cleanup["stream"]
    assert "state cleanup" in cleanup["bounded"] and "left = null" not in cleanup["bounded"]
    assert "right = null" not in cleanup["bounded"]


def test_copies_of_one_trip_spread_over_the_shares(spark, lake):
    copies = [_trip("2024-01-01", 1)] * 400
    lake.add_trips(copies, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE)
    trips, weather = stream_silver(spark, lake.folder("silver")), stream_weather(spark, lake.folder("weather"))
    joined = join_streams(trips, weather, 4).select("salt")
    query = joined.writeStream.format("parquet").option("checkpointLocation", lake.folder("c"))
    query.trigger(**ONCE_OVER_ALL_INPUT).start(lake.folder("out")).awaitTermination()
    shares = {r["salt"]: r["count"] for r in spark.read.parquet(lake.folder("out")).groupBy("salt").count().collect()}
    assert sum(shares.values()) == 400 and set(shares) == {0, 1, 2, 3}
    assert max(shares.values()) < 200


def test_a_hot_day_is_dealt_evenly(spark, lake):
    """One day has all trips: no partition of the join gets over 1.5 times the mean."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(6000).select(
        F.lit(1).alias("vendor_id"),
        *(F.lit(at("2024-01-01T10:00:00")).alias(c) for c in ("pickup_timestamp", "drop_off_timestamp")),
        F.lit(1.0).alias("passenger_count"), F.lit(1).cast("long").alias("payment_type"), F.lit(1.0).alias("fare_amount"),
        F.lit("a").alias("pickup_location"), F.lit("b").alias("drop_off_location"),
    ).write.partitionBy("vendor_id").parquet(lake.folder("silver"))
    lake.add_weather(DAY_ONE, ("NYC", "1950-05-05", "1.0", "1.0"))
    salts = pinned_day_salts(spark, lake.folder("c"), 2 * partitions)
    assert pinned_day_salts(spark, lake.folder("c"), 2 * partitions).count() == salts.count() > 20_000
    joined = join_streams(
        stream_silver(spark, lake.folder("silver")), stream_weather(spark, lake.folder("weather")), 2 * partitions, salts
    ).select(F.spark_partition_id().alias("place"))
    query = joined.writeStream.format("parquet").option("checkpointLocation", lake.folder("c"))
    query.trigger(**ONCE_OVER_ALL_INPUT).start(lake.folder("out")).awaitTermination()
    sizes = [r["count"] for r in spark.read.parquet(lake.folder("out")).groupBy("place").count().collect()]
    assert sum(sizes) == 6000 and len(sizes) == partitions and max(sizes) <= 1.5 * 6000 / partitions


def test_shares_of_a_day_go_to_different_partitions(spark):
    for shares, partitions in ((16, 48), (16, 16), (24, 8)):
        placed = day_salts(spark, shares, partitions).where("salted_day between '2023-01-01' and '2023-12-31'").select(
            "salted_day", F.explode("salts").alias("salt")
        ).withColumn("place", F.expr(f"pmod(hash(salted_day, salt), {partitions})"))
        assert placed.select("salted_day", "salt").distinct().count() == 365 * shares
        most = placed.groupBy("salted_day", "place").count().agg(F.avg(F.expr("int(count > {})".format(-(-shares // partitions)))).alias("over")).first()
        assert most["over"] < 0.02


def test_the_number_of_shares_is_kept_with_the_checkpoint(spark, folder):
    assert pinned_salts(spark, folder("c"), 3) == 3
    assert pinned_salts(spark, folder("c"), None) == 3
    with pytest.raises(ValueError):
        pinned_salts(spark, folder("c"), 5)
    assert pinned_salts(spark, folder("other"), None) == FEWEST_SHARES  # the session has fewer partitions


def test_a_repeated_batch_leaves_the_same_gold_rows(spark, lake):
    """The driver is lost after a batch was written and before it was committed."""
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE, DAY_TWO)
    applied = lake.gold("table")
    commits = spark._jvm.org.apache.hadoop.fs.Path(lake.folder("gold-table-c", "commits", "0"))
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, False)
    assert lake.gold("table") == applied

    # Cut off earlier, before the batch was published: it is written again, and what the first attempt left is removed.
    published = spark._jvm.org.apache.hadoop.fs.Path(lake.folder("gold-table", "_parts", "000000000000.json"))
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(published, False)
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, False)
    left = {file.name for file in Path(lake.folder("gold-table")).rglob("part=*")}
    assert lake.gold_rows("table") == []
    assert lake.gold("table") == applied
    assert left and not left & {file.name for file in Path(lake.folder("gold-table")).rglob("part=*")}


def test_table_mode_refuses_an_output_of_another_checkpoint(spark, lake):
    lake.add_trips(TRIPS[:1], "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE)
    lake.gold("table")
    with pytest.raises(ValueError, match="does not know"):
        jobs.run_gold(
            spark, lake.folder("silver"), lake.folder("weather"), lake.folder("gold-table"), lake.folder("new-c"), **NOW
        )


def test_table_mode_starts_before_any_row_can_join(lake):
    lake.add_trips([TRIPS[-1]], "bronze")
    lake.silver()
    lake.add_weather(("NYC", "bad", "1.0", "0.5"))
    assert lake.gold("table") == []
    lake.add_weather(DAY_ONE)
    lake.add_trips(TRIPS[:2], "bronze")
    lake.silver()
    assert lake.gold("table") == lake.batch_gold() != []


def test_table_mode_without_broadcast_gives_the_same_rows(spark, lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE, DAY_TWO, DAY_ONE_AGAIN)
    start_remembered_join(
        stream_silver(spark, lake.folder("silver")),
        stream_weather(spark, lake.folder("weather")),
        lake.folder("gold-x"),
        lake.folder("c"),
        trigger=ONCE_OVER_ALL_INPUT,
        max_broadcast_bytes=0,
    ).awaitTermination()
    assert lake.gold_rows("x") == lake.batch_gold()


def test_gate_stops_the_stream_and_nothing_of_the_batch_is_seen(lake):
    lake.add_trips([_trip("2024-01-01", 1)], "bronze")
    lake.silver(validation="fail")
    lake.add_trips([_trip("2024-01-01", 2), _trip("2024-01-01", 3, fare=-1.0)], "bronze")
    with pytest.raises(StreamingQueryException, match="isNonNegative"):
        lake.silver(validation="fail")
    assert read_silver(lake.spark, lake.folder("silver")).count() == 1


def test_report_mode_counts_in_the_progress(lake):
    lake.add_trips(TRIPS, "bronze")
    query = lake.silver(validation="report")
    metrics = query.recentProgress[0].observedMetrics[OBSERVATION_NAME].asDict()
    assert metrics == {"total": 19, "passed_0": 14, "passed_1": 19, "passed_2": 18}
    assert read_silver(lake.spark, lake.folder("silver")).count() == len(TRIPS)


def test_bronze_widens_after_a_restart(spark, lake):
    lake.add_trips(TRIPS[:3])
    lake.bronze(schema=UNENRICHED)
    lake.add_trips([_trip("2024-01-04", 1, pickup_location="A")])
    lake.bronze(schema=RAW)
    merged = read_bronze(spark, lake.folder("bronze"), schema=None)
    assert sorted(merged.columns) == sorted(RAW.fieldNames())
    assert sorted((r["pickup_location"] for r in merged.collect()), key=str) == ["A", None, None, None]


def test_rebalanced_silver_has_the_same_rows(lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver(rebalance=True)
    assert read_silver(lake.spark, lake.folder("silver")).count() == len(TRIPS)


def test_empty_input_writes_nothing(lake):
    lake.add_trips([], "bronze")
    lake.silver(validation="fail")
    assert read_silver(lake.spark, lake.folder("silver")).count() == 0


def test_static_weather_beyond_the_broadcast_bound(spark, lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE, DAY_TWO)
    weather = read_weather(spark, lake.folder("weather")).select(*WEATHER_SIDE)
    joined = join_weather(stream_silver(spark, lake.folder("silver")), weather, max_broadcast_bytes=0)
    query = to_gold(joined).writeStream.format("parquet").option("checkpointLocation", lake.folder("c"))
    query.trigger(**ONCE_OVER_ALL_INPUT).start(lake.folder("gold-s")).awaitTermination()
    assert lake.gold_rows("s") == lake.batch_gold()


def test_parts_stay_few_and_late_weather_opens_few_files(spark, lake):
    """Twenty batches of trips over three years; the number of folders follows months and levels, not batches."""
    batches = 20
    for k in range(batches):
        days = (f"2022-{1 + k % 12:02d}-05", f"2023-{1 + k % 12:02d}-06", "2024-01-02")
        lake.add_trips([_trip(day, n, vendor=1 + n % 2) for n, day in enumerate(days)], "bronze")
    lake.add_weather(DAY_TWO)
    lake.silver(source_options={"maxFilesPerTrigger": 1})
    lake.gold("table", source_options={"maxFilesPerTrigger": 2})
    path, checkpoint = lake.folder("gold-table"), lake.folder("gold-table-c")
    ledger = read_ledger(spark, path)
    assert ledger.through + 1 >= batches
    for table in ("memory", "gold"):
        levels = [part.level for part in ledger.of(table)]
        assert max(levels) >= 1 and all(levels.count(level) < 2 * MERGED_AT_ONCE for level in levels)
    assert lake.gold_rows("table") == lake.batch_gold()

    memory = Memory(spark, f"{checkpoint}/remembered", ledger)
    far = spark.sql("SELECT array(DATE'2022-03-05', DATE'2023-09-06') AS days").first()["days"]
    earlier = memory.trips_of(far)
    merged = [file for file in earlier.inputFiles() if "/month=" in file]
    single = [part for part in memory.parts(TRIP) if part.level == 0]
    assert {Path(file).parent.name for file in merged} == {"month=2022-03", "month=2023-09"}
    assert len(merged) <= 2 * len(memory.parts(TRIP)) and len(single) < 2 * MERGED_AT_ONCE
    assert earlier.count() == sum(k % 12 == 2 for k in range(batches)) + sum(k % 12 == 8 for k in range(batches))
    assert "In(day, [2022-03-05,2023-09-06])" in plan_of(earlier.select("day"))

    # Late weather for both days finds all of their trips, whatever part they are in by now.
    lake.add_weather(("NYC", "2022-03-05", "1.0", "0.5"), ("NYC", "2023-09-06", "2.0", "0.5"))
    assert lake.gold("table") == lake.batch_gold()
    assert read_remembered(spark, path, checkpoint).count() == 3 * batches


def test_gold_lies_by_vendor_and_a_vendor_filter_prunes(spark, lake):
    lake.add_trips(TRIPS, "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE, DAY_TWO)
    lake.gold("table")
    folders = {path.name for path in Path(lake.folder("gold-table")).glob("vendor_id=*")}
    assert folders == {"vendor_id=1", "vendor_id=2", "vendor_id=3", "vendor_id=__HIVE_DEFAULT_PARTITION__"}
    one = read_gold(spark, lake.folder("gold-table")).where("vendor_id = '2'")
    assert "(vendor_id" in plan_of(one).split("PartitionFilters")[1]
    assert {Path(file).parents[1].name for file in one.inputFiles()} >= {"vendor_id=2"} and one.count() == 4


def test_replaced_parts_are_deleted_some_batches_later(spark, lake, monkeypatch):
    from fareloom.streaming import parts

    monkeypatch.setattr(parts, "KEPT_AFTER", 1)
    monkeypatch.setattr(parts, "MERGED_AT_ONCE", 2)
    monkeypatch.setattr(parts, "KEPT_FILES", 3)
    lake.add_weather(DAY_ONE, DAY_TWO)
    for k in range(0, len(TRIPS), 3):
        lake.add_trips(TRIPS[k : k + 3], "bronze")
    lake.silver(source_options={"maxFilesPerTrigger": 1})
    assert lake.gold("table", source_options={"maxFilesPerTrigger": 1}) == lake.batch_gold()
    there = {path.name for path in Path(lake.folder("gold-table")).rglob("part=*")}
    ledger = read_ledger(spark, lake.folder("gold-table"))
    assert len(there) <= len(ledger.of("gold")) + 6
    assert len(list(Path(lake.folder("gold-table", "_parts")).glob("*.json"))) <= 3


def test_rows_behind_the_watermark_are_kept(spark, lake):
    """The watermark follows both streams, less their delays; late rows join nothing and none is lost."""
    lake.add_trips([_trip("2024-01-10", 1), _trip("2024-01-02", 2)], "bronze")
    lake.silver()
    lake.add_weather(("NYC", "2024-01-12", "1.0", "0.5"), DAY_TWO, DAY_ONE)
    path, checkpoint = lake.folder("gold-bounded"), lake.folder("gold-bounded-c")
    delays = {"trip_delay": "2 days", "weather_delay": "5 days"}  # the watermark is the start of January 7
    assert len(lake.gold("bounded", **delays)) == 1
    lake.add_trips([_trip("2024-01-06", 3), _trip("2024-01-07", 4), _trip("2024-01-01", 5), _trip("2024-01-12", 6)], "bronze")
    lake.silver()
    lake.add_weather(("NYC", "2024-01-05", "3.0", "1.0"), ("NYC", "2024-01-07", "4.0", "1.0"))
    rows = lake.gold("bounded", **delays)
    assert sorted(str(row[2].date()) for row in rows) == ["2024-01-02", "2024-01-07", "2024-01-12"]
    late = read_late(spark, path, checkpoint).collect()
    assert sorted((r["batch_id"], r["is_trip"], str(r["day"])) for r in late) == [
        (1, False, "2024-01-05"), (1, True, "2024-01-01"), (1, True, "2024-01-06")
    ]
    assert read_remembered(spark, path, checkpoint).count() + 2 == 6
    # A restart goes on with the same watermark.
    lake.add_trips([_trip("2024-01-01", 7)], "bronze")
    lake.silver()
    assert lake.gold("bounded", **delays) == rows
    assert read_late(spark, path, checkpoint).where("batch_id = 2").count() == 1


def test_bounded_memory_forgets_days_behind_the_watermark(spark, lake, monkeypatch):
    from fareloom.streaming import parts

    monkeypatch.setattr(parts, "MERGED_AT_ONCE", 2)
    lake.add_weather(*(("NYC", f"2024-02-{d:02d}", "1.0", "0.5") for d in range(1, 29)))
    for d in range(1, 9):
        lake.add_trips([_trip(f"2024-02-{d:02d}", 1)], "bronze")
    lake.silver(source_options={"maxFilesPerTrigger": 1})
    # A limit on batches is refused in this mode, so the files are offered one after the other.
    for k, file in enumerate(sorted(Path(lake.folder("silver")).rglob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)):
        day = spark.read.parquet(str(file))
        day.withColumn("vendor_id", F.lit(1)).write.mode("append").partitionBy("vendor_id").parquet(lake.folder("slowly"))
        jobs.run_gold(
            spark, lake.folder("slowly"), lake.folder("weather"), lake.folder("gold-b"), lake.folder("gold-b-c"), mode="bounded", **NOW
        )
    assert lake.gold_rows("b") == lake.batch_gold()
    days = {str(r["day"]) for r in read_remembered(spark, lake.folder("gold-b"), lake.folder("gold-b-c")).collect()}
    assert "2024-02-08" in days and not days & {"2024-02-01", "2024-02-02"}
    assert read_late(spark, lake.folder("gold-b"), lake.folder("gold-b-c")).count() == 0


def test_unknown_mode_is_refused(spark, folder):
    with pytest.raises(ValueError):
        jobs.run_gold(spark, "a", "b", "c", "d", mode="sideways")


def test_streaming_zone_lookup_uses_the_static_dimension(spark, lake, folder):
    from fareloom.operators.zones import add_zone_names
    from fareloom.sources.readers import stream_trips
    from tests.conftest import zone_table

    lake.add_trips([_trip("2024-01-01", 1, PULocationID=1, DOLocationID=9)])
    named = add_zone_names(stream_trips(spark, folder("raw"), UNENRICHED), zone_table(spark, [(1, "A")]))
    query = named.writeStream.format("parquet").option("checkpointLocation", folder("c"))
    query.trigger(**ONCE_OVER_ALL_INPUT).start(folder("out")).awaitTermination()
    row = spark.read.parquet(folder("out")).first()
    assert (row["pickup_location"], row["drop_off_location"]) == ("A", None)


def test_the_stream_join_remembers_bundles_of_trips(spark, lake):
    """2,000 trips of two days are a few rows of the state; a checkpoint that began with single trips keeps to them."""
    lake.add_trips([*(_trip("2024-01-01", i % 40) for i in range(1600)), *TRIPS[12:], *[_trip("2024-01-02", 1)] * 400], "bronze")
    lake.silver()
    lake.add_weather(DAY_ONE, DAY_ONE_AGAIN, DAY_TWO)
    assert lake.gold("stream", salts=2) == lake.batch_gold()
    assert len(lake.batch_gold()) == 2 * 1600 + 405
    trips, weather = stream_silver(spark, lake.folder("silver")), stream_weather(spark, lake.folder("weather")).select(*WEATHER_SIDE)
    written = {}
    for bundles in (True, False):
        query = to_gold(join_streams(trips, weather, 2, bundles=bundles)).writeStream.format("noop")
        query = query.option("checkpointLocation", lake.folder(f"c-{bundles}")).trigger(**ONCE_OVER_ALL_INPUT).start()
        query.awaitTermination()
        written[bundles] = sum(operator["numRowsUpdated"] for p in query.recentProgress for operator in p["stateOperators"])
    assert written[False] >= 2005 and written[True] <= 40
    assert pinned_bundles(spark, lake.folder("gold-stream-c")) and not pinned_bundles(spark, lake.folder("c-False"))


def test_bundles_hold_every_dated_trip_of_one_day_each(spark, folder):
    rows = [(str(i % 3), at(f"2024-01-{1 + i % 2:02d}T10:00:00") if i % 5 else None, i) for i in range(3000)]
    trips = spark.createDataFrame(rows, "vendor_id string, drop_off_timestamp timestamp, payment_type long").coalesce(1)
    bundles = bundle_trips(trips)
    assert rows_of(bundles.selectExpr("inline(bundle)")) == rows_of(trips.where("drop_off_timestamp IS NOT NULL"))
    assert bundles.selectExpr("day", "inline(bundle)").where("day <> to_date(drop_off_timestamp)").count() == 0
    sizes = [len(r["bundle"]) for r in bundles.collect()]
    assert max(sizes) <= BUNDLED_TRIPS and len(sizes) == 2 * -(-1200 // BUNDLED_TRIPS)
    assert bundle_trips(trips.limit(0)).count() == 0


def test_rows_are_not_sorted_to_be_laid_out_by_vendor(spark, lake):
    """Vendors come mixed; a task writes them to their folders as they come, in the order it has read them."""
    session = isolated_session(spark)
    raw_trips(spark, [_trip("2024-01-01", i, vendor=1 + i % 3) for i in range(30)]).coalesce(1).write.parquet(lake.folder("bronze"))
    jobs.run_silver(session, lake.folder("bronze"), lake.folder("silver"), lake.folder("silver-c"), **NOW)
    assert int(session.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 8
    assert int(session.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("m")) <= 64
    for vendor in (1, 2, 3):
        files = list(Path(lake.folder("silver")).glob(f"vendor_id={vendor}/*.parquet"))
        assert len(files) == 1
        passengers = [r["passenger_count"] for r in spark.read.parquet(str(files[0])).collect()]
        assert passengers == [float(i) for i in range(30) if 1 + i % 3 == vendor]


def test_a_batch_is_remembered_in_small_splits(spark, lake, monkeypatch):
    """A task sorts one split of the arriving files, however large the session's splits are."""
    monkeypatch.setattr(remembered, "KEPT_SPLIT", "2k")
    silver_trips(spark, [{"vendor_id": "1", "drop_off_timestamp": at("2024-01-01T10:00:00"), "passenger_count": float(i)} for i in range(20)]).repartition(
        10
    ).write.partitionBy("vendor_id").parquet(lake.folder("silver"))
    lake.add_weather(DAY_ONE)
    session = isolated_session(spark, {"spark.sql.files.maxPartitionBytes": "64m", "spark.sql.files.openCostInBytes": "1k"})
    jobs.run_gold(session, lake.folder("silver"), lake.folder("weather"), lake.folder("gold"), lake.folder("gold-c"), **NOW)
    kept = list(Path(lake.folder("gold-c")).glob("remembered/part=*/kind=trip/*.parquet"))
    assert len(kept) >= 5
    assert read_gold(spark, lake.folder("gold")).count() == 20
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "64m"


def test_what_arrives_is_sorted_by_its_day_alone(spark, lake, monkeypatch):
    """A file of each kind is open at once, whatever the session says, so the sort compares numbers and no texts."""
    frame, orders = type(spark.range(1)), []
    sort = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda rows, *columns: orders.append(columns) or sort(rows, *columns))
    days = [1 + 7 * i % 28 for i in range(28)]
    silver_trips(
        spark, [{"vendor_id": "1", "drop_off_timestamp": at(f"2024-01-{day:02d}T10:00:00"), "fare_amount": 1.0} for day in days for _ in range(20)]
    ).coalesce(1).write.partitionBy("vendor_id").parquet(lake.folder("silver"))
    lake.add_weather(DAY_TWO, DAY_ONE)
    session = isolated_session(spark, {remembered._OPEN_FILES: "0"})
    jobs.run_gold(session, lake.folder("silver"), lake.folder("weather"), lake.folder("gold"), lake.folder("gold-c"), **NOW)
    assert orders == [("day",)]
    for kind, rows in (("trip", len(days) * 20), ("weather", 2)):
        (file,) = Path(lake.folder("gold-c")).glob(f"remembered/part=*/kind={kind}/*.parquet")
        kept = [r["day"] for r in spark.read.parquet(str(file)).select("day").collect()]
        assert len(kept) == rows and kept == sorted(kept)
    assert session.conf.get(remembered._OPEN_FILES) == "0"

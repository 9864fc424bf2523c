"""Layouts that get wider, and files that are archived once they are read."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fareloom.__main__ import main
from fareloom.jobs import run_bronze, run_silver
from fareloom.schemas import RAW
from fareloom.sources.evolution import agreed_schema, publish_schema, published_schema, read_schema
from fareloom.sources.readers import archived_to, read_bronze, read_silver
from fareloom.streaming.sinks import ONCE_OVER_ALL_INPUT
from tests.conftest import at, raw_trips

ROW = {"VendorID": 1, "tpep_pickup_datetime": at("2024-01-01T10:00:00"), "tpep_dropoff_datetime": at("2024-01-01T11:00:00")}
NARROW = StructType(RAW.fields[:-1])
WIDE = StructType(list(RAW.fields)).add("cbd_fee", "double")


def _retyped(name, data_type):
    return StructType([StructField(f.name, data_type) if f.name == name else f for f in RAW])


def test_versions(spark, folder):
    table = folder("table")
    assert published_schema(spark, table) is None
    assert agreed_schema(spark, table, None, RAW) == RAW
    assert publish_schema(spark, table, None, RAW) == RAW
    assert publish_schema(spark, table, WIDE, RAW) == WIDE
    assert publish_schema(spark, table, None, RAW) == published_schema(spark, table) == WIDE
    assert len(list(Path(table, "_schema").glob("*.json"))) == 2
    for narrower in (RAW, NARROW):
        with pytest.raises(ValueError, match="lacks"):
            publish_schema(spark, table, narrower, RAW)
    assert published_schema(spark, table) == WIDE


def test_types_may_only_widen(spark, folder):
    table = folder("table")
    publish_schema(spark, table, RAW, RAW)
    with pytest.raises(ValueError, match="VendorID is integer in .* cannot become string"):
        publish_schema(spark, table, _retyped("VendorID", RAW["store_and_fwd_flag"].dataType), RAW)
    with pytest.raises(ValueError, match="cannot become integer"):
        publish_schema(spark, table, _retyped("fare_amount", RAW["VendorID"].dataType), RAW)
    publish_schema(spark, table, _retyped("PULocationID", LongType()), RAW)
    with pytest.raises(ValueError, match="PULocationID is long"):
        publish_schema(spark, table, RAW, RAW)


def _files(root):
    return sorted(p.name for p in Path(root).rglob("*.parquet"))


def test_both_jobs_get_wider_from_the_command_line(spark, folder):
    def run(job, source, output, *more):
        paths = ["--input-path", folder(source), "--output-path", folder(output)]
        main([job, *paths, "--checkpoint-location", folder(f"{output}-c"), "--once", *more])

    def both(*more):
        run("bronze", "raw", "bronze", *more)
        run("silver", "bronze", "silver", *more)

    raw_trips(spark, [ROW]).coalesce(1).write.parquet(folder("raw"))
    both()
    # A new column, and ids that need more bits.
    wide = _retyped("PULocationID", LongType()).add("cbd_fee", "double")
    text = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wide)
    Path(folder("wide.ddl")).write_text(text)
    Path(folder("wide.json")).write_text(wide.json())
    assert read_schema(spark, folder("wide.ddl")) == read_schema(spark, folder("wide.json")) == wide
    newer = raw_trips(spark, [ROW]).withColumns({"PULocationID": F.lit(2**40), "cbd_fee": F.lit(0.75)})
    newer.coalesce(1).write.mode("append").parquet(folder("raw"))
    both("--schema", folder("wide.ddl"))
    newer.coalesce(1).write.mode("append").parquet(folder("raw"))
    both()  # the table knows by now
    rows = read_bronze(spark, folder("bronze"), schema=None)
    assert rows.schema == wide
    found = sorted((tuple(r) for r in rows.select("PULocationID", "cbd_fee").collect()), key=repr)
    assert found == [(2**40, 0.75), (2**40, 0.75), (None, None)]
    assert read_silver(spark, folder("silver")).count() == 3
    Path(folder("raw.json")).write_text(RAW.json())
    for job, source, output in (("bronze", "raw", "bronze"), ("silver", "bronze", "silver")):
        with pytest.raises(ValueError, match="cannot become integer|lacks"):
            run(job, source, output, "--schema", folder("raw.json"))
    with pytest.raises(ValueError, match="no schema file"):
        run("bronze", "raw", "bronze", "--schema", folder("nowhere"))


def test_files_are_archived_and_no_row_is_lost(spark, folder):
    def bronze(options):
        run_bronze(
            spark, folder("raw"), folder("bronze"), folder("bronze-c"),
            trigger=ONCE_OVER_ALL_INPUT, source_options=options,
        )

    options = {"maxFilesPerTrigger": 1, **archived_to(folder("old"))}
    for _ in range(3):
        raw_trips(spark, [ROW, ROW]).coalesce(1).write.mode("append").parquet(folder("raw"))
    names = _files(folder("raw"))
    bronze(options)
    raw_trips(spark, [ROW, ROW]).coalesce(1).write.mode("append").parquet(folder("raw"))
    bronze(options)
    bronze(options)
    assert read_bronze(spark, folder("bronze")).count() == 8
    # Every file is in one of the two places, and those of the first run have moved.
    archived = _files(folder("old"))
    assert set(archived).isdisjoint(_files(folder("raw")))
    assert len(archived) + len(_files(folder("raw"))) == 4
    assert len(set(archived) & set(names)) >= 2


def test_a_table_of_a_sink_cannot_be_cleaned(spark, folder):
    raw_trips(spark, [ROW]).write.parquet(folder("raw"))
    run_bronze(spark, folder("raw"), folder("bronze"), folder("bronze-c"), trigger=ONCE_OVER_ALL_INPUT)
    with pytest.raises(Exception, match="(?i)clean"):
        run_silver(
            spark, folder("bronze"), folder("silver"), folder("silver-c"),
            trigger=ONCE_OVER_ALL_INPUT, source_options=archived_to(folder("old")),
        )

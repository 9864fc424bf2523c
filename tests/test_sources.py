"""Readers over edge-case files."""

import pytest
from pyspark.sql import functions as F

from fareloom.schemas import RAW, SILVER, WEATHER, WEATHER_COLUMNS
from fareloom.sources.readers import read_bronze, read_silver, read_trips, read_weather, read_zones, stream_silver
from tests.conftest import at, plan_of, raw_trips, silver_trips, weather_rows

TRIP = {"VendorID": 1, "tpep_dropoff_datetime": at("2024-01-01T10:00:00"), "fare_amount": 1.0}


def test_layouts_have_the_expected_width():
    assert (len(RAW), len(SILVER), len(WEATHER)) == (21, 8, 33)
    assert all(field.nullable for field in RAW)


def test_zone_text_na_is_null(spark, folder):
    with open(folder("zones.csv"), "w") as file:
        file.write('"LocationID","Borough","Zone","service_zone"\n264,"Unknown","N/A","N/A"\n265,"N/A","Outside","N/A"\n')
    rows = read_zones(spark, folder("zones.csv")).orderBy("LocationID").collect()
    assert [tuple(r) for r in rows] == [(264, "Unknown", None, None), (265, None, "Outside", None)]


def test_bronze_schema_drops_extra_and_fills_missing_columns(spark, folder):
    extra = raw_trips(spark, [TRIP]).withColumn("surprise", F.lit(1)).drop("extra")
    extra.write.parquet(folder("bronze"))
    row = read_bronze(spark, folder("bronze")).first()
    assert row.__fields__ == RAW.fieldNames()
    assert row["extra"] is None and row["fare_amount"] == 1.0
    assert "surprise" in read_trips(spark, folder("bronze")).columns


def test_merged_bronze_shows_null_for_older_rows(spark, folder):
    raw_trips(spark, [TRIP]).write.parquet(folder("bronze"))
    raw_trips(spark, [TRIP]).withColumn("surge", F.lit(2.0)).write.mode("append").parquet(folder("bronze"))
    merged = read_bronze(spark, folder("bronze"), schema=None)
    assert sorted((r["surge"] for r in merged.collect()), key=str) == [2.0, None]


def test_weather_is_positional_and_a_swapped_header_is_an_error(spark, folder):
    rows = weather_rows(spark, [("NYC", "2024-01-01", "5.0", "1.0")])
    rows.write.option("header", True).csv(folder("good"))
    assert str(read_weather(spark, folder("good")).first()["date"]) == "2024-01-01"
    swapped = [*WEATHER_COLUMNS]
    swapped[2], swapped[3] = swapped[3], swapped[2]
    rows.select(*swapped).write.option("header", True).csv(folder("bad"))
    with pytest.raises(Exception, match="(?i)header"):
        read_weather(spark, folder("bad")).collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_weather(spark, folder("bad")).select("date", "tempmax").collect()


def test_vendor_comes_back_as_text_from_the_folders(spark, folder):
    vendors = [1, 2, None]
    silver = silver_trips(spark, [{"fare_amount": float(i)} for i in range(3)])
    numbered = silver.withColumn("vendor_id", F.element_at(F.array(*map(F.lit, vendors)), F.col("fare_amount").cast("int") + 1))
    numbered.write.partitionBy("vendor_id").parquet(folder("silver"))
    read = read_silver(spark, folder("silver"))
    assert read.columns == SILVER.fieldNames()
    assert sorted((r["vendor_id"] for r in read.collect()), key=str) == ["1", "2", None]
    assert stream_silver(spark, folder("silver")).schema == read.schema


def test_vendor_filter_prunes_folders_and_fare_filter_reaches_the_scan(spark, folder):
    silver_trips(spark, [{"vendor_id": "1", "fare_amount": 1.0}]).write.partitionBy("vendor_id").parquet(folder("s"))
    plan = plan_of(read_silver(spark, folder("s")).where("vendor_id = '1' AND fare_amount > 0"))
    assert "PartitionFilters: [isnotnull(vendor_id" in plan
    assert "GreaterThan(fare_amount,0.0)" in plan

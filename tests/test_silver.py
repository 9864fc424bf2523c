"""Rename and prune."""

import pytest
from pyspark.errors import AnalysisException

from fareloom.operators.silver import rename_to_silver, to_silver
from fareloom.schemas import RAW, SILVER
from tests.conftest import at, plan_of, raw_trips

ROW = {
    "VendorID": 2,
    "tpep_pickup_datetime": at("2024-01-01T10:00:00"),
    "tpep_dropoff_datetime": at("2024-01-01T10:20:00"),
    "passenger_count": 1.0,
    "payment_type": 1,
    "fare_amount": 12.5,
    "pickup_location": "A",
    "drop_off_location": "B",
}


def test_three_columns_are_renamed_and_the_rest_stay(spark):
    renamed = rename_to_silver(raw_trips(spark, [ROW]))
    changed = {"VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime"}
    assert set(RAW.fieldNames()) - set(renamed.columns) == changed
    assert len(renamed.columns) == len(RAW)


def test_silver_has_eight_columns_in_order(spark):
    silver = to_silver(raw_trips(spark, [ROW]))
    assert silver.columns == SILVER.fieldNames()
    assert tuple(silver.first()) == tuple(ROW.values())
    assert silver.schema["vendor_id"].dataType.simpleString() == "int"


def test_a_missing_raw_column_passes_the_rename_and_fails_the_select(spark):
    short = raw_trips(spark, [ROW]).drop("fare_amount")
    assert "vendor_id" in rename_to_silver(short).columns
    with pytest.raises(AnalysisException):
        to_silver(short)


def test_the_scan_reads_only_silver_columns(spark, folder):
    raw_trips(spark, [ROW]).write.parquet(folder("raw"))
    plan = plan_of(to_silver(spark.read.parquet(folder("raw"))))
    assert plan.count("Project") <= 1
    assert "trip_distance" not in plan and "Exchange" not in plan

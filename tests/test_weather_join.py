"""Batch weather join."""

import pytest
from pyspark.sql import functions as F

from fareloom.operators.weather import WEATHER_SIDE, join_weather, to_gold, with_weather_day
from fareloom.schemas import GOLD
from tests.conftest import at, plan_of, rows_of, silver_trips, weather_rows


def _trip(name, pickup, drop_off):
    return {
        "vendor_id": "1",
        "pickup_location": name,
        "pickup_timestamp": at(pickup),
        "drop_off_timestamp": at(drop_off),
    }


def _gold(spark, trips, weather):
    joined = join_weather(silver_trips(spark, trips), with_weather_day(weather_rows(spark, weather)))
    return to_gold(joined).select("pickup_location", "tempmax")


def test_the_drop_off_day_decides(spark):
    trips = [
        _trip("over midnight", "2024-01-01T23:50:00", "2024-01-02T00:10:00"),
        _trip("no drop-off", "2024-01-02T10:00:00", None),
        _trip("no weather", "2024-01-05T10:00:00", "2024-01-05T10:10:00"),
    ]
    weather = [("NYC", "2024-01-01", "1.0", "0.0"), ("NYC", "2024-01-02", "2.0", "0.0")]
    assert rows_of(_gold(spark, trips, weather)) == [("over midnight", "2.0")]


def test_two_stations_repeat_the_trip(spark):
    trips = [_trip("a", "2024-01-01T10:00:00", "2024-01-01T10:10:00")]
    weather = [("X", "2024-01-01", "1.0", None), ("Y", "2024-01-01", "2.0", None)]
    assert rows_of(_gold(spark, trips, weather)) == [("a", "1.0"), ("a", "2.0")]


@pytest.mark.parametrize("text", ["bad", "", None, "2024-01-01T00:00", "2024-13-01"])
def test_bad_days_never_join(spark, text):
    weather = with_weather_day(weather_rows(spark, [("NYC", text, "1.0", "0.0")]))
    assert weather.first()["date"] is None
    trips = silver_trips(spark, [_trip("a", "2024-01-01T10:00:00", "2024-01-01T10:10:00")])
    assert join_weather(trips, weather).count() == 0


def test_gold_columns_and_text_vendor(spark):
    trips = silver_trips(spark, [_trip("a", "2024-01-01T10:00:00", "2024-01-01T10:10:00")])
    weather = with_weather_day(weather_rows(spark, [("NYC", "2024-01-01", "1.0", "0.0")]))
    joined = join_weather(trips.withColumn("vendor_id", F.lit(1)), weather)
    assert len(joined.columns) == 42
    gold = to_gold(joined)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in GOLD]


def test_small_weather_is_broadcast_and_pruned(spark, folder):
    weather_rows(spark, [("NYC", "2024-01-01", "1.0", "0.0")]).write.option("header", True).csv(folder("w"))
    silver_trips(spark, [_trip("a", "2024-01-01T10:00:00", "2024-01-01T10:10:00")]).write.parquet(folder("t"))
    from fareloom.sources.readers import read_silver, read_weather

    gold = to_gold(join_weather(read_silver(spark, folder("t")), read_weather(spark, folder("w"))))
    plan = plan_of(gold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "humidity" not in plan and "IsNotNull(drop_off_timestamp)" in plan


def test_a_hot_day_beyond_the_broadcast_bound_is_split(spark):
    """A third of the trips fall on one day."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        number = F.col("id")
        offset = F.when(number % 3 == 0, 0).otherwise(number % 90).cast("int")
        day = F.date_add(F.lit("2024-01-01").cast("date"), offset)
        trips = spark.range(0, 60000, 1, 8).select(
            F.lit("1").alias("vendor_id"),
            F.lit(None).cast("timestamp").alias("pickup_timestamp"),
            day.cast("timestamp").alias("drop_off_timestamp"),
            F.lit(1.0).alias("passenger_count"),
            F.lit(1).cast("long").alias("payment_type"),
            F.lit(1.0).alias("fare_amount"),
            F.sha2(number.cast("string"), 256).alias("pickup_location"),
            F.lit("b").alias("drop_off_location"),
        )
        days = [("NYC", f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", str(i), "0") for i in range(112)]
        weather = with_weather_day(weather_rows(spark, days)).select(*WEATHER_SIDE)
        split = to_gold(join_weather(trips, weather, max_broadcast_bytes=0))
        counted = split.groupBy("tempmax").count()
        whole = to_gold(join_weather(trips, weather)).groupBy("tempmax").count()
        assert rows_of(counted) == rows_of(whole)
        split.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(split)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

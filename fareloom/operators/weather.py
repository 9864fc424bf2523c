"""Trips joined with the weather of their drop-off day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.days import trip_day, weather_day
from fareloom.operators.sizing import MAX_BROADCAST_BYTES, fits_broadcast
from fareloom.schemas import GOLD

# What the gold table needs of a weather row; selecting these first keeps the other 31 out of any join state.
WEATHER_SIDE = ("date", "tempmax", "tempmin")


def with_weather_day(weather: DataFrame) -> DataFrame:
    return weather.withColumn("date", weather_day("datetime"))


def join_weather(trips: DataFrame, weather: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Inner join on the drop-off day with a static weather table; the trips may be static or streaming.

    A trip with no weather is left out and a day with several weather rows repeats its trips. Weather measured
    within the bound is broadcast, so the trips are not shuffled; beyond it both sides are shuffled by day and
    the adaptive plan splits a hot day.
    """
    if fits_broadcast(weather, max_broadcast_bytes):
        weather = F.broadcast(weather)
    return trips.join(weather, trip_day(trips["drop_off_timestamp"]) == weather["date"])


def to_gold(joined: DataFrame) -> DataFrame:
    """The ten gold columns in order; the vendor is text here, as in the partition folders it comes from."""
    return joined.withColumn("vendor_id", F.col("vendor_id").cast("string")).select(*GOLD.fieldNames())

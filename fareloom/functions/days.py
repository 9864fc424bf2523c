"""The two calendar days that trips and weather meet on."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"


def weather_day(text: str | Column) -> Column:
    """Day of a weather row. Text that is not a whole ``yyyy-MM-dd`` day becomes null and never joins."""
    return F.try_to_date(text, DAY_FORMAT)


def trip_day(moment: str | Column) -> Column:
    """Calendar day of a trip's drop-off time, in the session time zone."""
    return F.to_date(moment)

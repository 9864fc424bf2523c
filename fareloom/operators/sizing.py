"""Broadcast only what has been measured."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Room per value for the row format's null bits, offsets and padding.
_BYTES_PER_VALUE = 16


def row_bytes(df: DataFrame) -> Column:
    """Size of one row as it will sit in memory, rounded up."""
    width = F.lit(_BYTES_PER_VALUE * len(df.columns)).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return width


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows of a static frame, from one aggregate that returns a single number."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes

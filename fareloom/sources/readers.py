"""Static readers (``read_*``) and streaming readers (``stream_*``) over the same folders and schemas."""

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.operators.weather import with_weather_day
from fareloom.schemas import GOLD, RAW, SILVER, WEATHER, ZONES
from fareloom.sources.evolution import published_schema
from fareloom.streaming.parts import is_published
from fareloom.streaming.remembered import read_published_gold

# A header that is not in the expected order is an error instead of a silent mix-up.
WEATHER_OPTIONS = {"header": "true", "sep": ",", "enforceSchema": "false"}

# Spark's own limit of a week skips files that arrive late or are copied with their old time stamps. The price: the
# driver keeps the names of all files it has seen, some hundred bytes each, until it compacts its log.
MAX_FILE_AGE = "36500d"


def archived_to(folder: str) -> dict[str, str]:
    """Source options that move a file to ``folder``, below its own path, when a batch after its own is committed.

    The folder must not lie in the source. Only files that no other job reads should be moved; tables that Spark's file sink
    has written (bronze, silver) cannot be cleaned this way, and Spark says so.
    """
    return {"cleanSource": "archive", "sourceArchiveDir": folder}


def _ordered(df: DataFrame, schema: StructType) -> DataFrame:
    # A partition column is read from the folder name and would otherwise come last.
    return df.select(*schema.fieldNames())


def _stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str, options: dict[str, Any] | None
) -> DataFrame:
    # A Delta table brings its own schema and knows its files.
    if fmt == "delta":
        return spark.readStream.format(fmt).options(**(options or {})).load(path)
    return spark.readStream.format(fmt).options(**{"maxFileAge": MAX_FILE_AGE, **(options or {})}).schema(schema).load(path)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Raw trips as the files describe them, before enrichment."""
    return spark.read.parquet(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension, columns found by their header names; empty texts, ``N/A`` and ``NA`` mean no value.

    Other columns are left out. A file without one of the expected columns is an error.
    """
    raw = spark.read.option("header", True).csv(path)
    missing = [name for name in ZONES.fieldNames() if name not in raw.columns]
    if missing:
        raise ValueError(f"zone file without {', '.join(missing)}: {path}")
    value = {name: F.when(~F.trim(F.col(name)).isin("", "N/A", "NA"), F.col(name)) for name in ZONES.fieldNames()}
    return raw.select(*(value[field.name].cast(field.dataType).alias(field.name) for field in ZONES))


def stream_trips(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW,
    fmt: str = "parquet",
    options: dict[str, Any] | None = None,
) -> DataFrame:
    """Raw or bronze trips as they arrive in a folder.

    ``options`` are those of Spark's file source. ``maxBytesPerTrigger`` cuts a large backlog into batches that
    can be restarted one by one; ``maxFileAge`` (100 years unless given) skips files that are older than the newest by more.
    """
    return _stream(spark, path, schema, fmt, options)


def read_bronze(spark: SparkSession, path: str, schema: StructType | None = RAW) -> DataFrame:
    """Bronze rows. With ``schema=None`` in the layout that the table keeps, older rows showing null in newer columns.

    A table that keeps none has the columns of its files merged, which opens every file.
    """
    schema = schema or published_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return _ordered(spark.read.schema(SILVER).parquet(path), SILVER)


def stream_silver(
    spark: SparkSession, path: str, fmt: str = "parquet", options: dict[str, Any] | None = None
) -> DataFrame:
    """Silver trips as they are appended; ``vendor_id`` comes from the folder names, as text."""
    return _ordered(_stream(spark, path, SILVER, fmt, options), SILVER)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return with_weather_day(spark.read.options(**WEATHER_OPTIONS).schema(WEATHER).csv(path))


def stream_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather files as they arrive, however old their time stamps are: late weather counts."""
    return with_weather_day(_stream(spark, path, WEATHER, "csv", WEATHER_OPTIONS))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold rows, by vendor. Of a table written in parts only the published ones are read."""
    if is_published(spark, path):
        return read_published_gold(spark, path)
    return _ordered(spark.read.schema(GOLD).parquet(path), GOLD)

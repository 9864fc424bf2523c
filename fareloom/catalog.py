"""The bronze table as the catalog declares it: lower-case names, one folder per vendor."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.schemas import RAW

# Names in the catalog.
DATABASE = "taxi_data_db"
TABLE = "bronze_taxi_data"
PARTITION_COLUMN = "vendorid"

DATA_COLUMNS = StructType()
for _field in RAW:
    if _field.name.lower() != PARTITION_COLUMN:
        DATA_COLUMNS.add(_field.name.lower(), _field.dataType)


def to_catalog_layout(raw: DataFrame) -> DataFrame:
    """The table's columns; the vendor is text and comes last, as a folder name."""
    columns = [F.col(name).alias(name.lower()) for name in RAW.fieldNames() if name.lower() != PARTITION_COLUMN]
    return raw.select(*columns, F.col("VendorID").cast("string").alias(PARTITION_COLUMN))


def _plain(location: str) -> str:
    return re.sub(r"^file:/+", "/", location).rstrip("/")


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return _plain(described["data_type"])


def register_bronze(
    spark: SparkSession,
    location: str,
    database: str = DATABASE,
    table: str = TABLE,
    database_location: str | None = None,
) -> str:
    """Create database and external table where they are missing, pick up new vendor folders, return the name."""
    name = f"`{database}`.`{table}`"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in DATA_COLUMNS)
    place = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    if spark.catalog.tableExists(name) and _location(spark, name) != _plain(location):
        # The rows have moved, or a run was cut off between the two steps below. No file goes with the entry.
        spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        # Created over a folder that a stream has written, a table would lose its partition column; it is
        # therefore created over no folder and then pointed to the real one.
        spark.sql(
            f"CREATE TABLE {name} ({columns}, `{PARTITION_COLUMN}` string) "
            f"USING PARQUET PARTITIONED BY (`{PARTITION_COLUMN}`) LOCATION '{location}/_none'"
        )
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.recoverPartitions(name)
    return name

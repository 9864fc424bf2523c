"""Trips, zones and weather derived from the given tables, as frames and as staged files."""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.jobs import run_bronze, run_catalog, run_silver
from fareloom.operators.zones import add_zone_names
from fareloom.schemas import RAW, UNENRICHED, WEATHER_COLUMNS
from fareloom.session import isolated_session, scratch_folder
from fareloom.streaming.sinks import ONCE_OVER_ALL_INPUT

ROW_TAG = "l_orderkey"
SMALLEST_FILE, LARGEST_FILE = 25_000, 1_000_000  # rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as raw trips (times without zone); the order key is carried along as a row tag."""
    values = {
        "VendorID": "CAST(NULLIF(l_linenumber, 7) AS INT)",
        "tpep_pickup_datetime": "l_shipdate",
        "tpep_dropoff_datetime": "timestampadd(MINUTE, CAST((l_quantity - 5) * 30 AS INT), l_shipdate)",
        "passenger_count": "l_quantity",
        "trip_distance": "l_extendedprice",
        "RatecodeID": "CAST(l_linenumber AS DOUBLE)",
        "store_and_fwd_flag": "l_linestatus",
        "PULocationID": "CAST(l_suppkey % 27 AS INT)",
        "DOLocationID": "CAST(l_partkey % 27 AS INT)",
        "payment_type": "CAST(l_linenumber AS BIGINT)",
        "fare_amount": "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END",
        "extra": "l_tax",
        "mta_tax": "l_tax",
        "tip_amount": "l_discount",
        "tolls_amount": "l_tax",
        "improvement_surcharge": "l_discount",
        "total_amount": "l_extendedprice",
        "congestion_surcharge": "l_discount",
        "Airport_fee": "l_tax",
    }
    columns = [F.expr(values[name]).alias(name) for name in UNENRICHED.fieldNames()]
    return table(spark, sf_dir, "lineitem").select(ROW_TAG, *columns)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("n_regionkey").cast("string").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("all").alias("service_zone"),
    )


def weather(spark: SparkSession, sf_dir: str, stations: bool = False) -> DataFrame:
    """Orders per day read as weather, all text: one station, or one per order status."""
    name = F.col("o_orderstatus") if stations else F.lit("NYC")
    price = F.col("o_totalprice")
    measured = (
        table(spark, sf_dir, "orders")
        .groupBy(name.alias("name"), F.to_date("o_orderdate").cast("string").alias("datetime"))
        .agg(
            F.max(price).cast("decimal(18,2)").cast("string").alias("tempmax"),
            F.min(price).cast("decimal(18,2)").cast("string").alias("tempmin"),
        )
    )
    known = set(measured.columns)
    return measured.select(
        *(F.col(c) if c in known else F.lit(None).cast("string").alias(c) for c in WEATHER_COLUMNS)
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_zone_names(trips(spark, sf_dir), zones(spark, sf_dir))


def typed(df: DataFrame) -> DataFrame:
    """The raw table's own types: times become instants in the session time zone, the row tag goes."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW if f.name in df.columns))


def job_session(spark: SparkSession) -> SparkSession:
    """Settings of the streaming jobs, kept apart from the caller's; state is spread over all cores."""
    cores = str(spark.sparkContext.defaultParallelism)
    return isolated_session(spark, {"spark.sql.shuffle.partitions": cores})


def write_weather(df: DataFrame, folder: str) -> None:
    df.write.mode("append").option("header", True).csv(folder)


def files_a_batch(files: int, batches: int) -> int:
    """So many files a batch that all files take this number of batches at most, and one file a batch if they are few."""
    return max(-(-files // batches), 1)


# Staged inputs are made once per session and data folder and shared by all queries that read them.


@lru_cache(maxsize=None)
def staged_trips(spark: SparkSession, sf_dir: str) -> str:
    """Raw trips in several files, as they arrive: a task with a large share of the rows writes more than one."""
    folder = scratch_folder(spark, "trips")
    rows = table(spark, sf_dir, "lineitem").count()
    per_file = min(max(rows // (2 * spark.sparkContext.defaultParallelism), SMALLEST_FILE), LARGEST_FILE)
    raw = typed(enriched(job_session(spark), sf_dir))
    raw.write.option("maxRecordsPerFile", per_file).parquet(folder)
    return folder


@lru_cache(maxsize=None)
def staged_weather(spark: SparkSession, sf_dir: str, stations: bool = False) -> str:
    folder = scratch_folder(spark, "weather")
    write_weather(weather(job_session(spark), sf_dir, stations), folder)
    return folder


@lru_cache(maxsize=None)
def staged_bronze(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_folder(spark, "bronze")
    run_bronze(
        job_session(spark),
        staged_trips(spark, sf_dir),
        f"{folder}/table",
        f"{folder}/checkpoint",
        trigger=ONCE_OVER_ALL_INPUT,
    )
    return f"{folder}/table"


@lru_cache(maxsize=None)
def staged_silver(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_folder(spark, "silver")
    run_silver(
        job_session(spark),
        staged_bronze(spark, sf_dir),
        f"{folder}/table",
        f"{folder}/checkpoint",
        trigger=ONCE_OVER_ALL_INPUT,
    )
    return f"{folder}/table"


def catalog_table(spark: SparkSession, sf_dir: str) -> str:
    """Bronze trips laid out by vendor and registered under a name of their own."""
    folder = scratch_folder(spark, "catalog")
    return run_catalog(
        job_session(spark),
        staged_bronze(spark, sf_dir),
        f"{folder}/table",
        f"{folder}/checkpoint",
        database="fareloom_check",
        table="bronze_" + folder.rsplit("-", 1)[-1],
        database_location=f"{folder}/database",
    )

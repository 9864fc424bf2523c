"""The queries. Each reads the whole of its tables and returns a frame."""

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from fareloom.functions.days import trip_day
from fareloom.jobs import run_bronze, run_enrich, run_gold, run_silver
from fareloom.operators.quality import (
    TRIP_CONSTRAINTS,
    QualityError,
    is_complete,
    is_non_negative,
    passing_rows,
    quality_report,
    read_report,
    require_quality,
)
from fareloom.operators.silver import rename_to_silver, to_silver
from fareloom.operators.weather import WEATHER_SIDE, join_weather, to_gold
from fareloom.operators.zones import add_drop_off_zone, add_pickup_zone
from fareloom.plans import fixtures
from fareloom.schemas import RAW, UNENRICHED
from fareloom.session import matching_paths, scratch_folder, set_old_time
from fareloom.sources.readers import read_bronze, read_gold, read_silver, read_trips, read_weather, read_zones
from fareloom.streaming.remembered import read_late, read_remembered
from fareloom.streaming.sinks import ONCE_OVER_ALL_INPUT

Query = Callable[[SparkSession, str], DataFrame]

# Weather up to here is there for the first run of the late-weather queries, the rest for the second.
LATE_FROM = "1998-06-01"
# Trips from here on come in the first batch of the bounded query, the rest in the second; the watermark lies between.
BOUNDED_FROM = "1996-01-01"
BOUNDED_DELAY = "1200 days"
# Batches of each of the two runs of bronze in batches, and the most batches of the report.
BATCHES, REPORTED_BATCHES = 3, 8


def _without_zone(df: DataFrame) -> DataFrame:
    """Instants as plain UTC times, which compare the same wherever the result is collected."""
    utc = lambda name: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(name).cast("timestamp_ntz"))
    return df.select(
        *(utc(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else f.name for f in df.schema)
    )


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "raw")
    fixtures.trips(spark, sf_dir).write.parquet(folder)
    return read_trips(spark, folder)


def zones_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone file with its columns in another order and one more, an empty name and two that say there is none."""
    folder = scratch_folder(spark, "zones")
    number = F.col("LocationID")
    name = F.when(number == 24, "N/A").when(number == 23, "").when(number == 22, "NA").otherwise(F.col("Zone"))
    staged = fixtures.zones(spark, sf_dir).withColumn("Zone", name).withColumn("remark", F.lit("x"))
    staged = staged.select("Zone", "remark", "LocationID", "service_zone", "Borough")
    staged.write.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(folder)
    return read_zones(spark, folder)


def enrich_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_pickup_zone(fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir))


def enrich_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_drop_off_zone(fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir))


def enrich_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.enriched(spark, sf_dir)


def enrich_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with whole numbers and a zone file, through the enrichment job and the bronze job."""
    folder = scratch_folder(spark, "enriched")
    whole = {name: F.col(name).cast("long") for name in ("passenger_count", "RatecodeID", "VendorID", "PULocationID")}
    job = fixtures.job_session(spark)
    raw = fixtures.trips(job, sf_dir).drop(fixtures.ROW_TAG).withColumns(whole)
    raw.write.parquet(f"{folder}/raw")
    fixtures.zones(job, sf_dir).write.option("header", True).csv(f"{folder}/zones")
    run_enrich(job, f"{folder}/raw", f"{folder}/zones", f"{folder}/named")
    run_bronze(job, f"{folder}/named", f"{folder}/bronze", f"{folder}/checkpoint", trigger=ONCE_OVER_ALL_INPUT)
    return _without_zone(read_bronze(spark, f"{folder}/bronze"))


def silver_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_to_silver(fixtures.enriched(spark, sf_dir))


def silver_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(fixtures.enriched(spark, sf_dir))


def _weather_days(stations: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        weather = read_weather(spark, fixtures.staged_weather(spark, sf_dir, stations))
        return weather.select("name", "datetime", "tempmax", "tempmin", "date")

    return query


def trip_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.trips(spark, sf_dir).select(
        fixtures.ROW_TAG,
        trip_day("tpep_pickup_datetime").alias("pickup_day"),
        trip_day("tpep_dropoff_datetime").alias("drop_off_day"),
    )


def _gold(stations: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = to_silver(fixtures.enriched(spark, sf_dir))
        weather = read_weather(spark, fixtures.staged_weather(spark, sf_dir, stations)).select(*WEATHER_SIDE)
        return to_gold(join_weather(silver, weather))

    return query


def _passing(position: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return passing_rows(rename_to_silver(fixtures.trips(spark, sf_dir)), TRIP_CONSTRAINTS[position])

    return query


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(rename_to_silver(fixtures.trips(spark, sf_dir)))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: how many constraints the gate names when it stops the trips, and whether it does."""
    rejected, named = False, 0
    try:
        require_quality(rename_to_silver(fixtures.trips(spark, sf_dir)))
    except QualityError as error:
        rejected, named = True, sum(constraint.name in str(error) for constraint in TRIP_CONSTRAINTS)
    row = spark.range(1).select(F.lit(named).cast("long").alias("failed_constraints"))
    return row.withColumn("rejected", F.lit(rejected))


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(read_bronze(spark, fixtures.staged_bronze(spark, sf_dir)))


def stream_bronze_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in three batches of equally many files, stopped and started again, with an old time stamp on a file that comes later.

    A file is written by one task and has ``LARGEST_FILE`` rows at most, so small tables have one file a batch."""
    folder = scratch_folder(spark, "bronze-batches")
    job = fixtures.job_session(spark)
    staged = job.read.schema(RAW).parquet(fixtures.staged_trips(spark, sf_dir))
    files = fixtures.files_a_batch(staged.count(), 2 * BATCHES * fixtures.LARGEST_FILE)
    for part in (0, 1):
        rows = staged.where(F.pmod(F.xxhash64(*RAW.fieldNames()), F.lit(2)) == part)
        rows.repartition(BATCHES * files).write.mode("append").parquet(f"{folder}/raw")
        if part:
            set_old_time(spark, f"{folder}/raw")
        run_bronze(
            job,
            f"{folder}/raw",
            f"{folder}/table",
            f"{folder}/checkpoint",
            trigger=ONCE_OVER_ALL_INPUT,
            source_options={"maxFilesPerTrigger": files},
        )
    return _without_zone(read_bronze(spark, f"{folder}/table"))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(read_silver(spark, fixtures.staged_silver(spark, sf_dir)))


def silver_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows by their vendor folder: the vendor is text, and rows of no vendor keep theirs as null."""
    silver = read_silver(spark, fixtures.staged_silver(spark, sf_dir))
    return silver.select("vendor_id", "payment_type", "fare_amount", "pickup_location")


def _stream_gold(mode: str, stations: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_folder(spark, f"gold-{mode}")
        run_gold(
            fixtures.job_session(spark),
            fixtures.staged_silver(spark, sf_dir),
            fixtures.staged_weather(spark, sf_dir, stations),
            f"{folder}/table",
            f"{folder}/checkpoint",
            mode=mode,
            trigger=ONCE_OVER_ALL_INPUT,
        )
        return _without_zone(read_gold(spark, f"{folder}/table"))

    return query


def _stream_gold_late_weather(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_folder(spark, f"gold-late-{mode}")
        weather = fixtures.weather(spark, sf_dir)
        for run, arrived in enumerate((F.col("datetime") < LATE_FROM, F.col("datetime") >= LATE_FROM), 1):
            fixtures.write_weather(weather.where(arrived), f"{folder}/weather")
            run_gold(
                fixtures.job_session(spark),
                fixtures.staged_silver(spark, sf_dir),
                f"{folder}/weather",
                f"{folder}/table",
                f"{folder}/checkpoint",
                mode=mode,
                trigger=ONCE_OVER_ALL_INPUT,
            )
            # The rows there are after each run; the second run adds to the same table.
            seen = read_gold(spark, f"{folder}/table").withColumn("run", F.lit(run))
            seen.write.mode("append").parquet(f"{folder}/seen")
        return _without_zone(spark.read.parquet(f"{folder}/seen"))

    return query


def stream_gold_bounded_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips before a day come a batch too late for the bounded mode: for each batch the trips that arrived, those that may
    join, those behind the watermark, and the gold rows there are after it."""
    folder = scratch_folder(spark, "gold-bounded-late")
    job = fixtures.job_session(spark)
    # Written as they are made: each batch is a part of the trips, so a table staged for other queries would be written again.
    made = to_silver(fixtures.typed(fixtures.enriched(job, sf_dir))).where("drop_off_timestamp IS NOT NULL")
    newer = F.to_date("drop_off_timestamp") >= BOUNDED_FROM
    for run, arriving in enumerate((newer, ~newer)):
        made.where(arriving).write.mode("append").partitionBy("vendor_id").parquet(f"{folder}/silver")
        run_gold(
            job,
            f"{folder}/silver",
            fixtures.staged_weather(spark, sf_dir),
            f"{folder}/table",
            f"{folder}/checkpoint",
            mode="bounded",
            trip_delay=BOUNDED_DELAY,
            weather_delay=BOUNDED_DELAY,
            trigger=ONCE_OVER_ALL_INPUT,
        )
        seen = read_gold(job, f"{folder}/table").agg(F.count("*").alias("gold")).withColumn("batch_id", F.lit(run).cast("long"))
        seen.write.mode("append").parquet(f"{folder}/seen")
    by_batch = lambda rows, name: rows.groupBy("batch_id").agg(F.count("*").alias(name))
    silver = read_silver(job, f"{folder}/silver")
    arrived = by_batch(silver.select(F.when(newer, 0).otherwise(1).cast("long").alias("batch_id")), "arrived")
    candidates = by_batch(read_remembered(job, f"{folder}/table", f"{folder}/checkpoint"), "candidates")
    late = by_batch(read_late(job, f"{folder}/table", f"{folder}/checkpoint").where("is_trip"), "late")
    counted = arrived.join(candidates, "batch_id", "left").join(late, "batch_id", "left").join(job.read.parquet(f"{folder}/seen"), "batch_id")
    return counted.na.fill(0, ["candidates", "late"])


def stream_gold_table_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default mode over batches of few files, enough of them that parts of closed batches are merged."""
    folder = scratch_folder(spark, "gold-table-batches")
    job = fixtures.job_session(spark)
    silver = read_silver(job, fixtures.staged_silver(spark, sf_dir))
    silver.repartition(9).write.partitionBy("vendor_id").parquet(f"{folder}/silver")
    run_gold(
        job,
        f"{folder}/silver",
        fixtures.staged_weather(spark, sf_dir),
        f"{folder}/table",
        f"{folder}/checkpoint",
        trigger=ONCE_OVER_ALL_INPUT,
        source_options={"maxFilesPerTrigger": 7},
    )
    return _without_zone(read_gold(spark, f"{folder}/table"))


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the silver job keeps of each batch, summed over its batches: of one file each, or of more if they were too many."""
    folder = scratch_folder(spark, "silver-report")
    bronze = fixtures.staged_bronze(spark, sf_dir)
    files = len(matching_paths(spark, f"{bronze}/*.parquet"))
    run_silver(
        fixtures.job_session(spark),
        bronze,
        f"{folder}/table",
        f"{folder}/checkpoint",
        validation="report",
        report=f"{folder}/report",
        trigger=ONCE_OVER_ALL_INPUT,
        source_options={"maxFilesPerTrigger": fixtures.files_a_batch(files, REPORTED_BATCHES)},
    )
    kept = read_report(spark, f"{folder}/report")
    of = lambda c, value: F.sum(F.when(F.col("constraint") == c.name, F.col(value)))
    passed = [of(c, "passed").alias(f"passed_{i}") for i, c in enumerate(TRIP_CONSTRAINTS)]
    return kept.agg(of(TRIP_CONSTRAINTS[0], "total").alias("total"), *passed)


def stream_gate_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows behind a gate whose constraints all rows pass."""
    folder = scratch_folder(spark, "silver-gate-open")
    run_silver(
        fixtures.job_session(spark),
        fixtures.staged_bronze(spark, sf_dir),
        f"{folder}/table",
        f"{folder}/checkpoint",
        validation="fail",
        constraints=(is_complete("payment_type"), is_non_negative("passenger_count")),
        trigger=ONCE_OVER_ALL_INPUT,
    )
    return _without_zone(read_silver(spark, f"{folder}/table"))


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: did the gate stop the silver stream, and how many rows reached its table?"""
    folder = scratch_folder(spark, "silver-gate")
    rejected = False
    try:
        run_silver(
            fixtures.job_session(spark),
            fixtures.staged_bronze(spark, sf_dir),
            f"{folder}/table",
            f"{folder}/checkpoint",
            validation="fail",
            trigger=ONCE_OVER_ALL_INPUT,
        )
    except StreamingQueryException as error:
        if "data quality check has failed" not in str(error):
            raise
        rejected = True
    written = read_silver(spark, f"{folder}/table")
    return written.agg(F.count(F.lit(1)).alias("rows_written")).withColumn("rejected", F.lit(rejected))


def bronze_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips go through the bronze job twice: with a schema before the zone names, and after a restart with them."""
    folder = scratch_folder(spark, "evolution")
    job = fixtures.job_session(spark)
    # Written as they are made: a copy staged for other queries would be one more write of all rows.
    arriving = ((UNENRICHED, fixtures.trips(job, sf_dir)), (RAW, fixtures.enriched(job, sf_dir)))
    for schema, rows in arriving:
        fixtures.typed(rows).write.mode("append").parquet(f"{folder}/raw")
        run_bronze(
            job, f"{folder}/raw", f"{folder}/table", f"{folder}/checkpoint", schema=schema, trigger=ONCE_OVER_ALL_INPUT
        )
    return _without_zone(read_bronze(spark, f"{folder}/table", schema=None))


def catalog_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(spark.table(fixtures.catalog_table(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "bronze_scan": bronze_scan,
    "zones_csv": zones_csv,
    "enrich_pickup": enrich_pickup,
    "enrich_dropoff": enrich_dropoff,
    "enrich_zones": enrich_zones,
    "enrich_roundtrip": enrich_roundtrip,
    "silver_rename": silver_rename,
    "silver_select": silver_select,
    "weather_day": _weather_days(stations=False),
    "weather_day_stations": _weather_days(stations=True),
    "trip_day": trip_days,
    "gold_join": _gold(stations=False),
    "gold_join_fanout": _gold(stations=True),
    "dq_complete": _passing(0),
    "dq_nonneg": _passing(1),
    "dq_order": _passing(2),
    "dq_report": dq_report,
    "dq_gate": dq_gate,
    "stream_bronze": stream_bronze,
    "stream_bronze_batches": stream_bronze_batches,
    "stream_silver": stream_silver,
    "stream_report": stream_report,
    "stream_gate": stream_gate,
    "stream_gate_open": stream_gate_open,
    "silver_partition_read": silver_partition_read,
    "stream_gold": _stream_gold("stream"),
    "stream_gold_fanout": _stream_gold("stream", stations=True),
    "stream_gold_bounded": _stream_gold("bounded"),
    "stream_gold_static": _stream_gold("static"),
    "stream_gold_table": _stream_gold("table"),
    "stream_gold_late_weather": _stream_gold_late_weather("stream"),
    "stream_gold_table_late_weather": _stream_gold_late_weather("table"),
    "stream_gold_bounded_late": stream_gold_bounded_late,
    "stream_gold_table_batches": stream_gold_table_batches,
    "bronze_evolution": bronze_evolution,
    "catalog_bronze": catalog_bronze,
}

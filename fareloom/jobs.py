"""The jobs. The streaming ones are coupled only by the folders they read and write."""

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, IntegralType, StringType, StructType

from fareloom import catalog
from fareloom.operators.quality import TRIP_CONSTRAINTS, Constraint, observe_quality, validate
from fareloom.operators.silver import to_silver
from fareloom.operators.weather import WEATHER_SIDE, join_weather, to_gold
from fareloom.operators.zones import add_zone_names
from fareloom.schemas import RAW
from fareloom.session import TIME_ZONE, pinned_session
from fareloom.sources.evolution import agreed_schema, publish_schema
from fareloom.sources.readers import (
    read_trips,
    read_weather,
    read_zones,
    stream_silver,
    stream_trips,
    stream_weather,
)
from fareloom.streaming.joins import join_streams, pinned_bundles, pinned_day_salts, pinned_salts
from fareloom.streaming.remembered import start_remembered_join
from fareloom.streaming.report import ReportKeeper
from fareloom.streaming.sinks import EVERY_100_SECONDS, ONCE_OVER_ALL_INPUT, append_stream

BATCH_LIMITS = ("maxBytesPerTrigger", "maxFilesPerTrigger")
GOLD_MODES = ("table", "stream", "bounded", "static")


def as_raw_layout(trips: DataFrame) -> DataFrame:
    """The trips in the types of the raw layout, for the columns of it that they have; other columns are kept.

    Files come with whole numbers where the layout has doubles. A value that its type cannot hold, be it too large, no
    number, or a fraction where the layout has whole numbers, stops the job, whatever the session's ANSI setting.
    """
    given = {field.name: field.dataType for field in trips.schema}
    wanted = {field.name: field.dataType for field in RAW}
    return trips.select(*(_fitting(c, given[c], wanted[c]) if c in wanted else F.col(f"`{c}`") for c in trips.columns))


def _fitting(name: str, given: DataType, wanted: DataType) -> Column:
    value = F.col(f"`{name}`")
    if given == wanted:
        return value
    fitted = value.try_cast(wanted)
    lost = value.isNotNull() & fitted.isNull()
    if isinstance(wanted, IntegralType) and not isinstance(given, IntegralType):
        # Text is compared as a number: "1.0" is whole, "1.7" is not.
        number = value.cast("double") if isinstance(given, StringType) else value
        lost = lost | (fitted != number)
    problem = F.concat(F.lit(f"{name} does not fit {wanted.simpleString()}: "), value.cast("string"))
    return F.when(lost, F.raise_error(problem).cast(wanted)).otherwise(fitted).alias(name)


def run_enrich(
    spark: SparkSession,
    trips: str,
    zones: str,
    output: str,
    mode: str = "errorifexists",
    time_zone: str = TIME_ZONE,
) -> None:
    """Batch: raw trips plus both zone names, in the layout that the bronze job reads.

    A folder that has rows already is an error, unless ``mode`` says ``append`` or ``overwrite``. Times without a zone
    are taken to be of ``time_zone``, whatever the caller's session says.
    """
    spark = pinned_session(spark, time_zone)
    named = add_zone_names(as_raw_layout(read_trips(spark, trips)), read_zones(spark, zones))
    named.write.mode(mode).parquet(output)


def _finish(query: StreamingQuery, wait: bool) -> StreamingQuery:
    if wait:
        query.awaitTermination()
    return query


def run_bronze(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    *,
    schema: StructType | None = None,
    fmt: str = "parquet",
    trigger: dict[str, Any] | None = None,
    source_options: dict[str, Any] | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append arriving raw files to the bronze table: scan and write, no shuffle.

    Passing a wider ``schema`` after a restart adds columns; rows already written read as null there. The table keeps it
    (``sources.evolution``), so later starts need not pass it again; a narrower one is refused. The first is the raw layout.
    """
    if fmt == "parquet":
        schema = publish_schema(spark, output, schema, RAW)
    trips = stream_trips(spark, source, schema or RAW, options=source_options)
    query = append_stream(trips, output, checkpoint, fmt=fmt, trigger=trigger, merge_schema=True)
    return _finish(query, wait)


def run_silver(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    *,
    validation: str = "off",
    constraints: Sequence[Constraint] = TRIP_CONSTRAINTS,
    report: str | None = None,
    schema: StructType | None = None,
    fmt: str = "parquet",
    trigger: dict[str, Any] | None = EVERY_100_SECONDS,
    source_options: dict[str, Any] | None = None,
    rebalance: bool = False,
    wait: bool = True,
) -> StreamingQuery:
    """Bronze to silver: rename, prune, validate, append by vendor.

    Bronze is read in the layout that it keeps; a ``schema`` that is narrower than that is refused.

    With ``report``, a folder, the counts of each batch and constraint are kept there, as the query itself observes them.
    A report that cannot be kept stops the job. Without ``wait`` the query comes back with its ``report`` (a
    ``ReportKeeper``), whose ``finish`` waits for the end and raises that error.
    """
    layout = agreed_schema(spark, source, schema, RAW)
    silver = to_silver(stream_trips(spark, source, layout, fmt, source_options))
    keeper = ReportKeeper(spark, report, checkpoint, constraints) if report else None
    if keeper and validation != "report":
        silver = observe_quality(silver, constraints)
    query = append_stream(
        validate(silver, validation, constraints),
        output,
        checkpoint,
        fmt=fmt,
        partition_by="vendor_id",
        trigger=trigger,
        rebalance=rebalance,
        name=keeper.name if keeper else None,
    )
    if keeper is None:
        return _finish(query, wait)
    query.report = keeper
    if wait:
        keeper.finish(query)
    return query


def run_gold(
    spark: SparkSession,
    source: str,
    weather: str,
    output: str,
    checkpoint: str,
    *,
    mode: str = "table",
    salts: int | None = None,
    trip_delay: str = "10 minutes",
    weather_delay: str = "1 day",
    fmt: str = "parquet",
    trigger: dict[str, Any] | None = EVERY_100_SECONDS,
    source_options: dict[str, Any] | None = None,
    time_zone: str = TIME_ZONE,
    wait: bool = True,
) -> StreamingQuery:
    """Silver and weather to gold, on the days of ``time_zone``, whatever the caller's session says.

    The modes differ in what they remember:

    ``table``    both sides for good, in a written table; late weather still finds earlier trips
    ``stream``   the same rows, remembered in the state store, which then grows with the trips
    ``bounded``  both sides up to the watermark that the two delays set, in a written table; later rows join nothing and
                 are kept for ``remembered.read_late``
    ``static``   nothing; weather as it is at the start, so each trip needs its weather to be there already
    """
    if mode not in GOLD_MODES:
        raise ValueError(f"unknown gold mode: {mode!r}")
    if mode == "bounded" and any(limit in (source_options or {}) for limit in BATCH_LIMITS):
        # Batches cut from a backlog move the watermark past rows that are still to come.
        raise ValueError("the bounded mode takes all arrived trips in one batch; limit batches in the other modes")
    spark = pinned_session(spark, time_zone)
    trips = stream_silver(spark, source, fmt, source_options)
    if mode in ("table", "bounded"):
        if fmt != "parquet":
            raise ValueError(f"the {mode} mode writes parquet")
        delays = (trip_delay, weather_delay) if mode == "bounded" else None
        arriving = stream_weather(spark, weather)
        return _finish(start_remembered_join(trips, arriving, output, checkpoint, trigger, delays=delays), wait)
    if mode == "static":
        joined = join_weather(trips, read_weather(spark, weather).select(*WEATHER_SIDE))
    else:
        arriving = stream_weather(spark, weather).select(*WEATHER_SIDE)
        shares = pinned_salts(spark, checkpoint, salts)
        by_day = pinned_day_salts(spark, checkpoint, shares)
        joined = join_streams(trips, arriving, shares, by_day, pinned_bundles(spark, checkpoint))
    query = append_stream(
        to_gold(joined), output, checkpoint, fmt=fmt, partition_by="vendor_id", trigger=trigger
    )
    return _finish(query, wait)


def run_catalog(
    spark: SparkSession,
    source: str,
    location: str,
    checkpoint: str,
    database: str = catalog.DATABASE,
    table: str = catalog.TABLE,
    database_location: str | None = None,
    source_options: dict[str, Any] | None = None,
) -> str:
    """Bring the catalog table up to date with the bronze rows it does not have yet; return its name.

    ``source_options`` may cut a backlog into batches.
    """
    rows = catalog.to_catalog_layout(stream_trips(spark, source, options=source_options))
    partition = catalog.PARTITION_COLUMN
    append_stream(
        rows, location, checkpoint, partition_by=partition, trigger=ONCE_OVER_ALL_INPUT
    ).awaitTermination()
    return catalog.register_bronze(spark, location, database, table, database_location)

"""Weather joins between two streams, with the state spread so that no day is held by one task."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StructType

from fareloom.functions.days import trip_day
from fareloom.session import path_exists, write_text


#: Shares of a day unless told otherwise: at least and at most so many, and between them one for each partition.
FEWEST_SHARES, MOST_SHARES = 16, 64
#: Days that have their salts listed; trips of other days use the numbers of the shares themselves.
FIRST_DAY, DAYS = "1990-01-01", 21_915
#: Salts that are tried for each partition before a share takes one that may meet another share.
TRIED = 5
#: Trips that a task holds at once to bundle them by day, and the most trips of a bundle.
HELD_TRIPS, BUNDLED_TRIPS = 1 << 18, 512


def _nullable(salt: Column) -> Column:
    # Spark compares the nullability of state columns between batches, and a batch without rows has all nullable.
    return F.nullif(salt, F.lit(-1))


def day_salts(spark: SparkSession, shares: int, partitions: int) -> DataFrame:
    """``salted_day`` and ``salts``: for each listed day a salt for each share.

    Rows are dealt by the hash of (day, salt). The shares of a day go to partitions one after the other, from one that the day
    itself picks, so however hot a day is, its shares meet in a partition only as often as they must: of the salts that are
    tried, each share takes one whose hash goes where the share belongs. A few thousand small rows, days times shares.
    """
    tried = TRIED * partitions * -(-shares // partitions)
    place = lambda salt: F.pmod(F.hash("salted_day", salt.cast("int")), F.lit(partitions))
    days = spark.range(DAYS).select(F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("id").cast("int")).alias("salted_day"))
    placed = days.select(
        "salted_day",
        F.pmod(F.hash("salted_day"), F.lit(partitions)).alias("first"),
        F.transform(F.sequence(F.lit(0), F.lit(tried - 1)), place).alias("places"),
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for first, places in zip(batch.column("first").to_pylist(), batch.column("places")):
                own = np.asarray(places.values)
                by_place = np.argsort(own, kind="stable")
                begins = np.searchsorted(own[by_place], np.arange(partitions + 1))
                turns, places_of = divmod(np.arange(shares), partitions)
                places_of = (first + places_of) % partitions
                at = begins[places_of] + turns
                # A share that finds no salt takes a number beyond those tried, and may meet another share.
                found = at < begins[places_of + 1]
                chosen.append(np.where(found, by_place[np.where(found, at, 0)], tried + np.arange(shares)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("salted_day"), pa.array(chosen, pa.list_(pa.int32()))], ["salted_day", "salts"])

    return placed.mapInArrow(choose, "salted_day date, salts array<int>")


def _spread_trips(trips: DataFrame, salts: int, by_day: DataFrame | None = None) -> DataFrame:
    """Give each trip one random share of its day.

    The draw does not look at the row, so even copies of one trip spread out. Apply it right after the scan:
    there a repeated task draws the same numbers for the same rows.
    """
    return _spread_days(trips.withColumn("day", trip_day("drop_off_timestamp")).where(F.col("day").isNotNull()), salts, by_day)


def _spread_days(rows: DataFrame, salts: int, by_day: DataFrame | None) -> DataFrame:
    drawn = rows.withColumn("salt", _nullable(F.floor(F.rand() * salts).cast("int")))
    if by_day is None:
        return drawn
    listed = drawn.join(F.broadcast(by_day), F.col("day") == F.col("salted_day"), "left")
    salt = F.coalesce(F.try_element_at("salts", F.col("salt") + 1), F.col("salt"))
    return listed.withColumn("salt", _nullable(salt)).drop("salted_day", "salts")


def _repeat_weather(weather: DataFrame, salts: int, by_day: DataFrame | None = None) -> DataFrame:
    """Put each weather row into every share of its day; the rows are few and narrow."""
    known = weather.where(F.col("date").isNotNull())
    shares = F.sequence(F.lit(0), F.lit(salts - 1))
    if by_day is not None:
        known = known.join(F.broadcast(by_day), F.col("date") == F.col("salted_day"), "left")
        shares = F.coalesce("salts", shares)
    repeated = known.withColumn("share", F.explode(shares)).drop("salted_day", "salts")
    return repeated.withColumn("weather_salt", _nullable(F.col("share"))).drop("share")


def bundle_trips(trips: DataFrame) -> DataFrame:
    """``day`` and ``bundle``: the trips that have a day, in lists of at most ``BUNDLED_TRIPS`` of one day.

    A task bundles ``HELD_TRIPS`` of its rows at a time, so nothing is shuffled and a hot day becomes many bundles.
    """
    schema = StructType().add("day", DateType()).add("bundle", ArrayType(trips.schema))

    def bundled(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        days = rows.column(0).cast(pa.int32()).to_numpy()
        order = np.argsort(days, kind="stable")
        firsts = np.flatnonzero(np.diff(days[order], prepend=days[order[0]] - 1))
        place = np.arange(len(days)) - np.repeat(firsts, np.diff(firsts, append=len(days)))
        begins = np.flatnonzero(place % BUNDLED_TRIPS == 0)
        values = rows.take(pa.array(order)).select(rows.schema.names[1:]).to_struct_array()
        bundles = pa.ListArray.from_arrays(pa.array(np.append(begins, len(days)), pa.int32()), values)
        return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(order[begins])), bundles], ["day", "bundle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= HELD_TRIPS:
                yield bundled(held)
                held, rows = [], 0
        if rows:
            yield bundled(held)

    dated = trips.select(trip_day("drop_off_timestamp").alias("day"), *trips.columns).where(F.col("day").isNotNull())
    return dated.mapInArrow(run, schema)


def join_streams(
    trips: DataFrame, weather: DataFrame, salts: int, by_day: DataFrame | None = None, bundles: bool = False
) -> DataFrame:
    """Inner join with no bound on lateness: both sides are remembered for good.

    ``by_day`` are the salts of ``day_salts`` for this number of shares, which deal the shares of a day evenly over the partitions.
    With ``bundles`` the state holds lists of trips of a day instead of trips: the same rows for far fewer writes.
    """
    columns = [*trips.columns, *weather.columns]
    same_share = (F.col("day") == F.col("date")) & (F.col("salt") == F.col("weather_salt"))
    weather = _repeat_weather(weather, salts, by_day)
    if not bundles:
        return _spread_trips(trips, salts, by_day).join(weather, same_share)
    joined = _spread_days(bundle_trips(trips), salts, by_day).join(weather, same_share)
    return joined.select(F.inline("bundle"), *weather.columns).select(*columns)


def join_streams_bounded(
    trips: DataFrame,
    weather: DataFrame,
    salts: int,
    trip_delay: str = "10 minutes",
    weather_delay: str = "1 day",
) -> DataFrame:
    """The same join, but rows older than the watermarks are forgotten and late ones ignored.

    The day hides the event time from the watermark, so a time range is added. It never decides a match
    (equal days imply it, also where a day has 23 or 25 hours); it tells Spark when state can go.
    """
    trips = _spread_trips(trips.withWatermark("drop_off_timestamp", trip_delay), salts)
    weather = weather.withColumn("day_start", F.col("date").cast("timestamp"))
    weather = _repeat_weather(weather.withWatermark("day_start", weather_delay), salts)
    return trips.join(
        weather,
        (F.col("day") == F.col("date"))
        & (F.col("salt") == F.col("weather_salt"))
        & (F.col("drop_off_timestamp") >= F.expr("day_start - INTERVAL 2 HOURS"))
        & (F.col("drop_off_timestamp") <= F.expr("day_start + INTERVAL 26 HOURS")),
    )


def pinned_salts(spark: SparkSession, checkpoint: str, wanted: int | None) -> int:
    """The number of shares this checkpoint was started with, stored on the first run.

    Weather in the state is repeated that many times, so another number after a restart would lose rows.
    """
    path = f"{checkpoint.rstrip('/')}/salts"
    stored = spark.read.schema("salts int").json(path).first() if path_exists(spark, path) else None
    if stored:
        if wanted not in (None, stored["salts"]):
            raise ValueError(f"this checkpoint was started with {stored['salts']} salts, not {wanted}")
        return stored["salts"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = wanted or min(max(partitions, FEWEST_SHARES), MOST_SHARES)
    spark.range(1).select(F.lit(salts).alias("salts")).write.mode("overwrite").json(path)
    return salts


def pinned_day_salts(spark: SparkSession, checkpoint: str, shares: int) -> DataFrame | None:
    """The salts of each day that this checkpoint was started with, written on the first run; none for a checkpoint
    that began without them."""
    folder = f"{checkpoint.rstrip('/')}/day_salts"
    if not path_exists(spark, f"{folder}/_whole"):
        if path_exists(spark, f"{checkpoint.rstrip('/')}/commits"):
            return None
        # A stateful query keeps the number of partitions of its first run.
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        day_salts(spark, shares, partitions).coalesce(1).write.mode("overwrite").parquet(folder)
        write_text(spark, f"{folder}/_whole", "")
    return spark.read.schema("salted_day date, salts array<int>").parquet(folder)


def pinned_bundles(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the state of this checkpoint holds bundles: that of a new one does, one begun with single trips keeps to them."""
    marker = f"{checkpoint.rstrip('/')}/bundles"
    if path_exists(spark, marker):
        return True
    if path_exists(spark, f"{checkpoint.rstrip('/')}/commits"):
        return False
    write_text(spark, marker, "")
    return True

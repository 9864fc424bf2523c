"""Weather join without a state store: what has been seen is kept in a written table.

The plain stream join remembers every trip for good, so its state grows as large as the trip table. This form
gives the same rows, late weather included, with batch joins over a table that only grows on storage. Of
the pairs (trip, weather row) batch ``n`` emits those whose later member arrived in it:

    trips of batch n      x  weather of batches <= n
    trips of batches < n  x  weather of batch n        (skipped unless new weather came)

Both the memory and the gold rows are tables of parts (``fareloom.streaming.parts``), published together at the end of a
batch. What arrives is written to the memory once and read back from there, so a source is scanned once a batch. Gold lies in
folders by vendor. Parts of closed batches are merged; merged trips lie in folders by month, sorted by day: late weather opens
the folders of its own months, of a number of parts that grows with the logarithm of the batches, and skips the row groups
of other days.

With ``delays`` the memory is bounded. The watermark of a batch is the lesser of the latest drop-off seen in earlier
batches less the first delay and the latest weather day seen less the second, and none before both have been seen. Rows with a time
before it are late: they join nothing, and are kept with their batch for ``read_late``. Trips and weather of days that lie
wholly before the watermark leave the memory when parts are merged, or with their whole part.

Output and checkpoint carry the same id; a folder written for another checkpoint is refused.
"""

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fareloom.functions.days import trip_day
from fareloom.operators.sizing import MAX_BROADCAST_BYTES, measured_bytes
from fareloom.operators.weather import to_gold
from fareloom.schemas import GOLD, SILVER
from fareloom.session import matching_paths, path_exists, read_text, write_text
from fareloom.streaming.parts import Ledger, Part, part_name, publish, read_folders, read_ledger, sweep

_KINDS = TRIP, WEATHER, LATE = "trip", "weather", "late"
_ROWS = StructType(list(GOLD.fields)).add("day", "date").add("batch_id", "long").add("is_trip", "boolean")
_KEPT = StructType(list(_ROWS.fields)).add("part", "string").add("kind", "string").add("month", "string")
_WEATHER_VALUES = ("tempmax", "tempmin")
_MONTH = "yyyy-MM"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: A task sorts the rows of a split of arriving files, in some twenty times the memory they take there. Its files are merged later.
KEPT_SPLIT = "16m"
#: Microseconds of a day, and the hours that a day can have at most in any time zone.
_DAY = 86_400_000_000
_LONGEST_DAY = 26 * 3_600_000_000


def _one_stream(trips: DataFrame, weather: DataFrame) -> DataFrame:
    tagged_trips = trips.select(
        F.lit(True).alias("is_trip"),
        trip_day("drop_off_timestamp").alias("day"),
        *(F.col(field.name).cast(field.dataType).alias(field.name) for field in SILVER),
    )
    tagged_weather = weather.select(F.lit(False).alias("is_trip"), F.col("date").alias("day"), *_WEATHER_VALUES)
    return tagged_trips.unionByName(tagged_weather, allowMissingColumns=True).where(F.col("day").isNotNull())


def _event_time() -> Column:
    """The time that a watermark looks at, in microseconds: the drop-off, or the start of the weather day."""
    moment = F.when(F.col("is_trip"), F.col("drop_off_timestamp")).otherwise(F.col("day").cast("timestamp"))
    return F.unix_micros(moment)


class Memory:
    """The remembered rows under ``root``: ``part=…/kind=…``, and below that ``month=…`` for trips of merged parts."""

    def __init__(self, spark: SparkSession, root: str, ledger: Ledger) -> None:
        self.spark, self.root, self.ledger = spark, root, ledger

    def folder(self, part: Part) -> str:
        return f"{self.root}/part={part.name}"

    def parts(self, kind: str) -> list[Part]:
        return [part for part in self.ledger.of("memory") if kind in part.notes["kinds"]]

    def _read(self, folders: list[str]) -> DataFrame:
        # Folders by month and others cannot be read as one table.
        by_month = [folder for folder in folders if "/month=" in folder]
        plain = [folder for folder in folders if folder not in by_month]
        rows = [read_folders(self.spark, self.root, some, _KEPT) for some in (plain, by_month) if some or not folders]
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def rows(self, kind: str, parts: Iterable[Part]) -> DataFrame:
        folders = []
        for part in parts:
            if kind in part.notes["kinds"]:
                place = f"{self.folder(part)}/kind={kind}"
                months = part.notes["months"] if kind == TRIP and part.level else None
                folders += [place] if months is None else [f"{place}/month={month}" for month in months]
        return self._read(folders)

    def trips_of(self, days: list) -> DataFrame:
        """Remembered trips of these days; of merged parts only the folders of their months are listed and opened."""
        months = sorted({f"{day:%Y-%m}" for day in days})
        folders = []
        for part in self.parts(TRIP):
            place = f"{self.folder(part)}/kind={TRIP}"
            folders += [f"{place}/month={m}" for m in months if m in part.notes["months"]] if part.level else [place]
        return self._read(folders).where(F.col("day").isin(days))

    def keep(self, rows: DataFrame, batch_id: int, watermark: int | None) -> Part:
        """Write what arrived as a new part; its rows have their kind as folder and are sorted by day."""
        late = F.lit(False) if watermark is None else _event_time() < watermark
        kind = F.when(late, LATE).when(F.col("is_trip"), TRIP).otherwise(WEATHER)
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("kind", kind)
        name = part_name(batch_id)
        part = Part("memory", name, 0, batch_id, {"kinds": []})
        # A day alone sorts as a number, without comparing rows; a file of each kind is open, so rows need no order of kinds.
        with _setting(self.spark, _OPEN_FILES, str(len(_KINDS))):
            rows.sortWithinPartitions("day").write.partitionBy("kind").parquet(self.folder(part))
        return Part("memory", name, 0, batch_id, self._notes(part, {}))

    def _notes(self, part: Part, known: dict) -> dict:
        place = self.folder(part)
        kinds = [path.rsplit("kind=", 1)[-1] for path in matching_paths(self.spark, f"{place}/kind=*")]
        months = [path.rsplit("month=", 1)[-1] for path in matching_paths(self.spark, f"{place}/kind={TRIP}/month=*")]
        part = Part(part.table, part.name, part.level, part.last_batch, {"kinds": kinds})
        weather = self.rows(WEATHER, [part])
        size = measured_bytes(weather.select("day", *_WEATHER_VALUES)) if WEATHER in kinds else 0
        return {**known, "kinds": kinds, "months": months, "weather_bytes": size}

    def merge(self, batch_id: int, watermark: int | None) -> None:
        """Merge parts of closed batches where there are enough of a level."""
        while old := self.ledger.due("memory"):
            last = max(part.last_batch for part in old)
            part = Part("memory", part_name(last), old[0].level + 1, last, {"kinds": []})
            # One write: rows of different kinds go to different folders, and only trips are cut by month.
            for kind in (TRIP, WEATHER, LATE):
                held = [p for p in old if kind in p.notes["kinds"]]
                if not held:
                    continue
                rows = self.rows(kind, held)
                if watermark is not None and kind != LATE:
                    rows = rows.where(F.unix_micros(F.col("day").cast("timestamp")) >= watermark - _LONGEST_DAY)
                rows = rows.withColumn("month", F.date_format("day", _MONTH)).select(*_ROWS.fieldNames(), "kind", "month")
                folders = ("kind", "month") if kind == TRIP else ("kind",)
                rows = rows.hint("rebalance", "month") if kind == TRIP else rows.drop("month")
                rows.sortWithinPartitions(*folders, "day").write.mode("append").partitionBy(*folders).parquet(self.folder(part))
            notes = {"latest": max((p.notes.get("latest") or 0 for p in old), default=0)}
            merged = Part("memory", part.name, part.level, last, self._notes(part, notes))
            self.ledger.replace(old, merged, self.folder, batch_id)

    def forget(self, batch_id: int, watermark: int) -> None:
        """Let go of parts whose trips and weather all lie before the watermark; late rows stay."""
        for k, part in enumerate(self.ledger.parts):
            latest = part.notes.get("latest")
            kinds = [kind for kind in part.notes.get("kinds", ()) if kind != LATE]
            if part.table == "memory" and kinds and latest is not None and latest < watermark - _LONGEST_DAY:
                self.ledger.retire([f"{self.folder(part)}/kind={kind}" for kind in kinds], batch_id)
                left = {**part.notes, "kinds": [k for k in part.notes["kinds"] if k == LATE], "months": [], "weather_bytes": 0}
                self.ledger.parts[k] = Part(part.table, part.name, part.level, part.last_batch, left)


def _gold_folder(path: str, part: Part) -> str:
    return f"{path}/vendor_id=*/part={part.name}"


def _write_gold(rows: DataFrame, path: str, name: str) -> None:
    rows.withColumn("part", F.lit(name)).write.mode("append").partitionBy("vendor_id", "part").parquet(path)


def read_published_gold(spark: SparkSession, path: str) -> DataFrame:
    """The gold rows of the published batches. A filter on the vendor opens its folder only."""
    live = [part.name for part in read_ledger(spark, path).of("gold")]
    if not live:
        return spark.createDataFrame([], GOLD)
    rows = spark.read.schema(StructType(list(GOLD.fields)).add("part", "string")).parquet(path)
    return rows.where(F.col("part").isin(live)).select(*GOLD.fieldNames())


def read_late(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Rows that came behind the watermark of their batch: ``batch_id``, ``is_trip``, ``day`` and the row's own columns."""
    memory = Memory(spark, _memory_root(checkpoint), read_ledger(spark, path))
    return memory.rows(LATE, memory.parts(LATE)).select("batch_id", "is_trip", "day", *GOLD.fieldNames())


def read_remembered(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Trips that are remembered, with the batch they arrived in."""
    memory = Memory(spark, _memory_root(checkpoint), read_ledger(spark, path))
    return memory.rows(TRIP, memory.parts(TRIP)).select("batch_id", "day", *SILVER.fieldNames())


def _memory_root(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/remembered"


def _merge_gold(spark: SparkSession, path: str, ledger: Ledger, batch_id: int) -> None:
    """Merge gold parts; a vendor's rows are rebalanced into few full files, a hot vendor's split by size."""
    while old := ledger.due("gold"):
        last = max(part.last_batch for part in old)
        name = part_name(last)
        rows = spark.read.schema(StructType(list(GOLD.fields)).add("part", "string")).parquet(path)
        rows = rows.where(F.col("part").isin([part.name for part in old])).select(*GOLD.fieldNames())
        _write_gold(rows.hint("rebalance", "vendor_id"), path, name)
        ledger.replace(old, Part("gold", name, old[0].level + 1, last), partial(_gold_folder, path), batch_id)


def _claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Give output and checkpoint one id on their first run; later refuse an output of another checkpoint."""
    mine, its = f"{checkpoint.rstrip('/')}/output_id", f"{path}/_output_id"
    own, found = read_text(spark, mine), read_text(spark, its)
    if own is None:
        own = uuid.uuid4().hex
        write_text(spark, mine, own)
    if found is None and not any(matching_paths(spark, f"{path}/{folder}=*") for folder in ("vendor_id", "batch_id")):
        write_text(spark, its, own)
    elif found != own:
        raise ValueError(f"{path} holds rows that this checkpoint does not know; batch numbers would clash")


def _pairs(trips: DataFrame, weather: DataFrame, broadcast: bool) -> DataFrame:
    trips = trips.select("day", *SILVER.fieldNames())
    weather = weather.select("day", *_WEATHER_VALUES)
    return to_gold(trips.join(F.broadcast(weather) if broadcast else weather, "day"))


def _micros(spark: SparkSession, delay: str) -> int:
    """A delay such as ``10 minutes`` in microseconds."""
    length = F.unix_micros(F.expr(f"TIMESTAMP'1970-01-01 00:00:00 UTC' + INTERVAL {delay}"))
    return spark.range(1).select(length).first()[0]


def _watermark(notes: dict, delays: tuple[int, int] | None) -> int | None:
    seen = (notes.get("latest_trip"), notes.get("latest_weather"))
    if delays is None or None in seen:
        return None
    return min(latest - delay for latest, delay in zip(seen, delays))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_remembered_join(
    trips: DataFrame,
    weather: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    delays: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Start the join; gold rows go to ``path``, seen rows to the checkpoint's folder.

    Arriving files are read in splits of ``KEPT_SPLIT``, what is read back in those of the session.

    A batch writes new parts and then publishes them in one step; a batch that is published is not written
    again, one that was cut off leaves folders that no reader sees and that the next start removes.
    """
    path = path.rstrip("/")
    root = _memory_root(checkpoint)
    first = trips.sparkSession
    _claim(first, path, checkpoint)
    bounds = tuple(_micros(first, delay) for delay in delays) if delays else None
    known = read_ledger(first, path)
    sweep(first, f"{path}/vendor_id=*/part=*", known)
    sweep(first, f"{root}/part=*", known)
    split = first.conf.get(_SPLIT)

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The splits of what arrives are settled by now.
        with _setting(batch.sparkSession, _SPLIT, split):
            apply_to(batch.sparkSession, batch, batch_id)

    def apply_to(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        ledger = read_ledger(spark, path)
        if ledger.through >= batch_id:
            return
        memory = Memory(spark, root, ledger)
        watermark = _watermark(ledger.notes, bounds)
        memory.merge(batch_id, watermark)
        _merge_gold(spark, path, ledger, batch_id)
        if watermark is not None:
            memory.forget(batch_id, watermark)

        part = memory.keep(batch, batch_id, watermark)
        arrived = {kind: memory.rows(kind, [part]) for kind in (TRIP, WEATHER)}
        if bounds:
            times = arrived[TRIP].unionByName(arrived[WEATHER]).groupBy("is_trip").agg(F.max(_event_time()).alias("latest"))
            latest = {row["is_trip"]: row["latest"] for row in times.collect()}  # two rows at most
            for key, name in ((True, "latest_trip"), (False, "latest_weather")):
                both = [t for t in (ledger.notes.get(name), latest.get(key)) if t is not None]
                ledger.notes[name] = max(both, default=None)
            part.notes["latest"] = max(latest.values(), default=None)

        earlier = memory.parts(WEATHER)
        size = sum(p.notes["weather_bytes"] for p in (*earlier, part))
        # Row positions say nothing here; what is broadcast is measured when it is written.
        gold = _pairs(arrived[TRIP], memory.rows(WEATHER, [*earlier, part]), size <= max_broadcast_bytes)
        if WEATHER in part.notes["kinds"] and memory.parts(TRIP):
            # The days of one batch of weather come to the driver: there are as many as the calendar has.
            days = [row["day"] for row in arrived[WEATHER].select("day").distinct().collect()]
            small = part.notes["weather_bytes"] <= max_broadcast_bytes
            gold = gold.unionByName(_pairs(memory.trips_of(days), arrived[WEATHER], small))
        name = part_name(batch_id)
        _write_gold(gold, path, name)
        if matching_paths(spark, f"{path}/vendor_id=*/part={name}"):
            ledger.parts.append(Part("gold", name, 0, batch_id))
        if part.notes["kinds"]:
            ledger.parts.append(part)
        ledger.through = batch_id
        publish(spark, path, ledger)

    writer = _one_stream(trips, weather).writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    if trigger:
        writer = writer.trigger(**trigger)
    with _setting(first, _SPLIT, KEPT_SPLIT):
        # The query takes the settings of its start with it.
        return writer.start()

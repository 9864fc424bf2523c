"""Helpers that the operators share."""

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.session import scratch_folder

#: Bits of the hash that draws bounded samples.
_DRAW_BITS = 20


def _workers_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, besides where they look anyway."""
    environment = spark.sparkContext.environment
    places = environment.get("PYTHONPATH", "").split(os.pathsep)
    own = str(Path(__file__).resolve().parents[2])
    if own not in places:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, places), own])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    _workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again: later reads survive lost executors."""
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def with_text(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns of ``docs`` and, last, its texts as ``__text``."""
    return docs.select(*(F.col(f"`{c}`") for c in columns), F.col("text").alias("__text"))


def extended(given: DataFrame, columns: str) -> StructType:
    """The fields of ``with_text`` but its last, and then the columns of this schema text."""
    return StructType([*given.schema.fields[:-1], *StructType.fromDDL(columns).fields])


def _threshold(rows: int, total: int) -> int:
    return int((1.0 if total <= rows else rows / total) * (1 << _DRAW_BITS)) + 1


def draw(key: str) -> Column:
    """The hash of a key by which samples are drawn."""
    return F.pmod(F.xxhash64(key), F.lit(1 << _DRAW_BITS))


def hashed_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, the same ones on every run: those whose hashed key falls below a share."""
    return df.where(draw(key) < F.lit(_threshold(rows, total)))


def drawn_by_group(df: DataFrame, key: str, group: str, sizes: dict[str, tuple[int, int, int]]) -> DataFrame:
    """The same for each value of ``group``, in one pass; no other values are drawn.

    ``sizes`` has (rows, total, least hash of a key) of each; the row with the least hash is drawn in any case.
    """
    bounds = [(value, max(_threshold(rows, total), least + 1)) for value, (rows, total, least) in sizes.items()]
    known = df.sparkSession.createDataFrame(bounds, f"`{group}` string, __bound long")
    return df.join(F.broadcast(known), group).where(draw(key) < F.col("__bound")).select(df.columns)


def sliced(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into shorter ones of about ``most_bytes`` of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)

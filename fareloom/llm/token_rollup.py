"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes says what became of documents: ``insert`` adds one with its count, ``delete`` takes one with its
count away, ``revise`` replaces ``old_tokens`` by ``n_tokens`` under the same key. (A document that moves to
another source, language or version is a delete and an insert.) Each batch is summed to one row per key and
written as a delta; totals are the sums of committed deltas, so a batch costs its own size, not the corpus's.

Commits are idempotent. The delta of a batch is written first, replacing what a broken attempt left, then a
one-row commit record; only deltas with a record count. Committing a batch again changes nothing; committing
other sums under a committed id is refused. ``compact`` writes the totals as one delta whose record names those it
replaces.

Nulls and edges: null sources, languages and versions are keys of their own. A null count is 0 tokens. A null or
unknown operation is refused. Repeated rows count each time. An empty batch can be committed. Keys that no
document is left under are not in the totals. Other columns of the changes are not looked at.
"""

import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import path_exists

KEYS = ("source", "lang", "tokenizer_version")
DELTA_SCHEMA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long, batch_id string"
COMMIT_SCHEMA = "rows long, n_docs long, n_tokens long, mark decimal(38,0), replaces array<string>, batch_id string"
INSERT, DELETE, REVISE = "insert", "delete", "revise"


def _sums() -> tuple[Column, Column]:
    tokens, old = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_tokens", "old_tokens"))
    docs = F.when(F.col("op") == INSERT, 1).when(F.col("op") == DELETE, -1).when(F.col("op") == REVISE, 0)
    signed = F.when(F.col("op") == INSERT, tokens).when(F.col("op") == DELETE, -tokens).otherwise(tokens - old)
    refused = F.raise_error(F.concat(F.lit("not an operation: "), F.coalesce("op", F.lit("null"))))
    return F.sum(F.coalesce(docs, refused.cast("int"))).alias("n_docs"), F.sum(signed).alias("n_tokens")


def _folder_text(batch_id: str) -> str:
    """The id as it stands in folder names and commit records: only characters that no file system and no reader changes."""
    return quote(batch_id, safe="").replace("%", "!")


class TokenRollup:
    """The rollup kept in ``root``, a folder that the whole cluster sees."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, kind: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/{kind}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")

    def _write(self, delta: DataFrame, batch_id: str, replaces: list[str]) -> None:
        name = f"batch_id={batch_id}"
        folder = f"{self.root}/deltas/{name}"
        delta.write.mode("overwrite").parquet(folder)
        record = self._record(self.spark.read.schema(delta.schema).parquet(folder))
        record = record.withColumn("replaces", F.array(*map(F.lit, replaces)).cast("array<string>"))
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/{name}")

    @staticmethod
    def _record(delta: DataFrame) -> DataFrame:
        mark = F.sum(F.xxhash64(*KEYS, "n_docs", "n_tokens").cast("decimal(38,0)"))
        zero = lambda c: F.coalesce(c, F.lit(0))
        return delta.agg(
            F.count("*").alias("rows"),
            zero(F.sum("n_docs")).alias("n_docs"),
            zero(F.sum("n_tokens")).alias("n_tokens"),
            zero(mark).cast("decimal(38,0)").alias("mark"),
        )

    def commits(self) -> DataFrame:
        return self._read("commits", COMMIT_SCHEMA)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch of (source, lang, tokenizer_version, op, n_tokens, old_tokens); false if it was there already."""
        if not batch_id:
            raise ValueError("a batch needs an id")
        batch_id = _folder_text(batch_id)
        delta = changes.groupBy(*KEYS).agg(*_sums())
        there = self.commits().where(F.col("batch_id") == batch_id).select("rows", "n_docs", "n_tokens", "mark").first()
        if there is None:
            self._write(delta, batch_id, [])
            return True
        if self._record(delta).first() != there:
            raise ValueError(f"batch {batch_id} is committed with other counts")
        return False

    @staticmethod
    def _live(commits: DataFrame) -> DataFrame:
        replaced = commits.select(F.explode("replaces").alias("batch_id"))
        return commits.select("batch_id").join(replaced, "batch_id", "left_anti")

    def _summed(self, live: DataFrame) -> DataFrame:
        deltas = self._read("deltas", DELTA_SCHEMA).join(live, "batch_id", "left_semi")
        return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, n_docs, n_tokens) over all committed batches."""
        return self._summed(self._live(self.commits())).where("n_docs <> 0")

    def compact(self) -> None:
        """Replace the deltas committed so far by one; their ids stay known, so replays are still recognised.

        The batches are listed once and exactly these are summed, so one that is committed meanwhile stays a delta of its own. Keys
        without documents keep their tokens: a delete may come before its insert.
        """
        ids = sorted(row["batch_id"] for row in self._live(self.commits()).collect())
        if ids:
            live = self.spark.createDataFrame([(i,) for i in ids], "batch_id string")
            self._write(self._summed(live).where("n_docs <> 0 OR n_tokens <> 0"), f"compacted-{uuid.uuid4().hex}", ids)

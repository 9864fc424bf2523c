"""The corpus pipeline: raw documents to packed sequences, one operator a stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns it was given; the last returns the packed pieces. ``run`` writes each stage's rows to the shared scratch
folder and reads them again for the next.

A null id, repeated rows and null texts pass through as the operators say: a document without a word is rejected by
the first stage, so later ones see texts only.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import langid, packing, resampling, simhash, suffix_dedup
from fareloom.llm.common import documents, labels, saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words that a worker of the last stage remembers: the stages before it have left the executors little memory.
REMEMBERED_WORDS = 100_000

#: Scores below this say that a text fits no language better than the others.
LEAST_LANGUAGE_SCORE = 0.02


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return resampling.sampled_rows(docs, labels(spark, sf_dir))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told."""
    return langid.in_known_language(docs, LEAST_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_of_each(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids have; documents of which a word is left."""
    left = suffix_dedup.without_repeats(docs)
    return left.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1,024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), special_tokens=True, remembered=REMEMBERED_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("packing", pack),
]

#: Learned models, suffix matching and ids have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs

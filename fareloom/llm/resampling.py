"""Quality classifier by importance resampling.

Two bags of hashed word unigrams and bigrams are counted: of the target (documents labelled good and not toxic) and of
all documents. A bucket's log ratio is ``log p_target - log p_raw``, each with one count more at the raw model's
expectation. It is shrunk by how sure it is: with z the standard errors between the target's count and what the raw model
expects of a text as long as the target, it is taken times ``z^4 / (z^4 + doubt^4)``. Otherwise the many rare n-grams, which
the bounded target has by chance or not, drown the few that tell, such as abuse in a text that is good otherwise.

A document's log weight is the mean ratio over its n-grams. The mean, and not the sum, makes texts of all lengths
comparable: the sum of a long text is lower by its length alone. Divided by ``temperature``, the part of a text's n-grams
that is worth one unit, and with Gumbel noise that depends only on the document's id and the seed, it is the key; the k documents with the highest keys are a sample without replacement in
proportion to the weights. ``k`` is given, or calibrated: the number of documents whose key is no lower than that
of all but ``clean_loss`` of the good documents set aside for this.

The raw counts cover all documents. Sample: about ``max_labelled`` labelled documents, drawn by hashed id, give the
target model (one half) and the calibration (the other).

Nulls and edges: a text without a word has no weight and is never kept. Words are lower-cased in a-z only and
separated by white space of ASCII. Documents with one null id share their noise. Where several documents have exactly
the k-th key, all of them are kept; repeated rows therefore stand or fall together. Without usable labels every
document with a word has weight 0 and, k not being given, is kept. An empty table gives an empty result.
"""

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import extended, hashed_sample, saved, with_text

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
MAX_LABELLED = 20_000
TEMPERATURE = 0.002
DOUBT = 3.0
CLEAN_LOSS = 0.01
SEED = 20
#: Keys that the selection of the k-th key brings to the driver at once.
_FEW_KEYS = 10_000
_SPLITS = 4_096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(text: str | None) -> np.ndarray:
    """The bucket of each word and of each pair of neighbouring words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    two = one[:-1] * _MIX + one[1:]
    return ((np.concatenate([one, two]) + np.uint64(1)) * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1)):
            found = ngram_buckets(text.as_py())
            np.add.at(raw, found, 1)
            if good.as_py():
                np.add.at(target, found, 1)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, raw[used], target[used])], ["bucket", "raw", "target"])


def ngram_counts(docs: DataFrame, good: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket comes in all documents and in those of ``good`` (doc_id), a bounded set."""
    marked = docs.select("doc_id", "text").join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left")
    per_task = marked.select("text", "good").mapInArrow(_counts, "bucket long, raw long, target long")
    # One row a bucket, however many documents there are.
    sums = per_task.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros((2, BUCKETS))
    bucket = sums["bucket"].to_numpy(np.int64)
    raw[bucket], target[bucket] = sums["raw"], sums["target"]
    return raw, target


def log_ratios(docs: DataFrame, good: DataFrame, doubt: float = DOUBT) -> np.ndarray:
    """The shrunk ``log p_target - log p_raw`` of each bucket; half of it where the counts differ by ``doubt`` standard errors."""
    raw, target = ngram_counts(docs, good)
    if not target.any():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    sure = (target - expected) ** 4 / (expected + 1) ** 2
    return np.log((target + 1) / (expected + 1)) * sure / (sure + doubt**4)


def log_weights(docs: DataFrame, ratios: np.ndarray, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """These columns, ``__n_grams`` and ``__log_weight`` (null without n-grams) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    given = with_text(docs, columns)
    schema = extended(given, "__n_grams long, __log_weight double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            found = [shared.value[ngram_buckets(t.as_py())] for t in texts]
            sizes = pa.array([len(x) for x in found], pa.int64())
            means = pa.array([float(x.mean()) if len(x) else None for x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*kept, sizes, means], schema.names)

    return given.mapInArrow(run, schema)


def with_keys(weighted: DataFrame, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Adds ``__key``: the tempered log weight plus Gumbel noise of the document."""
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return weighted.withColumn("__key", F.col("__log_weight") / temperature - F.log(-F.log(uniform)))


def kth_largest(values: DataFrame, k: int) -> float:
    """The k-th largest of the one double column ``key`` (no nulls, at least k rows), by narrowing counted ranges."""
    low, high = values.agg(F.min("key"), F.max("key")).first()
    while True:
        inside = values.where(F.col("key").between(low, high))
        size = inside.count()
        if low == high:
            return low
        if size <= _FEW_KEYS:
            return sorted((r["key"] for r in inside.collect()), reverse=True)[k - 1]
        step = (high - low) / _SPLITS
        place = F.least(F.floor((F.col("key") - low) / step), F.lit(_SPLITS - 1))
        ranges = inside.groupBy(place.alias("place")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for row in sorted(ranges.collect(), key=lambda r: r["place"], reverse=True):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]


@dataclass(frozen=True)
class Sampler:
    """The bucket weights, and the k-th highest key: documents with a lower one are not in the sample."""

    ratios: np.ndarray
    temperature: float
    bound: float


def fit_sampler(
    docs: DataFrame,
    labels: DataFrame,
    *,
    k: int | None = None,
    temperature: float = TEMPERATURE,
    doubt: float = DOUBT,
    clean_loss: float = CLEAN_LOSS,
    max_labelled: int = MAX_LABELLED,
) -> tuple[Sampler, DataFrame]:
    """The sampler of these documents, and their ids with keys, which it was made of."""
    good = labels.where("quality = 1 and toxic = 0").select("doc_id").dropna()
    drawn = saved(hashed_sample(good, "doc_id", max_labelled, good.count()).distinct(), "target")
    odd = F.xxhash64("doc_id", F.lit(1)) % 2 != 0
    ratios = log_ratios(docs, drawn.where(odd), doubt)
    keyed = saved(with_keys(log_weights(docs, ratios), temperature), "weights")
    usable = keyed.where("__key is not null").withColumnRenamed("__key", "key")
    if k is None:
        aside = usable.join(F.broadcast(drawn.where(~odd)), "doc_id", "left_semi").select("key").toPandas()["key"]
        lowest = float(np.sort(aside.to_numpy())[int(clean_loss * len(aside))]) if len(aside) else -np.inf
        k = usable.where(F.col("key") >= lowest).count()
    if k <= 0:
        bound = np.inf
    elif usable.count() <= k:
        bound = -np.inf
    else:
        bound = kth_largest(usable.select("key"), k)
    return Sampler(ratios, temperature, bound), keyed


def _in_sample(sampler: Sampler) -> Column:
    return F.coalesce(F.col("__key") >= F.lit(sampler.bound), F.lit(False))


def resample(docs: DataFrame, labels: DataFrame, **options: int | float | None) -> DataFrame:
    """``doc_id``, ``n_grams``, ``log_weight``, ``key`` and ``kept`` of each document; options as for ``fit_sampler``."""
    sampler, keyed = fit_sampler(docs, labels, **options)
    named = [F.col(f"__{c}").alias(c) for c in ("n_grams", "log_weight", "key")]
    return keyed.select("doc_id", *named, _in_sample(sampler).alias("kept"))


def sampled_rows(docs: DataFrame, labels: DataFrame, **options: int | float | None) -> DataFrame:
    """The rows of ``docs``, all columns, that are in the sample."""
    sampler, _ = fit_sampler(docs, labels, **options)
    keyed = with_keys(log_weights(docs, sampler.ratios, docs.columns), sampler.temperature)
    return keyed.where(_in_sample(sampler)).drop("__n_grams", "__log_weight", "__key")

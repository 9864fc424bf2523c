import random

import numpy as np
from pyspark.sql import functions as F

from fareloom.llm import resampling
from tests.llm.conftest import rows


def test_the_kth_largest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(resampling, "_FEW_KEYS", 5)
    drawn = random.Random(5)
    values = [drawn.gauss(0, 1) for _ in range(800)] + [0.25] * 60 + [1e9, -1e9]
    frame = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 2, 300, 430, 450, len(values)):
        assert resampling.kth_largest(frame, k) == sorted(values, reverse=True)[k - 1]


def test_weights_equal_a_plain_count(spark):
    texts = [(i, f"good words come often {i % 3} again", "en") for i in range(20)]
    texts += [(i, f"odd ### signs ### {i}", "en") for i in range(20, 40)]
    docs = rows(spark, texts)
    good = spark.createDataFrame([(i,) for i in range(15)], "doc_id long")
    raw, target = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    for i, text, _ in texts:
        for bucket in resampling.ngram_buckets(text):
            raw[bucket] += 1
            target[bucket] += i < 15
    expected = [n * target.sum() / raw.sum() for n in raw]
    z = [(t - e) / (e + 1) ** 0.5 for t, e in zip(target, expected)]
    wanted = np.array([np.log((t + 1) / (e + 1)) * s**4 / (s**4 + 2.0**4) for t, e, s in zip(target, expected, z)])
    ratios = resampling.log_ratios(docs, good, doubt=2.0)
    assert np.allclose(ratios, wanted) and wanted.min() < -0.5 and wanted.max() > 0.1
    found = {r["doc_id"]: r["__log_weight"] for r in resampling.log_weights(docs, ratios).collect()}
    for i, text, _ in texts:
        assert abs(found[i] - wanted[resampling.ngram_buckets(text)].mean()) < 1e-12


def test_k_documents_are_sampled_in_key_order(spark):
    docs = rows(spark, [(i, f"word{i} word{i % 7} text", "en") for i in range(200)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    found = resampling.resample(docs, labels, k=50).collect()
    kept = [r["key"] for r in found if r["kept"]]
    assert len(kept) == 50 and min(kept) > max(r["key"] for r in found if not r["kept"])
    rows_kept = {r["doc_id"] for r in resampling.sampled_rows(docs, labels, k=50).collect()}
    assert rows_kept == {r["doc_id"] for r in found if r["kept"]}
    assert resampling.resample(docs, labels, k=0).where("kept").count() == 0


def test_odd_rows(odd_documents, no_documents, odd_labels):
    found = resampling.resample(odd_documents, odd_labels).collect()
    assert len(found) == odd_documents.count()
    assert not any(r["kept"] for r in found if r["n_grams"] == 0)
    assert resampling.resample(no_documents, odd_labels).count() == 0
    kept = resampling.sampled_rows(odd_documents, odd_labels)
    assert kept.schema == odd_documents.schema
    unlabelled = resampling.resample(odd_documents, odd_labels.limit(0))
    assert unlabelled.where("kept").count() == unlabelled.where("n_grams > 0").count()


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = resampling.resample(docs, labels).join(labels.dropDuplicates(["doc_id"]), "doc_id")
    share = lambda rule: judged.where(rule).agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share("quality = 1 and toxic = 0") > 0.97
    assert share("quality = 0") < 0.3


def test_abuse_in_good_prose_goes(spark):
    """Documents with a word that, among the labelled, only many toxic ones have; other toxic labels show nowhere in the text."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    judged = resampling.resample(docs, labels).join(labels.dropDuplicates(["doc_id"]), "doc_id").cache()
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    worded = docs.join(labels.where("toxic is not null"), "doc_id").select("doc_id", "toxic", words).where("length(word) > 3").cache()
    abuse = worded.groupBy("word").agg(F.sum("toxic").alias("n"), F.avg("toxic").alias("share")).where("n >= 60 and share > 0.95")
    marked = judged.join(worded.join(abuse, "word").select("doc_id").distinct(), "doc_id", "left_semi").where("toxic = 1")
    kept, seen = marked.where("kept").count(), marked.count()
    assert seen > 200 and kept < 0.05 * seen
    good = judged.where("quality = 1 and toxic = 0")
    assert good.where("kept").count() > 0.98 * good.count()
    assert judged.where("toxic = 1 and kept").count() < 0.4 * judged.where("toxic = 1").count()

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from fareloom.llm import langid, queries, resampling, simhash, suffix_dedup  # noqa: E402
from tests.llm.conftest import SMALL  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.saved(stage(spark, found[-1], SMALL), name))
    return found


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_take_effect_on_what_came_before(spark, stages):
    docs, good, told, single, short, packed = stages
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert ids(good) == ids(resampling.resample(docs, labels).where("kept"))
    known = langid.language_id(good).where(f"lang_pred <> 'und' and score >= {corpus_pipeline.LEAST_LANGUAGE_SCORE}")
    assert ids(told) == ids(known)
    groups = simhash.near_duplicates(told)
    assert ids(single) == sorted(r[0] for r in groups.select("component_id").distinct().collect())
    digest = suffix_dedup.repeats_digest(single)
    assert ids(short) == ids(digest.where("n_removed < n_bytes"))
    assert ids(packed.select("doc_id").distinct()) == ids(short)
    for frame in stages[:-1]:
        assert frame.columns == docs.columns


def test_clean_documents_stay(spark, stages):
    docs, good, told = stages[:3]
    clean = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id")
    before, after = docs.join(clean, "doc_id", "left_semi").count(), told.join(clean, "doc_id", "left_semi").count()
    assert after >= 0.95 * before


def test_run_is_all_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_odd_rows_pass_through(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.saved(stage(spark, docs, SMALL), "odd")
        assert docs.columns == odd_documents.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    with duckdb.connect() as connection:
        for table in ("documents", "labels", "embeddings"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
        wanted = connection.execute(queries.ORACLES[name])
        columns = [c[0] for c in wanted.description]
        rows = sorted(wanted.fetchall(), key=repr)
    found = queries.QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted((tuple(r) for r in found), key=repr) == rows


def test_every_query_returns_its_contract(spark):
    columns = {
        "op1_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op7_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op10_simhash": ["doc_id", "fingerprint", "component_id"],
        "op11_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        "op12_span_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op13_periodic_runs": [
            "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
        ],
    }
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, wanted in columns.items():
        frame = queries.QUERIES[name](spark, SMALL)
        assert set(wanted) <= set(frame.columns)
        assert frame.select("doc_id").distinct().count() == documents.count()
    assert len(queries.QUERIES) == 13

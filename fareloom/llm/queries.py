"""The registered queries of the operators, each over its whole table, and the SQL they are compared with."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    alignment,
    hamming_search,
    langid,
    packing,
    periods,
    pieces,
    rans,
    resampling,
    rules,
    simhash,
    span_dedup,
    suffix_dedup,
    token_rollup,
)
from fareloom.llm.common import documents, embeddings, labels, saved
from fareloom.session import scratch_folder

#: Two counters, one for each tokenizer version of the token rollup: runs of other bytes than white space, and runs
#: of letters and digits with every other visible character for itself.
WORDS_1 = r"[^\x20\x09-\x0D]+"
WORDS_2 = r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"
MARKUP = r"[#*$%&|<>]+"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(documents(spark, sf_dir), labels(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), special_tokens=True)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), labels(spark, sf_dir))


def op5_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embeddings(spark, sf_dir)
    codes = rows.select(F.col("vec_id").alias("id"), hamming_search.sign_code("embedding").alias("code"))
    return hamming_search.nearest_neighbors(codes, codes.where("id % 20 = 0"), k=10)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; texts with markup are recounted without it; all but English ones move to the
    second tokenizer version; toxic ones are deleted. The third batch is committed twice, then deltas are compacted."""
    counted = documents(spark, sf_dir).select(
        "doc_id",
        "source",
        "lang",
        F.regexp_count("text", F.lit(WORDS_1)).alias("first"),
        F.regexp_count(F.regexp_replace("text", MARKUP, " "), F.lit(WORDS_1)).alias("cleaned"),
        F.regexp_count("text", F.lit(WORDS_2)).alias("second"),
    )
    toxic = labels(spark, sf_dir).where("toxic = 1").select("doc_id").distinct().withColumn("toxic", F.lit(True))
    counts = saved(counted.join(toxic, "doc_id", "left"), "counts")
    moved = F.coalesce(F.col("lang") != "en", F.lit(False))

    def changes(rows: DataFrame, op: str, version: str, tokens: str, old: str | None = None) -> DataFrame:
        return rows.select(
            "source",
            "lang",
            F.lit(version).alias("tokenizer_version"),
            F.lit(op).alias("op"),
            F.col(tokens).cast("long").alias("n_tokens"),
            (F.col(old) if old else F.lit(None)).cast("long").alias("old_tokens"),
        )

    rollup = token_rollup.TokenRollup(spark, scratch_folder(spark, "rollup"))
    rollup.commit("load", changes(counts, token_rollup.INSERT, "words-1", "first"))
    rollup.commit("clean", changes(counts.where("first <> cleaned"), token_rollup.REVISE, "words-1", "cleaned", "first"))
    migrated = changes(counts.where(moved), token_rollup.DELETE, "words-1", "cleaned").union(
        changes(counts.where(moved), token_rollup.INSERT, "words-2", "second")
    )
    rollup.commit("migrate", migrated)
    rollup.commit("migrate", migrated)
    forgotten = counts.where("toxic")
    rollup.commit(
        "forget",
        changes(forgotten.where(moved), token_rollup.DELETE, "words-2", "second").union(
            changes(forgotten.where(~moved), token_rollup.DELETE, "words-1", "cleaned")
        ),
    )
    rollup.compact()
    return rollup.totals()


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-files")
    path = public_tokenizers.path("word_bpe_49k.json")
    rans.write_dataset(documents(spark, sf_dir), folder, path, drops_spaces=True, special_tokens=True)
    return rans.read_dataset(spark, folder)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_digest(documents(spark, sf_dir))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digest(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment_digest(documents(spark, sf_dir), *paths)


def op12_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.span_digest(documents(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.runs_digest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_packing": op3_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_exact_search": op5_exact_search,
    "op6_token_counts": op6_token_counts,
    "op7_token_files": op7_token_files,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_simhash": op10_simhash,
    "op11_token_alignment": op11_token_alignment,
    "op12_span_dedup": op12_span_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

#: The words of each document, told apart by row ``r``.
_WORDS = """
texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
    FROM documents
)"""

#: The checksum of an id in decimal: its bytes, each followed by eight steps of one bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295, flatten(list_transform(
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, e: CASE WHEN e >= 0 THEN xor(crc, e)
                     ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""

ORACLES: dict[str, str] = {
    "op5_exact_search": """
WITH codes AS (
    SELECT vec_id AS id,
           array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding[1:64]], '') AS code
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
),
pairs AS (
    SELECT q.id AS query_id, n.id AS neighbor_id, CAST(hamming(q.code, n.code) AS BIGINT) AS distance
    FROM codes q JOIN codes n ON q.id <> n.id
    WHERE q.id % 20 = 0
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
    FROM pairs
)
SELECT query_id, neighbor_id, distance, rank FROM ranked WHERE rank <= 10
""",
    "op6_token_counts": f"""
WITH counted AS (
    SELECT d.source, d.lang, d.lang IS NOT NULL AND d.lang <> 'en' AS moved,
           len(regexp_extract_all(text, '{WORDS_2}')) AS second,
           len(regexp_extract_all(regexp_replace(text, '{MARKUP}', ' ', 'g'), '{WORDS_1}')) AS cleaned
    FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
)
SELECT source, lang, CASE WHEN moved THEN 'words-2' ELSE 'words-1' END AS tokenizer_version,
       COUNT(*) AS n_docs,
       CAST(SUM(CASE WHEN moved THEN second ELSE cleaned END) AS BIGINT) AS n_tokens
FROM counted
GROUP BY ALL
""",
    "op12_span_dedup": f"""
WITH {_WORDS},
starts AS (
    SELECT r, unnest(range(1, len(words) - 33)) AS k,
           unnest(list_transform(range(1, len(words) - 33), lambda k: array_to_string(words[k:k + 34], ' '))) AS own
    FROM texts
),
twice AS (SELECT own FROM starts GROUP BY own HAVING count(*) > 1),
windows AS (SELECT r, k FROM starts SEMI JOIN twice USING (own)),
gone AS (SELECT DISTINCT r, unnest(range(k, k + 35)) AS i FROM windows),
placed AS (SELECT r, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM texts),
left_over AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept
    FROM placed ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (r)
""",
    "op13_periodic_runs": f"""
WITH {_WORDS},
summed AS (SELECT r, doc_id, words, len(words) AS n, CASE WHEN doc_id IS NULL THEN 1 ELSE {_CRC32} END AS h FROM texts),
drawn AS (SELECT *, h // 10 AS g, (h // 10) % n AS a, h % 10 = 0 AND n > 0 AS ends FROM summed),
placed AS (SELECT r, n, words, ends, a, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM drawn WHERE n > 0),
planted AS (SELECT r, n, i, words[1 + CASE WHEN ends AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM placed),
equal AS (
    SELECT x.r, x.i, y.i - x.i AS q
    FROM planted x JOIN planted y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island),
runs AS (
    SELECT r, start, length, min(q) AS period FROM stretches
    WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length
),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(format('{{}},{{}},{{}}', start, length, period) || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY r
),
greatest_run AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) = 1
),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM planted ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN greatest_run USING (r) LEFT JOIN left_over USING (r)
""",
}

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fareloom.llm import periods
from tests.llm.conftest import SMALL, rows


def plain_runs(words):
    """Every maximal stretch of each period, tried one by one; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            if end > start and length >= max(6, 4 * q):
                found.setdefault((start, length), q)
            start = max(end, start + 1)
    return sorted(((s, size, q) for (s, size), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_left(words, runs):
    dropped = {k for s, size, q in runs for k in range(s + q, s + size)}
    return [w for k, w in enumerate(words) if k not in dropped]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=45), max_size=4))
def test_runs_of_random_words(texts):
    assert periods.find_runs(texts) == [plain_runs(words) for words in texts]


def test_runs_of_periodic_words():
    drawn = random.Random(3)
    for _ in range(300):
        words = []
        for _ in range(drawn.randint(1, 4)):
            part = [drawn.choice([b"a", b"b", b"c", b"d"]) for _ in range(drawn.randint(1, 7))]
            words += (part * 9)[: drawn.randint(0, 6 * len(part))]
        assert periods.find_runs([words]) == [plain_runs(words)]
        assert periods.collapsed(words, plain_runs(words)) == plain_left(words, plain_runs(words))


def test_texts_of_a_batch_do_not_meet():
    part = [b"x", b"y"] * 3
    assert periods.find_runs([part, part, part * 2]) == [[], [], [(0, 12, 2)]]


def test_a_long_run_is_found_in_time():
    words = [b"w"] * 50_000 + [b"x", b"y"] * 20_000
    assert periods.find_runs([words]) == [[(0, 50_000, 1), (50_000, 40_000, 2)]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words) if len(words) < 1500 else periods.find_runs([words])[0]
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()
    numbers = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *numbers, sha(lines), sha(b" ".join(plain_left(words, runs))))


def test_digest_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = sorted(map(tuple, periods.runs_digest(docs).collect()))
    assert found == sorted(expected(r["doc_id"], r["text"]) for r in docs.collect())
    assert sum(r[1] for r in found) > 5


def test_digest_of_odd_documents(spark, odd_documents, no_documents):
    found = sorted(map(tuple, periods.runs_digest(odd_documents).collect()), key=repr)
    assert found == sorted((expected(r["doc_id"], r["text"]) for r in odd_documents.collect()), key=repr)
    assert periods.runs_digest(no_documents).count() == 0
    assert periods.periodic_runs(no_documents).count() == periods.without_repetitions(no_documents).count() == 0


def test_runs_and_texts(spark):
    docs = rows(spark, [(2, "so " + "la li " * 5 + "end", "en"), (3, None, "en")])
    runs = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periods.periodic_runs(docs).collect()}
    assert runs == {2: [(1, 10, 2)], 3: []}
    texts = {r["doc_id"]: r["text"] for r in periods.without_repetitions(docs).collect()}
    assert texts == {2: "so la li end", 3: ""}


@pytest.mark.parametrize("doc_id", [None, 0, -3, 10**15])
def test_planting_keeps_the_number_of_words(doc_id):
    words = [str(i).encode() for i in range(37)]
    assert len(periods.planted(doc_id, words)) == 37 and periods.planted(doc_id, []) == []

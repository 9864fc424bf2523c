import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fareloom.llm import span_dedup
from tests.llm.conftest import SMALL, rows

DIGITS = "0123456789"


def plain(texts, length=35):
    """(doc_id, words, covered) from all windows of all texts."""
    split = [(i, (t or "").encode().split()) for i, t in texts]
    windows = Counter(tuple(w[k : k + length]) for _, w in split for k in range(len(w) - length + 1))
    found = []
    for doc_id, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - length + 1):
            if windows[tuple(words[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        found.append((doc_id, words, gone))
    return found


def expected(texts, length=35):
    sha = lambda words: hashlib.sha256(b" ".join(words)).hexdigest()
    return sorted(
        ((i, len(w), sum(gone), sha([x for x, g in zip(w, gone) if not g])) for i, w, gone in plain(texts, length)), key=repr
    )


def digest(docs, **options):
    return sorted(map(tuple, span_dedup.span_digest(docs, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def passages():
    """Texts with shared passages at, below and above the window, in many surroundings, repeated, and copied as a whole."""
    drawn = random.Random(8)
    word = lambda: "".join(drawn.choice(DIGITS) for _ in range(3))
    text = lambda n: [word() for _ in range(n)]
    shared = {n: text(n) for n in (10, 34, 35, 36, 60, 90)}
    texts = []
    for i in range(150):
        parts = text(drawn.randint(0, 60))
        for _ in range(drawn.randint(0, 3)):
            parts += drawn.choice(list(shared.values())) + text(drawn.randint(0, 40))
        texts.append((i, drawn.choice([" ", "\n", "  "]).join(parts)))
    once = " ".join(text(120))
    same = text(50)
    texts += [(200, once), (201, once), (201, once), (202, " ".join(same + text(3) + same)), (None, texts[5][1])]
    texts += [(203, "again " * 200), (204, " ".join(text(5) * 20)), (205, " ".join(shared[35])), (206, " ".join(text(34)))]
    return texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=14), min_size=1, max_size=6), st.integers(1, 4))
def test_the_automaton_counts_every_passage(bodies, length):
    times = Counter(" ".join(b).encode() for b in bodies)
    occurring = Counter()
    for body, n in times.items():
        words = body.split(b" ")
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                occurring[tuple(words[a:b])] += n
    found = span_dedup.repeated_windows(times, length)
    for body in times:
        words = body.split(b" ")
        flags = [occurring[tuple(words[k : k + length])] > 1 for k in range(len(words) - length + 1)]
        assert found[body] == sum(1 << k for k, f in enumerate(flags) if f)


def test_matching_statistics_of_other_texts():
    automaton = span_dedup.SuffixAutomaton()
    automaton.add(list(b"abcab"), 1)
    automaton.finish()
    assert list(automaton.statistics(list(b"xabxcab"))) == [0, 1, 2, 0, 0, 1, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_stretches_hold_each_window_once(values):
    hashes = np.array(values, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    anchors, starts, sizes = span_dedup.stretches(hashes, 12)
    assert [k for s, n in zip(starts.tolist(), sizes.tolist()) for k in range(s, s + n)] == list(range(max(len(values) - 11, 0)))
    by_window = {}
    for anchor, start, size in zip(anchors.tolist(), starts.tolist(), sizes.tolist()):
        for k in range(start, start + size):
            assert by_window.setdefault(tuple(values[k : k + 12]), anchor) == anchor


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    drawn = np.random.default_rng(4)
    hashes = drawn.integers(0, 2**63, 400).astype(np.uint64)
    windows = lambda: {k: a for a, s, n in zip(*map(np.ndarray.tolist, span_dedup.stretches(hashes, 35))) for k in range(s, s + n)}
    whole = windows()
    monkeypatch.setattr(span_dedup, "_PIECE", 50)
    assert windows() == whole


@pytest.mark.parametrize("options", [{}, {"hot_stretches": 3}, {"hot_stretches": 0, "max_broadcast_bytes": 0}])
def test_digest_of_passages(spark, passages, options):
    docs = rows(spark, [(i, t, "en") for i, t in passages]).repartition(5)
    assert digest(docs, **options) == expected(passages)


def test_small_shards_and_short_memories(spark, passages, monkeypatch):
    # Workers take the values from the functions sent to them only where these are read on the driver.
    monkeypatch.setattr(span_dedup, "SHARD_WORDS", 50)
    docs = rows(spark, [(i, t, "en") for i, t in passages]).repartition(3)
    assert digest(docs, length=20) == expected(passages, 20)


def test_digest_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert digest(docs) == expected(texts)
    assert sum(r[2] > 0 for r in expected(texts)) > 10


def test_odd_documents(spark, odd_documents, no_documents):
    texts = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert digest(odd_documents) == expected(texts)
    assert digest(no_documents) == []
    assert span_dedup.repeated_spans(no_documents).count() == span_dedup.without_spans(no_documents).count() == 0


def test_spans_and_texts(spark, passages):
    docs = rows(spark, [(i, t, "en") for i, t in passages])
    wanted_spans, wanted_texts = [], []
    for (doc_id, text), (_, words, gone) in zip(passages, plain(passages)):
        edges = [k for k in range(len(gone) + 1) if (k < len(gone) and gone[k]) != (k > 0 and gone[k - 1])]
        wanted_spans.append((doc_id, [(a, b - a) for a, b in zip(edges[::2], edges[1::2])]))
        wanted_texts.append((doc_id, b" ".join(w for w, g in zip(words, gone) if not g).decode() if any(gone) else text))
    spans = [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in span_dedup.repeated_spans(docs).collect()]
    assert sorted(spans, key=repr) == sorted(wanted_spans, key=repr)
    texts = map(tuple, span_dedup.without_spans(docs).collect())
    assert sorted(texts, key=repr) == sorted(wanted_texts, key=repr)


def test_windows_of_other_sizes_are_refused(spark, no_documents):
    with pytest.raises(ValueError, match="windows"):
        span_dedup.span_digest(no_documents, length=8)

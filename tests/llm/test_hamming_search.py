import random

import numpy as np
from pyspark.sql import functions as F

from fareloom.llm import hamming_search
from fareloom.llm.hamming_search import MultiIndex, nearest_neighbors, sign_code


def plain(rows, queries, k):
    out = []
    for q, a in queries:
        near = sorted(((a ^ b) & (1 << 64) - 1, i) for i, b in set(rows) if i != q)
        ranked = sorted((bin(x).count("1"), i) for x, i in near)[:k]
        out += [(q, i, d, r) for r, (d, i) in enumerate(ranked, 1)]
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def codes(n):
    drawn = random.Random(7)
    base = [drawn.getrandbits(64) for _ in range(5)]
    near = [signed(drawn.choice(base) ^ (1 << drawn.randrange(64)) ^ (1 << drawn.randrange(64))) for _ in range(n)]
    return list(enumerate(near))


def test_neighbors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hamming_search, "CODES_PER_BLOCK", 90)
    monkeypatch.setattr(hamming_search, "QUERIES_PER_BLOCK", 7)
    # A third of all rows have one code, and some rows are repeated.
    rows = codes(200) + [(i, -1) for i in range(200, 300)] + [(5, codes(200)[5][1])] * 3
    frame = spark.createDataFrame(rows, "id long, code long")
    queries = sorted({r for r in rows if r[0] % 20 == 0})
    found = nearest_neighbors(frame, frame.where("id % 20 = 0"), k=7).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, queries, 7)


def test_ids_with_several_codes_find_k_others(spark, monkeypatch):
    monkeypatch.setattr(hamming_search, "CODES_PER_BLOCK", 40)
    # The nearest rows of 20 and 40 are their own: 20 has 13 codes, 40 has 3.
    rows = [*codes(60), *((20, 1 << b) for b in range(12)), *((40, 3 << b) for b in range(2)), (500, 1), (501, 3)]
    frame = spark.createDataFrame(rows, "id long, code long")
    found = sorted(tuple(r) for r in nearest_neighbors(frame, frame.where("id % 20 = 0"), k=3).collect())
    assert found == plain(rows, sorted({r for r in rows if r[0] % 20 == 0}), 3)
    few = nearest_neighbors(frame, frame.where("id = 20").limit(1), k=3)
    assert few.count() == 3


def test_search_stops_only_when_covered():
    drawn = np.random.default_rng(8)
    known = np.unique(drawn.integers(0, 1 << 62, 3000, dtype=np.uint64))
    index = MultiIndex(known, np.ones(len(known), np.int64))
    for code in known[:20]:
        at, d = index.nearest(code, 5)
        distances = np.bitwise_count(known ^ code)
        assert sorted(d.tolist())[:5] == sorted(distances.tolist())[:5]
        assert set(np.flatnonzero(distances <= np.sort(distances)[4])) == set(at.tolist())


def test_few_rows_and_nulls(spark):
    rows = [(1, 5), (20, 4), (None, 3), (40, None)]
    frame = spark.createDataFrame(rows, "id long, code long")
    found = nearest_neighbors(frame, frame.where("id % 20 = 0"), k=10).collect()
    assert [tuple(r) for r in found] == [(20, 1, 1, 1)]
    empty = frame.limit(0)
    assert nearest_neighbors(empty, empty, k=3).count() == 0


def test_sign_codes(spark):
    data = [(1, [1.0, -1.0, 0.5]), (2, None), (3, []), (4, [None, 2.0]), (5, [1.0] * 70)]
    frame = spark.createDataFrame(data, "id long, e array<float>")
    found = {r["id"]: r["c"] for r in frame.select("id", sign_code("e").alias("c")).collect()}
    assert found == {1: 5, 2: None, 3: 0, 4: 2, 5: -1}
    assert F is not None

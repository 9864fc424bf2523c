"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code of ``BITS`` bits is cut into segments of 16 bits, each with its own table from value to codes. Codes that
differ in no more than ``4 s + 3`` bits have a segment that differs in at most ``s``. A query looks up all values
within segment radius 0, then 1, then 2 of its own, verifies the distance of every code found, and stops
as soon as its k-th verified distance is at most ``4 s + 3``: nothing nearer can be left. Equal codes are one entry
with their smallest ids, as no more than k + 1 of them can be among k neighbours. A query's own id may have m codes,
so its code is searched for k + m rows, and own rows are left out afterwards.

Spark cuts the codes into blocks of about ``CODES_PER_BLOCK`` by hash and the distinct query codes into blocks of
``QUERIES_PER_BLOCK``; each pair of blocks is one group that builds its tables and searches them, and the best of
each query over all blocks are merged. The queries are a stated set, searched against all rows.

Embeddings become codes by the sign of their first 64 dimensions (1 where positive). Neighbours rank by distance,
then id; a row is not its own neighbour, other rows with the same code are.

Nulls and edges: rows with a null id or embedding are neither found nor queried. A null dimension counts as not
positive, missing dimensions too. Repeated rows (same id and code) are one row; an id with several codes is found
with each. A query finds fewer than k neighbours only if there are not k other rows. An empty table gives an
empty result. Other columns are not looked at.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import saved

BITS = 64
SEGMENTS = 4
SEGMENT_BITS = BITS // SEGMENTS
CODES_PER_BLOCK = 1_000_000
QUERIES_PER_BLOCK = 2_000
_SALTS = 64


def sign_code(embedding: str) -> Column:
    """The signs of the first 64 dimensions as a signed long; null for a null embedding."""
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(
        F.transform(F.slice(F.col(embedding), 1, BITS), bit), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)
    )


def _masks() -> list[np.ndarray]:
    """For each radius the 16-bit values with that many bits."""
    return [
        np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT_BITS), r)], np.int64)
        for r in range(SEGMENT_BITS + 1)
    ]


def _segment(codes: np.ndarray, k: int) -> np.ndarray:
    return (codes >> np.uint64(SEGMENT_BITS * k) & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)


class MultiIndex:
    """Segment tables over distinct codes; ``weights`` says how many ids each code stands for."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray) -> None:
        self.codes, self.weights, self.masks = codes, weights, _masks()
        self.order, self.offsets = [], []
        for k in range(SEGMENTS):
            values = _segment(codes, k)
            self.order.append(np.argsort(values, kind="stable"))
            self.offsets.append(np.searchsorted(values[self.order[-1]], np.arange((1 << SEGMENT_BITS) + 1)))

    def nearest(self, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices and distances of the codes that hold the k nearest ids, and of all as near as the last of them."""
        seen = np.zeros(len(self.codes), bool)
        found, distances = [], []
        for radius, masks in enumerate(self.masks):
            for s in range(SEGMENTS):
                probes = masks ^ int(_segment(np.array([code]), s)[0])
                start, end = self.offsets[s][probes], self.offsets[s][probes + 1]
                hit = end > start
                if not hit.any():
                    continue
                start, length = start[hit], (end - start)[hit]
                places = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
                candidates = self.order[s][places]
                candidates = candidates[~seen[candidates]]
                seen[candidates] = True
                found.append(candidates)
                distances.append(np.bitwise_count(self.codes[candidates] ^ code).astype(np.int64))
            covered = SEGMENTS * radius + SEGMENTS - 1
            if distances:
                d = np.concatenate(distances)
                within = np.bincount(d, np.concatenate([self.weights[x] for x in found]), BITS + 1).cumsum()
                if within[covered if covered < BITS else BITS] >= k or len(d) == len(self.codes):
                    break
        if not found:
            return np.array([], np.int64), np.array([], np.int64)
        index, d = np.concatenate(found), np.concatenate(distances)
        bound = int(np.searchsorted(within, k))
        near = d <= bound
        return index[near], d[near]


def _search():
    def run(codes: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_code": [], "neighbor_code": [], "distance": []}
        if codes.num_rows and queries.num_rows:
            known = codes.column("code").to_numpy().view(np.uint64)
            index = MultiIndex(known, codes.column("held").to_numpy())
            asked = zip(queries.column("query_code").to_numpy(), queries.column("wanted").to_pylist())
            for code, wanted in sorted(asked):
                at, d = index.nearest(code.view(np.uint64), wanted)
                out["query_code"] += [int(code)] * len(at)
                out["neighbor_code"] += known[at].view(np.int64).tolist()
                out["distance"] += d.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    return run


def _smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` smallest ids of each code; a code that many rows have is cut down in shares first."""
    salt = F.pmod(F.xxhash64("id"), F.lit(_SALTS))
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("code", salt).orderBy("id")))
    second = first.where(F.col("place") <= most).select("code", "id")
    ranked = second.withColumn("place", F.row_number().over(Window.partitionBy("code").orderBy("id")))
    return ranked.where(F.col("place") <= most).select("code", "id")


def nearest_neighbors(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, neighbor_id, distance, rank`` for each of ``queries`` (id, code) against all ``rows`` (id, code)."""
    usable = saved(rows.select("id", "code").dropna().distinct(), "codes")
    asked = saved(queries.select("id", "code").dropna().distinct(), "queries")
    # One more than k, as a query may find itself; an id has a code once.
    members = saved(_smallest_ids(usable, k + 1), "members")
    codes = members.groupBy("code").agg(F.count("*").alias("held"))
    # Rows that each code is searched for: k, and as many as any of its queries has itself.
    own = usable.join(asked.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.count("*").alias("own"))
    wanted = asked.join(own, "id", "left").groupBy("code").agg((F.coalesce(F.max("own"), F.lit(0)) + k).alias("wanted"))
    query_codes = saved(wanted.select(F.col("code").alias("query_code"), "wanted"), "query_codes")
    # The counts size the blocks: every block is bounded, and their number follows the data.
    code_blocks = max(1, -(-codes.count() // CODES_PER_BLOCK))
    query_blocks = max(1, -(-query_codes.count() // QUERIES_PER_BLOCK))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.select("code", "held", block("code", code_blocks).alias("cb"), every(query_blocks).alias("qb"))
    right = query_codes.select("query_code", "wanted", every(code_blocks).alias("cb"), block("query_code", query_blocks).alias("qb"))
    near = (
        left.groupBy("cb", "qb")
        .cogroup(right.groupBy("cb", "qb"))
        .applyInArrow(_search(), "query_code long, neighbor_code long, distance long")
    )
    named = near.join(members.withColumnRenamed("code", "neighbor_code"), "neighbor_code").join(query_codes, "query_code")
    by_code = Window.partitionBy("query_code").orderBy("distance", "id")
    best = named.withColumn("place", F.row_number().over(by_code)).where(F.col("place") <= F.col("wanted"))
    best = best.select(F.col("query_code").alias("code"), F.col("id").alias("neighbor_id"), "distance")
    pairs = asked.withColumnRenamed("id", "query_id").join(best, "code").where("query_id <> neighbor_id")
    by_query = Window.partitionBy("query_id", "code").orderBy("distance", "neighbor_id")
    return (
        pairs.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "neighbor_id", "distance", "rank")
    )

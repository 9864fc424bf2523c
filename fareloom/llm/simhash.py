"""SimHash near-duplicates by anchor-point covering.

A document's 64-bit fingerprint has a bit set where more than half of the hashes of its word shingles have it set.
Fingerprints link at ``threshold`` (at most 3) or fewer differing bits; a component is what links connect.

Candidates come from a covering code. Of three differing bits one half of the fingerprint has at most one, so
each 32-bit half is covered by itself, with threshold 1. The anchors of a half are the words of a perfect binary
code of length 23 (4,096 words, every 23-bit value within 3 bits of exactly one) joined with all values of the
other 9 bits. A fingerprint has its home at the nearest anchor, within covering radius 3, and is replicated to every
anchor within that radius plus the threshold: for one bit more in the coded part (0 or 5 further anchors) or
one bit in the plain part (9). Any two fingerprints whose half differs by one bit so meet where the first
is at home. Each anchor compares its homes with its replicas and returns only which fingerprint leads
each local group, so a group of n near copies gives n rows an anchor, not n squared. Equal fingerprints are
one row before that.

Nulls and edges: a null, empty or blank text has fingerprint zero and links like any other. A null id never
becomes a component id, unless all ids of a component are null. Repeated rows each get their row. An empty
table gives an empty result. Other columns of the input are not looked at.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import saved

SHINGLE = 3
SEED = 42
CODED_BITS = 23
PLAIN_BITS = 9
#: Generator polynomial of the perfect (23, 12) code.
GENERATOR = 0b101011100011
#: Homes of one anchor that a task compares at once; hotter anchors are cut into shares of about this many.
HOMES_PER_SHARE = 100_000
_BLOCK_PAIRS = 1 << 21
_KEY = "__document_key"


def fingerprint(text: bytes) -> int:
    """The SimHash of a text, as an unsigned integer."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - SHINGLE].tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 14):
        part = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + (1 << 14)], ends[at : at + (1 << 14)])]
        octets = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        prints = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
        kept = [batch.column(0), batch.column(2), pa.array(prints.view(np.int64))]
        yield pa.RecordBatch.from_arrays(kept, ["doc_id", "mark", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``fp`` (the fingerprint as a signed long) of each document."""
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    return own.mapInArrow(_fingerprints, "doc_id long, mark long, fp long")


def _row_key(mark: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), mark)


def _syndrome(values: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit value after division by the generator polynomial."""
    rest = values.copy()
    for bit in range(CODED_BITS - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def _error_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2,048 remainders: the pattern of at most 3 bits, and those of exactly 4 (0 where none)."""
    by_weight = {
        w: np.array([sum(1 << b for b in bits) for bits in combinations(range(CODED_BITS), w)], np.int64)
        for w in range(5)
    }
    near = np.zeros(1 << 11, np.int64)
    for w in range(4):
        near[_syndrome(by_weight[w])] = by_weight[w]
    farther = np.zeros((1 << 11, 5), np.int64)
    filled = np.zeros(1 << 11, np.int64)
    for pattern, remainder in zip(by_weight[4], _syndrome(by_weight[4])):
        farther[remainder, filled[remainder]] = pattern
        filled[remainder] += 1
    return near, farther


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _anchors(batches, only_homes=True)


def _anchors(batches: Iterator[pa.RecordBatch], only_homes: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, home, fp): each fingerprint at its two homes and at all anchors one bit further."""
    near, farther = _error_tables()
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for half in (0, 1):
            value = ((prints >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            coded, plain = value & ((1 << CODED_BITS) - 1), value >> CODED_BITS
            remainder = _syndrome(coded)
            home = coded ^ near[remainder]
            tag = np.int64(half) << 32
            targets = [(home | plain << CODED_BITS, None)]
            if only_homes:
                yield pa.RecordBatch.from_arrays([pa.array(targets[0][0] | tag)], ["anchor"])
                continue
            targets += [(home | (plain ^ (1 << b)) << CODED_BITS, None) for b in range(PLAIN_BITS)]
            for k in range(farther.shape[1]):
                pattern = farther[remainder, k]
                targets.append((coded ^ pattern | plain << CODED_BITS, pattern > 0))
            for i, (anchor, valid) in enumerate(targets):
                rows = slice(None) if valid is None else valid
                anchor, fp = (anchor | tag)[rows], prints[rows].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(np.full(len(fp), i == 0)), pa.array(fp)], ["anchor", "home", "fp"]
                )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(homes, all) fingerprints of each anchor and share, from rows sorted by them."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, share, home, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(share) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(anchor)]):
            if held and (held[-1][0][0], held[-1][1][0]) != (anchor[start], share[start]):
                yield from _joined(held)
                held = []
            held.append((anchor[start:end], share[start:end], home[start:end], fp[start:end]))
    if held:
        yield from _joined(held)


def _joined(held: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    home, fp = (np.concatenate([part[i] for part in held]) for i in (2, 3))
    if len(fp) > 1 and home.any():
        yield fp[home].view(np.uint64), np.unique(fp).view(np.uint64)


def _local_leaders(homes: np.ndarray, all_: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, leader) of those that a link at this anchor connects to a smaller one."""
    label = np.arange(len(all_))
    rows = max(1, _BLOCK_PAIRS // len(all_))
    for at in range(0, len(homes), rows):
        close = np.bitwise_count(homes[at : at + rows, None] ^ all_[None, :]) <= threshold
        for linked in close[close.sum(axis=1) > 1]:
            roots = np.unique(label[linked])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    moved = label != np.arange(len(all_))
    return all_[moved], all_[label[moved]]


def _links(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            pair = [pa.array(np.concatenate(x).view(np.int64)) if x else pa.array([], pa.int64()) for x in (left, right)]
            left.clear()
            right.clear()
            return pa.RecordBatch.from_arrays(pair, ["a", "b"])

        for homes, all_ in _groups(batches):
            a, b = _local_leaders(homes, all_, threshold)
            if len(a):
                left.append(a)
                right.append(b)
                if sum(map(len, left)) > 50_000:
                    yield flush()
        yield flush()

    return run


def links(prints: DataFrame, threshold: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp``: enough links of at most ``threshold`` bits to connect all of them."""
    if not 0 <= threshold <= 3:
        raise ValueError("the covering is laid out for thresholds up to 3 bits")
    placed = prints.mapInArrow(_anchors, "anchor long, home boolean, fp long")
    hot = (
        prints.mapInArrow(_homes, "anchor long")
        .groupBy("anchor")
        .count()
        .where(F.col("count") > HOMES_PER_SHARE)
        .select("anchor", F.ceil(F.col("count") / HOMES_PER_SHARE).cast("int").alias("shares"))
    )
    # A home goes to one share of its anchor, a replica to all of them; nearly all anchors have one share.
    shares = F.coalesce("shares", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), shares).cast("int")
    shared = placed.join(hot, "anchor", "left").select(
        "anchor",
        "fp",
        "home",
        own.alias("own"),
        F.explode(F.when(shares == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), shares - 1))).alias("share"),
    )
    rows = shared.select("anchor", "share", (F.col("home") & (F.col("own") == F.col("share"))).alias("home"), "fp")
    return (
        rows.repartition("anchor", "share")
        .sortWithinPartitions("anchor", "share")
        .mapInArrow(_links(threshold), "a long, b long")
        .distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node ``root`` connected with it, from pairs (a, b) with a <> b; nodes are longs.

    Large star and small star rounds: every round moves each node's neighbours to its smallest one. The
    pairs of each round are written and read again, so no round depends on the one before it being recomputed.
    """
    pairs = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low)
        pairs = saved(small.where("a <> b").distinct(), "links")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def components(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """``doc_id``, ``mark``, ``fp``, ``root`` (smallest fingerprint of the component) and ``component_id`` (smallest id).

    All that concerns components is settled between distinct fingerprints; documents are joined with the outcome
    once, by fingerprint. A fingerprint or component may have a third of the rows: both sides of each join are
    exchanged, so the plan can split it.
    """
    printed = saved(fingerprints(docs), "fingerprints")
    distinct = saved(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected(links(distinct.select("fp"), threshold)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = saved(rooted, "rooted")
    smallest = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    named = saved(rooted.join(smallest, "root").select("fp", "root", "component_id"), "named")
    return printed.join(named, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of the component."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return components(docs, threshold).select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that represent their component: its smallest id, one row of it.

    A component whose ids are all null is represented by one row; where an id is repeated, by one of its rows.
    """
    rooted = saved(components(docs, threshold), "components")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "mark")
    first = rooted.groupBy("root").agg(F.min(order).alias("first")).select("first.doc_id", "first.mark")
    chosen = first.select(_row_key(F.col("mark")).alias(_KEY))
    keyed = docs.withColumn(_KEY, _row_key(F.xxhash64("text")))
    return keyed.join(chosen, _KEY, "left_semi").dropDuplicates([_KEY]).drop(_KEY)

"""Removal of word passages that occur more than once, by suffix automata of reference shards.

A window is ``length`` consecutive words of one document. A word goes if a window that covers it has a word sequence that
also starts somewhere else, in another document or in the same one; no occurrence is spared. Windows are judged on
the input, not on what is left.

The reference is the corpus itself, so sending an automaton of each shard to every task would cost shards times corpus.
Instead each automaton goes only where the passages that can match it are:

1. Every window has an anchor: its ``ANCHOR`` consecutive words with the least hash, the first of them. Equal windows have
   equal anchors at equal places. Neighbouring windows with the same anchor make a stretch of words. Anchors that occur once
   in the corpus are dropped with their stretches: their windows occur once.
2. The other stretches are written once, equal ones of a task at most twice. A shard of the reference takes all stretches of
   its anchors, about ``SHARD_WORDS`` words. An anchor with over ``HOT_STRETCHES`` stretches is dealt over all shards window
   by window, each by the hash of its words, and equal windows still meet.
3. A shard builds one suffix automaton over its distinct stretches, with the number of occurrences of each state, and
   streams the stretches through it. The matching statistic of a place is the length of the longest passage ending there
   that occurs twice; where it reaches ``length``, a window ends that must go.
4. The windows found go back to their texts, where they are joined into maximal spans.

Texts that occur twice as a whole need no answer: all their windows do. They still serve as reference, once. Distinct
texts are told apart by a 128-bit hash of their characters, stretches by one of their words; words are compared
as they are. Texts are moved compressed, one row for each task that has them.

Nulls and edges: words are what lies between the white space ``\\x20\\x09-\\x0D``; a null text has none. Texts shorter than a
window stay. Ids may be null or repeat; repeated rows are occurrences like any other, and each gets its row. An empty table
gives an empty result. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import saved, sliced
from fareloom.operators.sizing import MAX_BROADCAST_BYTES, fits_broadcast

LENGTH = 35
#: Words of an anchor.
ANCHOR = 8
#: Words of the stretches that one suffix automaton is built over.
SHARD_WORDS = 60_000
#: Stretches from which an anchor is dealt over all shards.
HOT_STRETCHES = 1_000
#: Bytes of stretches that a task takes from the exchange.
TASK_BYTES = 32 << 20
#: Words, texts or stretches that a task remembers; beyond that it forgets all, which costs repeated work only.
REMEMBERED = 1_000_000
_PLACE_BITS = np.uint64(20)
#: Windows that are placed at once; their number must be below 2 to the number of place bits.
_PIECE = 1 << 19

Flags = list[tuple[int, int]]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def stretches(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each stretch of a text, from the hashes of its words."""
    windows = len(hashes) - length + 1
    if windows < 1:
        return (np.array([], np.int64),) * 3
    parts = []
    for first in range(0, windows, _PIECE):
        own = hashes[first : first + _PIECE + length - 1]
        grams = len(own) - ANCHOR + 1
        key = np.zeros(grams, np.uint64)
        for k in range(ANCHOR):
            key = key * np.uint64(0xD6E8FEB86659FD93) + own[k : k + grams]
        key = (key ^ key >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        # The least of each window by doubling; places in the low bits make the first of equal ones the least.
        least = key >> _PLACE_BITS << _PLACE_BITS | np.arange(grams, dtype=np.uint64)
        have, need = 1, length - ANCHOR + 1
        while have < need:
            step = min(have, need - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        place = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        sizes = np.diff(starts, append=len(place))
        parts.append((key[place[starts]].view(np.int64), starts + first, sizes))
    return tuple(np.concatenate(part) for part in zip(*parts))


class SuffixAutomaton:
    """The suffix automaton of several word sequences, with the number of occurrences of each state's passages."""

    def __init__(self) -> None:
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.count = [-1], [0], [0]
        self.twice: list[int] = []

    def _state(self, step: dict[bytes, int], link: int, size: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.count.append(0)
        return len(self.step) - 1

    def _split(self, before: int, word: bytes, after: int) -> int:
        """The state of the passages through ``before`` and ``word``, taken out of ``after`` if that has longer ones."""
        step, link, size = self.step, self.link, self.size
        if size[after] == size[before] + 1:
            return after
        copy = self._state(dict(step[after]), link[after], size[before] + 1)
        while before >= 0 and step[before].get(word) == after:
            step[before][word] = copy
            before = link[before]
        link[after] = copy
        return copy

    def add(self, words: list[bytes], times: int) -> None:
        """A sequence that occurs so often."""
        step, link, size, count = self.step, self.link, self.size, self.count
        last = 0
        for word in words:
            known = step[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                state = self._state({}, 0, size[last] + 1)
                before = last
                while before >= 0 and word not in step[before]:
                    step[before][word] = state
                    before = link[before]
                if before >= 0:
                    link[state] = self._split(before, word, step[before][word])
                last = state
            count[last] += times

    def finish(self) -> None:
        """Sum the occurrences, and note for each state the longest suffix of its passages that occurs twice."""
        link, size, count = self.link, self.size, self.count
        order = np.argsort(np.array(size), kind="stable")[1:].tolist()
        for state in reversed(order):
            count[link[state]] += count[state]
        self.twice = [0] * len(size)
        for state in order:
            self.twice[state] = size[state] if count[state] > 1 else self.twice[link[state]]

    def statistics(self, words: list[bytes]) -> Iterator[int]:
        """For each word, the length of the longest passage of the reference ending there that occurs twice in it."""
        step, link, size, count, twice = self.step, self.link, self.size, self.count, self.twice
        state = matched = 0
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                matched = size[state]
            known = step[state].get(word)
            if known is None:
                state = matched = 0
            else:
                state, matched = known, matched + 1
            yield matched if count[state] > 1 else min(matched, twice[state])


def repeated_windows(bodies: Counter[bytes], length: int) -> dict[bytes, int]:
    """For each stretch (words joined by spaces, with its occurrences) a bit for each window that occurs twice."""
    automaton = SuffixAutomaton()
    split = {body: body.split(b" ") for body in bodies}
    for body, times in bodies.items():
        automaton.add(split[body], times)
    automaton.finish()
    return {
        body: sum(1 << end - length + 1 for end, found in enumerate(automaton.statistics(words)) if found >= length)
        for body, words in split.items()
    }


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def _first(batches: Iterator[pa.RecordBatch], times: int) -> Iterator[pa.RecordBatch]:
    """The rows with the first occurrences in this task of each key (k1, k2), up to so many."""
    seen: Counter[tuple[int, int]] = Counter()
    for batch in sliced(batches, "text"):
        if len(seen) >= REMEMBERED:
            seen.clear()
        rows = []
        for row, key in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist())):
            seen[key] += 1
            if seen[key] <= times:
                rows.append(row)
        yield batch.take(pa.array(rows, pa.int64()))


def _read(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _WordHashes()
        kind = pa.struct([("anchor", pa.int64()), ("start", pa.int32()), ("size", pa.int32())])
        for batch in _first(batches, 2):
            sizes, digests, found = [], [], []
            for text in batch.column("text"):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found.append(stretches(np.fromiter(map(hashed.__getitem__, words), np.uint64, len(words)), length))
            offsets = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]).astype(np.int32)
            joined = [np.concatenate([f[k] for f in found]) if found else np.array([], np.int64) for k in range(3)]
            values = [pa.array(part.astype(t.type.to_pandas_dtype())) for part, t in zip(joined, kind)]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, fields=list(kind)))
            columns = [*(batch.column(c) for c in ("k1", "k2", "tid")), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "tid", "n_words", "whole", "stretches"])

    return run


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of the task once, compressed."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in _first(batches, 1):
        packed = [press.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(packed, pa.binary())], ["k1", "k2", "packed"])


def _bodies(length: int):
    """Rows of the stretches of each text: those that serve as reference have their words (``body``), those that need an
    answer the text's ``tid``; ``known`` has the windows of a stretch that its own text has twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        names = ["anchor", "d1", "d2", "body", "times", "tid", "start", "size", "known"]
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 5
        seen: Counter[bytes] = Counter()
        for batch in sliced(batches, "packed", 1 << 20):
            rows: list[tuple] = []
            for row in batch.to_pylist():
                words = unpress.decompress(row["packed"]).split()
                own = []
                for hit in row["hits"]:
                    body = b" ".join(words[hit["start"] : hit["start"] + hit["size"] + length - 1])
                    own.append((hit["anchor"], hit["start"], hit["size"], body, xxhash.xxh3_128_digest(body)))
                times = Counter(digest for *_, digest in own)
                if len(seen) >= REMEMBERED:
                    seen.clear()
                alone = row["copies"] == 1
                for anchor, start, size, body, digest in own:
                    first, seen[digest] = seen[digest] < 2, min(seen[digest] + (1 if alone else 2), 2)
                    if not (first or alone):
                        continue
                    d1, d2 = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                    known = (1 << size) - 1 if times[digest] > 1 else None
                    tid = row["tid"] if alone else None
                    rows.append((anchor, d1, d2, body if first else None, 1 if alone else 2, tid, start, size, known))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        bodies = table.column("body").to_pylist()
        times: Counter[bytes] = Counter()
        for body, n in zip(bodies, table.column("times").to_pylist()):
            times[body] += n
        found = repeated_windows(times, length)
        keys = zip(table.column("d1").to_pylist(), table.column("d2").to_pylist(), table.column("first").to_pylist())
        rows = sorted({(d1, d2, found[body] << first) for body, (d1, d2, first) in zip(bodies, keys) if found[body]})
        return pa.table({name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(("d1", "d2", "flags"))})

    return run


def _answers(parts: DataFrame, length: int, hot_stretches: int, max_broadcast_bytes: int) -> DataFrame:
    """For each stretch (d1, d2), by its automaton, ``flags`` of its windows that occur twice."""
    spark = parts.sparkSession
    bodies = parts.where("body is not null").select("anchor", "d1", "d2", "body", "times", "size")
    total = bodies.agg(F.sum(F.col("size") + length - 1).alias("words"), F.sum(F.octet_length("body")).alias("bytes")).first()
    hot = saved(bodies.groupBy("anchor").count().where(F.col("count") > hot_stretches).select("anchor"), "hot-anchors")
    small = fits_broadcast(hot, max_broadcast_bytes)
    chosen = F.broadcast(hot) if small else hot
    shards = max((total["words"] or 0) // SHARD_WORDS, 1)
    dealt = lambda key: F.pmod(F.xxhash64(key), F.lit(shards))
    whole = bodies.join(chosen, "anchor", "left_anti").select(
        dealt("anchor").alias("shard"), "d1", "d2", F.lit(0).cast("long").alias("first"), "body", "times"
    )
    words = F.split(F.col("body").cast("string"), " ")
    windows = F.transform(F.sequence(F.lit(1), F.col("size").cast("int")), lambda at: F.array_join(F.slice(words, at, length), " "))
    single = bodies.join(chosen, "anchor", "left_semi").select("d1", "d2", "times", F.posexplode(windows).alias("first", "window"))
    single = single.select(
        dealt("window").alias("shard"), "d1", "d2", F.col("first").cast("long"), F.col("window").cast("binary").alias("body"), "times"
    )
    tasks = max(spark.sparkContext.defaultParallelism, (total["bytes"] or 0) // TASK_BYTES)
    rows = whole.unionByName(single).repartition(int(tasks), "shard")
    found = rows.groupBy("shard").applyInArrow(_shard(length), "d1 long, d2 long, flags long")
    return found.groupBy("d1", "d2").agg(F.bit_or("flags").alias("flags"))


def _covered(n_words: int, flags: Flags, length: int) -> np.ndarray:
    """Which words the windows cover; ``flags`` are first windows of stretches and the bits of their windows."""
    depth = np.zeros(n_words + 1, np.int64)
    for start, bits in flags:
        while bits:
            lowest = bits & -bits
            at = start + lowest.bit_length() - 1
            depth[at] += 1
            depth[at + length] -= 1
            bits ^= lowest
    return np.cumsum(depth[:-1]) > 0


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
        for batch in sliced(batches, "packed", 1 << 20):
            removed, digests, spans, kept = [], [], [], []
            for row in batch.to_pylist():
                words = unpress.decompress(row["packed"]).split()
                gone = _covered(len(words), [(f["start"], f["flags"]) for f in row["found"]], length)
                left = b" ".join(words[k] for k in np.flatnonzero(~gone).tolist())
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).tolist()
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                spans.append([{"start": a, "size": b - a} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(left.decode("utf-8", "surrogatepass"))
            columns = [batch.column("k1"), batch.column("k2"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            columns += [pa.array(spans, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n_removed", "kept_sha256", "spans", "kept"])

    return run


_CUT = "k1 long, k2 long, n_removed long, kept_sha256 string, spans array<struct<start: long, size: long>>, kept string"


def _removals(docs: DataFrame, length: int, hot_stretches: int, max_broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(all, cut): for each distinct text its ``n_words``, digest ``whole`` and whether it occurs twice (``again``); and for
    each text that occurs once and loses words what it loses and keeps."""
    if length <= ANCHOR or length - ANCHOR > 62:
        raise ValueError(f"windows must have {ANCHOR + 1} to {ANCHOR + 62} words")
    keyed = _keyed(docs).select("k1", "k2", "text")
    read = keyed.withColumn("tid", F.monotonically_increasing_id()).mapInArrow(
        _read(length),
        "k1 long, k2 long, tid long, n_words long, whole string, stretches array<struct<anchor: long, start: int, size: int>>",
    )
    read = saved(read, "stretches")
    placed = read.select("tid", F.inline("stretches"))
    # Written tables on the right of joins: behind their exchanges nothing keeps the plan from splitting a hot key on the left.
    again = saved(placed.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    hits = placed.join(again, "anchor", "left_semi").groupBy("tid").agg(F.collect_list(F.struct("anchor", "start", "size")).alias("hits"))
    wanted = (
        read.select("tid", "k1", "k2")
        .join(hits, "tid")
        .groupBy("k1", "k2")
        .agg(F.count("*").alias("copies"), F.min_by(F.struct("tid", "hits"), "tid").alias("one"))
        .select("k1", "k2", "copies", "one.tid", "one.hits")
    )
    packed = keyed.mapInArrow(_pressed, "k1 long, k2 long, packed binary")
    texts = saved(packed.join(wanted, ["k1", "k2"]), "texts")
    schema = "anchor long, d1 long, d2 long, body binary, times long, tid long, start long, size long, known long"
    parts = saved(texts.select("copies", "tid", "hits", "packed").mapInArrow(_bodies(length), schema), "bodies")
    answers = saved(_answers(parts, length, hot_stretches, max_broadcast_bytes), "answers")
    asked = parts.where("tid is not null and known is null").select("d1", "d2", "tid", "start")
    told = asked.join(answers, ["d1", "d2"]).select("tid", "start", "flags")
    known = parts.where("tid is not null and known is not null").select("tid", "start", F.col("known").alias("flags"))
    found = told.unionByName(known).groupBy("tid").agg(F.collect_list(F.struct("start", "flags")).alias("found"))
    cut = texts.where("copies = 1").select("tid", "k1", "k2", "packed").join(found, "tid")
    cut = cut.select("k1", "k2", "packed", "found").mapInArrow(_cut(length), _CUT)
    distinct = read.groupBy("k1", "k2").agg(
        F.max("n_words").alias("n_words"), F.max("whole").alias("whole"), (F.count("*") > 1).alias("again")
    )
    return distinct, cut


def span_digest(
    docs: DataFrame,
    length: int = LENGTH,
    hot_stretches: int = HOT_STRETCHES,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` (of the words left, joined by one space) of each document."""
    distinct, cut = _removals(docs, length, hot_stretches, max_broadcast_bytes)
    all_gone = F.col("again") & (F.col("n_words") >= length)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    outcome = distinct.join(cut.select("k1", "k2", "n_removed", "kept_sha256"), ["k1", "k2"], "left").select(
        "k1",
        "k2",
        "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, nothing).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
    # A text may have a third of all rows: both sides are exchanged, so the plan can split it.
    outcome = saved(outcome, "outcome")
    return _keyed(docs).drop("text").join(outcome, ["k1", "k2"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_words`` and ``spans``, the maximal removed runs of words as an array of (start, size)."""
    distinct, cut = _removals(docs, length, HOT_STRETCHES, MAX_BROADCAST_BYTES)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("size")))
    none = F.array().cast("array<struct<start: long, size: long>>")
    outcome = distinct.join(cut.select("k1", "k2", "spans"), ["k1", "k2"], "left").select(
        "k1", "k2", "n_words", F.when(F.col("again") & (F.col("n_words") >= length), whole).otherwise(F.coalesce("spans", none)).alias("spans")
    )
    return _keyed(docs).drop("text").join(saved(outcome, "outcome"), ["k1", "k2"]).select("doc_id", "n_words", "spans")


def without_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id`` and ``text``: of texts that lose words those left, joined by one space; other texts as they are."""
    distinct, cut = _removals(docs, length, HOT_STRETCHES, MAX_BROADCAST_BYTES)
    outcome = distinct.join(cut.select("k1", "k2", "kept"), ["k1", "k2"], "left").select(
        "k1", "k2", F.when(F.col("again") & (F.col("n_words") >= length), F.lit("")).otherwise(F.col("kept")).alias("kept")
    )
    text: Column = F.coalesce("kept", "text")
    return _keyed(docs).join(saved(outcome, "outcome"), ["k1", "k2"]).select("doc_id", text.alias("text"))

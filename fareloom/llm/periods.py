"""Periodic runs of words, by maximal pairs from the LCP-interval tree of each text.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST_PERIODS`` times as long as q and
``LEAST_WORDS`` words long, that no neighbouring word extends with that period.

Two equal stretches of L words at a and a+q that neither the word before nor the word behind them extends are a maximal
pair. If L is at least max(LEAST_WORDS - q, (LEAST_PERIODS - 1) * q), the words from a to a+q+L are a run as they
stand: nothing needs to be extended. Such pairs are found as follows.

1. The suffixes of a text are sorted by prefix doubling; the ranks of each length also give the common prefixes (LCP)
   of neighbours. Texts of a batch are sorted together, their words told apart by text. Texts in which no five words
   come twice have no such pair, and are left out before.
2. The tree of LCP intervals is walked from the bottom. A node holds the positions of its suffixes, each listed with
   its class, the word to its left. Where two children meet, a position of one and a position of the other share
   exactly the node's LCP; the pair is maximal if their classes differ. The lists are merged smaller into larger.
3. Only pairs at most LCP / 3 apart are looked for, and of these only neighbours in the order of positions: were there
   a third position between two that near, the stretch would have a smaller period, and the pair would not be a run's.
   So a position meets two others for each merge, not all of a class, and each run is found once with its period.

Nulls and edges: words are what lies between the white space ``\\x20\\x09-\\x0D``; a null text has none. Repeated rows each
get their row. A null id is only carried along. An empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are not looked at. A text is worked on whole, in one task.
"""

import hashlib
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareloom.llm.common import sliced

LEAST_PERIODS = 4
LEAST_WORDS = 6
#: The shortest common prefix of a run's pair: its period is 1 and it has ``LEAST_WORDS`` words.
LEAST_COMMON = LEAST_WORDS - 1
#: Bytes of text that a task sorts at once; a longer text is sorted by itself.
BATCH_BYTES = 1 << 20

Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _repeating(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which positions start five words that may come twice in their text (by a hash: none is missed)."""
    mixed = (ids * np.uint64(0x9E3779B97F4A7C15)) ^ (text * np.uint64(0xC2B2AE3D27D4EB4F))
    key = np.zeros(max(len(ids) - LEAST_COMMON + 1, 0), np.uint64)
    for k in range(LEAST_COMMON):
        key = key * np.uint64(0xD6E8FEB86659FD93) + (mixed[k : k + len(key)] ^ (mixed[k : k + len(key)] >> np.uint64(29)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    found = np.zeros(len(ids), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    return found


def _sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the length of the prefix that each shares with the next."""
    size = len(symbols)
    levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int64)]
    while levels[-1].max() + 1 < size:
        step = 1 << (len(levels) - 1)
        behind = np.zeros(size, np.int64)
        behind[: max(size - step, 0)] = levels[-1][step:] + 1
        levels.append(np.unique(levels[-1] * (size + 1) + behind, return_inverse=True)[1].astype(np.int64))
    order = np.argsort(levels[-1])
    common = np.zeros(max(size - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # Equal ranks reach over the last word only for equal positions, which are not compared.
        a, b = order[:-1] + common, order[1:] + common
        inside = np.maximum(a, b) < size
        equal = levels[k][np.where(inside, a, 0)] == levels[k][np.where(inside, b, 0)]
        common += np.where(inside & equal, 1 << k, 0)
    return order, common


def _merged(one: list[int], other: list[int], common: int, left: list[int], runs: list[Run]) -> list[int]:
    """The positions of two children of a node; runs whose pair meets here are added to ``runs``."""
    small, large = (one, other) if len(one) < len(other) else (other, one)
    farthest = common // (LEAST_PERIODS - 1)
    last = len(small) - 1
    for k, x in enumerate(small):
        at = bisect_left(large, x)
        near = []
        if at and not (k and small[k - 1] > large[at - 1]):
            near.append((large[at - 1], x))
        if at < len(large) and not (k < last and small[k + 1] < large[at]):
            near.append((x, large[at]))
        for a, b in near:
            period = b - a
            if period <= farthest and period + common >= LEAST_WORDS and left[a] != left[b]:
                runs.append((a, period + common, period))
    if 16 * len(small) > len(large):
        return sorted(large + small)
    for x in small:
        insort(large, x)
    return large


def _walk(suffixes: list[int], common: list[int], left: list[int], runs: list[Run]) -> None:
    """The tree over neighbouring suffixes, from the bottom."""
    open_nodes: list[tuple[int, list[int]]] = []
    for value, suffix in zip([*common, -1], suffixes):
        node = [suffix]
        while open_nodes and open_nodes[-1][0] > value:
            shared, held = open_nodes.pop()
            node = _merged(held, node, shared, left, runs)
        if open_nodes and open_nodes[-1][0] == value:
            node = _merged(open_nodes.pop()[1], node, value, left, runs)
        open_nodes.append((value, node))


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """For each text, a list of words, its runs (start, length, period) by start and period."""
    found: list[list[Run]] = [[] for _ in texts]
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.fromiter((numbers[w] for words in texts for w in words), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    if len(ids) < LEAST_WORDS:
        return found
    some = np.zeros(len(texts), bool)
    some[text[_repeating(ids.astype(np.uint64), text.astype(np.uint64))]] = True
    kept = some[text]
    ids, text = ids[kept], text[kept]
    if not len(ids):
        return found
    starts = np.cumsum(np.where(some, sizes, 0)) - np.where(some, sizes, 0)
    order, common = _sorted_suffixes(text * len(numbers) + ids)
    left = np.empty(len(ids), np.int64)
    left[1:] = ids[:-1]
    left[starts[some]] = -1
    classes = left.tolist()
    runs: list[Run] = []
    enough = np.concatenate([[False], common >= LEAST_COMMON, [False]]).astype(np.int8)
    for a, b in zip(np.flatnonzero(np.diff(enough) == 1).tolist(), np.flatnonzero(np.diff(enough) == -1).tolist()):
        _walk(order[a : b + 1].tolist(), common[a:b].tolist(), classes, runs)
    for start, length, period in sorted(runs, key=lambda run: (run[0], run[2])):
        own = int(text[start])
        found[own].append((start - int(starts[own]), length, period))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run has behind its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for batch in sliced(batches, "text", BATCH_BYTES):
        yield batch, [words_of(t.as_py()) for t in batch.column("text")]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``runs``, an array of (start, length, period) by start, of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch, texts in _batches(batches):
            rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in find_runs(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "runs"])

    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def without_repetitions(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, its words joined by one space, of each run only the first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches):
            kept = [b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(texts, find_runs(texts))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, for a tenth of all ids with a periodic end; a null id is not among them."""
    if doc_id is None or not words:
        return words
    tens, ones = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if ones:
        return words
    start = tens % len(words)
    period = 1 + (len(words) - start) // (3 + tens % 8)
    again = words[start : start + period]
    rest = len(words) - start
    return words[:start] + (again * (rest // period + 1))[:rest]


def _greatest(runs: list[Run]) -> tuple[int | None, ...]:
    """The run of the greatest length / period, of equal ones the first, and its exponent in thousandths."""
    best: Run | None = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])


def runs_digest(docs: DataFrame) -> DataFrame:
    """The runs of each document with its planted end: their number, the greatest one, and digests of all runs and of
    the words left when each run keeps its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = ["n_runs", "start", "length", "period", "exponent_milli"]
        digests = ["runs_sha256", "collapsed_sha256"]
        for batch, texts in _batches(batches):
            texts = [planted(i, w) for i, w in zip(batch.column("doc_id").to_pylist(), texts)]
            rows = []
            for words, runs in zip(texts, find_runs(texts)):
                lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
                left = b" ".join(collapsed(words, runs))
                shas = (hashlib.sha256(part).hexdigest() for part in (lines.encode(), left))
                rows.append((len(runs), *_greatest(runs), *shas))
            kinds = [pa.int64()] * len(numbers) + [pa.string()] * len(digests)
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *numbers, *digests])

    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)

"""Order-preserving packing of documents into fixed windows by dynamic programming.

The documents of a task, in their order in the table, are one stream of ids, each document followed by an end id. Windows
of at most ``size`` ids follow each other without gaps. Where they may be cut: behind a document (free), behind a
sentence (``SENTENCE_PENALTY``), and every ``STEP`` ids inside a sentence longer than ``LONG_SENTENCE`` (``INSIDE_PENALTY``). The
cost of a window is its padding, the penalty of its end and ``WINDOW_COST``; padding fills it to ``size`` unless its
length is a power of two. With f the least cost up to a cut and p the cut's position,

    f(j) = min over i with p(j) - p(i) <= size of f(i) + size - (p(j) - p(i)), plus penalties,

which is a minimum of f(i) + p(i) over a sliding range: a monotone queue has it at its head, so a cut costs constant
time. Windows of an exempt length are compared besides.

A stream is packed in blocks of about ``BLOCK_BYTES`` of text, so memory is bounded by that or the longest
text; only the last window of a block is short. No row is shuffled. A sequence id is the task's number and a
running number, so the rows of a task that is run again are the same.

Nulls and edges: a null or empty text is its end id alone. Repeated rows and null ids are packed like others. A
document longer than a window spans several. An empty table gives an empty result. Columns other than ``doc_id`` and
``text`` are not looked at.
"""

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fareloom.llm.common import sliced
from fareloom.llm.tokens import MOST_REMEMBERED, WordTokenizer, word_tokenizer

SIZE = 1024
END_ID = 0
SENTENCE_PENALTY = 2.0
INSIDE_PENALTY = 64.0
WINDOW_COST = 64.0
LONG_SENTENCE = 256
STEP = 32
BLOCK_BYTES = 8 << 20
#: Sequence numbers of one task.
_TASK_SHIFT = 32


@dataclass(frozen=True)
class Cuts:
    """Where a stream may be cut: positions, from 0 to its length, and what ending a window there costs."""

    positions: np.ndarray
    penalties: np.ndarray


def padding(length: int, size: int = SIZE) -> int:
    """Ids added to a window of this length."""
    return 0 if length & (length - 1) == 0 else size - length


def best_windows(cuts: Cuts, size: int = SIZE, window_cost: float = WINDOW_COST) -> np.ndarray:
    """Positions of the cuts that make the cheapest windows, the first and the last position among them.

    Neighbouring cuts must not be more than ``size`` apart.
    """
    positions = cuts.positions.tolist()
    penalties = (cuts.penalties + window_cost).tolist()
    exempt: list[list[int]] = [[] for _ in positions]
    length = 1
    while length <= size:
        at = np.searchsorted(cuts.positions, cuts.positions - length)
        for j in np.flatnonzero(cuts.positions[at] == cuts.positions - length):
            exempt[j].append(int(at[j]))
        length *= 2
    cost = [0.0] * len(positions)
    before = [0] * len(positions)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(positions)):
        here = positions[j]
        while here - positions[queue[0][1]] > size:
            queue.popleft()
        least, best = queue[0]
        least += size - here
        for i in exempt[j]:
            if cost[i] < least:
                least, best = cost[i], i
        cost[j] = least = least + penalties[j]
        before[j] = best
        rank = least + here
        while queue and queue[-1][0] >= rank:
            queue.pop()
        queue.append((rank, j))
    chosen = [len(positions) - 1]
    while chosen[-1]:
        chosen.append(before[chosen[-1]])
    return cuts.positions[chosen[::-1]]


def possible_cuts(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray) -> Cuts:
    """Cuts of a stream: ``ends`` are the positions behind its documents, ``sentence_end`` tells it of each id."""
    # One byte an id: 0 is no cut, others are places in the list of penalties.
    kind = np.zeros(len(ids) + 1, np.uint8)
    kind[1:][sentence_end[ids]] = 2
    kind[ends] = kind[0] = 1
    positions = np.flatnonzero(kind)
    for k in np.flatnonzero(np.diff(positions) > LONG_SENTENCE):
        kind[positions[k] + STEP : positions[k + 1] : STEP] = 3
    positions = np.flatnonzero(kind)
    return Cuts(positions, np.array([np.inf, 0.0, SENTENCE_PENALTY, INSIDE_PENALTY])[kind[positions]])


@lru_cache
def sentence_ends(tokenizer: WordTokenizer) -> np.ndarray:
    """Whether an id ends a sentence: its text ends with a full stop, a mark or a line end."""
    names = [tokenizer.tokenizer.decode([i]) for i in range(tokenizer.size)]
    return np.array([name.rstrip("\"')").endswith((".", "!", "?", "\n")) for name in names])


def pack_block(
    texts: list[str | None], tokenizer: WordTokenizer, sentence_end: np.ndarray, end_id: int, size: int
) -> dict[str, np.ndarray]:
    """The pieces of the texts: document, start, length, ids_crc32, doc_tokens, sequence and offset, in order."""
    parts = []
    end = np.array([end_id], "<u4")
    for text in texts:
        if text:
            parts.append(tokenizer.encode(text))
        parts.append(end)
    ids = np.concatenate(parts).astype("<u4", copy=False)
    ends = np.cumsum([len(p) for p in parts])[[p is end for p in parts]]
    del parts
    cuts = best_windows(possible_cuts(ids, ends, sentence_end), size)
    bounds = np.sort(np.concatenate([cuts, ends]))
    bounds = bounds[np.diff(bounds, prepend=-1) > 0]
    start, length = bounds[:-1], np.diff(bounds)
    begins = np.concatenate([[0], ends[:-1]])
    document = np.searchsorted(ends, start, side="right")
    sequence = np.searchsorted(cuts, start, side="right") - 1
    octets = memoryview(ids).cast("B")
    crc = [zlib.crc32(octets[4 * s : 4 * (s + n)]) for s, n in zip(start.tolist(), length.tolist())]
    return {
        "document": document,
        "start": start - begins[document],
        "length": length,
        "ids_crc32": np.array(crc, np.int64),
        "doc_tokens": (ends - begins)[document],
        "sequence": sequence,
        "offset": start - cuts[sequence],
    }


def pack(
    docs: DataFrame,
    path: str,
    *,
    drops_spaces: bool = False,
    special_tokens: bool = False,
    end_id: int = END_ID,
    size: int = SIZE,
    remembered: int = MOST_REMEMBERED,
) -> DataFrame:
    """One row for each piece of a document: where it lies in the document and in its sequence.

    ``remembered`` bounds the words whose ids a worker keeps at hand; fewer cost time, not rows.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, drops_spaces, special_tokens, remembered)
        sentence_end = sentence_ends(tokenizer)
        # What earlier work of this worker has freed goes back to the system before new memory is taken.
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()
        sequences = TaskContext.get().partitionId() << _TASK_SHIFT
        for batch in sliced(batches, "text", BLOCK_BYTES):
            found = pack_block(batch.column(1).to_pylist(), tokenizer, sentence_end, end_id, size)
            columns = [batch.column(0).take(pa.array(found["document"]))]
            columns += [pa.array(found[name]) for name in names[1:5]]
            columns += [pa.array(found["sequence"] + sequences), pa.array(found["offset"])]
            sequences += int(found["sequence"][-1]) + 1
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{name} long" for name in names))

"""Token ids in a compressed file format: a static range asymmetric numeral system.

All blocks share one frequency table, counted over all ids and scaled to ``2 ** TABLE_BITS``. A block holds whole
documents in ascending id order, about ``BLOCK_IDS`` ids, and is coded for itself by ``LANES`` interleaved coders: id i
belongs to lane ``i % LANES``, and the lanes advance together in numpy. A coder's state is 64 bits wide and moves 32
bits at a time. Every ``CHECKPOINT_STEPS`` steps the block notes all states and the place in the words,
so a reader can start there, or have several parts of a block decoded at once. Each part between
checkpoints has a CRC-32 of its ids, the block one of its bytes, and it names the CRC of its table.

The dataset is a folder that Spark writes: ``table`` (id, frequency) and ``blocks`` (shard, block, ids of the shard before
it, numbers of documents and ids, payload). Shards are ranges of document ids, blocks are numbered within.

Nulls and edges: a null text is encoded like an empty one: its end id alone. Documents with a null id come first.
Repeated rows are each encoded, in the order of their ids' bytes. An empty table gives a dataset without blocks.
Columns other than ``doc_id`` and ``text`` are not looked at.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import saved, sliced
from fareloom.llm.tokens import word_tokenizer

TABLE_BITS = 20
LANES = 1024
CHECKPOINT_STEPS = 256
BLOCK_IDS = 1 << 19
IDS_PER_SHARD = 1 << 22
MAGIC = b"RNS1"
END_ID = 1
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIQIIII")
_WORD = np.uint64(32)
_BITS = np.uint64(TABLE_BITS)
BLOCK_SCHEMA = "shard int, block int, ids_before long, n_docs long, n_ids long, payload binary"


class Table:
    """Scaled frequencies of the ids, their running sums, and which id each slot belongs to."""

    def __init__(self, frequencies: np.ndarray) -> None:
        self.frequencies = frequencies.astype(np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(frequencies)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        self.mark = zlib.crc32(np.asarray(frequencies, "<u4").tobytes())


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2 ** TABLE_BITS``, in proportion to the counts and at least 1 where one is."""
    total, goal = int(counts.sum()), 1 << TABLE_BITS
    if (counts > 0).sum() > goal:
        raise ValueError(f"more than {goal} different ids")
    if total == 0:
        return np.zeros(len(counts), np.int64)
    out = np.where(counts > 0, np.maximum(1, counts * (goal / total)).astype(np.int64), 0)
    # What rounding gave or took is settled with the most frequent ids, where it weighs least.
    over = int(out.sum()) - goal
    for k in np.argsort(-out, kind="stable"):
        change = min(over, int(out[k]) // 2)
        out[k] -= change
        over -= change
        if not over:
            break
    return out


def encode_ids(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, states, places): states and places in the words at each checkpoint, in reading order."""
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, _LOW, np.uint64)
    chunks: list[np.ndarray] = []
    states, places, written = [], [], 0
    for step in range(steps - 1, -1, -1):
        part = ids[step * LANES : (step + 1) * LANES]
        x, f = state[: len(part)], table.frequencies[part]
        full = (x >> np.uint64(63 - TABLE_BITS)) >= f
        if full.any():
            chunks.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += len(chunks[-1])
            x = np.where(full, x >> _WORD, x)
        quotient = x // f
        state[: len(part)] = (quotient << _BITS) + (x - quotient * f) + table.starts[part]
        if step % CHECKPOINT_STEPS == 0:
            states.append(state.copy())
            places.append(written)
    words = np.concatenate(chunks[::-1]) if chunks else np.array([], "<u4")
    return words, np.array(states[::-1], "<u8").reshape(-1, LANES), written - np.array(places[::-1], np.int64)


def decode_part(words: np.ndarray, state: np.ndarray, place: int, n: int, table: Table) -> np.ndarray:
    """``n`` ids from a checkpoint on."""
    out = np.empty(n, "<u4")
    state = state.astype(np.uint64)
    mask = np.uint64((1 << TABLE_BITS) - 1)
    for at in range(0, n, LANES):
        size = min(LANES, n - at)
        x = state[:size]
        slot = x & mask
        found = table.slots[slot]
        out[at : at + size] = found
        x = table.frequencies[found] * (x >> _BITS) + slot - table.starts[found]
        empty = np.flatnonzero(x < _LOW)
        x[empty] = (x[empty] << _WORD) | words[place : place + len(empty)]
        place += len(empty)
        state[:size] = x
    return out


def encode_block(doc_ids: list[int | None], parts: list[np.ndarray], table: Table) -> bytes:
    """A block of documents: head, documents (id, has id, length), checkpoints (place, CRC, states), words, CRC-32."""
    ids = np.concatenate(parts).astype("<u4")
    words, states, places = encode_ids(ids, table)
    span = CHECKPOINT_STEPS * LANES
    sums = np.array([zlib.crc32(ids[k : k + span].tobytes()) for k in range(0, len(ids), span)], "<u4")
    documents = np.array([(d or 0, d is not None, len(p)) for d, p in zip(doc_ids, parts)], "<i8")
    body = zlib.compress(documents.tobytes(), 1)
    head = _HEAD.pack(MAGIC, table.mark, len(ids), len(parts), len(body), len(sums), len(words))
    raw = b"".join([head, body, places.astype("<u4").tobytes(), sums.tobytes(), states.tobytes(), words.tobytes()])
    return raw + struct.pack("<I", zlib.crc32(raw))


def decode_block(payload: bytes, table: Table) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, all ids) of a block; raises ValueError where a checksum does not hold."""
    if zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
        raise ValueError("the block's bytes are damaged")
    magic, mark, n, _, size, checkpoints, n_words = _HEAD.unpack_from(payload)
    if magic != MAGIC or mark != table.mark:
        raise ValueError("not a block of this dataset")
    at = _HEAD.size
    documents = np.frombuffer(zlib.decompress(payload[at : at + size]), "<i8").reshape(-1, 3)
    at += size
    places = np.frombuffer(payload, "<u4", checkpoints, at)
    sums = np.frombuffer(payload, "<u4", checkpoints, at + 4 * checkpoints)
    at += 8 * checkpoints
    states = np.frombuffer(payload, "<u8", checkpoints * LANES, at).reshape(-1, LANES)
    words = np.frombuffer(payload, "<u4", n_words, at + states.nbytes)
    span = CHECKPOINT_STEPS * LANES
    parts = []
    for k in range(checkpoints):
        parts.append(decode_part(words, states[k], int(places[k]), min(span, n - k * span), table))
        if zlib.crc32(parts[-1].tobytes()) != sums[k]:
            raise ValueError(f"part {k} of the block is damaged")
    ids = np.concatenate(parts) if parts else np.array([], "<u4")
    return [int(d) if known else None for d, known, _ in documents], documents[:, 2], ids


def tokenized(docs: DataFrame, path: str, drops_spaces: bool, end_id: int, special_tokens: bool = False) -> DataFrame:
    """``doc_id``, ``n`` and ``ids`` (little-endian, 2 or 4 bytes each, as the vocabulary needs) with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, drops_spaces, special_tokens)
        end = np.array([end_id], tokenizer.kind).tobytes()
        width = len(end)
        for batch in sliced(batches, "text"):
            ids = [(tokenizer.encode(t).tobytes() if t else b"") + end for t in batch.column(1).to_pylist()]
            sizes = pa.array([len(x) // width for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(ids, pa.binary())], ["doc_id", "n", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids binary")


def _counted(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            size = max(len(counts), len(found))
            counts = np.pad(counts, (0, size - len(counts))) + np.pad(found, (0, size - len(found)))
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts[ids], pa.int64())], ["id", "n"])

    return run


def write_dataset(
    docs: DataFrame, folder: str, path: str, *, drops_spaces: bool, special_tokens: bool = False, end_id: int = END_ID
) -> None:
    """Encode every document into the dataset at ``folder``, in ascending order of ``doc_id``."""
    spark = docs.sparkSession
    tokenizer = word_tokenizer(path, drops_spaces, special_tokens)
    size, kind = max(tokenizer.size, end_id + 1), tokenizer.kind
    rows = saved(tokenized(docs, path, drops_spaces, end_id, special_tokens), "ids")
    # One row for each id of the vocabulary, whose size is fixed.
    counted = rows.select("ids").mapInArrow(_counted(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for row in counted.collect():
        counts[row["id"]] = row["n"]
    frequencies = scaled(counts)
    table_rows = pa.table({"id": pa.array(range(size), pa.int32()), "frequency": pa.array(frequencies, pa.int32())})
    spark.createDataFrame(table_rows.to_pandas()).coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(frequencies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        shard, block = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = before = 0

        def flush() -> pa.RecordBatch:
            payload = encode_block(doc_ids, parts, table)
            columns = [[shard], [block], [before], [len(parts)], [held], [payload]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["shard", "block", "ids_before", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                parts.append(np.frombuffer(ids.as_py(), kind))
                held += len(parts[-1])
                if held >= BLOCK_IDS:
                    yield flush()
                    doc_ids, parts, before, held, block = [], [], before + held, 0, block + 1
        if parts:
            yield flush()

    shards = max(1, -(-int(counts.sum()) // IDS_PER_SHARD))
    ordered = rows.select("doc_id", "ids").repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")


def read_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, decoded from the dataset's files.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is of the ids as unsigned 32-bit integers.
    """
    table_rows = spark.read.parquet(f"{folder}/table").orderBy("id").collect()
    shared = spark.sparkContext.broadcast(np.array([r["frequency"] for r in table_rows], np.int64))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    # One number for each shard, of which there are as many as the writing job had tasks.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).orderBy("shard").collect()
    ends = np.cumsum([row["n_ids"] for row in sizes]).tolist()
    shard_starts = spark.sparkContext.broadcast(dict(zip((row["shard"] for row in sizes), [0, *ends])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in batches:
            for shard, before, payload in zip(*(batch.column(k) for k in range(3))):
                start = shard_starts.value[shard.as_py()] + before.as_py()
                doc_ids, lengths, ids = decode_block(payload.as_py(), table)
                ends = np.cumsum(lengths)
                octets = memoryview(ids.astype("<u4").tobytes())
                begins = (ends - lengths).tolist()
                crc = [zlib.crc32(octets[4 * b : 4 * e]) for b, e in zip(begins, ends.tolist())]
                columns = [doc_ids, ends - lengths + start, lengths, crc]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = blocks.select("shard", "ids_before", "payload")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

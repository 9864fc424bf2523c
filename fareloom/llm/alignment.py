"""Alignment of the tokens that two tokenizers cut a text into, by diagonal run skipping.

Both tokenizers cover the same bytes, so the byte offsets at which their tokens end tell which tokens belong together:
offsets that both have cut the tokens into groups. A text's two end arrays are walked with one index shift between
them. As long as the arrays agree at that shift, tokens are one to one; exponential probing compares stretches of 1,
2, 4, ... ends and then halves the step, so such a run is jumped in a few comparisons. Where the arrays differ, the
group is irregular: its tokens are resolved one by one until both end together, and the shift is updated.

Links are pairs of tokens whose byte ranges overlap. The count of a pair of ids is the number of documents that hold it
linked. Each document's distinct linked pairs are written once with how often it has them; counts, the highest count
of each first id, and the sums of each document follow from that table. Counts are broadcast if measured
within ``fareloom.operators.sizing.MAX_BROADCAST_BYTES`` and joined by shuffle beyond. A first id has at most as
many partners as the second vocabulary has ids.

Tokens are those of the libraries, the strings of special tokens being plain text. B's words seen before are remembered
where this cannot change ids: no piece spans a space that has other characters on both sides. All other texts go
through the library whole.

Nulls and edges: a text that is null or empty, or that one of the two tokenizers does not give back byte by byte (behind
a space), has no tokens, groups or links. Each row is a document, repeated rows too. Ids may be null or repeat. An empty table gives
an empty result. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareloom.llm.common import saved, sliced
from fareloom.llm.tokens import _STANDS_FOR
from fareloom.operators.sizing import MAX_BROADCAST_BYTES, fits_broadcast

SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: A space that has not another visible character right behind it, or white space at the start.
_ODD_SPACE = re.compile(r" (?:\s|\Z)|\A\s")
#: Words remembered by a Python worker; beyond that it forgets all and starts again.
REMEMBERED_WORDS = 600_000
#: Bytes of text that a task has encoded at once.
BATCH_BYTES = 1 << 20
_PAIRS = "array<struct<a: int, b: int, n: int>>"


class TokenPair:
    """A byte-level tokenizer file (A) and a piece model (B)."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        byte_of = {chr(b): b for b in range(256)} | {chr(shown): b for b, shown in _STANDS_FOR.items()}
        by_id = {i: token for token, i in self.a.get_vocab().items()}
        special = self.a.get_added_tokens_decoder()
        self.bytes_a = [
            by_id[i].encode() if i in special else bytes(map(byte_of.__getitem__, by_id.get(i, "")))
            for i in range(max(by_id) + 1)
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(_BYTE.fullmatch(p).group(1), 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # Words are told apart by their spaces only if no piece has one behind another character.
        self.by_words = all(SPACE not in p.lstrip(SPACE) for p in pieces)
        self.sizes_a, self.sizes_b = (np.array(list(map(len, own)), np.int64) for own in (self.bytes_a, self.bytes_b))
        self.ranked = _ranked(self.a, {own: i for i, own in enumerate(self.bytes_a) if own and i not in special})
        self.words_b: dict[str, bytes] = {}

    def _same(self, text: str, ids_a: np.ndarray, ids_b: np.ndarray) -> bool:
        whole = b" " + text.encode()
        joined = (b"".join(map(own.__getitem__, ids.tolist())) for own, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))
        return all(part == whole for part in joined)

    def encode_a(self, text: str) -> np.ndarray:
        """Ids of A of a space and the text."""
        if self.ranked:
            return np.array(self.ranked.encode_ordinary(" " + text), np.int64)
        return np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int64)

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        ids_a, ids_b = self.encode_a(text), np.array(self.b.encode(text), np.int64)
        return (ids_a, ids_b) if self._same(text, ids_a, ids_b) else None

    def _remember(self, words: set[str]) -> None:
        """Ids of B of words with a space before them; those that it does not give back are left out."""
        new = [word for word in words if word not in self.words_b]
        if len(self.words_b) + len(new) > REMEMBERED_WORDS:
            self.words_b.clear()
            new = list(words)
        for word, ids in zip(new, self.b.encode(new, num_threads=1)):
            if b"".join(map(self.bytes_b.__getitem__, ids)) == b" " + word.encode():
                self.words_b[word] = array("i", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers of each text, or none if it has no tokens."""
        by_words: dict[int, list[str]] = {}
        if self.by_words:
            plain = ((k, t) for k, t in enumerate(texts) if t and SPACE not in t and not _ODD_SPACE.search(t))
            by_words = {k: text.split(" ") for k, text in plain}
            self._remember(set().union(*by_words.values()))
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for k, text in enumerate(texts):
            try:
                ids_b = np.frombuffer(b"".join(map(self.words_b.__getitem__, by_words[k])), np.int32)
            except KeyError:
                found.append(self._whole(text) if text else None)
                continue
            found.append((self.encode_a(text), ids_b.astype(np.int64)))
        return found


def _ranked(tokenizer: Tokenizer, ids: dict[bytes, int]) -> tiktoken.Encoding | None:
    """The same tokenizer for a faster library, if its ids are in the order of its merges and it cuts texts as usual."""
    parts = json.loads(tokenizer.to_str())
    cut, model = parts["pre_tokenizer"] or {}, parts["model"]
    if parts["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    if model["type"] != "BPE" or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    merged = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])) or len(merged) + 256 != len(ids):
        return None
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ids, special_tokens={})


_PAIRS_OF_FILES: dict[tuple[str, str], TokenPair] = {}


def token_pair(path_a: str, path_b: str) -> TokenPair:
    """The two tokenizers, loaded once in each Python worker."""
    key = (path_a, path_b)
    if key not in _PAIRS_OF_FILES:
        _PAIRS_OF_FILES[key] = TokenPair(*key)
    return _PAIRS_OF_FILES[key]


@dataclass(frozen=True)
class Alignment:
    """Groups by the index of their last token on each side, and the linked tokens."""

    last_a: np.ndarray
    last_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Align two increasing arrays of end offsets with the same last value (or both empty)."""
    a, b = array("q", ends_a.astype(np.int64).tobytes()), array("q", ends_b.astype(np.int64).tobytes())
    size_a, size_b = len(a), len(b)
    # One-to-one runs by start and length; irregular groups by their last tokens; links within these.
    run_a, run_b, run_size = array("q"), array("q"), array("q")
    last_a, last_b = array("q"), array("q")
    link_a, link_b = array("q"), array("q")
    i = j = 0
    while i < size_a:
        start, step, growing = i, 1, True
        while step:
            if i + step <= size_a and j + step <= size_b and a[i : i + step] == b[j : j + step]:
                i += step
                j += step
                step = 2 * step if growing else step // 2
            else:
                growing = False
                step //= 2
        if i > start:
            run_a.append(start)
            run_b.append(j - (i - start))
            run_size.append(i - start)
        if i == size_a:
            break
        while True:
            link_a.append(i)
            link_b.append(j)
            if a[i] < b[j]:
                i += 1
            elif b[j] < a[i]:
                j += 1
            else:
                break
        last_a.append(i)
        last_b.append(j)
        i += 1
        j += 1
    sizes = np.frombuffer(run_size, np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    single_a, single_b = (np.repeat(np.frombuffer(own, np.int64), sizes) + within for own in (run_a, run_b))
    joined = lambda one, more: np.concatenate([one, np.frombuffer(more, np.int64)])
    groups_a, groups_b = joined(single_a, last_a), joined(single_b, last_b)
    return Alignment(np.sort(groups_a), np.sort(groups_b), joined(single_a, link_a), joined(single_b, link_b))


def align_texts(pair: TokenPair, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, Alignment] | None]:
    """For each text the ids of both tokenizers and their alignment, or none if it has no tokens."""
    for ids in pair.encode(texts):
        if ids is None:
            yield None
        else:
            ends_a, ends_b = np.cumsum(pair.sizes_a[ids[0]]), np.cumsum(pair.sizes_b[ids[1]])
            yield *ids, align_ends(ends_a, ends_b)


class _GroupText:
    """Groups as text: ids of A, a bar, ids of B; commas between ids and semicolons between groups."""

    def __init__(self, pair: TokenPair) -> None:
        self.size_a, self.size_b = len(pair.bytes_a), len(pair.bytes_b)
        a, b = (list(map(str, range(size))) for size in (self.size_a, self.size_b))
        self.shown = [f"{i}{mark}" for own, marks in ((a, ",|"), (b, ",;")) for mark in marks for i in own]

    def __call__(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> str:
        before_a, before_b = (np.concatenate([[-1], last[:-1]]) for last in (found.last_a, found.last_b))
        place_a = np.arange(len(ids_a)) + np.repeat(before_b + 1, found.last_a - before_a)
        place_b = np.arange(len(ids_b)) + np.repeat(found.last_a + 1, found.last_b - before_b)
        shown = np.empty(len(ids_a) + len(ids_b), np.int64)
        ids_a, ids_b = ids_a.copy(), ids_b + 2 * self.size_a
        ids_a[found.last_a] += self.size_a
        ids_b[found.last_b] += self.size_b
        shown[place_a], shown[place_b] = ids_a, ids_b
        return "".join(map(self.shown.__getitem__, shown.tolist()))[:-1]


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id``, ``ids_a``, ``ids_b``, and for each group the index of its last token on either side, ``last_a`` and ``last_b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(path_a, path_b)
        names = ["ids_a", "ids_b", "last_a", "last_b"]
        for batch in sliced(batches, "text", BATCH_BYTES):
            rows: list[tuple[np.ndarray, ...]] = []
            for found in align_texts(pair, batch.column("text").to_pylist()):
                rows.append((found[0], found[1], found[2].last_a, found[2].last_b) if found else (np.array([], np.int64),) * 4)
            columns = [pa.array([r[k].astype(np.int32) for r in rows], pa.list_(pa.int32())) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    schema = "doc_id long, ids_a array<int>, ids_b array<int>, last_a array<int>, last_b array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _pair_lists(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(n) for _, _, n in rows])]).astype(np.int32)
    values = [pa.array(np.concatenate([r[k] for r in rows]).astype(np.int32)) for k in range(3)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, names=["a", "b", "n"]))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each document: ``key`` (tells rows apart), ``doc_id``, numbers of tokens, groups and links, the digest of
    its groups, and ``pairs``, its distinct linked ids with how many links have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(path_a, path_b)
        shown = _GroupText(pair)
        none = (np.array([], np.int64),) * 3
        for batch in sliced(batches, "text", BATCH_BYTES):
            numbers, digests, linked = [], [], []
            for found in align_texts(pair, batch.column("text").to_pylist()):
                if found is None:
                    numbers.append((0, 0, 0, 0))
                    digests.append("")
                    linked.append(none)
                    continue
                ids_a, ids_b, groups = found
                numbers.append((len(ids_a), len(ids_b), len(groups.last_a), len(groups.link_a)))
                digests.append(hashlib.sha256(shown(ids_a, ids_b, groups).encode()).hexdigest())
                both = ids_a[groups.link_a] * shown.size_b + ids_b[groups.link_b]
                distinct, times = np.unique(both, return_counts=True)
                linked.append((distinct // shown.size_b, distinct % shown.size_b, times))
            columns = [batch.column("key"), batch.column("doc_id")]
            columns += [pa.array([r[k] for r in numbers], pa.int64()) for k in range(4)]
            columns += [pa.array(digests, pa.string()), _pair_lists(linked)]
            names = ["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs {_PAIRS}"
    keyed = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("key"))
    return keyed.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``docs`` (documents that hold the pair linked) and ``best`` (no pair of this a has more)."""
    counts = saved(aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.count("*").alias("docs")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def alignment_digest(
    docs: DataFrame, path_a: str, path_b: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``doc_id``, numbers of tokens, groups and links, ``n_best``, ``count_sum`` and ``groups_sha256`` of each document."""
    # Written once: the keys stay the same, and no text is encoded again.
    aligned = saved(aligned_documents(docs, path_a, path_b), "aligned")
    counts = saved(pair_counts(aligned), "pair-scores")
    if fits_broadcast(counts, max_broadcast_bytes):
        counts = F.broadcast(counts)
    scored = (
        aligned.select("key", F.inline("pairs"))
        .join(counts, ["a", "b"])
        .groupBy("key")
        .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("best_links"), F.sum(F.col("n") * F.col("docs")).alias("total"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return aligned.drop("pairs").join(scored, "key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        zero("best_links").alias("n_best"), zero("total").alias("count_sum"), "groups_sha256",
    )

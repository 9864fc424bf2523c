"""SentencePiece encoding and decoding with an Aho-Corasick automaton and a single-pass Viterbi.

The pieces of a vocabulary file and their scores are taken as they are; nothing is trained. The automaton reads a text
once. At each position its output links name all pieces that end there, and each relaxes the best score of the
position: best[end] = max over pieces of best[start] + score. The best path gives the ids. So the result is the
segmentation with the highest sum of scores, of equal ones the one whose last differing piece is longest. (A model
trained by merges is cut by its merge order in other encoders; here its scores decide.)

Spaces become U+2581 and one is put in front. No piece holds U+2581 behind another character, or a line end, so the best path of a
text is that of its words one after the other, and words seen before are remembered. A character that no piece can
cover (and a literal U+2581, to keep it apart from a space) falls back to the pieces of its UTF-8 bytes, at
``UNKNOWN_PENALTY`` below the lowest score. Decoding therefore gives back every text exactly.

Nulls and edges: a null text is encoded like an empty one, into no ids. White space is kept as it is. Very long
words are cut nowhere. Repeated rows each get their row. An empty table gives an empty result. Columns other
than ``doc_id`` and ``text`` are not looked at.
"""

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words remembered by a task; beyond that it forgets all and starts again.
REMEMBERED_WORDS = 400_000
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: Words with the spaces before them, and line ends.
_WORDS = re.compile(r" *[^ \n]+|\n| +")


class PieceCodec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_ids: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        scores = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(_BYTE.fullmatch(piece).group(1), 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                    raise ValueError(f"piece {i} spans words, which this encoder does not split for")
                scores.append(model.get_score(i))
                self.automaton.add_word(piece, (len(piece), scores[-1], i))
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        self.automaton.make_automaton()
        self.unknown = min(scores) - UNKNOWN_PENALTY
        raw = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.id_bytes = [raw.get(i) or p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.remembered: dict[str, tuple[np.ndarray, float, int]] = {}

    def best_path(self, marked: str) -> tuple[list[int], float, int]:
        """Ids, score and characters that fell back, for a text whose spaces are marked; U+2581 in it is a space."""
        size = len(marked)
        best, back = [0.0], [(0, -1)]

        def reach(end: int) -> None:
            # Every position can be reached from the one before by the bytes of their character.
            for start in range(len(best) - 1, end):
                best.append(best[start] + self.unknown)
                back.append((start, -1))

        for last, (length, score, piece) in self.automaton.iter(marked):
            end = last + 1
            reach(end)
            total = best[end - length] + score
            if total > best[end]:
                best[end], back[end] = total, (end - length, piece)
        reach(size)
        ids: list[int] = []
        unknown, at = 0, size
        while at:
            start, piece = back[at]
            if piece < 0:
                ids += [self.byte_ids[b] for b in reversed(marked[start].encode("utf-8", "surrogatepass"))]
                unknown += 1
            else:
                ids.append(piece)
            at = start
        return ids[::-1], best[size], unknown

    def _word(self, word: str, marks: str) -> tuple[np.ndarray, float, int]:
        """A word with the spaces before it; ``marks`` is the mark in front of a text's first word."""
        known = None if marks else self.remembered.get(word)
        if known is None:
            bare = word.lstrip(" ")
            marked = marks + SPACE * (len(word) - len(bare))
            if SPACE not in bare:
                ids, score, unknown = self.best_path(marked + bare)
            else:
                ids, score, unknown = [], 0.0, 0
                for k, part in enumerate(bare.split(SPACE)):
                    if k:
                        ids += [self.byte_ids[b] for b in SPACE.encode()]
                        score, unknown = score + self.unknown, unknown + 1
                    part = part if k else marked + part
                    more = self.best_path(part)
                    ids, score, unknown = ids + more[0], score + more[1], unknown + more[2]
            known = (np.array(ids, "<u4").tobytes(), score, unknown)
            if not marks:
                if len(self.remembered) >= REMEMBERED_WORDS:
                    self.remembered.clear()
                self.remembered[word] = known
        return known

    def encode(self, text: str) -> tuple[np.ndarray, float, int]:
        """Ids, score and number of characters that fell back to bytes."""
        if not text:
            return np.array([], "<u4"), 0.0, 0
        if text.startswith(" ") or SPACE in text:
            found = [self._word(w, SPACE if k == 0 else "") for k, w in enumerate(_WORDS.findall(text))]
        else:
            # The mark in front makes the first word look like any other.
            found = [self._word(w, "") for w in _WORDS.findall(" " + text)]
        ids, scores, unknown = zip(*found)
        return np.frombuffer(b"".join(ids), "<u4"), float(sum(scores)), sum(unknown)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids."""
        return b"".join(map(self.id_bytes.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a vocabulary file, made once in each Python worker."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids``, ``score`` and ``n_fallback`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            found = [pieces.encode(t.as_py() or "") for t in batch.column(1)]
            columns = [
                batch.column(0),
                pa.array([ids.astype(np.int32) for ids, _, _ in found], pa.list_(pa.int32())),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([n for _, _, n in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "score", "n_fallback"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, score double, n_fallback long")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of each row of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            texts = [pieces.decode(np.array(ids.as_py() or [], np.int64)) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encoding_digest(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, n_fallback, ids_crc32, score, round_trip``: every text encoded and decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        names = ["doc_id", "n_tokens", "n_fallback", "ids_crc32", "score", "round_trip"]
        for batch in batches:
            rows = []
            for t in batch.column(1):
                text = t.as_py() or ""
                ids, score, unknown = pieces.encode(text)
                rows.append((len(ids), unknown, zlib.crc32(ids.tobytes()), score, pieces.decode(ids) == text))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = "doc_id long, n_tokens long, n_fallback long, ids_crc32 long, score double, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)

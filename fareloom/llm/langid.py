"""Language identification by cross-parsing entropy.

Each language has a reference text, made of labelled documents. Its suffix automaton tells how far a text can
be followed through the reference: a phrase is the longest match from where the last phrase ended, and the
text is parsed into phrases. In the language of the text phrases are long, so there are few. The phrase count is
normalised to bits a character, ``phrases * log2(reference length) / text length``, which makes references
of different lengths comparable; the language with the least wins. Equal counts go to the language that
sorts first. The score is 1 less the mean ratio of its bits to those of each other language: 0 where all fit equally.

Texts are parsed whole, in lower case, as code points; what is between letters counts as one space, so that markup and
punctuation say nothing. So that a task follows many texts at once in numpy, texts are cut
into stretches of ``STRETCH`` characters and a phrase does not go on from one stretch to the next.

Sample: the reference of a language holds about ``reference_chars`` characters of documents, drawn by hashed
id from all documents that may be learned from, each with its first ``LONGEST_SAMPLE`` characters. Every language with such
a document is learned: the one with the least hash is always drawn. All characters of a reference are told apart,
whatever its script; those that it does not have match nothing in it. These bounds make the automata below 1 MB
each; the model, and the time a text takes, grow with the number of languages.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing can be
learned. Documents with a null language or text are not learned from. A null id counts as held out: it has no
remainder. Repeated rows each get their row; repeated texts enter a reference once. Columns other than ``doc_id``,
``text`` and ``lang`` are not looked at.
"""

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import draw, drawn_by_group, extended, sliced, with_text

REFERENCE_CHARS = 24_000
#: Characters that a document gives to a reference at most, so that it holds several.
LONGEST_SAMPLE = 6_000
STRETCH = 256
UNDETERMINED = "und"
HELD_OUT = 2
_LETTER = re.compile(r"[^\W\d_]")
_BETWEEN = re.compile(r"[\W\d_]+")
_STATE = np.int64(2**32 - 1)
#: Places that were tried in vain before the search for room in a table moves on.
_MOST_TRIES = 30


def letters(text: str) -> str:
    """The text in lower case, with one space for every run of other characters than letters."""
    return _BETWEEN.sub(" ", text.lower())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton that accepts all substrings of the text; state 0 is the start."""
    to: list[dict[str, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for char in text:
        new = len(to)
        to.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        state = last
        while state >= 0 and char not in to[state]:
            to[state][char] = new
            state = link[state]
        if state >= 0:
            target = to[state][char]
            if longest[state] + 1 == longest[target]:
                link[new] = target
            else:
                clone = len(to)
                to.append(dict(to[target]))
                link.append(link[target])
                longest.append(longest[state] + 1)
                while state >= 0 and to[state].get(char) == target:
                    to[state][char] = clone
                    state = link[state]
                link[target] = link[new] = clone
        last = new
    return to


@dataclass(frozen=True)
class Table:
    """The automaton of one reference: classes of symbols (0: not in it), moves, and the state behind a class alone.

    States are places in ``moves``, laid so that the moves of one fill gaps between those of others: the entry at
    ``state + class`` has its owner in the upper half and the next state in the lower one. Where the owner is another
    state, the phrase ends before this character. State 0 has no moves: a text starts there, and goes there behind a
    character that the reference does not have, which is a phrase of its own.
    """

    classes: np.ndarray
    moves: np.ndarray
    alone: np.ndarray


@dataclass(frozen=True)
class Model:
    """Languages, the symbols of code points (0: in no reference), and a table for each language."""

    languages: tuple[str, ...]
    symbols: np.ndarray
    tables: tuple[Table, ...]
    bits_per_phrase: tuple[float, ...]


def _table(reference: str, symbols: dict[str, int]) -> Table:
    automaton = suffix_automaton(reference)
    number = {c: k for k, (c, _) in enumerate(sorted(Counter(reference).items(), key=lambda x: (-x[1], x[0])), 1)}
    width = len(number)
    rows = [sorted(number[c] for c in moves) for moves in automaton]
    base = [0] * len(automaton)
    taken = {0}
    used = bytearray(4 * width)
    low = first = width + 1
    size = 0
    for state in sorted((s for s in range(1, len(rows)) if rows[s]), key=lambda s: (-len(rows[s]), s)):
        row = rows[state]
        if len(row) == 1 and size != 1:
            low = first
        size = len(row)
        place, tries = low - 1, 0
        while True:
            place = used.find(0, place + 1)
            if place < 0 or place + width >= len(used):
                place = len(used) if place < 0 else place
                used.extend(bytes(len(used)))
            at = place - row[0]
            if at not in taken and not any(used[at + k] for k in row):
                break
            tries += 1
        base[state] = at
        taken.add(at)
        for k in row:
            used[at + k] = 1
        if tries > _MOST_TRIES or size == 1:
            low = place
    moves = np.full(max(base) + width + 1, -1 << 32, np.int64)
    for state, to in enumerate(automaton):
        if base[state]:
            for char, target in to.items():
                moves[base[state] + number[char]] = base[state] << 32 | base[target]
    classes = np.zeros(len(symbols) + 1, np.int64)
    alone = np.zeros(width + 1, np.int64)
    for char, k in number.items():
        classes[symbols[char]] = k
        alone[k] = base[automaton[0][char]]
    return Table(classes, moves, alone)


def build_model(references: dict[str, str]) -> Model:
    """The model of the languages' reference texts."""
    texts = {lang: letters(text) for lang, text in sorted(references.items()) if text}
    numbers = {c: k for k, c in enumerate(sorted(set().union(*texts.values())), 1)}
    symbols = np.zeros(0x110000, np.int32)
    for char, k in numbers.items():
        symbols[ord(char)] = k
    return Model(
        tuple(texts),
        symbols,
        tuple(_table(text, numbers) for text in texts.values()),
        tuple(float(np.log2(len(text) + 1)) for text in texts.values()),
    )


def phrase_counts(texts: list[str], model: Model) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns)."""
    lowered = [letters(t) for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    stretches = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(texts)), stretches)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    start = np.repeat(np.cumsum(sizes) - sizes, stretches) + within * STRETCH
    length = np.minimum(STRETCH, np.repeat(sizes, stretches) - within * STRETCH)
    # Longest first, so that those which go on at a step come before those that have ended.
    order = np.argsort(-length, kind="stable")
    owner, start, length = owner[order], start[order], length[order]
    going = np.searchsorted(-length, -np.arange(length.max(initial=0)), side="left")
    symbols = model.symbols[points]
    grid = [symbols[start[:n] + step] for step, n in enumerate(going)]
    phrases = np.zeros((len(texts), len(model.languages)), np.int64)
    for k, table in enumerate(model.tables):
        state = np.zeros(len(owner), np.int64)
        ended = np.zeros(len(owner), np.int64)
        for n, row in zip(going, grid):
            kinds = table.classes[row]
            moved = table.moves[state[:n] + kinds]
            missed = moved >> 32 != state[:n]
            ended[:n] += missed
            state[:n] = np.where(missed, table.alone[kinds], moved & _STATE)
        phrases[:, k] = np.bincount(owner, ended, len(texts))
    return phrases


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    found = [UNDETERMINED] * len(texts)
    scores = np.zeros(len(texts))
    rows = [i for i, t in enumerate(texts) if t and model.languages and _LETTER.search(t)]
    if not rows:
        return found, scores
    bits = phrase_counts([texts[i] for i in rows], model) * np.array(model.bits_per_phrase)
    best = bits.argmin(axis=1)
    lowest = bits.min(axis=1)
    others = (lowest[:, None] / bits).sum(axis=1) - 1
    share = others / max(len(model.languages) - 1, 1)
    scores[rows] = np.clip(1 - share, 0, 1)
    for i, k in zip(rows, best):
        found[i] = model.languages[k]
    return found, scores


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def references(docs: DataFrame, reference_chars: int = REFERENCE_CHARS) -> dict[str, str]:
    """The reference text of each language, from a bounded sample of the documents that may be learned from."""
    usable = docs.where((remainder() != HELD_OUT) & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "doc_id", F.substring("text", 1, LONGEST_SAMPLE).alias("text"), "lang"
    )
    known = usable.groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.min(draw("doc_id")).alias("least")
    )
    # Twice the wanted number of documents, as copies of one text are taken once; one row a language.
    sizes = {
        r["lang"]: (2 + int(2 * reference_chars * r["n"] / r["chars"]), r["n"], r["least"]) for r in known.toLocalIterator()
    }
    if not sizes:
        return {}
    drawn = drawn_by_group(usable, "doc_id", "lang", sizes)
    parts: dict[str, list[str]] = {}
    held: Counter = Counter()
    unique = drawn.dropDuplicates(["lang", "text"]).toPandas().sort_values(["doc_id", "text"], kind="stable")
    for lang, text in zip(unique["lang"], unique["text"]):
        if held[lang] < reference_chars:
            parts.setdefault(lang, []).append(text)
            held[lang] += len(text)
    return {lang: "\n".join(texts) for lang, texts in parts.items()}


def identify(docs: DataFrame, model: Model, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """These columns, ``__lang`` and ``__score`` of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = with_text(docs, columns)
    schema = extended(given, "__lang string, __score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "__text", 4 << 20):
            *kept, texts = batch.columns
            found, scores = predict(texts.to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string()), pa.array(scores)], schema.names)

    return given.mapInArrow(run, schema)


def language_id(docs: DataFrame, reference_chars: int = REFERENCE_CHARS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: learned from the documents whose remainder is not 2."""
    told = identify(docs, build_model(references(docs, reference_chars)))
    held_out = F.coalesce(remainder() == HELD_OUT, F.lit(True))
    return told.select("doc_id", held_out.alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def in_known_language(docs: DataFrame, least_score: float, reference_chars: int = REFERENCE_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, whose language can be told with at least this score."""
    told = identify(docs, build_model(references(docs, reference_chars)), docs.columns)
    sure = (F.col("__lang") != UNDETERMINED) & (F.col("__score") >= least_score)
    return told.where(sure).drop("__lang", "__score")

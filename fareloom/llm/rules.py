"""Quality rules: a decision list learned from labelled documents and applied as one Spark expression.

Text statistics are counted over whole texts in one pass; words are runs of bytes other than space and \\x09-\\x0D.
From the statistics of labelled documents, sequential covering learns what to reject: a rule is grown on two thirds
of the examples left, one threshold condition after the other by information gain, until it covers no good
example; conditions are then pruned from its end while the remaining third agrees. A rule that is not
``min_precision`` right on that third, nor on all examples left, ends the list. The examples a rule covers
are taken out before the next one is grown. The list becomes ``when(...).when(...).otherwise(True)``.

Sample: at most about ``max_labelled`` labelled documents, drawn by hashed id, are learned from; a documented bound,
as the list is small and the rest of the labels would not change it. Statistics are counted for all documents.

Nulls and edges: a null text counts as empty. A text with no words fails the base rules. Labels that are null,
or whose document is missing, are not learned from; with no labels, or labels of one kind only, the list is
empty and the base rules decide alone. Repeated rows each get their row. An id labelled twice is learned with the
lower label. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import hashed_sample

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 3
MAX_LABELLED = 20_000
STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_chars_all",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_lines",
    "n_distinct_words",
)
#: What conditions look at: statistics in proportion to the text, so that a threshold means the same at any length.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs at least twice in the list."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = reach = 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + WINDOW - max(at, reach)
            reach = at + WINDOW
    return covered


def text_statistics(text: str) -> tuple[int, ...]:
    """The counts named in ``STATISTICS``."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    gone = lambda octets: len(data) - len(data.translate(None, octets))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(text),
        gone(_UPPER),
        gone(_DIGITS),
        gone(_MARKS),
        len(lines),
        len(set(words)),
    )


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *STATISTICS]
    for batch in batches:
        counts = [text_statistics(t.as_py() or "") for t in batch.column(1)]
        columns = np.array(counts, np.int64).reshape(-1, len(STATISTICS)).T
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text statistics of each document."""
    schema = ", ".join(["doc_id long", *(f"{name} long" for name in STATISTICS)])
    return docs.select("doc_id", "text").mapInArrow(_statistics, schema)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature]).cast("double")
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    hit = np.ones(size, bool)
    for condition in rule:
        hit &= condition.holds(table)
    return hit


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray) -> Condition | None:
    """The condition with the highest information gain over examples that all pass so far."""
    before = np.log2(bad.mean())
    best: tuple[float, Condition] | None = None
    for feature, values in table.items():
        order = np.argsort(values, kind="stable")
        ranked, hits = values[order], bad[order].astype(np.int64)
        cuts = np.flatnonzero(np.diff(ranked) > 0)
        if not len(cuts):
            continue
        below_bad, below = np.cumsum(hits)[cuts], cuts + 1
        for above, p, n in ((False, below_bad, below), (True, hits.sum() - below_bad, len(hits) - below)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - before), -np.inf)
            at = int(np.argmax(gain))
            if gain[at] > 1e-9 and (best is None or gain[at] > best[0] + 1e-9):
                middle = float((ranked[cuts[at]] + ranked[cuts[at] + 1]) / 2)
                best = (float(gain[at]), Condition(feature, above, middle))
    return best[1] if best else None


def learn_rules(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    *,
    min_precision: float = 0.95,
    min_support: int = 10,
    max_conditions: int = 4,
    max_rules: int = 20,
) -> list[Rule]:
    """An ordered list of rules, each of which rejects; examples in row order decide, so equal input gives equal rules."""
    rules: list[Rule] = []
    pick = lambda mask: {k: v[mask] for k, v in table.items()}
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < max_rules and bad[left].sum() >= min_support:
        grow, prune = left & ~third, left & third
        rule: Rule = ()
        inside = grow.copy()
        while len(rule) < max_conditions and bad[inside].any() and not bad[inside].all():
            condition = _best_condition(pick(inside), bad[inside])
            if condition is None:
                break
            rule = (*rule, condition)
            inside &= condition.holds(table)
        if not rule:
            break

        def worth(candidate: Rule, among: np.ndarray) -> tuple[float, int]:
            hit = _covered(candidate, table, len(bad)) & among
            return (float(bad[hit].mean()) if hit.any() else 0.0), int(bad[hit].sum())

        while len(rule) > 1 and worth(rule[:-1], prune) >= worth(rule, prune):
            rule = rule[:-1]
        precision, support = worth(rule, left)
        if min(precision, worth(rule, prune)[0]) < min_precision or support < min_support:
            break
        rules.append(rule)
        left &= ~_covered(rule, table, len(bad))
    return rules


def keep_expression(rules: list[Rule]) -> Column:
    """The decision list over the statistics' columns: false at the first rule that holds, else true."""
    verdict = None
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column()
        verdict = (F if verdict is None else verdict).when(holds, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def fit_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules learned from ``labels`` (doc_id, quality: 1 good, 0 bad) and the texts of their documents."""
    known = labels.select("doc_id", "quality").dropna()
    drawn = hashed_sample(known, "doc_id", max_labelled, known.count())
    drawn = drawn.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_semi")
    measured = statistics(texts.dropDuplicates(["doc_id"])).join(drawn, "doc_id")
    rows = measured.select("doc_id", "quality", *(F.expr(e).cast("double").alias(k) for k, e in FEATURES.items()))
    sample = rows.toPandas().sort_values("doc_id", kind="stable")
    return learn_rules({k: sample[k].to_numpy() for k in FEATURES}, sample["quality"].to_numpy() == 0)


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Statistics of each document, ``base_failed``, and ``kept``: passed the base rules and the learned list."""
    keep = keep_expression(fit_rules(docs, labels, max_labelled))
    failed = F.expr(BASE_FAILED)
    return statistics(docs).select("doc_id", *STATISTICS, failed.alias("base_failed"), (~failed & keep).alias("kept"))

"""Removal of passages that documents with smaller ids have, by a run-compressed suffix index.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Texts are their
UTF-8 bytes; strings are compared within documents and on the input, not on what is left.

Every string of ``length`` bytes has an anchor: the substring of ``ANCHOR`` bytes whose hash is least, the first of them. Equal
strings have equal anchors at equal places, so strings only meet where their anchors do. Neighbouring strings with the
same anchor make a stretch of bytes; stretches of one anchor go to one bucket.

1. Documents are written once, in groups of about ``GROUP_BYTES``, however many that takes, so that no later step moves
   texts. A file of the table has one group, or, as Spark bounds the buckets of a table, several beyond ``MOST_FILES``; each group
   is read and worked on by itself.
2. Each group tells the buckets its anchors' hashes, each once, and about how many stretches it has of each. It learns
   which anchors more documents have, and which have over ``HOT_STRETCHES`` stretches.
3. Each group sends the stretches of those anchors, equal ones once with their smallest id. A bucket builds the
   run-compressed index of ``run_index`` over its distinct stretches in order of ids, but for those whose anchor has no
   other, as the strings of one stretch all differ; streams their matching statistics, and answers with the smallest id that has each stretch and the parts that match an earlier one.
   Stretches of hot anchors are not sent: their strings are, each as a 128-bit hash with its smallest id, to buckets
   by that hash. So the strings of one anchor are dealt over all buckets, equal ones still meet, and the
   bucket answers with the smallest id of each.
4. Each group removes: a stretch that a smaller id has as a whole, otherwise its matching parts, and strings of hot
   anchors that a smaller id has.

Equal stretches and equal strings meet as one, so a passage that a third of all documents share is one entry a group,
also at its borders, where each document goes on in its own words. An index is built over a bucket's share of the
repeated text, so memory is bounded by the bucket sizes, which follow the data.

Nulls and edges: a null text is empty. Documents with a null id come behind all others and not before each other;
rows with equal ids do not match each other. Texts shorter than ``length`` lose nothing. Texts of any length are
worked on in windows. An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are passed on
or not looked at.
"""

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from fareloom.llm.common import saved
from fareloom.llm.run_index import RunIndex
from fareloom.session import scratch_folder

LENGTH = 50
ANCHOR = 16
GROUP_BYTES = 8 << 20
MOST_FILES = 50_000
#: Text that one index holds, small enough for a processor's cache; a bucket has as many indexes as it needs.
INDEX_BYTES = 1 << 18
#: Stretches of one anchor that go to one bucket, counted up to twice too high; they are a few times as long as one index.
HOT_STRETCHES = 10_000
#: Bytes that are hashed at once, for the same reason.
_WINDOW = 1 << 17
_PLACE = np.uint64((1 << 22) - 1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_FILE, _GROUP, _ORDER, _MARK = "__file", "__group", "__order", "__mark"
_REPLY = "g int, bucket int, kind int, first binary, second binary"
_LAST = 2**63 - 1
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * _OTHER
    return h ^ h >> np.uint64(29)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes at each place, put together from halves."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _OTHER
    size, factor = 1, int(_PRIME)
    while size < ANCHOR:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor + 2 & (1 << 64) - 1
    return _mixed(h)


def _string_hashes(data: np.ndarray, length: int, seed: np.uint64) -> np.ndarray:
    """A hash of the ``length`` bytes at each place."""
    h = _mixed(data.astype(np.uint64) + seed)
    size = 1
    while 2 * size <= length:
        h = _mixed(h[:-size] * _PRIME + h[size:])
        size *= 2
    rest = length - size
    return _mixed(h[:-rest] * _PRIME + h[rest:]) if rest else h


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    known = 1
    while 2 * known <= width:
        values = np.minimum(values[:-known], values[known:])
        known *= 2
    rest = width - known
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end in blocks: (bytes, document, start in it, end in the block) of each piece of a block.

    Pieces of one text overlap by ``length - 1`` bytes, so each string starts in one of them.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), _WINDOW):
            part = text[start : start + _WINDOW + length - 1]
            held.append((i, start, part))
            size += len(part)
            if size >= _WINDOW:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
    document, start = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
    return data, document, start, np.cumsum([len(part) for _, _, part in held])


def stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, anchor hash) of all stretches, in order."""
    out: list[tuple[np.ndarray, ...]] = []
    for data, document, start, ends in _pieces(texts, length):
        grams = _gram_hashes(data)
        ranked = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
        anchor = (_least_in(ranked, length - ANCHOR + 1) & _PLACE).astype(np.int64)
        whole = np.ones(len(data), bool)
        whole[(ends[:, None] - 1 - np.arange(length - 1)).ravel()] = False
        places = np.flatnonzero(whole)
        of = anchor[places]
        fresh = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (np.diff(places) != 1)]))
        first, last = places[fresh], places[np.append(fresh[1:], len(places)) - 1]
        piece = np.searchsorted(ends, first, side="right")
        shift = start[piece] - np.concatenate([[0], ends[:-1]])[piece]
        out.append((document[piece], first + shift, last + length + shift, _mixed(grams[of[fresh]] + _PRIME)))
    if not out:
        return (*(np.array([], np.int64) for _ in range(3)), np.array([], np.uint64))
    return tuple(np.concatenate([part[k] for part in out]) for k in range(4))


def _slices(numbers: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each run of equal numbers, and where it is."""
    cuts = np.flatnonzero(np.diff(numbers, prepend=-1)).tolist()
    for start, end in zip(cuts, [*cuts[1:], len(numbers)]):
        yield int(numbers[start]), slice(start, end)


def _numbered(strings: Iterable[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct strings, in the order in which they first come, and the number of each string among them."""
    numbers: dict[bytes, int] = {}
    number = np.array([numbers.setdefault(s, len(numbers)) for s in strings], np.int64)
    return list(numbers), number


def _firsts(number: np.ndarray) -> np.ndarray:
    """Where each number of ``_numbered`` comes first."""
    return np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))


class _Lists:
    """Rows of (number, start, end) in order of numbers below ``size``, to be looked up by number."""

    def __init__(self, rows: np.ndarray, size: int) -> None:
        self.rows = rows
        self.count = np.bincount(rows[:, 0], minlength=size)
        self.first = np.cumsum(self.count) - self.count

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all rows of each of the numbers, and for each row which of these it is for."""
        count = self.count[numbers]
        entry = np.repeat(np.arange(len(numbers)), count)
        inside = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
        return entry, self.rows[self.first[numbers][entry] + inside, 1:]


@dataclass
class _Sent:
    """What a group sends of its repeated anchors: distinct stretches, by bucket, and where it has them."""

    strings: list[bytes]
    #: Of each string the smallest id, the length, and 32 bits of its anchor's hash.
    about: np.ndarray
    bucket: np.ndarray
    #: Stretches that are sent, and the number of the string that each is.
    stretch: np.ndarray
    number: np.ndarray


class _Group:
    """The documents of a group in order, and their anchors in the order in which buckets are told of them."""

    def __init__(self, rows: pa.Table, buckets: int, length: int) -> None:
        order, mark = (rows.column(c).to_numpy() for c in (_ORDER, _MARK))
        self.sorted = np.lexsort((mark, order))
        self.order = order[self.sorted]
        texts = rows.column("text").take(pa.array(self.sorted)).to_pylist()
        self.texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.document, self.start, self.end, hashes = stretches(self.texts, length)
        # Anchors by hash, and which of them each stretch has; buckets are ranges of hashes, so they are in order too.
        self.hashes, self.anchor_of = np.unique(hashes, return_inverse=True)
        self.bucket = ((self.hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.buckets, self.length = buckets, length

    def shared_anchors(self) -> np.ndarray:
        """Whether each anchor lies in documents of the group with different ids."""
        ids = self.order[self.document]
        least, most = np.full(len(self.hashes), _LAST), np.full(len(self.hashes), -(2**63))
        np.minimum.at(least, self.anchor_of, ids)
        np.maximum.at(most, self.anchor_of, ids)
        return most > least

    def sent(self, repeated: np.ndarray) -> _Sent:
        """The distinct stretches of repeated anchors."""
        chosen = np.flatnonzero(repeated[self.anchor_of])
        chosen = chosen[np.argsort(self.bucket[self.anchor_of[chosen]], kind="stable")]
        columns = (self.document[chosen].tolist(), self.start[chosen].tolist(), self.end[chosen].tolist())
        strings, number = _numbered(self.texts[d][s:e] for d, s, e in zip(*columns))
        # Equal stretches have one anchor, so one bucket; documents are in order of ids, so the first has the smallest.
        lead = chosen[_firsts(number)]
        anchor = self.anchor_of[lead]
        low = (self.hashes[anchor] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        about = np.column_stack([self.order[self.document[lead]], self.end[lead] - self.start[lead], low])
        return _Sent(strings, about, self.bucket[anchor], chosen, number)

    def strings(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, two hashes) of all strings in stretches of hot anchors, in order."""
        chosen = np.flatnonzero(hot[self.anchor_of])
        held = np.unique(self.document[chosen])
        texts = [self.texts[d] for d in held.tolist()]
        # Places of all these documents laid end to end; the first and the last string of each stretch.
        offset = np.cumsum([0, *map(len, texts)])
        own = offset[np.searchsorted(held, self.document[chosen])]
        first, last = own + self.start[chosen], own + self.end[chosen] - self.length
        out = [(np.array([], np.int64), np.array([], np.int64), np.zeros((0, 2), np.uint64))]
        for data, document, start, ends in _pieces(texts, self.length):
            places = np.arange(len(data) - self.length + 1)
            piece = np.searchsorted(ends, places, side="right")
            inside = places + start[piece] - np.concatenate([[0], ends[:-1]])[piece]
            at = offset[document[piece]] + inside
            stretch = np.searchsorted(first, at, side="right") - 1
            wanted = (places + self.length <= ends[piece]) & (stretch >= 0) & (at <= last[stretch])
            both = np.stack([_string_hashes(data, self.length, seed)[wanted] for seed in (_PRIME, _OTHER)], axis=1)
            out.append((held[document[piece[wanted]]], inside[wanted], both))
        return tuple(np.concatenate([part[k] for part in out]) for k in range(3))

    def hot_sent(self, hot: np.ndarray) -> tuple[Iterator[tuple[int, np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct strings of hot anchors by bucket, as rows of two hashes and the smallest id, and all uses.

        Uses are documents, places and numbers of the distinct ones, counted through all buckets.
        """
        document, place, hashes = self.strings(hot)
        ranked, number = _alike(hashes)
        # Strings are in order of ids and the sort keeps it, so the first of equal ones has the smallest.
        lead = ranked[np.flatnonzero(np.diff(number[ranked], prepend=-1))]
        bucket = ((hashes[lead, 0] >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        places = np.argsort(bucket, kind="stable")
        back = np.empty(len(places), np.int64)
        back[places] = np.arange(len(places))
        lead, bucket = lead[places], bucket[places]
        rows = np.column_stack([hashes[lead].view(np.int64), self.order[document[lead]]])
        return ((b, rows[s]) for b, s in _slices(bucket)), document, place, back[number]


def _alike(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two hashes in order of these, equal ones as given, and the number of each row's value in that order."""
    first, second = np.ascontiguousarray(hashes.T)
    ranked = np.argsort(first, kind="stable")
    if (_changes(second[ranked]) & ~_changes(first[ranked])).any():
        # Rows that agree in one hash only: rare, as each has 64 bits.
        ranked = np.lexsort((second, first))
    number = np.empty(len(ranked), np.int64)
    number[ranked] = np.cumsum(_changes(first[ranked]) | _changes(second[ranked])) - 1
    return ranked, number


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before; the first does."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def _reply(rows: list[tuple[int, int, int, bytes, bytes]]) -> pa.Table:
    kinds = {"g": pa.int32(), "bucket": pa.int32(), "kind": pa.int32(), "first": pa.binary(), "second": pa.binary()}
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(kinds.items())})


def _told(buckets: int, length: int):
    """Group to buckets: 32 bits of each anchor's hash, and a byte with the bit length of its number of stretches.

    The upper bit of the byte is set if the group itself repeats the anchor.
    """

    def run(rows: pa.Table) -> pa.Table:
        group, g = _Group(rows, buckets, length), rows.column(_GROUP)[0].as_py()
        low = (group.hashes & np.uint64(0xFFFFFFFF)).astype("<u4")
        shared = group.shared_anchors().astype(np.uint8) << 7
        about = shared | np.frexp(np.bincount(group.anchor_of, minlength=len(low)))[1].astype(np.uint8)
        return _reply([(g, b, 0, low[s].tobytes(), about[s].tobytes()) for b, s in _slices(group.bucket)])

    return run


def _answered(most: int):
    """Bucket to groups: which of a group's anchors several documents have, and which have over ``most`` stretches."""

    def run(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), "<u4") for x in rows.column("first")]
        told = np.concatenate(parts)
        about = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("second")])
        ranked = np.sort(np.concatenate([told, told[about > 127]]))
        repeated = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        place = np.searchsorted(repeated, told)
        known = np.append(repeated, 0)[place] == told
        known[place == len(repeated)] = False
        count = np.bincount(place[known], np.exp2(about[known] & 127), len(repeated) + 1)
        hot = known & (count[place] > most)
        out = []
        ends = np.cumsum([len(p) for p in parts])
        for g, b, part, end in zip(rows.column("g").to_pylist(), rows.column("bucket").to_pylist(), parts, ends):
            own = slice(end - len(part), end)
            out.append((g, b, 1, np.packbits(known[own]).tobytes(), np.packbits(hot[own]).tobytes()))
        return _reply(out)

    return run


def _repeated(group: _Group, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors of the group are repeated but not hot, and which are hot."""
    answers = {
        b: (first, second)
        for b, kind, first, second in zip(*(replies.column(c).to_pylist() for c in ("bucket", "kind", "first", "second")))
        if kind == 1
    }
    repeated, hot = np.zeros((2, len(group.hashes)), bool)
    for b, s in _slices(group.bucket):
        for out, bits in zip((repeated, hot), answers.get(b, ())):
            out[s] = np.unpackbits(np.frombuffer(bits, np.uint8))[: s.stop - s.start] > 0
    return repeated & ~hot, hot


def _brought(buckets: int, length: int):
    """Group to buckets: the distinct stretches of repeated anchors, and the distinct strings of hot ones, with ids."""

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _reply([])
        group, g = _Group(rows, buckets, length), rows.column(_GROUP)[0].as_py()
        repeated, hot = _repeated(group, replies)
        sent = group.sent(repeated)
        out = [(g, b, 4, known.tobytes(), b"") for b, known in group.hot_sent(hot)[0]]
        for b, s in _slices(sent.bucket):
            out.append((g, b, 2, sent.about[s].astype("<i8").tobytes(), b"".join(sent.strings[s])))
        return _reply(out)

    return run


def _earlier_parts(strings: list[bytes], ids: np.ndarray, length: int) -> np.ndarray:
    """(string, start, end) of the parts that one with a smaller id has; strings are in order of ids, and so are the parts."""
    index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), length)
    place, first = index.first_places()
    owner, source = (np.searchsorted(index.begins, x, side="right") - 1 for x in (place, first))
    place = np.sort(place[ids[source] < ids[owner]])
    fresh = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    starts, ends = place[fresh], place[np.append(fresh[1:], len(place))[: len(fresh)] - 1]
    owner = np.searchsorted(index.begins, starts, side="right") - 1
    return np.column_stack([owner, starts - index.begins[owner], ends - index.begins[owner] + length])


def _least_ids(rows: pa.Table) -> list[tuple[int, int, int, bytes, bytes]]:
    """The answers to groups that sent strings of hot anchors."""
    if not rows.num_rows:
        return []
    parts = [np.frombuffer(x.as_py(), "<i8").reshape(-1, 3) for x in rows.column("first")]
    sent = np.concatenate(parts)
    _, number = _alike(sent[:, :2])
    least = np.full(number.max() + 1, _LAST)
    np.minimum.at(least, number, sent[:, 2])
    cut = np.split(least[number], np.cumsum([len(p) for p in parts])[:-1])
    return [
        (g, b, 5, own.astype("<i8").tobytes(), b"")
        for g, b, own in zip(rows.column("g").to_pylist(), rows.column("bucket").to_pylist(), cut)
    ]


def _matched(length: int):
    """Bucket to groups: for each stretch the smallest id that has it, and the parts that a smaller id has.

    For each string of a hot anchor: the smallest id that has it.
    """

    def run(rows: pa.Table) -> pa.Table:
        of_strings = pc.equal(rows.column("kind"), 4)
        answers = _least_ids(rows.filter(of_strings))
        rows = rows.filter(pc.invert(of_strings))
        if not rows.num_rows:
            return _reply(answers)
        parts = [np.frombuffer(x.as_py(), "<i8").reshape(-1, 3) for x in rows.column("first")]
        about = np.concatenate(parts)
        octets = b"".join(rows.column("second").to_pylist())
        ends = np.cumsum(about[:, 1])
        strings, number = _numbered(octets[a:b] for a, b in zip((ends - about[:, 1]).tolist(), ends.tolist()))
        least = np.full(len(strings), _LAST)
        np.minimum.at(least, number, about[:, 0])
        # Strings of one stretch are all different, so where an anchor has a single one, no part has an earlier place.
        anchor, size = about[_firsts(number), 2], about[_firsts(number), 1]
        _, of, stretches_of = np.unique(anchor, return_inverse=True, return_counts=True)
        several = np.flatnonzero(stretches_of[of] > 1)
        # Several smaller indexes, each over all stretches of its anchors, take less memory than one.
        share = anchor % max(1, int(size[several].sum()) // INDEX_BYTES)
        ranked = several[np.lexsort((least[several], share[several]))]
        found = [np.zeros((0, 3), np.int64)]
        for _, s in _slices(share[ranked]):
            own = ranked[s]
            earlier = _earlier_parts([strings[i] for i in own.tolist()], least[own], length)
            earlier[:, 0] = own[earlier[:, 0]]
            found.append(earlier)
        spans = np.concatenate(found)
        spans = _Lists(spans[np.argsort(spans[:, 0], kind="stable")], len(strings))
        out = []
        last = np.cumsum([len(p) for p in parts])
        for g, b, part, end in zip(rows.column("g").to_pylist(), rows.column("bucket").to_pylist(), parts, last):
            mine = number[end - len(part) : end]
            # Who has a stretch with a larger id than the smallest gives all of it.
            leading = np.flatnonzero(part[:, 0] == least[mine])
            entry, span = spans.of(mine[leading])
            told = np.column_stack([leading[entry], span])
            out.append((g, b, 3, least[mine].astype("<i8").tobytes(), told.astype("<i4").tobytes()))
        return _reply(out + answers)

    return run


def _removed(group: _Group, replies: pa.Table) -> list[np.ndarray]:
    """The (start, end) ranges to remove from each document, merged and in order."""
    repeated, hot = _repeated(group, replies)
    sent = group.sent(repeated)
    columns = [replies.column(c).to_pylist() for c in ("bucket", "kind", "first", "second")]
    of_stretches = {b: (first, second) for b, kind, first, second in zip(*columns) if kind == 3}
    of_strings = {b: first for b, kind, first, _ in zip(*columns) if kind == 5}
    least = np.frombuffer(b"".join(of_stretches[b][0] for b, _ in _slices(sent.bucket)), "<i8")
    spans = [np.zeros((0, 3), np.int64)]
    for b, s in _slices(sent.bucket):
        spans.append(np.frombuffer(of_stretches[b][1], "<i4").reshape(-1, 3) + np.array([s.start, 0, 0]))
    # A stretch that a smaller id has goes as a whole, of another the parts that match.
    document = group.document[sent.stretch]
    whole = least[sent.number] < group.order[document]
    gone = sent.stretch[whole]
    out = [np.column_stack([document[whole], group.start[gone], group.end[gone]])]
    left = sent.stretch[~whole]
    entry, span = _Lists(np.concatenate(spans), len(sent.strings)).of(sent.number[~whole])
    out.append(np.column_stack([group.document[left[entry]], span + group.start[left[entry], None]]))
    parts, owner, place, number = group.hot_sent(hot)
    smallest = np.frombuffer(b"".join(of_strings[b] for b, _ in parts), "<i8")
    strings = np.flatnonzero(smallest[number] < group.order[owner])
    out.append(np.column_stack([owner[strings], place[strings], place[strings] + group.length]))
    # All documents end to end, a byte apart, so that ranges of two never touch.
    ranges = np.concatenate(out)
    begins = np.cumsum([0, *(len(t) + 1 for t in group.texts)])
    merged = _merged(ranges[:, 1:] + begins[ranges[:, 0], None])
    owner = np.searchsorted(begins, merged[:, 0], side="right") - 1
    return np.split(merged - begins[owner, None], np.searchsorted(owner, np.arange(1, len(group.texts))))


def _merged(ranges: np.ndarray) -> np.ndarray:
    """Ranges that touch or overlap made one."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    fresh = np.concatenate([[True], ranges[1:, 0] > reach[:-1]])
    last = np.append(np.flatnonzero(fresh)[1:], len(ranges)) - 1
    return np.stack([ranges[fresh, 0], reach[last]], axis=1)


def _kept(text: bytes, removed: np.ndarray) -> bytes:
    bounds = [0, *removed.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))


def _finished(buckets: int, length: int, columns: list[str], digest: bool):
    """The rows of a group with what is left of their texts, or the digest of it."""

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        group = _Group(rows, buckets, length)
        removed = _removed(group, replies)
        kept = [_kept(t, r) for t, r in zip(group.texts, removed)]
        rows = rows.take(pa.array(group.sorted))
        if digest:
            return pa.table(
                {
                    "doc_id": rows.column("doc_id"),
                    "n_bytes": pa.array([len(t) for t in group.texts], pa.int64()),
                    "n_removed": pa.array([len(t) - len(k) for t, k in zip(group.texts, kept)], pa.int64()),
                    "n_spans": pa.array([len(r) for r in removed], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                }
            )
        # A cut may go through a character; what is left of it is dropped. Null texts stay null.
        given = rows.column("text").to_pylist()
        left = [None if t is None else k.decode("utf-8", "ignore") for t, k in zip(given, kept)]
        return pa.table({c: pa.array(left, pa.string()) if c == "text" else rows.column(c) for c in columns})

    return run


def _run(docs: DataFrame, length: int, digest: bool) -> DataFrame:
    if length < ANCHOR + 1:
        raise ValueError(f"matches are at least {ANCHOR + 1} bytes long")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    files = min(MOST_FILES, groups)
    used = docs.select("doc_id", "text") if digest else docs
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    keyed = used.withColumns({_ORDER: order, _MARK: F.xxhash64("text")})
    keyed = keyed.withColumn(_GROUP, F.pmod(F.xxhash64(_ORDER, _MARK), F.lit(groups)).cast("int"))
    keyed = keyed.withColumn(_FILE, F.col(_GROUP) % files)
    name = f"texts_{uuid.uuid4().hex}"
    # One text moves once, here: the table is bucketed by file, and groups are read where they lie.
    table = keyed.repartition(files, _FILE).write.bucketBy(files, _FILE)
    together = spark.conf.get(_ALL_KEYS)
    try:
        table.option("path", scratch_folder(spark, "texts")).saveAsTable(name)
        # Groups of a file lie together, so what they are joined with is dealt by file alone.
        spark.conf.set(_ALL_KEYS, "false")
        return _kept_rows(spark.table(name), groups, files, length, used, digest)
    finally:
        spark.conf.set(_ALL_KEYS, together)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _kept_rows(rows: DataFrame, groups: int, files: int, length: int, used: DataFrame, digest: bool) -> DataFrame:
    """The answer for the table of groups, written."""

    def by_group(replies: DataFrame) -> GroupedData:
        return replies.withColumn(_FILE, F.col("g") % files).groupBy(_FILE, "g")

    def by_bucket(messages: DataFrame) -> GroupedData:
        # As many tasks as files, so that what one reads does not grow with the text.
        return messages.repartition(files, "bucket").groupBy("bucket")

    slim = rows.select(_FILE, _GROUP, _ORDER, _MARK, "text").groupBy(_FILE, _GROUP)
    told = slim.applyInArrow(_told(groups, length), _REPLY)
    answers = saved(by_bucket(told).applyInArrow(_answered(HOT_STRETCHES), _REPLY), "answers")
    brought = slim.cogroup(by_group(answers)).applyInArrow(_brought(groups, length), _REPLY)
    matches = saved(by_bucket(brought).applyInArrow(_matched(length), _REPLY), "matches")
    finish = _finished(groups, length, used.columns, digest)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" if digest else used.schema
    result = rows.groupBy(_FILE, _GROUP).cogroup(by_group(answers.union(matches))).applyInArrow(finish, schema)
    return saved(result, "kept")


def repeats_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each document."""
    return _run(docs, length, digest=True)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated passages taken out of ``text``."""
    return _run(docs, length, digest=False)

"""A run-compressed index over many short byte strings, for matches of one fixed length.

The strings are laid end to end, in the order given, with a separator that no UTF-8 text has. A row stands for each place
with ``length`` bytes of its string behind it, and for the place after the last of these. Rows are sorted by
their first ``length`` bytes and then by place; the byte before each is the Burrows-Wheeler transform. Rows are not kept, only
what repetitions do not lengthen:

- the runs of the transform: the byte of each, where it starts, and how many equal bytes lie before it,
- the classes of rows that share ``length`` bytes: where each starts, and a place sampled at its first row. As such rows are
  ordered by place, this is the first occurrence of those bytes in all strings.

Matching statistics are streamed: a string is read from its end, each byte takes the class to that of the rows that start
with it and go on like the one before, through the runs alone, as statistics are only asked for up to ``length``. The walk carries
the sample of its class, which is how a place learns where its bytes come first. All strings advance together in numpy.
"""

import numpy as np

SEPARATOR = 0xFF
_BIG = np.uint64(32)
#: Bits of a place or a rank where two ranks and a place, or some bytes and a place, are sorted as one number.
_FIELD = 21


def _ranks(high: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
    """The rank of each key, or of each pair of ranks, among the distinct ones."""
    n = len(high)
    if not n:
        return high
    if n <= 1 << _FIELD:
        # Whole numbers sort much faster than places by number.
        field = np.uint64(_FIELD)
        keys = high if low is None else high << field | low
        ranked = np.sort(keys << field | np.arange(n, dtype=np.uint64))
        order = (ranked & np.uint64((1 << _FIELD) - 1)).astype(np.int64)
        ranked >>= field
    else:
        keys = high if low is None else high << _BIG | low
        order = np.argsort(keys)
        ranked = keys[order]
    fresh = np.empty(n, np.uint64)
    fresh[0] = 0
    np.cumsum(ranked[1:] != ranked[:-1], out=fresh[1:])
    out = np.empty(n, np.uint64)
    out[order] = fresh
    return out


def _prefix_ranks(text: np.ndarray, length: int, places: np.ndarray) -> np.ndarray:
    """The rank of the ``length`` bytes at each of the places; beyond the end the separator goes on."""
    # As many bytes as fit beside a place, in the bits that this text's bytes need.
    octets = np.flatnonzero(np.bincount(text, minlength=256)).astype(np.uint8)
    bits = max(1, (len(octets) - 1).bit_length())
    known = min(2 * _FIELD // bits, length)
    padded = np.concatenate([np.searchsorted(octets, text), np.full(length, len(octets) - 1)]).astype(np.uint64)
    keys = np.zeros(len(text), np.uint64)
    for k in range(known):
        keys = keys << np.uint64(bits) | padded[k : k + len(text)]
    ranks = _ranks(keys)

    def later(distance: int) -> np.ndarray:
        # The last places have separators only, so what lies beyond the end ranks as the last place does.
        return np.append(ranks, np.full(distance, ranks[-1]))

    while 2 * known < length:
        ranks, known = _ranks(ranks, later(known)[known : known + len(text)]), 2 * known
    # The last step overlaps, as what is known twice does not change the order, and is for these places only.
    distance = length - known
    return _ranks(ranks[places], later(distance)[places + distance])


class RunIndex:
    """Index over ``strings``, bytes laid end to end with ``lengths``; strings shorter than ``length`` match nothing."""

    def __init__(self, strings: np.ndarray, lengths: np.ndarray, length: int) -> None:
        self.length = length
        ends = np.cumsum(lengths + 1)
        text = np.full(int(ends[-1]), SEPARATOR, np.uint8)
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        text[inside] = strings
        self.text, self.begins, self.lengths = text, ends - lengths - 1, lengths
        left = np.repeat(ends, lengths + 1) - np.arange(len(text)) - 1
        chosen = np.flatnonzero(left >= length - 1)
        ranks = _prefix_ranks(text, length, chosen)
        rows = np.sort(ranks << _BIG | chosen.astype(np.uint64))
        places = (rows & np.uint64(0xFFFFFFFF)).astype(np.int64)
        group = (rows >> _BIG).astype(np.int64)
        before = text[places - 1]
        # Runs of the transform: their byte, their first row, and equal bytes before them in all rows.
        heads = np.flatnonzero(np.diff(before.astype(np.int16), prepend=-1))
        order = np.argsort(before[heads], kind="stable")
        self.run_byte = before[heads][order]
        self.run_start = heads[order]
        self.run_length = np.diff(np.append(heads, len(rows)))[order]
        total = np.cumsum(self.run_length)
        self.smaller = np.concatenate([[0], total])[np.searchsorted(self.run_byte, np.arange(256))]
        self.run_before = total - self.run_length - self.smaller[self.run_byte]
        self.run_key = self.run_byte.astype(np.int64) << 32 | self.run_start
        # Only rows with ``length`` bytes can be led to by a byte; the others, one a string, are where walks begin.
        whole = left[places] >= length
        ending = np.flatnonzero(~whole)
        self.ending_rows = ending[np.argsort(places[ending])]
        # Classes of the whole rows: the first row of each, also as counted among whole rows, and the place sampled there.
        self.class_row = np.flatnonzero((np.diff(group, prepend=-1) != 0) & whole)
        self.class_start = self.class_row - np.searchsorted(ending, self.class_row)
        self.class_place = places[self.class_row]

    @property
    def runs(self) -> int:
        return len(self.run_key)

    @property
    def nbytes(self) -> int:
        """Bytes of the index beside the strings themselves."""
        return sum(a.nbytes for name, a in vars(self).items() if isinstance(a, np.ndarray) and name != "text")

    def _step(self, rows: np.ndarray, octets: np.ndarray) -> np.ndarray:
        """The class of the rows that start with the byte and go on like the given row."""
        key = octets.astype(np.int64) << 32 | rows
        # In order of keys, and so of images, neighbouring look-ups stay close to each other.
        order = np.argsort(key)
        key, rows, octets = key[order], rows[order], octets[order]
        run = np.searchsorted(self.run_key, key, side="right") - 1
        same = (run >= 0) & (self.run_byte[run] == octets)
        inside = np.minimum(rows - self.run_start[run], self.run_length[run])
        image = self.smaller[octets] + np.where(same, self.run_before[run] + inside, 0)
        reached = np.empty(len(order), np.int64)
        reached[order] = np.searchsorted(self.class_start, image, side="right") - 1
        return reached

    def first_places(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, first): for every place with a whole match length in its string, where those bytes come first."""
        ended = self.lengths >= self.length - 1
        sizes = self.lengths[ended] - self.length + 1
        order = np.argsort(-sizes, kind="stable")
        sizes, rows = sizes[order], self.ending_rows[order]
        last = self.begins[ended][order] + sizes
        found_place, found_first = [], []
        for step in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            alive = int(np.searchsorted(-sizes, -step, side="right"))
            place = last[:alive] - step
            reached = self._step(rows[:alive], self.text[place])
            rows = self.class_row[reached]
            found_place.append(place)
            found_first.append(self.class_place[reached])
        if not found_place:
            return np.array([], np.int64), np.array([], np.int64)
        return np.concatenate(found_place), np.concatenate(found_first)

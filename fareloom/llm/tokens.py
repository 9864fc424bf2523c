"""Whole texts to ids with the tokenizers library, remembering the ids of words seen before.

Both kinds of tokenizer here never merge across the start of white space, so a text's ids are those of its pieces, cut
before each run of white space, one after the other. Natural text repeats its words; the library is asked for
each once.
"""

import os
import re
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Unicode white space, which the tokenizers' patterns call \s; Python's own \s also has the separators 1C to 1F.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_WORDS = re.compile(f"[^{_SPACE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Remembered pieces in a Python worker; beyond that it forgets all and starts again.
MOST_REMEMBERED = 1_200_000
#: Words of letters below this are units of both kinds of tokenizer, whatever follows them.
_LETTERS_BELOW = "\u0130"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: The characters that stand for bytes in such vocabularies: printable Latin-1 for itself, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STANDS_FOR = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class _Remembered(dict):
    """Ids of a piece, as bytes; ``prefix`` goes in front of a key that does not start with a line end.

    When there are ``most`` pieces all are forgotten; with a smaller ``most`` than ``MOST_REMEMBERED`` they become the ``former``
    ones, in place of those. A former piece that is met again is remembered anew, so frequent pieces stay.
    """

    def __init__(self, tokenizer: Tokenizer, prefix: str, code: str, lower: bool, most: int) -> None:
        super().__init__()
        self.tokenizer, self.merged, self.code, self.lower = tokenizer, tokenizer.model.tokenize, code, lower
        self.prefix, self.shown_prefix = prefix, prefix.translate(_STANDS_FOR)
        self.marks: dict[str, bytes] = {"": b""}
        self.most, self.former = most, {}

    def _letters(self, word: str) -> bytes:
        """Ids of a word of letters: one unit, so the library's merges alone decide."""
        if self.lower:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_STANDS_FOR)
        return array(self.code, [token.id for token in self.merged(self.shown_prefix + word)]).tobytes()

    def _any(self, piece: str) -> bytes:
        return array(self.code, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def __missing__(self, key: str) -> bytes:
        ids = self.former.get(key)
        if ids is None:
            ids = self._ids(key)
        if len(self) + len(self.marks) >= self.most:
            self.former = dict(self) if self.most < MOST_REMEMBERED else {}
            self.clear()
            self.marks = {"": b""}
        self[key] = ids
        return ids

    def _ids(self, key: str) -> bytes:
        word = key.rstrip(_MARKS)
        if word.isalpha() and max(word) < _LETTERS_BELOW:
            # Marks behind a word are a unit of their own.
            marks = key[len(word) :]
            if marks not in self.marks:
                self.marks[marks] = self._any(marks)
            return self._letters(word) + self.marks[marks]
        return self._any(key if key.startswith("\n") else self.prefix + key)


class WordTokenizer:
    """A tokenizer file; ``drops_spaces`` if it lowers letters and its ids do not depend on white space.

    ``special_tokens``: special tokens' strings in a text get their one id, as by the library's plain call; otherwise they
    are ordinary text. ``most``: pieces that each of two dictionaries remembers.
    """

    def __init__(self, path: str, drops_spaces: bool, special_tokens: bool = False, most: int = MOST_REMEMBERED) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        self.size = self.tokenizer.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.drops_spaces = drops_spaces
        code = "H" if self.kind == "<u2" else "I"
        self.plain = _Remembered(self.tokenizer, "", code, drops_spaces, most)
        self.spaced = _Remembered(self.tokenizer, " ", code, drops_spaces, most)

    def encode(self, text: str) -> np.ndarray:
        """The ids of the text, without special tokens around it."""
        if self.drops_spaces:
            words = _WORDS.findall(text) if _SEPARATORS.search(text) else text.split()
            return np.frombuffer(b"".join(map(self.plain.__getitem__, words)), self.kind)
        if text and text.replace("\n", " ") == " ".join(text.split()):
            # Only single spaces and line ends: each word but the first has one before it.
            first, *rest = text.replace("\n", " \n").split(" ")
            ids = self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))
        else:
            ids = b"".join(map(self.plain.__getitem__, _PIECES.findall(text)))
        return np.frombuffer(ids, self.kind)


_LOADED: dict[tuple[str, bool, bool, int], WordTokenizer] = {}


def word_tokenizer(path: str, drops_spaces: bool, special_tokens: bool = False, most: int = MOST_REMEMBERED) -> WordTokenizer:
    """The tokenizer of a file, loaded once in each Python worker."""
    key = (path, drops_spaces, special_tokens, most)
    if key not in _LOADED:
        _LOADED[key] = WordTokenizer(*key)
    return _LOADED[key]

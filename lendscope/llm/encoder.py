"""Whole-text encoding inside tasks with a byte-level vocabulary of the tokenizers library.

The pre-tokenizer of such a vocabulary cuts a text by a fixed pattern, and merges happen
inside each match only, so a match has the same ids wherever it stands. A worker asks the
library's model for a match once and keeps the ids of the first `KEPT` it meets (frequent
ones come early); which are kept changes no result.

Most texts hold no two white-space characters in a row. A cut before a space or line end
then never falls inside a match, so such texts are looked up by whole blank-separated
parts; all other texts go match by match.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import regex

SLICE_CHARS = 1 << 20      # longer texts are matched in slices of about this many characters
KEPT = 1_000_000           # bound of the matches, and of the parts, whose ids a worker keeps
KEPT_CHARS = 48            # longer ones are not kept

_WORDS = regex.compile(public_tokenizers.PATTERN)
_CUT = regex.compile(r"\S\s")
_TWO_BLANKS = re.compile(r"\s\s")


def slices(text: str, limit: int = SLICE_CHARS) -> Iterator[str]:
    """Parts of a text whose matches are those of the whole text: a cut between a
    non-space and a space never falls inside a match, and no match looks back."""
    at = 0
    while len(text) - at > limit:
        found = _CUT.search(text, at + limit)
        if not found:
            break
        yield text[at:found.start() + 1]
        at = found.start() + 1
    yield text[at:] if at else text


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Kept(dict):
    """Ids by key; a missing key is computed, and kept while there is room."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key: str) -> bytes:
        ids = self.compute(key)
        if len(self) < KEPT and len(key) <= KEPT_CHARS:
            self[key] = ids
        return ids


class Encoder:
    """`encode(texts)` gives for each text its ids as little-endian bytes of `dtype`.
    Strings of special tokens in a text are ordinary text."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(vocabulary)
        size = library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.letters = byte_letters()
        self.bytes_of = [np.array([i], self.dtype).tobytes() for i in range(size)]
        self.tokenize = library.model.tokenize
        self.library = library                       # owns the model
        self.matches = _Kept(self._match)
        self.parts = _Kept(self._part)

    def _match(self, word: str) -> bytes:
        found = self.tokenize(word.encode().decode("latin-1").translate(self.letters))
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in found])

    def _part(self, part: str) -> bytes:
        """A part is what stands between blanks; its blank belongs to it, a line end too.
        Letters alone, or with a comma or stop behind, need no pattern to be cut."""
        if part.isalpha():
            return self.matches[" " + part]
        if part[-1:] in (",", ".") and part[:-1].isalpha():
            return self.matches[" " + part[:-1]] + self.matches[part[-1]]
        return self.by_matches(part if part[:1] == "\n" else " " + part)

    def by_matches(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, _WORDS.findall(text)))

    def one(self, text: str) -> bytes:
        if len(text) > SLICE_CHARS:
            return b"".join(map(self.by_matches, slices(text)))
        if _TWO_BLANKS.search(text):
            return self.by_matches(text)
        parts = iter(text.replace("\n", " \n").split(" "))
        return self.by_matches(next(parts)) + b"".join(map(self.parts.__getitem__, parts))

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(self.one, texts))


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(vocabulary)

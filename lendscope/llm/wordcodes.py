"""Words of whole texts as codes, vectorised over a batch of texts.

Words are maximal runs of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return. A word has two codes, the halves of a 128-bit digest of its bytes
(XXH3). The code of a run of words joins codes of shorter runs by a non-linear mixer, by
powers of two: no sum over places, so no structure of a text makes different runs equal.
Equal words and runs have equal codes; unequal ones share one with a probability of about
2^-64 for each of the two independent codes.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + np.uint64((0x632BE59BD9B4E019 * (salt + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word in a buffer of bytes."""
    edge = np.ones(len(text) + 2, bool)
    edge[1:-1] = _BLANK[text]
    at = np.flatnonzero(edge[1:] != edge[:-1])
    return at[::2], at[1::2]


def word_codes(text: np.ndarray, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The two codes of every word in a buffer of bytes, in order; digests are taken in blocks."""
    raw, digest = text.tobytes(), xxhash.xxh3_128_digest
    out, at = [], 0
    while at < len(raw):
        last = at + block
        while last < len(raw) and not _BLANK[raw[last]]:
            last += 1
        out.append(b"".join(map(digest, raw[at:last].split())))      # bytes.split cuts at these six blanks
        at = last
    codes = np.frombuffer(b"".join(out), "<u8").reshape(-1, 2)
    return np.ascontiguousarray(codes[:, 0]), np.ascontiguousarray(codes[:, 1])


def _joined(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    return mixed(left * np.uint64(0xA0761D6478BD642F) + right, salt)


def window_codes(words: np.ndarray, size: int, salt: int = 0, block: int = 1 << 16) -> np.ndarray:
    """Code of words[i:i+size] for every i at which it fits."""
    n = len(words) - size + 1
    out = [np.zeros(0, np.uint64)]
    for first in range(0, max(n, 0), block):
        last = min(n, first + block)
        run, width, count = mixed(words[first:last + size - 1], salt + 7), 1, last - first
        whole, have = None, 0                                        # runs of `have` words: the low bits of `size`
        while True:
            if size & width:
                whole = run[:count] if whole is None else _joined(whole, run[have:have + count], salt + 8)
                have += width
            if have == size:
                break
            run = _joined(run[:-width], run[width:], salt + width)
            width *= 2
        out.append(mixed(whole, salt))
    return np.concatenate(out)


def texts_as_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, word begins, word ends, first word of each text and the total)."""
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_spans(joined)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return joined, starts, ends, np.searchsorted(starts, at)

"""Compact columns for numbers that travel by the million inside one row."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(array: np.ndarray, level: int = 1) -> bytes:
    """zstd over the array's byte planes: the high bytes of small numbers stand together."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(codes: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(codes.astype(np.uint64), prepend=np.uint64(0)).astype("<u8"))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def pack_words(words: list[bytes]) -> bytes:
    """Number of words, their lengths, their bytes."""
    sizes = np.fromiter(map(len, words), "<u4", len(words)).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(np.uint32(len(words)).tobytes() + sizes + b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    at = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 * (n + 1)
    ends = at.tolist()
    return [raw[a:b] for a, b in zip([4 * (n + 1), *ends[:-1]], ends)]

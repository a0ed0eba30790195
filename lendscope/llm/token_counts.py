"""Token counts of sections, from one encoding of the whole document.

Encoding a section by itself counts other tokens than the document has, so each document
is encoded once; its tokens' spans tile its UTF-8 bytes, and the sections' character spans
are laid over them. Both are ascending, so the interval join is two binary searches per
section. A token that crosses a section's bound is allocated by an explicit rule:

    start   to the section that holds its first byte
    middle  to the one that holds its middle byte (the earlier of two)
    end     to the one that holds its last byte
    split   in proportion to its bytes

Under each of them, sections that tile a text get exactly the document's tokens in sum.
Lengths are taken in bytes, as a token may end inside a character.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, table, text_or_empty
from .encoder import encoder

RULES = ("start", "middle", "end", "split")


def lines(text: str) -> list[tuple[int, int]]:
    """Character spans of a text's lines, each with its line end; an empty text is one empty line."""
    ends = [i + 1 for i, c in enumerate(text) if c == "\n"] if "\n" in text else []
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends[:-1]], ends, strict=True))


@functools.lru_cache(maxsize=2)
def token_sizes(vocabulary: str) -> np.ndarray:
    """Bytes of every token: byte-level vocabularies write one letter per byte."""
    words = encoder(vocabulary).library.get_vocab(with_added_tokens=False)
    sizes = np.zeros(max(words.values()) + 1, np.int64)
    for word, token in words.items():
        sizes[token] = len(word)
    return sizes


def tokens_before(at: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens that the rule puts before each byte position; `ends` are the tokens' ends."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    if rule == "start":
        return np.searchsorted(starts, at, side="left")
    if rule == "end":
        return np.searchsorted(ends, at, side="right")
    if rule == "middle":
        return np.searchsorted((starts + ends - 1) // 2, at, side="left")
    whole = np.searchsorted(ends, at, side="right")
    inside = np.minimum(whole, max(len(ends) - 1, 0))
    part = np.where(whole < len(ends), (at - starts[inside]) / np.maximum(1, ends[inside] - starts[inside]), 0.0) if len(ends) else 0.0
    return whole + part


def crossing(at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of the token that each position lies inside of, or -1."""
    token = np.searchsorted(ends, at, side="left")
    starts = np.concatenate([[0], ends])[token]
    return np.where((starts < at) & (token < len(ends)) & (at != np.concatenate([ends, [0]])[token]), token, -1)


def section_counts(ids: np.ndarray, raw: bytes, spans: list[tuple[int, int]], sizes: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section (half-open spans in characters)."""
    ends = np.cumsum(sizes[ids])
    # Byte position of each character: where a byte is no continuation byte.
    heads = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    place = np.append(heads, len(raw))
    bounds = place[np.clip(np.array(spans, np.int64).reshape(-1, 2), 0, len(heads))]
    counts = tokens_before(bounds[:, 1], ends, rule) - tokens_before(bounds[:, 0], ends, rule)
    cut = crossing(bounds.ravel(), ends).reshape(-1, 2)
    both = (cut >= 0).sum(axis=1) - ((cut[:, 0] >= 0) & (cut[:, 0] == cut[:, 1]))
    return counts, both


def token_counts(docs: DataFrame, vocabulary: str, rule: str = "start", id_col: str = "doc_id", text_col: str = "text",
                 sections: Callable[[str], list[tuple[int, int]]] = lines) -> DataFrame:
    """One row per section: id, section (from 0), begin, end (characters), n_tokens, n_crossing.

    `sections` gives a text's spans, which may leave gaps or overlap. n_tokens is a double
    under "split", else a long. Null texts count as empty. Null and repeated ids are carried
    along; every row's sections are counted for themselves. An empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    kind, spark_kind = (pa.float64(), "double") if rule == "split" else (pa.int64(), "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sizes = encoder(vocabulary), token_sizes(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                of, number, begin, end, n, across = [], [], [], [], [], []
                for i, text in enumerate(part["text"].to_pylist()):
                    spans = sections(text)
                    if not spans:
                        continue
                    counts, both = section_counts(np.frombuffer(enc.one(text), enc.dtype), text.encode(), spans, sizes, rule)
                    of += [i] * len(spans)
                    number += range(len(spans))
                    begin += [a for a, _ in spans]
                    end += [b for _, b in spans]
                    n += counts.tolist()
                    across += both.tolist()
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(pa.array(of, pa.int64())), pa.array(number, pa.int32()), pa.array(begin, pa.int64()),
                     pa.array(end, pa.int64()), pa.array(n, kind), pa.array(across, pa.int64())],
                    ["id", "section", "begin", "end", "n_tokens", "n_crossing"])

    schema = f"id {id_type}, section int, begin long, end long, n_tokens {spark_kind}, n_crossing long"
    return map_batches(src, count, schema).withColumnRenamed("id", id_col)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, counted where they start."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op2_token_counts": (op2_token_counts, None)}

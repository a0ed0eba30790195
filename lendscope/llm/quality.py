"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms of a text, read from the bytes of the whole text: its style (trigrams of character
classes: lower, upper, digit, space, line end, every punctuation mark, beyond ASCII; word
lengths joined with whether a word repeats the one before) and its words, hashed by their
letters in order without regard to the case of A-Z. Language, source and ids take no part. A bounded, documented sample of labelled
rows (`sample`, the smallest id hashes; the contract's held-out fold never enters) gives
the term weights, the latent space (truncated SVD of the weighted, normalised rows) and
the labelled vectors: sample x dims floats, broadcast. Every document then gets its exact
cosines against all labelled vectors, in blocks, and the labels of its `neighbours` most
similar ones vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, table, text_or_empty

STYLE, WORDS = 3075, 2048
TERMS = STYLE + WORDS
BLOCK = 1 << 20      # bytes of text looked at together


def _classes() -> np.ndarray:
    out = np.zeros(256, np.int64)                                   # 0: control characters
    out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1] = 1, 2
    out[ord("0"):ord("9") + 1], out[128:], out[32], out[9] = 3, 4, 5, 5
    out[10] = out[13] = 6
    marks = [c for c in range(33, 127) if out[c] == 0]
    out[marks] = 7 + np.arange(len(marks))
    return out


_CLASS = _classes()
_WIDTH = 40
_LETTER = np.random.default_rng(7).integers(1, 1 << 44, 256)


_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_PLACE = np.random.default_rng(9).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _blocks(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(the two bytes before, block): a block ends with a word, so memory is bounded for long
    texts (by a word's size where a word is longer than a block) and no word is cut."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and _CLASS[text[end]] not in (5, 6):
            end += 1
        yield text[max(at - 2, 0):at], text[at:end]
        at = end


def term_counts(text: bytes) -> np.ndarray:
    """Counts of the hashed terms of one whole text, whatever its length."""
    counts = np.zeros(TERMS, np.int64)
    last, n_words, n_same, distinct = None, 0, 0, []
    for before, block in _blocks(text):
        raw = np.frombuffer(before + block, np.uint8)
        c = _CLASS[raw]
        if len(c) >= 3:
            gram = (c[:-2] * _WIDTH + c[1:-1]) * _WIDTH + c[2:]
            counts[:2048] += np.bincount((gram * 2654435761 >> 7) & 2047, minlength=2048)
        raw, c = raw[len(before):], c[len(before):]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], (c == 5) | (c == 6), [True]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        if not len(start):
            continue
        sums = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        bag = sums[end] - sums[start]                               # one number per bag of bytes
        begins = np.zeros(len(raw), np.int64)
        begins[start] = start
        place = np.arange(len(raw)) - np.maximum.accumulate(begins)
        code = np.concatenate([[np.uint64(0)], np.cumsum(_LETTER.astype(np.uint64)[_LOWER[raw]] * _PLACE[place & 63], dtype=np.uint64)])
        counts[STYLE:] += np.bincount(((code[end] - code[start]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(53)).astype(np.int64), minlength=WORDS)
        word = bag if last is None else np.append(last, bag)
        same = word[1:] == word[:-1]
        size, first = (end - start)[len(bag) - len(same):], c[start][len(bag) - len(same):]
        counts[2048:3072] += np.bincount((np.minimum(size, 15) * 2 + same) * 8 + np.minimum(first, 7), minlength=1024)[:1024]
        last, n_words, n_same = bag[-1], n_words + len(bag), n_same + int(same.sum())
        distinct.append(np.unique(bag))
    if n_words > 1:
        counts[3072:STYLE] = 4 * n_same, n_words, len(np.unique(np.concatenate(distinct)))
    return counts


def term_weights(counts: np.ndarray) -> np.ndarray:
    """Square roots of the terms' shares of the text: length takes no part. Style terms of
    whole words count double, as they are far fewer than the trigrams; the words themselves
    count a quarter, so that they decide between texts of one style."""
    row = np.sqrt(counts / max(1, counts[:2048].sum())).astype(np.float32)
    row[2048:STYLE] *= 2
    row[STYLE:] *= 0.25
    return row


@dataclass
class Model:
    weight: np.ndarray        # per term
    mean: np.ndarray          # of the weighted rows
    axes: np.ndarray          # terms x dims
    vectors: np.ndarray       # labelled rows, unit length
    labels: np.ndarray
    neighbours: int

    def latent(self, rows: np.ndarray) -> np.ndarray:
        z = rows * self.weight
        z -= self.mean
        z = z @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Similarity-weighted vote in [0, 1]; a text without terms gets the labels' mean,
        an empty model 0.5."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        base = float(self.labels.mean())
        cosine = (self.latent(rows) @ self.vectors.T).astype(np.float64)
        # Rounded, then the earlier labelled row first: the choice among equals is fixed.
        cosine = np.round(cosine, 5) - np.arange(len(self.labels)) * 1e-10
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0)
        total = vote.sum(axis=1)
        mean = (vote * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        blank = ~rows.any(axis=1) | (total <= 0)
        return np.clip(np.where(blank, base, mean), 0.0, 1.0)


def fit(rows: np.ndarray, labels: np.ndarray, dims: int, neighbours: int) -> Model:
    """Term weights, latent axes by subspace iteration (truncated SVD), labelled vectors."""
    if not len(rows):
        zero = np.zeros(TERMS, np.float32)
        return Model(zero, zero, np.zeros((TERMS, dims), np.float32), np.zeros((0, dims), np.float32), labels, neighbours)
    weight = (np.log((len(rows) + 1) / ((rows > 0).sum(axis=0) + 1)) + 1).astype(np.float32)
    z = rows * weight                          # the only other matrix of this size: the driver's memory is small
    mean = z.mean(axis=0)
    z -= mean
    for at in range(0, len(z), 256):
        z[at:at + 256] /= np.maximum(np.linalg.norm(z[at:at + 256], axis=1, keepdims=True), 1e-9)
    axes = np.random.default_rng(11).standard_normal((TERMS, dims + 8)).astype(np.float32)
    for _ in range(8):
        axes = np.linalg.qr(z.T @ (z @ axes))[0]
    small = np.linalg.svd(z @ axes, full_matrices=False)[2]
    del z
    model = Model(weight, mean, (axes @ small.T)[:, :dims], np.zeros((0, dims), np.float32), labels, neighbours)
    model.vectors = model.latent(rows)
    return model


def sparse_terms(text: str) -> tuple[bytes, bytes]:
    row = term_weights(term_counts(text.encode()))
    at = np.flatnonzero(row)
    return at.astype("<u2").tobytes(), row[at].tobytes()


def fit_on_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample: int = 4096, dims: int = 32,
                  neighbours: int = 7, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most `sample` labelled rows outside the held-out fold, those with the
    smallest hashes of their id. Several labels of an id count by their mean, null labels
    not at all; of several texts of an id the greatest is taken."""
    chosen = (only(labels, id_col, label_col).filter(F.col(label_col).isNotNull() & ~held_out(id_col))
              .groupBy(id_col).agg(F.avg(label_col).alias("label"))
              .orderBy(F.xxhash64(id_col), id_col).limit(sample))
    texts = (only(docs, id_col, text_col).join(F.broadcast(chosen), id_col)       # at most `sample` rows
             .groupBy(id_col, "label").agg(F.max(text_or_empty(text_col)).alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value = zip(*map(sparse_terms, batch["text"].to_pylist()), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array(at, pa.binary()), pa.array(value, pa.binary())],
                                             ["id", "label", "at", "value"])

    got = map_batches(texts.select(F.xxhash64(id_col).alias("id"), F.col("label").cast("double").alias("label"), "text"),
                      count, "id long, label double, at binary, value binary").collect()
    got.sort(key=lambda r: (r["id"], r["label"]))
    rows = np.zeros((len(got), TERMS), np.float32)
    for i, r in enumerate(got):
        rows[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["value"], np.float32)
    marks = np.array([r["label"] for r in got])
    del got
    return fit(rows, marks, dims, neighbours)


def held_out(id_col: str = "doc_id"):
    """True for the fold that never trains; a null id belongs to it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def classify(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """`docs` with `score` and `predicted` (1 if score >= threshold) appended; null texts
    count as empty, columns of these names are replaced, every other column stays."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    src = only(docs, *kept).withColumn("_text", text_or_empty(text_col))
    fitted = docs.sparkSession.sparkContext.broadcast(model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows = np.stack([term_weights(term_counts(t.encode())) for t in part["_text"].to_pylist()])
                score = fitted.value.score(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in kept], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    [*kept, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name in kept)
    return map_batches(src, vote, schema + ", score double, predicted int")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on_sample(docs, table(spark, sf_dir, "labels"), "quality")
    scored = classify(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op5_quality_classifier": (op5_quality_classifier, None)}

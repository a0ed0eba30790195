"""Substring dedup: fixed-block anchors.

A word is removed if it lies in a window of `window` words whose sequence also starts
elsewhere. The steps:

1. Index and probe. Blocks of `block` = (window + 1) / 2 words at every multiple of `block`
   are the reference index; every window holds one whole such block. Every rolling window
   of `block` words probes it: a place whose sequence is also a reference block at another
   place is a hit. Any repeat of `window` words makes hits at both of its places.
2. Extend. Around a hit lie the windows that hold it. A window whose sequence a second
   place has as well, is a repeat; repeats next to each other join to the maximal ones.
3. Remove the words that repeats cover, judged on the input.

Both look-ups send, for each chunk of documents (about `chunk_bytes`), its distinct codes
once to buckets of the code's range, and get back which of them count. A passage that a
third of all documents share is so one code per chunk, never one per document, and no
pairs are formed. Probe codes keep 48 bits, as a chance hit only costs a check in step 2;
there 96 bits decide, of two codes that share nothing: a word has two independent ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, ship_package, table, text_or_empty
from .packed import pack, pack_sorted, unpack, unpack_sorted
from .wordcodes import texts_as_words, window_codes, word_codes

FIRST, AGAIN = np.uint8(1), np.uint8(2)          # marks: is a reference block; stands in the chunk twice


def chunks_of(docs: DataFrame, chunk_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, texts): documents in the order of the scan, about `chunk_bytes` a row."""
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, size = TaskContext.get().partitionId(), 0, 0
        held: list[pa.RecordBatch] = []

        def row() -> pa.RecordBatch:
            nonlocal made, size
            ids = pa.concat_arrays([b["id"] for b in held])
            texts = pa.concat_arrays([b["text"] for b in held])
            out = pa.RecordBatch.from_arrays([pa.array([(task << 32) + made]), pa.ListArray.from_arrays([0, len(ids)], ids),
                                              pa.ListArray.from_arrays([0, len(texts)], texts)], ["chunk", "ids", "texts"])
            held.clear()
            made, size = made + 1, 0
            return out

        for batch in batches:
            ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:
                before = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + chunk_bytes - size, side="right")))
                last = min(last, batch.num_rows)
                held.append(batch.slice(first, last - first))
                size += int(ends[last - 1]) - before
                first = last
                if size >= chunk_bytes or first < batch.num_rows:
                    yield row()
        if held:
            yield row()

    return map_batches(src, gather, f"chunk long, ids array<{id_type}>, texts array<string>")


class Words:
    """The words of a chunk's documents as codes."""

    def __init__(self, texts: list[str]):
        self.bytes, self.starts, self.ends, self.first = texts_as_words([t.encode() for t in texts])
        self.codes, self.others = word_codes(self.bytes)

    def windows(self, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(places, codes) of the windows that lie in one document."""
        n = len(self.codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        inside = np.zeros(len(self.codes) + 1, np.int32)
        ends = self.first[1:] - size + 1
        fits = ends > self.first[:-1]
        np.add.at(inside, self.first[:-1][fits], 1)
        np.add.at(inside, ends[fits], -1)
        place = np.flatnonzero(np.cumsum(inside)[:n] > 0)
        return place, window_codes(self.codes, size, salt)[place]

    def aligned(self, places: np.ndarray, size: int) -> np.ndarray:
        """Which places are a multiple of `size` from their document's begin."""
        doc = np.searchsorted(self.first, places, side="right") - 1
        return (places - self.first[doc]) % size == 0


def _ranges(codes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bounds in the ascending `codes` of the buckets' equal code ranges."""
    limits = [(b << bits) // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(codes, np.array(limits, np.uint64)), [len(codes)]])


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                    chunk_bytes: int = 1 << 22, bucket_bytes: int = 1 << 24, whole_as_is: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (the text of the kept words joined
    by one space; with `whole_as_is`, a text that loses no word stays as it is).
    The id may be a struct, which carries further columns along.

    `docs` should be a stored table: a chunk that is computed again after an executor was
    lost must hold the same rows in the same order.

    `window` is odd. A null text has no words; texts under `window` words keep all of theirs.
    Repeated rows are documents of their own, so all of their windows repeat and none of them
    keeps those. An empty table gives an empty result. A bucket of step 1 takes the codes of
    about `bucket_bytes` of text, so the number of buckets grows with the input.
    """
    if window % 2 == 0:
        raise ValueError("window must be odd")
    block = (window + 1) // 2
    ship_package(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    chunks = chunks_of(docs, chunk_bytes, id_col, text_col)
    id_type = chunks.schema["ids"].dataType.elementType.simpleString()

    # Step 1: which blocks of a chunk are hits.
    def probes(rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("bucket", "chunk", "codes", "marks")}
        for row in rows.select(["chunk", "texts"]).to_pylist():
            words = Words(row["texts"])
            place, code = words.windows(block)
            code >>= np.uint64(16)
            distinct, count = np.unique(code, return_counts=True)
            marks = np.where(count > 1, AGAIN, np.uint8(0)).astype(np.uint8)
            marks[np.searchsorted(distinct, code[words.aligned(place, block)])] |= FIRST
            bounds = _ranges(distinct, 48, buckets)
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                mine = slice(bounds[b], bounds[b + 1])
                out["bucket"].append(b)
                out["chunk"].append(row["chunk"])
                out["codes"].append(pack_sorted(distinct[mine]))
                out["marks"].append(pack(marks[mine]))
        return pa.table(out, schema=pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary()), ("marks", pa.binary())]))

    def hits(rows: pa.Table) -> pa.Table:
        chunk = rows["chunk"].to_pylist()
        codes = [unpack_sorted(x) for x in rows["codes"].to_pylist()]
        marks = np.concatenate([unpack(x, np.uint8) for x in rows["marks"].to_pylist()])
        at = np.cumsum([0, *map(len, codes)])
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        held = np.bitwise_or.reduceat(marks[order], first)
        count = np.diff(first, append=len(flat))
        hit = np.zeros(len(flat), bool)
        hit[order] = np.repeat((held & FIRST > 0) & ((count > 1) | (held & AGAIN > 0)), count)
        found = [c[hit[a:b]] for c, a, b in zip(codes, at[:-1], at[1:], strict=True)]
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "hits": pa.array([pack_sorted(x) for x in found], pa.binary())}) \
            .filter(pa.array([len(x) > 0 for x in found]))

    # Step 2: the windows that hold a hit, once per chunk; which of them repeat.
    def around(key, rows: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("bucket", "chunk", "codes", "checks", "places", "marks")}
        if rows.num_rows and found.num_rows:
            words = Words(rows["texts"].to_pylist()[0])
            place, code = words.windows(block)
            known = np.sort(np.concatenate([unpack_sorted(x) for x in found["hits"].to_pylist()]))
            hit = place[_among(code >> np.uint64(16), known)]
            near = np.zeros(len(words.codes) + 2, np.int32)     # windows at hit - (block - 1) .. hit
            np.add.at(near, np.maximum(hit - (window - block), 0), 1)
            np.add.at(near, hit + 1, -1)
            near = np.cumsum(near) > 0
            place, code = words.windows(window, salt=1)
            picked = near[place]
            place, code = place[picked], code[picked]
            check = (window_codes(words.others, window, salt=2)[place] >> np.uint64(32)).astype("<u4") if len(place) else np.zeros(0, "<u4")
            order = np.lexsort((check, code))
            place, code, check = place[order], code[order], check[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (check[1:] != check[:-1])
            at = np.flatnonzero(new)
            marks = np.where(np.diff(at, append=len(code)) > 1, AGAIN, np.uint8(0)).astype(np.uint8)
            place, code, check = place[at], code[at], check[at]
            bounds = _ranges(code, 64, buckets)
            chunk = rows["chunk"][0].as_py()
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                mine = slice(bounds[b], bounds[b + 1])
                for name, value in (("bucket", b), ("chunk", chunk), ("codes", pack_sorted(code[mine])), ("checks", pack(check[mine])),
                                    ("places", pack(place[mine].astype("<u4"))), ("marks", pack(marks[mine]))):
                    out[name].append(value)
        return pa.table(out, schema=pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary()),
                                               ("checks", pa.binary()), ("places", pa.binary()), ("marks", pa.binary())]))

    def repeats(rows: pa.Table) -> pa.Table:
        def whole(name: str, dtype) -> list[np.ndarray]:
            return [unpack(x, dtype) for x in rows[name].to_pylist()]

        codes = [unpack_sorted(x) for x in rows["codes"].to_pylist()]
        at = np.cumsum([0, *map(len, codes)])
        code, check = np.concatenate(codes), np.concatenate(whole("checks", "<u4"))
        marks, places = np.concatenate(whole("marks", np.uint8)), np.concatenate(whole("places", "<u4"))
        order = np.lexsort((check, code))
        code, check = code[order], check[order]
        same = (code[1:] == code[:-1]) & (check[1:] == check[:-1])
        repeat = np.zeros(len(order), bool)
        repeat[order[1:]] |= same
        repeat[order[:-1]] |= same
        repeat |= marks & AGAIN > 0
        found = [np.sort(places[a:b][repeat[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.table({"chunk": rows["chunk"], "places": pa.array([pack_sorted(x.astype(np.uint64)) for x in found], pa.binary())}) \
            .filter(pa.array([len(x) > 0 for x in found]))

    # Step 3: remove the words that repeats cover.
    def remove(key, rows: pa.Table, found: pa.Table) -> pa.Table:
        ids, n_words, n_removed, kept = [], [], [], []
        for row in rows.to_pylist():
            words = Words(row["texts"])
            gone = np.zeros(len(words.codes), bool)
            if found.num_rows:
                place, code = words.windows(window, salt=1)
                shown = np.concatenate([unpack_sorted(x) for x in found["places"].to_pylist()]).astype(np.int64)
                known = np.sort(code[np.searchsorted(place, shown)])
                start = place[_among(code, known)]
                cover = np.zeros(len(gone) + 1, np.int32)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
            ids += row["ids"]
            raw = words.bytes.tobytes()
            for text, a, b in zip(row["texts"], words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                stay = np.flatnonzero(~gone[a:b]) + a
                n_words.append(b - a)
                n_removed.append(b - a - len(stay))
                if whole_as_is and not n_removed[-1]:
                    kept.append(text.encode())
                    continue
                begins, ends = words.starts[stay].tolist(), words.ends[stay].tolist()
                kept.append(b" ".join([raw[x:y] for x, y in zip(begins, ends, strict=True)]))
        kind = rows.schema.field("ids").type.value_type
        return pa.table({"id": pa.array(ids, kind), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    dealt = "bucket long, chunk long, codes binary, marks binary"
    found = (chunks.groupBy("chunk").applyInArrow(probes, dealt)
             .groupBy("bucket").applyInArrow(hits, "chunk long, hits binary"))
    asked = chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        around, "bucket long, chunk long, codes binary, checks binary, places binary, marks binary")
    answer = asked.groupBy("bucket").applyInArrow(repeats, "chunk long, places binary")
    return (chunks.groupBy("chunk").cogroup(answer.groupBy("chunk"))
            .applyInArrow(remove, f"id {id_type}, n_words long, n_removed long, kept string")
            .withColumnRenamed("id", id_col))


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values occur in the ascending array."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    return ascending[np.minimum(at, len(ascending) - 1)] == values


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS h FROM s),
r AS (SELECT doc_id, p FROM k QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (SELECT DISTINCT r.doc_id, r.p + o.i AS p FROM r, (SELECT range AS i FROM range(35)) o),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op6_substring_dedup": (op6_substring_dedup, OP6_SQL)}

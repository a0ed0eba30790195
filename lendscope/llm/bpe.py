"""Byte-level BPE by a global distinct-word shuffle, and decoding by the token-byte table.

1. Chunks. Each task explodes the pre-tokens (matches of the pattern) of its documents and
   numbers the distinct ones of a chunk of about `chunk_chars` of text. A chunk is one row:
   its documents, the word numbers in order of position, its words. Chunks are shuffled by
   their number once; both uses below read that same exchange.
2. Words. The chunks' words are dealt by hash to buckets, one for about `bucket_bytes` of text. A bucket
   holds all places of its words, at most one per chunk, so even the most frequent word of
   the corpus is a few bytes per chunk; each distinct word is encoded once, globally.
3. Back. The ids return to their chunks by chunk number, and every document's ids are put
   together by position.

Columns of numbers and words travel zstd-compressed, as Spark's row format would take
several times the room of the texts.

Decoding looks each id up in the table of token bytes, whose size is that of the vocabulary
file and not of the data; it is broadcast.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, ship_package, table, text_or_empty
from .encoder import slices
from .packed import pack, pack_sorted, pack_words, unpack, unpack_sorted, unpack_words

def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def word_encoder(ranks: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks),
                             special_tokens={}).encode_ordinary


class _Numbers(dict):
    """Numbers words in the order of their first place."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def chunk_documents(docs: DataFrame, pattern: str, chunk_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, counts, numbers, words): a row per chunk."""
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        task, made = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        counts: list[int] = []
        numbers: list[np.ndarray] = []
        known, size = _Numbers(), 0

        def row(kind: pa.DataType) -> pa.RecordBatch:
            nonlocal known, size, made
            held = pa.concat_arrays(ids) if ids else pa.array([], kind)
            out = pa.RecordBatch.from_arrays([
                pa.array([(task << 32) + made]), pa.ListArray.from_arrays([0, len(held)], held),
                pa.array([pack(np.array(counts, "<u4"))]),
                pa.array([pack(np.concatenate([*numbers, np.zeros(0, "<u4")]).astype("<u4"), level=3)]),
                pa.array([pack_words([w.encode() for w in known])])],
                ["chunk", "ids", "counts", "numbers", "words"])
            ids.clear(), counts.clear(), numbers.clear()
            known, size, made = _Numbers(), 0, made + 1
            return out

        for batch in batches:
            kind = batch.schema.field("id").type
            for i in range(batch.num_rows):
                text, count = batch["text"][i].as_py(), 0
                for part in slices(text):
                    words = find(part)
                    numbers.append(np.fromiter(map(known.__getitem__, words), "<u4", len(words)))
                    count += len(words)
                ids.append(batch["id"].slice(i, 1))
                counts.append(count)
                size += len(text)
                if size >= chunk_chars:
                    yield row(kind)
        if ids:
            yield row(kind)

    return map_batches(src, chunks, f"chunk long, ids array<{id_type}>, counts binary, numbers binary, words binary")


def encode_words(chunks: DataFrame, ranks: str, buckets: int) -> DataFrame:
    """(chunk, places, sizes, word_ids): ids of the words of each chunk, a row per bucket."""
    def deal(rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("bucket", "chunk", "places", "words")}
        for chunk, packed in zip(rows["chunk"].to_pylist(), rows["words"].to_pylist(), strict=True):
            words = unpack_words(packed)
            of = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(of, kind="stable")
            bounds = np.searchsorted(of[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                mine = order[bounds[b]:bounds[b + 1]]
                out["bucket"].append(b)
                out["chunk"].append(chunk)
                out["places"].append(pack_sorted(mine))
                out["words"].append(pack_words([words[i] for i in mine]))
        return pa.table(out, schema=pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("places", pa.binary()), ("words", pa.binary())]))

    def encode(rows: pa.Table) -> pa.Table:
        word_ids, known = word_encoder(ranks), {}
        sizes, ids = [], []
        for packed in rows["words"].to_pylist():
            of = []
            for word in unpack_words(packed):
                got = known.get(word)
                if got is None:
                    got = known[word] = np.array(word_ids(word.decode()), "<u4").tobytes()
                of.append(got)
            sizes.append(pack(np.fromiter((len(x) >> 2 for x in of), "<u4", len(of))))
            ids.append(pack(np.frombuffer(b"".join(of), "<u4")))
        return pa.table({"chunk": rows["chunk"], "places": rows["places"], "sizes": pa.array(sizes, pa.binary()),
                         "word_ids": pa.array(ids, pa.binary())})

    dealt = chunks.groupBy("chunk").applyInArrow(deal, "bucket long, chunk long, places binary, words binary")
    return dealt.groupBy("bucket").applyInArrow(encode, "chunk long, places binary, sizes binary, word_ids binary")


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0]+1, ..., then those of the next run: `size[i]` each."""
    ends = np.cumsum(size)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1])


def bpe_encode(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id",
               text_col: str = "text", chunk_chars: int = 1 << 23, bucket_bytes: int = 1 << 23,
               tokens: DataFrame | None = None) -> DataFrame:
    """(id, n_tokens, ids): ids of every whole text as little-endian unsigned 32-bit integers.
    With `tokens` (see `token_bytes`) also `decoded`, looked up from the ids in the same task:
    the round trip then needs no second Python worker beside the first.

    `docs` should be a stored table: a chunk that is computed again after an executor was
    lost must hold the same rows in the same order.

    One row per input row, so null and repeated ids stay; a null text counts as empty and
    has no ids; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    chunks = chunk_documents(docs, pattern, chunk_chars, id_col, text_col)
    id_type = chunks.schema["ids"].dataType.elementType

    shared = None if tokens is None else shared_token_table(tokens)

    def reassemble(key, chunk: pa.Table, words: pa.Table) -> pa.Table:
        row = chunk.select(["counts", "numbers"]).to_pylist()[0]
        numbers, counts = unpack(row["numbers"], "<u4"), unpack(row["counts"], "<u4").astype(np.int64)
        size, start = (np.zeros(int(numbers.max(initial=0)) + 1, np.int64) for _ in range(2))
        flat, at = [], 0
        for got in words.to_pylist():
            place, n = unpack_sorted(got["places"]), unpack(got["sizes"], "<u4").astype(np.int64)
            size[place], start[place] = n, at + np.cumsum(n) - n
            flat.append(unpack(got["word_ids"], "<u4"))
            at += len(flat[-1])
        flat = np.concatenate([*flat, np.zeros(0, "<u4")]).astype("<u4")
        ids, n_tokens, decoded, first = [], [], [], 0
        for count in counts.tolist():
            mine = numbers[first:first + count]
            first += count
            own = flat[spread(start[mine], size[mine])]
            n_tokens.append(len(own))
            ids.append(own.tobytes())
            if shared is not None:
                decoded.append(decode_ids(own, *shared.value))
        columns = [chunk["ids"].combine_chunks().flatten(), pa.array(n_tokens, pa.int64()), pa.array(ids, pa.binary())]
        if shared is not None:
            columns.append(pa.array(decoded, pa.binary()))
        return pa.table(columns, names=["id", "n_tokens", "ids", "decoded"][:len(columns)])

    back = encode_words(chunks, ranks, buckets).groupBy("chunk")
    return (chunks.groupBy("chunk").cogroup(back)
            .applyInArrow(reassemble, f"id {id_type.simpleString()}, n_tokens long, ids binary" + (", decoded binary" if tokens is not None else ""))
            .withColumnRenamed("id", id_col))


def token_bytes(spark: SparkSession, ranks: str) -> DataFrame:
    """The token-byte table (token, bytes) of a vocabulary file."""
    return spark.createDataFrame([(rank, bytearray(token)) for token, rank in read_ranks(ranks).items()], "token int, bytes binary")


def shared_token_table(tokens: DataFrame):
    """Broadcast (begin, size, bytes) of the token-byte table: as large as the vocabulary."""
    rows = sorted((r["token"], bytes(r["bytes"])) for r in tokens.collect())
    start, size = np.zeros(rows[-1][0] + 1, np.int64), np.full(rows[-1][0] + 1, -1, np.int64)
    at = 0
    for token, raw in rows:
        start[token], size[token] = at, len(raw)
        at += len(raw)
    letters = np.frombuffer(b"".join(raw for _, raw in rows), np.uint8)
    return tokens.sparkSession.sparkContext.broadcast((start, size, letters))


def decode_ids(ids: np.ndarray, start: np.ndarray, size: np.ndarray, letters: np.ndarray) -> bytes:
    parts = []
    for at in range(0, len(ids), 1 << 18):                                   # bounded memory for long texts
        of = ids[at:at + (1 << 18)]
        if of.max() >= len(size) or size[of].min() < 0:
            raise ValueError("an id is missing from the token-byte table")
        parts.append(letters[spread(start[of], size[of])].tobytes())
    return b"".join(parts)


def bpe_decode(encoded: DataFrame, tokens: DataFrame, ids_col: str = "ids") -> DataFrame:
    """`encoded` with `decoded` (bytes) appended. `tokens` holds a row per token of the
    vocabulary; null ids decode to null, an id that the table lacks is an error."""
    shared = shared_token_table(tokens)
    kept = [c for c in encoded.columns if c != "decoded"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                out = [decode_ids(np.frombuffer(raw.as_buffer(), "<u4"), *shared.value) if raw.is_valid else None for raw in rows[ids_col]]
                yield pa.RecordBatch.from_arrays([*[rows[c] for c in kept], pa.array(out, pa.binary())], [*kept, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in kept)
    return map_batches(only(encoded, *kept), look_up, schema + ", decoded binary")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_encode(table(spark, sf_dir, "documents"), ranks, tokens=token_bytes(spark, ranks)).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op1_bpe": (op1_bpe, None)}

"""Token-id output with keyed access.

Documents are range-partitioned by key, sorted, encoded and written as *segments*. A
segment is one row of a Parquet file (Spark's writers have no raw format) holding

    ids        the raw ids of its documents, one after the other, little-endian
    ends       ids before the end of each document, unsigned 64-bit
    keys       the keys in order (for listing; keyed access does not read them)
    seeds      displacement per hash bucket      } minimal perfect hash of the
    prints     32-bit fingerprint per slot       } distinct keys of the segment
    ordinals   first document of the slot's key  }
    copies     number of documents of that key   }
    nulls      number of documents without a key

A key's bucket gives a displacement, key and displacement give the slot, the slot's
fingerprint tells a foreign key with error 2^-32, and the slot's ordinal gives the place
in `ends` and `ids`: constant time for any segment size. A document is never divided, so
one longer than `segment_ids` makes a segment of its own.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, only, shared_dir, ship_package, table, text_or_empty
from .encoder import encoder

SEGMENT = ("shard int, segment int, first_key long, last_key long, documents long, n_ids long, "
           "ids binary, ends binary, keys array<bigint>, seeds binary, prints binary, ordinals binary, copies binary, nulls long")
DIRECT = np.int64(1) << 40        # a displacement from here on names the slot itself


# -- minimal perfect hash --------------------------------------------------

def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit finaliser with good avalanche."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_codes(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    """A null key is coded apart from every number by its own salt."""
    return np.where(null, mixed(np.zeros(1, np.uint64), 99)[0], mixed(keys.astype(np.int64).view(np.uint64), 1))


def displaced(codes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mixed(codes + seeds.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 2) % np.uint64(n)).astype(np.int64)


def build_hash(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per bucket, slot of each code) for distinct codes; slots are 0..n-1."""
    n = len(codes)
    buckets = max(1, n // 4)
    of = (mixed(codes, 3) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(buckets + 1))
    seeds, slots, free = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    sizes = np.diff(bounds)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[bounds[b]:bounds[b + 1]]
        if len(members) == 0:
            break
        if len(members) == 1:
            s = int(free.argmax())
            seeds[b] = DIRECT + s
            slots[members] = s
            free[s] = False
            continue
        at = 1
        while True:
            tries = np.arange(at, at + 64, dtype=np.int64)
            place = displaced(codes[members][None, :], tries[:, None], n)
            good = free[place].all(axis=1)
            if good.any():
                good &= (np.diff(np.sort(place, axis=1), axis=1) > 0).all(axis=1)
            if good.any():
                k = int(good.argmax())
                seeds[b] = tries[k]
                slots[members] = place[k]
                free[place[k]] = False
                break
            at += 64
    return seeds, slots


def look_up(codes: np.ndarray, seeds: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Slot of each code, or -1 where the slot's fingerprint tells that it is absent."""
    bucket = (mixed(codes, 3) % np.uint64(len(seeds))).astype(np.int64)
    seed = seeds[bucket]
    slot = np.where(seed >= DIRECT, seed - DIRECT, displaced(codes, seed, len(prints)))
    return np.where(prints[slot] == fingerprints(codes), slot, -1)


def fingerprints(codes: np.ndarray) -> np.ndarray:
    return (mixed(codes, 4) >> np.uint64(32)).astype("<u4")


# -- writing ---------------------------------------------------------------

def write_segments(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = None,
                   id_col: str = "doc_id", text_col: str = "text", segment_ids: int = 1 << 21) -> None:
    """Encode every whole text (null: empty), append `end_id`, write in ascending key
    order. Equal keys stay in order of their text's hash; null keys come first."""
    src = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("key"), text_or_empty(text_col).alias("text"))
    # Rows alike in key and text may be dealt to several ranges: they are interchangeable.
    ranged = (src.withColumn("h", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
              .repartitionByRange("key", "h", "nth").sortWithinPartitions("key", "h").select("key", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        shard, segment = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            nonlocal segment, size
            width = enc.dtype.itemsize
            ends = np.cumsum([len(x) // width for x in held], dtype="<u8")
            null = np.array([k is None for k in keys])
            number = np.array([0 if k is None else k for k in keys], np.int64)
            codes, first, times = np.unique(key_codes(number, null), return_index=True, return_counts=True)
            seeds, slots = build_hash(codes)
            ordinals, prints, copies = (np.zeros(len(codes), "<u4") for _ in range(3))
            ordinals[slots], prints[slots], copies[slots] = first, fingerprints(codes), times
            out = pa.RecordBatch.from_pylist([{
                "shard": shard, "segment": segment, "last_key": keys[-1],
                "first_key": next((k for k in keys if k is not None), None),
                "documents": len(keys), "n_ids": int(ends[-1]), "ids": b"".join(held), "ends": ends.tobytes(),
                "keys": keys, "seeds": seeds.astype("<i8").tobytes(), "prints": prints.tobytes(),
                "ordinals": ordinals.tobytes(), "copies": copies.tobytes(), "nulls": int(null.sum())}], schema=SCHEMA)
            segment, size = segment + 1, 0
            keys.clear()
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, ids in zip(part["key"].to_pylist(), enc.encode(part["text"].to_pylist()), strict=True):
                    if held and size + len(ids) > segment_ids * enc.dtype.itemsize:
                        yield row()
                    keys.append(key)
                    held.append(ids + end)
                    size += len(ids) + len(end)
        if held:
            yield row()

    # Ids of a vocabulary under 2^16 take two bytes; zstd is the files' own page compression.
    map_batches(ranged, encode, SEGMENT).write.option("compression", "zstd").parquet(path)


SCHEMA = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()),
                    ("documents", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary()), ("ends", pa.binary()),
                    ("keys", pa.list_(pa.int64())), ("seeds", pa.binary()), ("prints", pa.binary()),
                    ("ordinals", pa.binary()), ("copies", pa.binary()), ("nulls", pa.int64())])


# -- reading ---------------------------------------------------------------

def segment_starts(files: DataFrame) -> DataFrame:
    """Ids before each segment. Prefix sums over shards, then inside each shard: the only
    unpartitioned window has one row per writing task."""
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    over_shards = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    first = shards.select("shard", F.coalesce(F.sum("n").over(over_shards), F.lit(0)).alias("before"))
    return (files.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("within"))
            .join(first, "shard").select("shard", "segment", (F.col("before") + F.col("within")).alias("segment_start")))


def _documents(segment: dict, keys: np.ndarray, null: np.ndarray, width: int) -> dict[str, list]:
    """Find each key of a segment through its perfect hash and read its ids. A key that
    stands there several times is found at its first place; its repeats follow it."""
    seeds, prints = np.frombuffer(segment["seeds"], "<i8"), np.frombuffer(segment["prints"], "<u4")
    ordinals, ends = np.frombuffer(segment["ordinals"], "<u4"), np.frombuffer(segment["ends"], "<u8").astype(np.int64)
    codes = key_codes(keys, null)
    slot = look_up(codes, seeds, prints)
    nth = np.arange(len(codes))
    fresh = np.ones(len(codes), bool)
    fresh[1:] = codes[1:] != codes[:-1]
    nth -= np.maximum.accumulate(np.where(fresh, nth, 0))
    at = ordinals[slot].astype(np.int64) + nth
    starts, payload = np.where(at > 0, ends[at - 1], 0), memoryview(segment["ids"])
    found = slot >= 0
    spans = [(int(starts[i]), int(ends[at[i]])) for i in np.flatnonzero(found)]
    return {"found": found, "start": [a for a, _ in spans], "n_tokens": [b - a for a, b in spans],
            "ids": [bytes(payload[a * width:b * width]) for a, b in spans]}


def read_documents(files: DataFrame, vocabulary: str) -> DataFrame:
    """Every document of the files through the key index: key, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(vocabulary).dtype
        for batch in batches:
            for segment in batch.to_pylist():
                keys = segment["keys"]
                null = np.array([k is None for k in keys])
                got = _documents(segment, np.array([k or 0 for k in keys], np.int64), null, dtype.itemsize)
                if not got["found"].all():
                    raise ValueError("a stored key is missing from its segment's index")
                yield pa.RecordBatch.from_pydict({
                    "shard": [segment["shard"]] * len(keys), "segment": [segment["segment"]] * len(keys),
                    "key": pa.array(keys, pa.int64()), "at": got["start"], "n_tokens": got["n_tokens"],
                    "ids_crc32": [zlib.crc32(np.frombuffer(x, dtype).astype("<u4").tobytes()) for x in got["ids"]]}, OUT)

    docs = map_batches(files, read, "shard int, segment int, key long, at long, n_tokens long, ids_crc32 long")
    return docs.join(segment_starts(files), ["shard", "segment"]).select(
        "key", (F.col("segment_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


OUT = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("key", pa.int64()), ("at", pa.int64()),
                 ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _in_ranges(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the key, number of the range) wherever a key lies in one of the ascending
    ranges; neighbours may share a bound, as a key's documents may go on in the next one."""
    first, last = np.searchsorted(high, keys, side="left"), np.searchsorted(low, keys, side="right")
    many = np.maximum(last - first, 0)
    key = np.repeat(np.arange(len(keys)), many)
    return key, np.arange(len(key)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)


def fetch(files: DataFrame, keys: DataFrame, vocabulary: str, key_col: str = "key") -> DataFrame:
    """Keyed access: (key, ids) of every stored document of the distinct `keys`, null among
    them; absent keys have no row. Keys find their shards by binary search in the shards' key
    ranges (a row per writing task, broadcast) and their segments by one in the shard's
    segments, then probe the segments' indexes."""
    spark = files.sparkSession
    ship_package(spark)
    ranges = files.groupBy("shard").agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi"), F.sum("nulls").alias("nulls"))
    rows = ranges.orderBy("shard").collect()                                # one per writing task
    known = [r for r in rows if r["lo"] is not None]
    shared = spark.sparkContext.broadcast((
        *(np.array([r[c] for r in known], np.int64) for c in ("lo", "hi", "shard")), np.array([r["shard"] for r in rows if r["nulls"]], np.int64)))
    asked = keys.select(F.col(key_col).cast("long").alias("k")).distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, shard, with_null = shared.value
        for batch in batches:
            column = batch["k"]
            if column.null_count and len(with_null):
                yield pa.RecordBatch.from_arrays([pa.array(with_null, pa.int32()), pa.nulls(len(with_null), pa.int64())], ["shard", "k"])
            some = column.drop_null().to_numpy()
            key, at = _in_ranges(some, low, high)
            yield pa.RecordBatch.from_arrays([pa.array(shard[at], pa.int32()), pa.array(some[key], pa.int64())], ["shard", "k"])

    def to_segments(key, wanted: pa.Table, segments: pa.Table) -> pa.Table:
        segments, column = segments.sort_by("segment"), wanted["k"].combine_chunks()
        numbers = segments["segment"].to_numpy()
        keyed = segments.filter(segments["first_key"].is_valid())
        some = column.drop_null().to_numpy()
        at, of = _in_ranges(some, keyed["first_key"].to_numpy(), keyed["last_key"].to_numpy())
        found = [pa.array(some[at], pa.int64())]
        place = [keyed["segment"].to_numpy()[of] if len(of) else np.zeros(0, np.int32)]
        if column.null_count:
            place.append(numbers[segments["nulls"].to_numpy() > 0])
            found.append(pa.nulls(len(place[-1]), pa.int64()))
        place = np.concatenate(place)
        shard = segments["shard"][0].as_py() if segments.num_rows else 0
        return pa.table({"shard": pa.array(np.full(len(place), shard), pa.int32()), "segment": pa.array(place, pa.int32()), "k": pa.concat_arrays(found)})

    wanted = map_batches(asked, route, "shard int, k long")
    bounds = files.select("shard", "segment", "first_key", "last_key", "nulls")
    placed = wanted.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInArrow(to_segments, "shard int, segment int, k long")
    inside = placed.groupBy("shard", "segment").agg(F.collect_list(F.struct("k")).alias("asked"))
    hits = inside.join(files.drop("keys"), ["shard", "segment"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(vocabulary).dtype
        for batch in batches:
            for segment in batch.to_pylist():
                keys = sorted((r["k"] for r in segment["asked"]), key=lambda k: (k is not None, k))
                null = np.array([k is None for k in keys])
                number = np.array([k or 0 for k in keys], np.int64)
                slot = look_up(key_codes(number, null), np.frombuffer(segment["seeds"], "<i8"), np.frombuffer(segment["prints"], "<u4"))
                times = np.where(slot >= 0, np.frombuffer(segment["copies"], "<u4")[slot], 0).astype(np.int64)
                got = _documents(segment, np.repeat(number, times), np.repeat(null, times), dtype.itemsize)
                ids = [np.frombuffer(x, dtype).astype(np.int32).tolist() for x in got["ids"]]
                yield pa.RecordBatch.from_pydict({"key": [k for k, n in zip(keys, times.tolist(), strict=True) for _ in range(n)], "ids": ids},
                                                 pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))]))

    return map_batches(hits.select("asked", "ids", "ends", "seeds", "prints", "ordinals", "copies"), read, "key long, ids array<int>")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    path = f"{shared_dir(spark)}/llm-token-ids-{uuid.uuid4().hex}"
    write_segments(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return read_documents(spark.read.parquet(path), vocabulary).withColumnRenamed("key", "doc_id")


QUERIES = {"op8_token_output": (op8_token_output, None)}

"""Best-fit packing of documents into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so the whole instance is a histogram of at
most `capacity` counts: the driver plans on that bounded table, and the pieces, which
never leave the executors, look their place up by (length, rank among equal lengths).

Planning on the histogram:

* Martello-Toth dominance reduction. For the largest open length j, with r = capacity - j:
    - nothing fits beside j: j stays alone;
    - some k equals r: {j, k} fills a sequence and dominates every set holding j;
    - no two open lengths fit in r: j with its largest partner dominates;
    - no three fit, and every fitting pair is no larger than the largest partner k:
      {j, k} dominates (the pair can take k's place);
    - no three fit, and the greedy pair (k, b) bounds every fitting pair entry by entry:
      {j, k, b} dominates.
  Such sets are fixed for good, as often as the counts allow, and the rule is tried again
  on the smaller instance. Complementary pairs (the second rule holds for every j, not
  only for the largest) go first.
* Best fit, decreasing, over what is left: each length goes to the open sequences with the
  least room that still hold it, all sequences of the same room at once.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, only, stored, table, text_or_empty
from .encoder import encoder


@dataclass
class Plan:
    """Patterns (lengths in a sequence) with how many sequences follow each."""
    patterns: list[tuple[tuple[int, ...], int]]
    fixed: int                      # sequences fixed by dominance

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.patterns)


class _Open:
    """Counts of open lengths with order queries."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: n for k, n in counts.items() if n > 0}
        self.keys = sorted(self.count)

    def take(self, items: tuple[int, ...], times: int) -> None:
        for x in items:
            self.count[x] -= times
            if not self.count[x]:
                del self.count[x]
                self.keys.pop(bisect_left(self.keys, x))

    def largest(self, room: int, without: tuple[int, ...] = ()) -> int | None:
        """Largest open length up to `room` when `without` is in use."""
        i = bisect_right(self.keys, room) - 1
        while i >= 0:
            k = self.keys[i]
            if self.count[k] > without.count(k):
                return k
            i -= 1
        return None

    def smallest(self, n: int, without: tuple[int, ...]) -> list[int]:
        out: list[int] = []
        for k in self.keys:
            out += [k] * min(n - len(out), self.count[k] - without.count(k))
            if len(out) == n:
                break
        return out

    def times(self, items: tuple[int, ...]) -> int:
        return min(self.count[x] // items.count(x) for x in set(items))


def _dominant(open_: _Open, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set that dominates every feasible set holding `j`, if one of the rules tells it."""
    room = capacity - j
    k = open_.largest(room, (j,))
    if k is None:
        return (j,)
    if k == room:
        return (j, k)
    low = open_.smallest(3, (j,))
    if len(low) < 2 or low[0] + low[1] > room:
        return (j, k)
    if len(low) == 3 and sum(low) <= room:
        return None
    most, narrow = 0, 0             # over fitting pairs p >= q: largest p + q, largest q
    for p in open_.keys[:bisect_right(open_.keys, room)]:
        if open_.count[p] <= (p == j):
            continue
        q = open_.largest(min(p, room - p), (j, p))
        if q is not None:
            most, narrow = max(most, p + q), max(narrow, q)
    if most <= k:
        return (j, k)
    b = open_.largest(room - k, (j, k))
    if b is not None and min(k, b) >= narrow:
        return (j, k, b)
    return None


def plan_packing(counts: dict[int, int], capacity: int) -> Plan:
    """Pack `counts[length]` pieces of each length into as few sequences as it can."""
    open_ = _Open(counts)
    if open_.keys and (open_.keys[0] < 1 or open_.keys[-1] > capacity):
        raise ValueError("lengths must be 1..capacity")
    patterns: list[tuple[tuple[int, ...], int]] = []

    def fix(items: tuple[int, ...]) -> None:
        n = open_.times(items)
        patterns.append((items, n))
        open_.take(items, n)

    if capacity in open_.count:
        fix((capacity,))
    for j in reversed(list(open_.keys)):
        if j in open_.count and capacity - j in open_.count and (2 * j != capacity or open_.count[j] > 1):
            fix((j, capacity - j))
    while open_.keys:
        found = _dominant(open_, open_.keys[-1], capacity)
        if found is None:
            break
        fix(found)
    fixed = sum(n for _, n in patterns)

    # Best fit, decreasing. groups[room]: open sequences [pattern, how many] with that room.
    groups: dict[int, list[list]] = {}
    rooms: list[int] = []
    for length in reversed(list(open_.keys)):
        left = open_.count[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                per, source, room = 1, None, capacity
                n = left
            else:
                room = rooms[i]
                source = groups[room][-1]
                n = min(left, source[1])
            items = (length,) if source is None else (*source[0], length)
            if source is not None:
                source[1] -= n
                if not source[1]:
                    groups[room].pop()
                    if not groups[room]:
                        del groups[room]
                        rooms.pop(i)
            left -= n
            if source is None and length * 2 <= capacity:
                # Later pieces of this length go into the sequences just opened: fill whole ones at once.
                per = capacity // length
                if n >= per:
                    items, n, left = (length,) * per, n // per, n % per
                else:
                    items, n, left = (length,) * n, 1, 0
            now = capacity - sum(items)
            if now not in groups:
                groups[now] = []
                rooms.insert(bisect_left(rooms, now), now)
            groups[now].append([items, n])
    patterns += [(items, n) for held in groups.values() for items, n in held]
    return Plan(patterns, fixed)


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only a longer one is cut; the first piece
    takes what full pieces leave over."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)] if n else []


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int, end_id: int | None,
                  id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode whole texts and cut them: id, piece, start, length, ids_crc32 (and `ids`).

    A null text counts as empty. An empty text is the end id alone; without an end id it
    has no piece. Null and repeated ids are carried along, one set of pieces per row.
    """
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: dict[str, list] = {c: [] for c in ("of", "piece", "start", "length", "ids_crc32", "ids")}
                for i, raw in enumerate(enc.encode(part["text"].to_pylist())):
                    raw += end
                    wide = np.frombuffer(raw, enc.dtype).astype("<u4")
                    for piece, (start, length) in enumerate(piece_bounds(len(wide), capacity)):
                        rows["of"].append(i)
                        rows["piece"].append(piece)
                        rows["start"].append(start)
                        rows["length"].append(length)
                        rows["ids_crc32"].append(zlib.crc32(wide[start:start + length].tobytes()))
                        if with_ids:
                            rows["ids"].append(raw[start * width:(start + length) * width])
                out = [part["id"].take(pa.array(rows["of"], pa.int64())), pa.array(rows["piece"], pa.int32()),
                       pa.array(rows["start"], pa.int64()), pa.array(rows["length"], pa.int64()),
                       pa.array(rows["ids_crc32"], pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(rows["ids"], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return map_batches(src, cut, schema)


def _places(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: rank from which a run of places begins, its first sequence, the offset there."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for items, n in plan.patterns:
        offset = 0
        for length in items:
            rank = used.get(length, 0)
            runs.setdefault(length, []).append((rank, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in runs.items()}


def best_fit_pack(pieces: DataFrame, capacity: int, length_col: str = "length",
                  rank_rows: int = 1 << 17) -> tuple[DataFrame, Plan]:
    """`pieces` with sequence_id and offset (gapless from 0 in each sequence), and the plan.

    `pieces` must be a stored table: it is read for the histogram and again for the ranks.
    Ranks among equal lengths: rows are dealt to buckets by a hash, numbered inside
    (length, bucket), and shifted by the counts of the buckets before, so that no length,
    however frequent, is numbered by one task; a column `row` (any distinct numbers) deals
    rows that are alike in everything else.
    """
    spark = pieces.sparkSession
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(length_col).count().collect()}     # <= capacity rows
    plan = plan_packing(counts, capacity)
    places = spark.sparkContext.broadcast(_places(plan))
    columns = pieces.columns
    others = [c for c in columns if c != "ids"]
    buckets = max(4, -(-sum(counts.values()) // rank_rows))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*others), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(length_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy(length_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .select(length_col, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    inside = Window.partitionBy(length_col, "_bucket").orderBy(*others)
    ranked = (dealt.withColumn("_at", F.row_number().over(inside) - 1).join(first, [length_col, "_bucket"])
              .select(*[F.col(c) for c in columns], (F.col("_first") + F.col("_at")).cast("long").alias("_rank")))

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch[length_col].to_numpy(zero_copy_only=False)
            rank = batch["_rank"].to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                mine = np.flatnonzero(length == k)
                start, base, at = places.value[int(k)]
                run = np.searchsorted(start, rank[mine], side="right") - 1
                sequence[mine], offset[mine] = base[run] + rank[mine] - start[run], at[run]
            kept = [batch[c] for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return map_batches(ranked, seat, schema), plan


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int | None = 0,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places. An empty table gives an empty result."""
    pieces = cut_documents(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids)
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    return best_fit_pack(pieces, capacity)[0].drop("row").withColumnRenamed("id", id_col)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op3_best_fit_packing": (op3_best_fit_packing, None)}

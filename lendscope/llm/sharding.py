"""Sharding by vector bin packing: balance bytes, tokens and rows jointly.

Rows of one text stay together unless their group holds more than `whole` of a shard's
mean load; the placement works on *units* whose number is bounded by the parameters,
never by the data:

* small groups are dealt by the hash of their text to a fixed number of bundles;
* a group above `share` of a shard's mean load (in bytes, tokens or rows) is a unit of
  its own. At most 3 * shards / share such groups exist;
* a group above `whole` of a shard's mean load does not fit a shard well: its rows are
  split by the hash of id and row into units of about `share`, so a text that holds a
  third of all rows still spreads over the shards, whether or not its ids differ.

Units are placed largest first, each into the shard where the dot product of the
unit's load with the shard's residual capacity (all three normalised by the totals) is
highest; then units are moved or swapped between the fullest and the emptiest shards
as long as that lowers the spread of bytes and takes neither tokens nor rows further from
their mean (beyond a tolerance). For tokens stand the blank-separated words, or a token for
every TOKEN_BYTES bytes where that is more (texts without blanks). The driver sees unit
totals only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import only, stored, table, text_or_empty

TOKEN_BYTES = 4
WORD = "[^\\x20\\x09-\\x0D]+"


def place(loads: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit; `loads` is (units, 3), each column normalised to sum 1."""
    order = np.argsort(-loads.max(axis=1), kind="stable")
    residual = np.full((shards, loads.shape[1]), 1.0 / shards)
    out = np.empty(len(loads), dtype=np.int64)
    for u in order:
        fits = (residual >= loads[u]).all(axis=1)
        dot = residual @ loads[u]
        s = int(np.argmax(np.where(fits, dot, -np.inf) if fits.any() else dot))
        out[u] = s
        residual[s] -= loads[u]
    return out


def even_out(size: np.ndarray, shard: np.ndarray, shards: int, rounds: int = 4000,
             others: np.ndarray | None = None, tolerance: float = 0.02) -> np.ndarray:
    """Exchange one unit of the fullest shard for one of the emptiest (or for none)
    so that the difference of their sizes shrinks most; stop when nothing helps.

    `others` (units, measures): an exchange counts only if it leaves both shards within
    `tolerance` of the mean in each of these, or no further from it than the further one was."""
    total = np.bincount(shard, weights=size, minlength=shards)
    held = np.zeros((len(size), 0)) if others is None else others / np.maximum(others.sum(axis=0) / shards, 1e-300)
    load = np.stack([np.bincount(shard, weights=h, minlength=shards) for h in held.T], axis=1) if held.shape[1] else np.zeros((shards, 0))
    for _ in range(rounds):
        a, b = int(total.argmax()), int(total.argmin())
        gap = total[a] - total[b]
        ua, ub = np.flatnonzero(shard == a), np.flatnonzero(shard == b)
        if gap <= 0 or not len(ua):
            break
        ub = np.append(ub, -1)                                  # -1: move without exchange
        sb = np.append(size[ub[:-1]], 0.0)
        hb = np.vstack([held[ub[:-1]], np.zeros((1, held.shape[1]))])
        # Every pair, a slice of the fullest shard's units at a time.
        best = (gap / 2 - 1e-9, -1, -1)
        bound = np.maximum(tolerance, np.maximum(abs(load[a] - 1), abs(load[b] - 1)))
        for i in range(0, len(ua), 64):
            u = ua[i:i + 64]
            miss = np.abs(size[u][:, None] - sb[None, :] - gap / 2)
            for j in range(held.shape[1]):
                move = held[u, j][:, None] - hb[None, :, j]
                off = np.maximum(np.abs(load[a, j] - move - 1), np.abs(load[b, j] + move - 1))
                miss = np.where(off <= bound[j] + 1e-12, miss, np.inf)
            k = np.unravel_index(int(miss.argmin()), miss.shape)
            if miss[k] < best[0]:
                best = (miss[k], u[k[0]], ub[k[1]])
        _, x, y = best
        if x < 0:
            break
        move = held[x] - (held[y] if y >= 0 else 0.0)
        load[a] -= move
        load[b] += move
        shard[x] = b
        if y >= 0:
            shard[y] = a
        total = np.bincount(shard, weights=size, minlength=shards)
    return shard


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                    row_bytes: int = 16, bundles_per_shard: int = 128, share: float = 1 / 64,
                    whole: float = 1 / 2, slot_rows: int = 1 << 18) -> DataFrame:
    """One row per input row: id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    size = UTF-8 bytes + `row_bytes`; null text counts as none. Null ids are placed
    like others. Slots run from 0 without a gap inside each shard, in order of
    (slot bucket, id); repeated rows get slots of their own. An empty table gives an
    empty result; with fewer texts than shards some shards stay empty.
    """
    spark = docs.sparkSession
    t = only(docs, id_col, text_col).withColumn("t", text_or_empty(text_col))
    slim = stored(t.select(
        F.col(id_col).alias("id"), F.xxhash64("t").alias("h"),
        (F.octet_length("t") + F.lit(row_bytes)).cast("long").alias("size"),
        F.greatest(F.regexp_count("t", F.lit(WORD)), F.ceil(F.octet_length("t") / TOKEN_BYTES)).cast("long").alias("tokens"),
        F.crc32(F.col("t").cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")       # stored: the same in every later read

    total = slim.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens")).first()
    mean = {c: (total[c] or 0) / shards for c in ("rows", "size", "tokens")}
    limit = {c: max(1.0, mean[c] * share) for c in mean}
    parts = F.greatest(*[F.ceil(F.col(c) / F.lit(limit[c])) for c in limit])
    large = reduce(or_, [F.col(c) > F.lit(mean[c] * whole) for c in mean])
    # At most 3 * shards / share groups exceed a limit, whatever the input: a bounded list.
    hot = (slim.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens"))
           .filter(parts > 1).select("h", F.when(large, F.least(parts, "rows")).otherwise(1).cast("long").alias("parts")))
    hot = stored(hot, "shard-hot")
    bundles = shards * bundles_per_shard
    unit = F.when(F.col("parts").isNull(), F.struct(F.lit(0).cast("long").alias("g"), F.pmod("h", F.lit(bundles)).cast("long").alias("k"))) \
        .otherwise(F.struct(F.col("h").alias("g"), (F.lit(bundles) + F.pmod(F.xxhash64("id", "row"), "parts")).alias("k")))
    rows = slim.join(F.broadcast(hot), "h", "left").withColumn("unit", unit)

    units = (rows.groupBy("unit").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
             .select("unit.g", "unit.k", "size", "tokens", "rows").orderBy("g", "k").collect())
    shard_of: list[tuple[int, int, int]] = []
    if units:
        loads = np.array([[u["size"], u["tokens"], u["rows"]] for u in units], dtype=float)
        where = place(loads / np.maximum(loads.sum(axis=0), 1.0), shards)
        where = even_out(loads[:, 0], where, shards, others=loads[:, 1:])
        shard_of = [(u["g"], u["k"], int(s)) for u, s in zip(units, where, strict=True)]
    plan = spark.createDataFrame(shard_of, "g long, k long, shard int")
    placed = rows.select("id", "size", "crc", "row", F.col("unit.g").alias("g"), F.col("unit.k").alias("k")) \
        .join(F.broadcast(plan), ["g", "k"])

    # Slots: number rows inside (shard, bucket), then add the rows of the buckets before.
    buckets = max(8, -(-int(total["rows"]) // (shards * slot_rows)) * 8)
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("id", "crc", "row"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "size", "crc", "row")
    return (dealt.withColumn("at", F.row_number().over(inside) - 1).join(starts, ["shard", "bucket"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                    "shard", (F.col("first") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


QUERIES = {"op7_sharding": (op7_sharding, None)}

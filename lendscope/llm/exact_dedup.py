"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups.

DataFrame functions only. The plan:

1. rows:    (id, md5 of the normalised text, sha-256 of it), one scan, no shuffle.
2. classes: `groupBy(hash, normalised text)`. Grouping by the text itself *is* the
   byte comparison: two texts that share a hash still become two classes. Map-side
   aggregation sends each distinct text at most once per task, so a group holding a
   third of all rows arrives as one row per map task.
3. Each row looks its class up by hash. A hash that several classes share (a
   collision) is looked up by hash and text instead.

Both tables of the look-up are read back from the shared folder, so that the join
shuffles two plain scans, which adaptive execution splits where one hash is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, only, stored, table, tasks_for, text_or_empty


def md5_bytes(c: Column) -> Column:
    return F.unhex(F.md5(c))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest", hash128=md5_bytes, normalise=ascii_lower) -> DataFrame:
    """One row per input row: id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    `keep`: "smallest" or "largest" id of the group stays.
    Null text counts as empty, so null and empty texts form one group. Repeated
    ids: rows are counted one by one; of rows that share both the text and the
    kept id, each has kept = true (they are the same document twice). A null id
    never wins over another one; a group of null ids only has keep_id null and
    its rows are kept. An empty table gives an empty result.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    src = only(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), normalise(text_or_empty(text_col)).alias("norm"))
    hashed = src.withColumn("h", hash128(F.col("norm")))

    rows = stored(hashed.select("id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-rows")
    by_bytes = hashed.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("n"), best("id").alias("best"))
    by_hash = (by_bytes.groupBy("h")
               .agg(F.sum("n").alias("group_size"), best("best").alias("keep_id"),
                    F.count(F.lit(1)).alias("classes")))
    # Only hashes with more than one row need a look-up; the others are their own group.
    groups = stored(by_hash.filter("group_size > 1").coalesce(tasks_for(rows, rows.count())), "dedup-groups")

    looked = rows.join(groups, "h", "left")
    plain = looked.filter(F.coalesce(F.col("classes"), F.lit(1)) == 1).select(
        "id", F.coalesce("keep_id", "id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "sha")
    collided = groups.filter("classes > 1").select("h")
    if not collided.isEmpty():
        texts = hashed.join(collided, "h", "left_semi")
        classes = texts.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("group_size"), best("id").alias("keep_id"))
        plain = plain.unionByName(texts.join(classes, ["h", "norm"]).select(
            "id", "keep_id", "group_size", F.unhex(F.sha2("norm", 256)).alias("sha")))
    return plain.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


OP4_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       coalesce(doc_id = max(doc_id) OVER (PARTITION BY norm), max(doc_id) OVER (PARTITION BY norm) IS NULL) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""

QUERIES = {"op4_exact_dedup": (op4_exact_dedup, OP4_SQL)}

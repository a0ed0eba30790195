"""Categorical encoders (K-13..K-17, A-11, A-12, A-24, B-15, B-16).

One-hot columns need their names at plan time, so their vocabulary is read to the driver, in
one job for any number of tables (`vocabularies`). The job counts distinct values by a sketch
and tracks a bounded number of levels; only columns proven to have at most MAX_LEVELS reach
the driver. What a wide encoding cannot hold as columns, `category_long` gives as rows.
Callers that know their categories pass `vocab=` and skip the job. Label codes and target
means need no driver list: they are distributed tables, attached by `lookup_join`.

`lookup_join` never shuffles the fact side onto a category. It runs a job when called, to read
at most `BROADCAST_ROWS` rows of the lookup table; a table within that size is broadcast, a
larger one is computed again in the plan and joined with salted keys, so a category holding
a third of all rows is spread.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .series import prefix_sums, quantile_bucket

BROADCAST_ROWS = 100_000     # a lookup table up to this many rows is broadcast
MAX_LEVELS = 2_000           # levels of a column that may become dummy columns
LEVEL_BYTES = 256            # and the longest of them
SALTS = 32


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def lookup_join(df: DataFrame, lookup: DataFrame, keys: list[str], broadcast_rows: int | None = None,
                salts: int = SALTS) -> DataFrame:
    """Left join of `lookup` (one row per key) onto `df` without a shuffle of `df` by the key."""
    spark = df.sparkSession
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    rows = lookup.limit(limit + 1).collect()                  # bounded: at most limit + 1 rows
    if len(rows) <= limit:
        return df.join(F.broadcast(spark.createDataFrame(rows, lookup.schema)), keys, "left")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", salt).join(copies, [*keys, "_salt"], "left").drop("_salt")


def string_columns(df: DataFrame, among: Iterable[str] | None = None) -> list[str]:
    """Categorical columns = string-typed columns (P-7)."""
    allowed = None if among is None else set(among)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and (allowed is None or f.name in allowed)]


def _levels(df: DataFrame, columns: list[str], table: str, max_levels: int) -> DataFrame:
    """(table, name, levels, seen, rows, estimate, long) per column, from one aggregate without
    keys, in bounded memory. The tracked levels are all of them, with exact counts, unless a
    column has more than three quarters of the 4 * `max_levels` that the sketch has room for."""
    aggregates = []
    for i, c in enumerate(columns):
        v = quoted(c).cast("string")
        short = F.when(F.octet_length(v) <= LEVEL_BYTES, v)
        aggregates += [F.call_function("approx_top_k", short, F.lit(2 * max_levels), F.lit(4 * max_levels)).alias(f"top{i}"),
                       F.approx_count_distinct(v).alias(f"estimate{i}"),
                       F.count(F.when(F.octet_length(v) > LEVEL_BYTES, 1)).alias(f"long{i}")]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    return wide.select(F.lit(table).alias("table"), "rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"top{i}.item").alias("levels"),
                 F.aggregate(f"top{i}", F.lit(0).cast("long"), lambda total, x: total + x["count"]).alias("seen"),
                 F.col(f"estimate{i}").alias("estimate"), F.col(f"long{i}").alias("long")) for i, c in enumerate(columns)])).alias("c")) \
        .select("table", "rows", F.col("c.name").alias("name"), "c.seen", "c.estimate", "c.long",
                F.when((F.col("c.long") == 0) & (F.col("c.seen") == F.col("rows")) & (F.col("c.estimate") <= 2 * max_levels)
                       & (F.size(F.array_compact("c.levels")) <= max_levels), F.array_compact("c.levels")).alias("levels"))


def vocabularies(tables: Mapping[str, DataFrame | tuple[DataFrame, Iterable[str]]], max_levels: int = MAX_LEVELS) -> dict[str, dict[str, list[str]]]:
    """{table: {column: sorted distinct non-null values}} of the string columns (or the given
    ones) of several tables, in one job. A column with more than `max_levels` levels, or a value
    of more than LEVEL_BYTES bytes, is left out: its levels never leave the executors."""
    wanted = {name: (t[0], list(t[1])) if isinstance(t, tuple) else (t, string_columns(t)) for name, t in tables.items()}
    parts = [_levels(df, columns, name, max_levels) for name, (df, columns) in wanted.items() if columns]
    out: dict[str, dict[str, list[str]]] = {name: {} for name in wanted}
    if parts:
        for row in reduce(DataFrame.unionByName, parts).select("table", "name", "levels").collect():      # a row per column
            if row["levels"] is not None:
                out[row["table"]][row["name"]] = sorted(row["levels"])
    return out


def vocabulary(df: DataFrame, columns: Iterable[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """`vocabularies` of one table."""
    return vocabularies({"": (df, columns)}, max_levels)[""]


def listed(column: str, levels: Iterable[str]) -> Column:
    """The column, with an error in the running job for a value outside `levels`: a fixed
    list never loses rows silently. Missing values pass."""
    c, levels = quoted(column), list(levels)
    message = F.concat(F.lit(f"{column} has a level outside the given list: "), c)
    return F.when(c.isNull() | c.isin(levels), c).otherwise(F.raise_error(message))


def category_long(df: DataFrame, key: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Counts and shares of each category per key as rows (key, column, value, count, share),
    for columns with too many levels for dummy columns (A-11, A-12). Missing values are a
    level of their own (value NULL), as with the dummies' `_nan`."""
    columns = string_columns(df) if columns is None else list(columns)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]))
    counts = df.select(key, pairs.alias("p")).groupBy(key, "p.column", "p.value").agg(F.count(F.lit(1)).alias("count"))
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.join(rows, key).select(key, "column", "value", "count", (F.col("count") / F.col("_rows")).alias("share"))


def one_hot_exprs(column: str, levels: Iterable[str], dummy_na: bool) -> dict[str, Column]:
    """{`COL_value`: 0/1 column} for each level, plus `COL_nan` when `dummy_na`."""
    c = quoted(column)
    one, zero = F.lit(1), F.lit(0)
    out = {f"{column}_{v}": F.when(c == F.lit(v), one).otherwise(zero) for v in levels}
    if dummy_na:
        out[f"{column}_nan"] = F.when(c.isNull(), one).otherwise(zero)
    return out


def one_hot(df: DataFrame, columns: Iterable[str] | None = None, dummy_na: bool = False,
            vocab: Mapping[str, list[str]] | None = None,
            keep_original: bool = False, max_levels: int = MAX_LEVELS) -> tuple[DataFrame, list[str]]:
    """pandas `get_dummies` equivalent (K-14, K-15).

    Encodes `columns` (default: every string column). With `dummy_na` a
    `COL_nan` indicator is emitted even when the column has no missing value.
    Returns the new frame and the list of dummy column names. A column with more than
    `max_levels` levels and no `vocab` is an error: `category_long` is the form for it.
    """
    cols = string_columns(df) if columns is None else string_columns(df, columns)
    vocab = dict(vocab or {})
    missing = [c for c in cols if c not in vocab]
    vocab.update(vocabulary(df, missing, max_levels))
    wide = [c for c in cols if c not in vocab]
    if wide:
        raise ValueError(f"{', '.join(wide)}: too many or too long levels for dummy columns; use category_long, pass vocab= or leave the column out")
    dummies: dict[str, Column] = {}
    for c in cols:
        dummies.update(one_hot_exprs(c, vocab[c], dummy_na))
    keep = [quoted(c) for c in df.columns if keep_original or c not in cols]
    return df.select(*keep, *[e.alias(n) for n, e in dummies.items()]), list(dummies)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(column, code): rank of every distinct non-null value in string order (K-13). The
    ranks come from prefix sums over buckets of the value range, so no task ranks all levels.
    The reference's factorize numbers by first appearance in the file, which is not a defined
    order on a distributed table."""
    values = (df.select(quoted(column).cast("string").alias("_v")).filter(F.col("_v").isNotNull()).distinct()
              .withColumn("_one", F.lit(1).cast("bigint")))
    ranked = prefix_sums(values, ["_v"], ["_one"], quantile_bucket(values, "_v"))
    return ranked.select(F.col("_v").alias(column), F.col("_one_before").alias("code"))


def label_encode(df: DataFrame, columns: Iterable[str],
                 vocab: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Replace each column by its label code, missing -> -1. A column in `vocab` (complete,
    sorted levels) needs no job for its codes."""
    out = df
    for c in columns:
        keyed = out.withColumn("_level", quoted(c).cast("string"))
        if vocab and c in vocab and len(vocab[c]) <= BROADCAST_ROWS:
            codes = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(vocab[c])], "_level string, _code long")
            joined = keyed.join(F.broadcast(codes), "_level", "left")
        else:
            codes = label_codes(df, c).select(quoted(c).alias("_level"), F.col("code").alias("_code"))
            joined = lookup_join(keyed, codes, ["_level"])
        out = joined.withColumn(c, F.coalesce("_code", F.lit(-1)).cast("bigint")).drop("_level", "_code")
    return out.select(*[quoted(c) for c in df.columns])


# -- target encoding -------------------------------------------------------

def target_fit(df: DataFrame, cat: str, target: str, out: str | None = None) -> DataFrame:
    """Mean target per category (A-24). Missing categories are not a level;
    missing targets are skipped by the mean."""
    out = out or f"{cat}_TARGET_MEAN"
    return (df.filter(F.col(cat).isNotNull())
            .groupBy(cat).agg(F.avg(F.col(target)).alias(out)))


def target_transform(df: DataFrame, encoder: DataFrame, cat: str) -> DataFrame:
    """Attach the encoded value (K-16): left look-up on the category. Unseen -> NULL."""
    return lookup_join(df, encoder, [cat])


def target_fit_transform(df: DataFrame, cat: str, target: str, out: str | None = None) -> DataFrame:
    """K-17: fit on `df`, then encode `df` itself."""
    return target_transform(df, target_fit(df, cat, target, out), cat)


def target_encode_oof(df: DataFrame, cat: str, target: str, fold: str,
                      out: str | None = None) -> DataFrame:
    """Out-of-fold target mean: each row is encoded with the mean of the rows of
    the same category in the *other* folds, so the label never leaks into its
    own encoding. Built from two small aggregates and one look-up; no per-fold loop.
    """
    out = out or f"{cat}_TARGET_OOF"
    valid = df.filter(F.col(cat).isNotNull())
    per_fold = valid.groupBy(cat, fold).agg(F.sum(F.col(target).cast("double")).alias("_s"),
                                            F.count(F.col(target)).alias("_n"))
    w = per_fold.groupBy(cat).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    enc = per_fold.join(w, cat).select(
        cat, fold, F.try_divide(F.col("_ts") - F.col("_s"), (F.col("_tn") - F.col("_n")).cast("double")).alias(out))
    return lookup_join(df, enc, [cat, fold])

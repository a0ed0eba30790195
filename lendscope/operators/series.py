"""Ordered operators over per-entity series (W-1..W-6, J-6, J-8) and global
prefix sums (used by exact AUC/ROC and balanced fold assignment).

Scale notes
-----------
* `gap_to_previous` never sorts the raw rows of one entity in one task. It
  first reduces the rows to distinct `(entity, value)` pairs (a partial
  aggregate, so a hot entity with a third of all rows costs nothing extra),
  runs `lag` over those pairs (bounded by the value domain, e.g. day offsets),
  and joins the gap back on the row id of each pair's first row.
* `prefix_sums` replaces an unpartitioned running-sum window (one task for the
  whole table) by bucket totals -> offsets over a small table -> running sums
  inside each bucket. Buckets follow the rows: bounds come from a mergeable,
  row-weighted quantile summary, and their number from the row count.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def gap_to_previous(df: DataFrame, key: str, value: str, row_id: str, out: str,
                    descending: bool = False, where: Column | None = None) -> DataFrame:
    """Gap between a row's value and the previous row's value in its entity.

    Rows of each `key` are ordered by `value` (descending if asked; ties by
    `row_id`); the first row gets 0, every other row |value - previous value|
    (so tied rows after the first get 0). Rows whose value is NULL get 0.
    With `where`, only qualifying rows take part; the others get NULL.
    """
    qual = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    gaps = gaps_by_row(df, key, row_id, {out: (value, descending, where)})
    return (df.withColumn("_q", qual).join(gaps, row_id, "left")
            .withColumn(out, F.when(F.col("_q"), F.coalesce(F.col(out), F.lit(0)))).drop("_q"))


def gaps_by_row(df: DataFrame, key: str, row_id: str,
                series: dict[str, tuple[str, bool, Column | None]]) -> DataFrame:
    """Non-zero candidates of several gap columns in one pass: (row_id, *series).

    `series` maps an output name to (value column, descending, row predicate).
    Only the first row (smallest id) of an (entity, value) pair can have a gap other
    than 0, so pairs keep that id and the result joins back on the row id alone: no
    join on the entity, hence no hot key. Rows without an entry have gap 0.
    """
    entries = []
    for kind, (name, (value, descending, where)) in enumerate(series.items()):
        v = F.col(value).cast("double")
        taken = F.col(value).isNotNull() & (F.lit(True) if where is None else F.coalesce(where, F.lit(False)))
        entries.append(F.when(taken, F.struct(F.lit(kind).alias("kind"), (-v if descending else v).alias("v"))))
    long = (df.select(row_id, key, F.explode(F.array_compact(F.array(*entries))).alias("e"))
            .groupBy(key, "e.kind", "e.v").agg(F.min(row_id).alias(row_id)))
    w = Window.partitionBy(key, "kind").orderBy("v")
    gaps = long.withColumn("gap", F.col("v") - F.lag("v").over(w)).filter(F.col("gap").isNotNull())
    types = dict(df.dtypes)
    return gaps.groupBy(row_id).agg(*[
        F.max(F.when(F.col("kind") == kind, F.col("gap"))).cast(types[value]).alias(name)
        for kind, (name, (value, _, _)) in enumerate(series.items())])


def attach_group_stats(df: DataFrame, key: str | list[str], aggs: dict[str, Column]) -> DataFrame:
    """Group aggregates merged back onto every row of the group (J-8, W-3).

    A partial+final aggregate followed by an equi-join on the key: a hot key
    is reduced map-side before the shuffle, and the join's aggregated side has
    one row per key (AQE broadcasts it when small or splits a skewed key).
    """
    keys = [key] if isinstance(key, str) else list(key)
    stats = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    return df.join(stats, keys, "left")


def uniform_bucket(h: Column, n_buckets: int, modulus: float = 4294967296.0) -> Column:
    """Bucket of a uniform non-negative integer hash in [0, modulus)."""
    return F.floor(h.cast("double") * n_buckets / modulus).cast("int")


N_BUCKETS = 4096          # finest division of a global order; independent of the shuffle setting
BUCKET_ROWS = 4096        # rows for which a further bucket is worth it
_STEP = 16                # bounds are searched in steps of 256, 16 and 1
_SAMPLE = 16384           # values that stand for a column of strings


def quantile_bounds(df: DataFrame, column: str, n_buckets: int | None = None, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Ascending distinct bounds that cut the rows of `df` into near-equal parts by `column`, as
    a scalar subquery (no job at plan time): about one bucket for `bucket_rows` rows, at most
    N_BUCKETS; with `n_buckets`, that many. A struct of three arrays: every 256th bound (`far`),
    every 16th (`near`), and all.

    Numbers: a mergeable quantile summary over the rows, whose rank error is a small part of a
    bucket, so equal values weigh as often as they stand there. Strings, which such a summary
    does not take: quantiles of a uniform sample of the distinct values (the smallest hashes),
    so buckets are near-equal in values."""
    c = F.col(column)
    known = df.filter(c.isNotNull()).select(c.alias("v"))
    if isinstance(known.schema["v"].dataType, NumericType):
        grid = ",".join(str(i / N_BUCKETS) for i in range(1, N_BUCKETS))
        points = F.expr(f"approx_percentile(v, CAST(split('{grid}', ',') AS ARRAY<DOUBLE>), {8 * N_BUCKETS})")
        made = known.agg(points.alias("points"), F.count(F.lit(1)).alias("rows"))
        finest, size = 1, N_BUCKETS
    else:
        sample = known.distinct().orderBy(F.xxhash64("v"), "v").limit(_SAMPLE)
        made = sample.agg(F.sort_array(F.collect_list("v")).alias("points")).crossJoin(      # one row each
            known.agg(F.count_distinct("v").alias("rows")))
        finest, size = _STEP, F.size("points")
    wanted = F.lit(n_buckets) if n_buckets else F.greatest(F.lit(1), F.ceil(F.col("rows") / bucket_rows))
    stride = F.greatest(F.lit(finest if not n_buckets else 1), F.floor(size / wanted)).cast("int")
    made = made.select("points", stride.alias("stride"))
    bounds = made.select(F.array_distinct(_every("points", F.col("stride"))).alias("all"))
    return bounds.select(F.struct(_every("all", F.lit(_STEP * _STEP)).alias("far"), _every("all", F.lit(_STEP)).alias("near"), "all")).scalar()


def _every(values: str, step: Column) -> Column:
    return F.filter(values, lambda _, i: (i + 1) % step == 0)


def place_among(bounds: Column, c: Column) -> Column:
    """Number of the bounds (see `quantile_bounds`) below `c`, by three short searches instead of
    one through all. Plain array functions: subqueries may not stand in lambdas."""
    def below(part: Column) -> Column:
        return (F.array_position(F.sort_array(F.array_append(part, c)), c) - 1).cast("int")

    far = below(bounds["far"])
    near = far * _STEP + below(F.slice(bounds["near"], far * _STEP + 1, _STEP))
    return near * _STEP + below(F.slice(bounds["all"], near * _STEP + 1, _STEP))


def quantile_bucket(df: DataFrame, column: str, n_buckets: int | None = None, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Bucket index monotone in `column` (numbers or strings), near-equal in rows (strings: in
    distinct values) as far as single values allow; see `quantile_bounds`."""
    return place_among(quantile_bounds(df, column, n_buckets, bucket_rows), F.col(column)).cast("int")


def prefix_sums(df: DataFrame, order: Iterable[str | Column], values: Iterable[str],
                bucket: Column, partition: Iterable[str] = (), suffix: str = "_before") -> DataFrame:
    """Exclusive running sums of `values` in `order` (within `partition`).

    `bucket` must be non-decreasing along `order` inside each partition. The
    result adds `<value><suffix>` = sum of `value` over all earlier rows.
    """
    values = list(values)
    part = list(partition)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    b = df.withColumn("_b", bucket)
    totals = b.groupBy(*part, "_b").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wb = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_b", *[
        F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_o_{v}") for v in values])
    wi = Window.partitionBy(*part, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = b.select("*", *[F.coalesce(F.sum(v).over(wi), F.lit(0)).alias(f"_w_{v}") for v in values])
    joined = within.join(offsets, part + ["_b"])
    return joined.select(*df.columns, *[(F.col(f"_o_{v}") + F.col(f"_w_{v}")).alias(f"{v}{suffix}")
                                        for v in values])


def group_median(df: DataFrame, value: str, group: str, out: str,
                 n_buckets: int | None = None) -> DataFrame:
    """Exact median of `value` per `group` (A-9), missing values skipped; the
    mean of the two middle values for an even count (pandas' median).

    Skew-safe: rows are reduced to (group, value, count) by a partial
    aggregate, ranks come from bucketed prefix sums of those counts, and only
    the one or two (group, value) rows covering the middle ranks are kept, so
    no task ever holds a whole group (unlike a percentile aggregate, whose
    final merge keeps every distinct value of a group in one task).
    """
    v = df.filter(F.col(value).isNotNull())
    counts = v.groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sums(counts, [value], ["_c"], quantile_bucket(counts, value, n_buckets), [group])
    totals = counts.groupBy(group).agg(F.sum("_c").alias("_n"))
    j = ranked.join(totals, group)
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    start, end = F.col("_c_before"), F.col("_c_before") + F.col("_c")
    covers_lo, covers_hi = (start <= lo) & (end > lo), (start <= hi) & (end > hi)
    middle = j.filter(covers_lo | covers_hi)
    return middle.groupBy(group).agg(
        ((F.min(F.when(covers_lo, F.col(value))) + F.min(F.when(covers_hi, F.col(value))))
         / F.lit(2.0)).alias(out))

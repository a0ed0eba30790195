"""Data profiling operators (A-17..A-25, B-17): every result is a small table
computed by distributed aggregates; only scalars or bounded tables reach the
driver."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_ratios(df: DataFrame, columns: Iterable[str] | None = None, only_positive: bool = True) -> DataFrame:
    """Share of missing values per column (A-18, B-17), as a long table
    (column, null_ratio). One scan computes every ratio, then the single row
    is unpivoted."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "null_ratio")
    return long.filter(F.col("null_ratio") > 0) if only_positive else long


def value_counts(df: DataFrame, column: str, dropna: bool = True, out: str = "count") -> DataFrame:
    """Occurrences of each value (A-19), most frequent first, ties by value; missing values
    dropped like pandas."""
    src = df.filter(F.col(column).isNotNull()) if dropna else df
    return src.groupBy(column).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), column)


def binarised_counts(df: DataFrame, column: str, out_value: str = "is_nonzero") -> DataFrame:
    """Counts of (value != 0) as 0/1, missing counted as non-zero (A-20)."""
    flag = F.when(F.col(column) == 0, F.lit(0)).otherwise(F.lit(1))
    return df.groupBy(flag.alias(out_value)).agg(F.count(F.lit(1)).alias("count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, missing included as a value (A-25, U-3)."""
    return df.select(column).distinct()


def count_of_counts(df: DataFrame, key: str, out: str = "rows_per_key") -> DataFrame:
    """Distribution of group sizes (A-21): how many keys have n rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return sizes.groupBy(out).agg(F.count(F.lit(1)).alias("n_keys"))


def category_counts(df: DataFrame, category: str, id_col: str, out: str = "count") -> DataFrame:
    """Non-missing ids per category (A-22)."""
    return df.groupBy(category).agg(F.count(id_col).alias(out))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram as a table (A-23): bin index, lower/upper edge, count.

    Edges come from one min/max aggregate, a scalar subquery of the plan. The last bin is
    closed on the right, as in numpy/matplotlib. Empty bins are not listed.
    """
    v = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("ends")).scalar()
    known = df.filter(v.isNotNull()).select(v.alias("v"), ends.alias("e"))
    lo, span = F.col("e.lo"), F.col("e.hi") - F.col("e.lo")
    at = F.least(F.floor((F.col("v") - lo) * F.lit(float(bins)) / F.when(span > 0, span).otherwise(1.0)), F.lit(bins - 1))
    width = F.when(span > 0, span / F.lit(float(bins))).otherwise(1.0)
    counts = known.groupBy(at.cast("int").alias("bin"), lo.alias("lo"), width.alias("width")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select("bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("lower"),
                         (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper"), "count")


def global_stats(df: DataFrame, column: str) -> DataFrame:
    """Whole-column scalar aggregates (A-17): mean, min, max, distinct count."""
    c = F.col(column)
    return df.agg(F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"),
                  F.count_distinct(c).alias("nunique"), F.count(F.lit(1)).alias("rows"))


def count_where(cond: Column) -> Column:
    """Aggregate: number of rows satisfying `cond` (M-11)."""
    return F.count(F.when(cond, F.lit(1)))

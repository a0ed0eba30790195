"""Horizontal (row-wise) statistics over a list of columns (H-1..H-5, K-12).

pandas skips missing values in `sum/mean/std/kurtosis(axis=1)`; these are the
same statistics as flat column arithmetic, so they stay in whole-stage codegen.

Moment statistics (std, kurtosis) are built in stages by `with_row_stats`:
count and mean first, central moments next, the final formula last. Each
stage references the previous stage's columns, so the mean is computed once per
row (an inlined one-shot expression repeats the mean inside every squared
term; over 20 columns that overflows the 64 KB method limit and drops the
stage out of codegen). Catalyst keeps the stages separate because the helper
columns are referenced more than once.
"""

from __future__ import annotations

from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import col


def row_sum(cols) -> Column:
    """Sum skipping missing values; all missing -> 0 (H-1)."""
    return reduce(add, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_total(cols) -> Column:
    """Plain `a + b + ...`, NULL if any term is NULL (P-10)."""
    return reduce(add, [col(c) for c in cols])


def row_product(cols) -> Column:
    """NULL-propagating product (H-5)."""
    return reduce(mul, [col(c) for c in cols])


def row_count(cols) -> Column:
    """Number of non-missing values."""
    return reduce(add, [col(c).isNotNull().cast("int") for c in cols])


def row_mean(cols) -> Column:
    """Mean over non-missing values; NULL if none (H-2)."""
    return F.try_divide(row_sum(cols), row_count(cols).cast("double"))


def _central_sum(cols, mean: Column, power: int) -> Column:
    return reduce(add, [F.coalesce(F.pow(col(c).cast("double") - mean, F.lit(float(power))), F.lit(0.0))
                        for c in cols])


def _std(n: Column, m2: Column) -> Column:
    return F.when(n >= 2, F.sqrt(m2 / (n - 1).cast("double")))


def _kurtosis(n: Column, m2: Column, m4: Column) -> Column:
    n = n.cast("double")
    g2 = (n * (n + 1) * (n - 1) * m4 / ((n - 2) * (n - 3) * m2 * m2)
          - 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3)))
    return F.when(n < 4, F.lit(None).cast("double")).when(m2 == 0, F.lit(0.0)).otherwise(g2)


ROW_STATS = ("sum", "mean", "std", "kurtosis", "product", "total", "count")


def with_row_stats(df: DataFrame, outputs: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Add row-wise statistics: `outputs` maps a new column name to
    (statistic, input columns); statistic is one of ROW_STATS.

    std is the sample standard deviation (NULL below 2 values); kurtosis is the
    bias-corrected excess kurtosis (NULL below 4 values, 0 for constant rows).
    """
    direct = {"sum": row_sum, "mean": row_mean, "product": row_product, "total": row_total,
              "count": row_count}
    stage1, stage2, final, helpers = {}, {}, {}, []
    for i, (name, (stat, cols)) in enumerate(outputs.items()):
        if stat in direct:
            final[name] = direct[stat](cols)
            continue
        if stat not in ("std", "kurtosis"):
            raise ValueError(f"unknown row statistic {stat!r}")
        n, m, m2, m4 = (f"__rs{i}_{x}" for x in ("n", "mean", "m2", "m4"))
        helpers += [n, m, m2, m4]
        stage1[n] = row_count(cols)
        stage1[m] = row_mean(cols)
        stage2[m2] = _central_sum(cols, F.col(m), 2)
        if stat == "kurtosis":
            stage2[m4] = _central_sum(cols, F.col(m), 4)
            final[name] = _kurtosis(F.col(n), F.col(m2), F.col(m4))
        else:
            final[name] = _std(F.col(n), F.col(m2))
    out = df
    if stage1:
        out = out.withColumns(stage1).withColumns(stage2)
    out = out.withColumns(final)
    return out.drop(*[h for h in helpers if h in out.columns])

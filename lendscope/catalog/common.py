"""Registry of check queries and shared helpers for both sides of the check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .sqlroles import INT_COLS

DIGITS = 6

# name -> (spark callable(spark, base_dir) -> DataFrame, oracle SQL or None)
REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


TIE_NUDGE = 1.000000000001
SIG_DIGITS = 11
TINY = 1e-300


def _round_col(c):
    """floor(x' * p + 0.5) / p with x' = x * (1 + 1e-12) and p = 10^k,
    k = clamp(10 - floor(log10|x'|), 0, 6): 6 decimals below 1e5, then 11
    significant digits, integers from 1e10. p is an exact power of ten, and the
    same IEEE operations run in the oracle, so both engines agree bit for bit.
    Kept to a few expression nodes per column so the rounding projection never
    pushes the aggregate it is fused with out of whole-stage codegen."""
    x = c * F.lit(TIE_NUDGE)
    k = F.least(F.lit(DIGITS), F.greatest(F.lit(0), F.lit(SIG_DIGITS - 1)
                                            - F.floor(F.log10(F.greatest(F.abs(x), F.lit(TINY))))))
    p = F.pow(F.lit(10.0), k)
    return F.floor(x * p + F.lit(0.5)) / p


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column so engines that sum in a different order
    agree on the printed value: 6 decimals for |x| < 1e5, 11 significant
    digits above, integers from 1e10 (floating noise of a sum or variance sits near the last of
    ~16 digits). Values are first scaled by (1 + 1e-12), i.e. moved away from
    zero by far less than the rounding step but more than the relative
    summation error, so an exact half (e.g. a mean of 13/128) rounds the same
    way in both engines whichever side of it each floating sum landed on."""
    return df.select(*[_round_col(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# -- oracle-side SQL helpers ----------------------------------------------

def r(expr: str, digits: int = DIGITS) -> str:
    """The oracle-side twin of `finish`: the same IEEE operations in the same order."""
    x = f"(({expr}) * CAST({TIE_NUDGE!r} AS DOUBLE))"
    k = f"least({digits}, greatest(0, {SIG_DIGITS - 1} - floor(log10(greatest(abs({x}), {TINY!r})))))"
    p = f"power(CAST(10 AS DOUBLE), {k})"
    return f"(floor({x} * {p} + CAST(0.5 AS DOUBLE)) / {p})"


def sql_stat(col: str, stat: str, is_int: bool | None = None, src: str | None = None) -> str:
    """One aggregate in DuckDB SQL with the reference's null rules."""
    is_int = (col in INT_COLS) if is_int is None else is_int
    x = src or col
    if stat == "mean":
        return r(f"avg({x})")
    if stat == "sum":
        return f"CAST(coalesce(sum({x}), 0) AS BIGINT)" if is_int else r(f"coalesce(sum({x}), 0)")
    if stat in ("min", "max"):
        return f"{stat}({x})" if is_int else r(f"{stat}({x})")
    if stat == "var":
        return r(f"var_samp({x})")
    if stat == "std":
        return r(f"stddev_samp({x})")
    if stat == "size":
        return "count(*)"
    if stat == "count":
        return f"count({x})"
    if stat == "nunique":
        return f"count(DISTINCT {x})"
    if stat == "median":
        return r(f"median({x})")
    raise ValueError(stat)


def sql_spec(spec: dict, prefix: str = "", int_cols: set | None = None,
             sources: dict | None = None) -> list[str]:
    out = []
    for c, stats in spec.items():
        for s in stats:
            is_int = None if int_cols is None else (c in int_cols)
            out.append(f"{sql_stat(c, s, is_int, (sources or {}).get(c))} AS {prefix}{c}_{s.upper()}")
    return out

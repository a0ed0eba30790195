"""Null-safe scalar expressions.

Conventions (see SURVEY T3-T6): missing is always SQL NULL, never NaN;
division by zero yields NULL (`try_divide`) instead of raising under ANSI mode;
pandas' `!=` keeps missing values, which is `NOT (a <=> b)` here.
Every function returns a `Column`, so all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source data model.
DAYS_SENTINEL = 365243          # "no date" marker in DAYS_* columns
TIME_CONSTANT = 12              # months, decay of the delay seriousness score
DELAY_IMPORTANCE = 2            # exponent applied to the status code


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b with NULL for a zero or NULL denominator (K-1, T4)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def nullif_sentinel(c, sentinel=DAYS_SENTINEL) -> Column:
    """Sentinel -> NULL (K-3)."""
    return F.nullif(col(c), F.lit(sentinel))


def sentinel_to_zero(c, sentinel=DAYS_SENTINEL) -> Column:
    """Sentinel -> 0, everything else unchanged (K-4)."""
    c = col(c)
    return F.when(c == sentinel, F.lit(0)).otherwise(c)


def clip0(c) -> Column:
    """x if x > 0 else 0, missing -> 0 (K-5). `greatest` skips NULL."""
    return F.greatest(col(c), F.lit(0))


def flag_not_equal(c, value) -> Column:
    """0 if c == value else 1; missing -> 1 (K-6)."""
    return F.when(col(c) == F.lit(value), F.lit(0)).otherwise(F.lit(1))


def flag_not_negative(c) -> Column:
    """0 if c < 0 else 1; missing -> 1 (K-7)."""
    return F.when(col(c) < 0, F.lit(0)).otherwise(F.lit(1))


def neq_keep_null(c, value) -> Column:
    """Predicate `c != value` with pandas semantics: NULL rows are kept (F-1, T6)."""
    return ~col(c).eqNullSafe(F.lit(value))


def differs_or_missing(a, b) -> Column:
    """(a != b) as 0/1 where a missing comparison counts as different (K-8)."""
    return F.coalesce(col(a) != col(b), F.lit(True)).cast("int")


def status_int(c) -> Column:
    """Monthly status code -> integer, with C and X meaning 0 (K-9)."""
    c = col(c)
    return F.when(c.isin("C", "X"), F.lit(0)).otherwise(c.cast("int"))


def delay_seriousness(months, status) -> Column:
    """exp(month / 12) * status_int ** 2 (B-5, K-10)."""
    return (F.exp(col(months) / F.lit(float(TIME_CONSTANT)))
            * F.pow(status_int(status).cast("double"), F.lit(float(DELAY_IMPORTANCE))))


def hash_hex8(*parts) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5(parts joined by '_').

    Chosen because the same value is computable in any SQL engine
    (md5 + hex parse), so fold and sampling assignments are reproducible.
    """
    cols = [F.lit(str(p)) if isinstance(p, int) else col(p).cast("string") for p in parts]
    s = F.concat_ws("_", *cols)
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hash01(*parts) -> Column:
    """Deterministic uniform number in [0, 1) from `hash_hex8`."""
    return hash_hex8(*parts) / F.lit(4294967296.0)


def days_since(ts, ref: str) -> Column:
    """Whole days from `ref` (yyyy-mm-dd) to the date of `ts` (negative = before)."""
    return F.datediff(F.to_date(col(ts)), F.to_date(F.lit(ref)))


def months_before(ts, ref_year: int, ref_month: int = 12) -> Column:
    """Month offset of `ts` relative to the month of (ref_year, ref_month): -1 = latest."""
    return -((F.lit(ref_year) - F.year(col(ts))) * 12 + F.lit(ref_month) - F.month(col(ts)))

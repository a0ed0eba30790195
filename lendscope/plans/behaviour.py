"""Behavioural external-credit builder (B-3), its false-active variant (B-4),
the delay seriousness score (B-5) and the per-loan features (B-18).

Plan shape
----------
1. monthly rows -> one aggregate per credit (status counts, decayed delay
   score, last non-closed month): partial + final hash aggregate.
2. credits LEFT JOIN that aggregate on the credit id.
3. row-level gaps between consecutive credits (skew-safe `gap_to_previous`).
4. ONE aggregate per applicant for the all-credit spec and the Closed cohort.

The reference computes per-applicant constants (loan count, number of loan
types, debt/credit ratio, ...), merges them back onto every credit and then
averages them again per applicant. The mean of a per-applicant constant over
any non-empty set of that applicant's credits is the constant itself, so those
columns are computed directly in step 4 (guarded to NULL for an empty cohort)
and the self-join disappears.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import delay_seriousness, flag_not_equal, flag_not_negative, safe_div, status_int
from ..functions.scalar import neq_keep_null
from ..operators.aggspec import stat_expr
from ..operators.encode import listed
from ..operators.series import gaps_by_row

# Monthly status codes of the data model, delay codes 1..5.
STATUS_CODES = ["0", "1", "2", "3", "4", "5", "C", "X"]
DELAY_CODES = ["1", "2", "3", "4", "5"]
RATIO_BASES = ["STATUS_INT", "DELAY_SERIOUSITY"] + [f"STATUS_{s}" for s in STATUS_CODES if s != "C"]

# The reference's applicant-level specification (41 entries).
BEHAVIOUR_AGG = {
    "DAYS_CREDIT": ["mean"],
    "CREDIT_DAY_OVERDUE": ["mean", "sum", "max"],
    "DAYS_CREDIT_ENDDATE": ["mean"],
    "DAYS_CREDIT_UPDATE": ["mean", "max"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean", "sum"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "AMT_CREDIT_SUM": ["mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "DELAY_SERIOUSITY_SUM": ["mean", "sum"],
    "STATUS_0_SUM": ["mean", "sum"],
    "STATUS_1_SUM": ["mean", "sum"],
    "STATUS_2_SUM": ["mean", "sum"],
    "STATUS_3_SUM": ["mean", "sum"],
    "STATUS_4_SUM": ["mean", "sum"],
    "STATUS_5_SUM": ["mean", "sum"],
    "STATUS_X_SUM": ["mean", "sum"],
    "ACTIVE_MONTHS": ["mean", "sum", "max"],
    "STATUS_0_RATIO": ["mean"],
    "STATUS_1_RATIO": ["mean"],
    "STATUS_2_RATIO": ["mean"],
    "STATUS_3_RATIO": ["mean"],
    "STATUS_4_RATIO": ["mean"],
    "STATUS_5_RATIO": ["mean"],
    "STATUS_X_RATIO": ["mean"],
    "DELAYED_ONCE_OR_MORE": ["sum", "mean"],
    "DLYED_OOM_RATIO": ["mean"],
    "WEIGHTED_DELAY_SUM": ["mean", "sum"],
    "ACTIVE_LAST_MONTH": ["mean"],
    "BUREAU_LOAN_COUNT": ["mean"],
    "BUREAU_LOAN_TYPE": ["mean"],
    "ACTIVE_LOANS_PERCENTAGE": ["mean"],
    "CREDIT_ENDDATE_PERCENTAGE": ["mean"],
    "AVG_CREDITDAYS_PROLONGED": ["mean"],
    "AVERAGE_LOAN_TYPE": ["mean"],
    "DEBT_CREDIT_RATIO": ["mean"],
    "OVERDUE_DEBT_RATIO": ["mean"],
    "DAYS_DIFF": ["mean"],
    "DAYS_ENDDATE_DIFF": ["mean"],
}


def with_delay_seriousness(hist: DataFrame) -> DataFrame:
    """B-5: STATUS_INT and DELAY_SERIOUSITY = exp(month/12) * STATUS_INT^2 per row."""
    return hist.withColumns({
        "STATUS_INT": status_int("STATUS"),
        "DELAY_SERIOUSITY": delay_seriousness("MONTHS_BALANCE", "STATUS"),
    })


def monthly_behaviour(hist: DataFrame, compat: bool = True) -> DataFrame:
    """Month -> credit roll-up of the behavioural builder.

    `compat=True` reproduces the reference's DELAYED_ONCE_OR_MORE, which counts
    status-2 months twice; `compat=False` counts every delayed month once.
    """
    h = with_delay_seriousness(hist.withColumn("STATUS", listed("STATUS", STATUS_CODES)))
    counts = {f"STATUS_{s}_SUM": F.count(F.when(F.col("STATUS") == s, F.lit(1))) for s in STATUS_CODES}
    agg = h.groupBy("SK_ID_BUREAU").agg(
        *[e.alias(n) for n, e in counts.items()],
        F.count(F.lit(1)).alias("_MONTHS"),
        F.coalesce(F.sum("STATUS_INT"), F.lit(0)).alias("STATUS_INT_SUM"),
        F.coalesce(F.sum("DELAY_SERIOUSITY"), F.lit(0.0)).alias("DELAY_SERIOUSITY_SUM"),
        F.max(F.when(neq_keep_null("STATUS", "C"), F.col("MONTHS_BALANCE"))).alias("ACTIVE_LAST_MONTH"),
    )
    s = {d: F.col(f"STATUS_{d}_SUM") for d in DELAY_CODES}
    delayed = s["1"] + s["2"] + (s["2"] if compat else F.lit(0)) + s["3"] + s["4"] + s["5"]
    agg = agg.withColumn("ACTIVE_MONTHS", F.col("_MONTHS") - F.col("STATUS_C_SUM"))
    agg = agg.withColumns({f"{b}_RATIO": safe_div(f"{b}_SUM", "ACTIVE_MONTHS") for b in RATIO_BASES})
    agg = agg.withColumns({
        "DELAYED_ONCE_OR_MORE": delayed,
        "WEIGHTED_DELAY_SUM": sum((int(d) * s[d] for d in DELAY_CODES), F.lit(0)),
    })
    agg = agg.withColumn("DLYED_OOM_RATIO", safe_div("DELAYED_ONCE_OR_MORE", "ACTIVE_MONTHS"))
    return agg.drop("_MONTHS", "STATUS_C_SUM")


def fix_false_active(loans: DataFrame) -> DataFrame:
    """B-4 / P-11: a credit whose last non-closed month lies in the past but is
    not marked Closed is relabelled Closed (pandas `!=` keeps missing status)."""
    false_active = (F.col("ACTIVE_LAST_MONTH") < 0) & neq_keep_null("CREDIT_ACTIVE", "Closed")
    return loans.withColumn("CREDIT_ACTIVE",
                            F.when(false_active, F.lit("Closed")).otherwise(F.col("CREDIT_ACTIVE")))


def loan_flags(loans: DataFrame) -> DataFrame:
    """K-6/K-7 binaries and K-2 zero fills on the credit rows."""
    return loans.withColumns({
        "CREDIT_ACTIVE_BINARY": flag_not_equal("CREDIT_ACTIVE", "Closed"),
        "CREDIT_ENDDATE_BINARY": flag_not_negative("DAYS_CREDIT_ENDDATE"),
        "AMT_CREDIT_SUM_DEBT": F.coalesce(F.col("AMT_CREDIT_SUM_DEBT"), F.lit(0.0)),
        "AMT_CREDIT_SUM": F.coalesce(F.col("AMT_CREDIT_SUM"), F.lit(0.0)),
        "CNT_CREDIT_PROLONG": F.coalesce(F.col("CNT_CREDIT_PROLONG"), F.lit(0)),
    })


def credit_gaps(credit: DataFrame) -> DataFrame:
    """W-1 DAYS_DIFF (credit dates, newest first) and W-2 DAYS_ENDDATE_DIFF
    (end dates ascending, among credits whose end date is not in the past),
    as a narrow table keyed by SK_ID_BUREAU.

    Both come from one aggregate over (applicant, kind, day) of a four-column projection,
    so the wide credit rows are not shuffled for them. A credit without an entry has gap 0;
    `with_gaps` fills that in."""
    narrow = credit.select("SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE")
    return gaps_by_row(narrow, "SK_ID_CURR", "SK_ID_BUREAU", {
        "DAYS_DIFF": ("DAYS_CREDIT", True, None),
        "DAYS_ENDDATE_DIFF": ("DAYS_CREDIT_ENDDATE", False, flag_not_negative("DAYS_CREDIT_ENDDATE") == 1)})


def with_gaps(loans: DataFrame, credit: DataFrame) -> DataFrame:
    future = flag_not_negative("DAYS_CREDIT_ENDDATE") == 1
    return loans.join(credit_gaps(credit), "SK_ID_BUREAU", "left").withColumns({
        "DAYS_DIFF": F.coalesce(F.col("DAYS_DIFF"), F.lit(0)).cast("bigint"),
        "DAYS_ENDDATE_DIFF": F.when(future, F.coalesce(F.col("DAYS_ENDDATE_DIFF"), F.lit(0))).cast("bigint")})


def applicant_constants(overdue_filled: bool = False) -> dict[str, Column]:
    """Per-applicant aggregates of B-18 (F1, F2, F3, F4, F6, F8, F9, F10).
    `overdue_filled` zero-fills AMT_CREDIT_SUM_OVERDUE (notebook variant)."""
    overdue = F.col("AMT_CREDIT_SUM_OVERDUE")
    if overdue_filled:
        overdue = F.coalesce(overdue, F.lit(0.0))
    count = F.count("DAYS_CREDIT")
    types = F.count_distinct("CREDIT_TYPE")
    debt = F.coalesce(F.sum("AMT_CREDIT_SUM_DEBT"), F.lit(0.0))
    credit = F.coalesce(F.sum("AMT_CREDIT_SUM"), F.lit(0.0))
    over = F.coalesce(F.sum(overdue), F.lit(0.0))
    return {
        "BUREAU_LOAN_COUNT": count,
        "BUREAU_LOAN_TYPE": types,
        "ACTIVE_LOANS_PERCENTAGE": F.avg("CREDIT_ACTIVE_BINARY"),
        "CREDIT_ENDDATE_PERCENTAGE": F.avg("CREDIT_ENDDATE_BINARY"),
        "AVG_CREDITDAYS_PROLONGED": F.avg("CNT_CREDIT_PROLONG"),
        "AVERAGE_LOAN_TYPE": safe_div(count, types),
        "DEBT_CREDIT_RATIO": safe_div(debt, credit),
        "OVERDUE_DEBT_RATIO": safe_div(over, debt),
    }


def behaviour_loans(credit: DataFrame, hist: DataFrame, fix_active: bool = False,
                    compat: bool = True) -> DataFrame:
    """Credit rows with their monthly roll-up, flags, fills and gaps."""
    loans = with_gaps(credit.join(monthly_behaviour(hist, compat), "SK_ID_BUREAU", "left"), credit)
    if fix_active:
        loans = fix_false_active(loans)
    return loan_flags(loans)


def loan_type_counts(credit: DataFrame) -> DataFrame:
    """Distinct credit types per applicant, from distinct (applicant, type)
    pairs. Kept out of the wide aggregate: a COUNT(DISTINCT) there would make
    Spark expand every wide row, and a set aggregate would take the whole
    aggregate out of codegen."""
    pairs = credit.select("SK_ID_CURR", "CREDIT_TYPE").filter(F.col("CREDIT_TYPE").isNotNull()).distinct()
    return pairs.groupBy("SK_ID_CURR").agg(F.count(F.lit(1)).alias("_types"))


def bureau_behaviour(credit: DataFrame, hist: DataFrame, fix_active: bool = False,
                     compat: bool = True, emit_active: bool = False) -> DataFrame:
    """B-3 (and B-4 with `fix_active=True`): one row per applicant with BURO_
    and CLOSED_ columns (`emit_active` adds the ACTIVE_ cohort the reference
    computes but discards)."""
    loans = behaviour_loans(credit, hist, fix_active, compat)
    consts = applicant_constants()
    consts.pop("BUREAU_LOAN_TYPE")
    consts.pop("AVERAGE_LOAN_TYPE")
    cohorts = {"BURO_": None, "CLOSED_": F.col("CREDIT_ACTIVE") == "Closed"}
    if emit_active:
        cohorts["ACTIVE_"] = F.col("CREDIT_ACTIVE") == "Active"
    exprs, post, order = [F.count("DAYS_CREDIT").alias("_count")], {}, []
    for prefix, cond in cohorts.items():
        present = F.lit(True) if cond is None else F.col(f"_has_{prefix}")
        if cond is not None:
            exprs.append((F.count(F.when(cond, F.lit(1))) > 0).alias(f"_has_{prefix}"))
        for c, stats in BEHAVIOUR_AGG.items():
            for s in stats:
                name = f"{prefix}{c}_{s.upper()}"
                order.append(name)
                if c == "BUREAU_LOAN_TYPE":
                    post[name] = F.when(present, F.coalesce(F.col("_types"), F.lit(0)).cast("double"))
                elif c == "AVERAGE_LOAN_TYPE":
                    post[name] = F.when(present, safe_div("_count", F.coalesce(F.col("_types"), F.lit(0))))
                elif c in consts:
                    e = consts[c].cast("double")
                    if cond is not None:
                        e = F.when(F.count(F.when(cond, F.lit(1))) > 0, e)
                    exprs.append(e.alias(name))
                else:
                    exprs.append(stat_expr(c, s, cond).alias(name))
    wide = loans.groupBy("SK_ID_CURR").agg(*exprs)
    out = wide.join(loan_type_counts(credit), "SK_ID_CURR", "left").withColumns(post)
    return out.select("SK_ID_CURR", *order)


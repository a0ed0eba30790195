"""Check queries for the behavioural credit builders (B-3, B-4, B-5, B-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.series import attach_group_stats
from ..plans import behaviour as BH
from ..sources import roles
from .common import finish, query, r, sql_stat
from .sqlroles import INT_COLS, with_roles

# Fixed values, written out once more for the oracle.
_STATUS = ["0", "1", "2", "3", "4", "5", "C", "X"]
_RATIOS = ["STATUS_INT", "DELAY_SERIOUSITY", "STATUS_0", "STATUS_1", "STATUS_2", "STATUS_3", "STATUS_4", "STATUS_5", "STATUS_X"]
_AGG = {
    "DAYS_CREDIT": ["mean"], "CREDIT_DAY_OVERDUE": ["mean", "sum", "max"], "DAYS_CREDIT_ENDDATE": ["mean"],
    "DAYS_CREDIT_UPDATE": ["mean", "max"], "AMT_CREDIT_MAX_OVERDUE": ["mean", "sum"], "CNT_CREDIT_PROLONG": ["sum"],
    "AMT_CREDIT_SUM": ["mean", "sum"], "AMT_CREDIT_SUM_DEBT": ["mean", "sum"], "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"], "AMT_ANNUITY": ["max", "mean"], "DELAY_SERIOUSITY_SUM": ["mean", "sum"],
    "STATUS_0_SUM": ["mean", "sum"], "STATUS_1_SUM": ["mean", "sum"], "STATUS_2_SUM": ["mean", "sum"],
    "STATUS_3_SUM": ["mean", "sum"], "STATUS_4_SUM": ["mean", "sum"], "STATUS_5_SUM": ["mean", "sum"],
    "STATUS_X_SUM": ["mean", "sum"], "ACTIVE_MONTHS": ["mean", "sum", "max"], "STATUS_0_RATIO": ["mean"],
    "STATUS_1_RATIO": ["mean"], "STATUS_2_RATIO": ["mean"], "STATUS_3_RATIO": ["mean"], "STATUS_4_RATIO": ["mean"],
    "STATUS_5_RATIO": ["mean"], "STATUS_X_RATIO": ["mean"], "DELAYED_ONCE_OR_MORE": ["sum", "mean"],
    "DLYED_OOM_RATIO": ["mean"], "WEIGHTED_DELAY_SUM": ["mean", "sum"], "ACTIVE_LAST_MONTH": ["mean"],
    "BUREAU_LOAN_COUNT": ["mean"], "BUREAU_LOAN_TYPE": ["mean"], "ACTIVE_LOANS_PERCENTAGE": ["mean"],
    "CREDIT_ENDDATE_PERCENTAGE": ["mean"], "AVG_CREDITDAYS_PROLONGED": ["mean"], "AVERAGE_LOAN_TYPE": ["mean"],
    "DEBT_CREDIT_RATIO": ["mean"], "OVERDUE_DEBT_RATIO": ["mean"], "DAYS_DIFF": ["mean"],
    "DAYS_ENDDATE_DIFF": ["mean"],
}

# ---- oracle building blocks, in the reference's own structure ------------
_H = """h AS (SELECT *, CASE WHEN STATUS IN ('C', 'X') THEN 0 ELSE CAST(STATUS AS INTEGER) END AS STATUS_INT FROM hist)
, h2 AS (SELECT *, exp(MONTHS_BALANCE / CAST(12 AS DOUBLE)) * power(CAST(STATUS_INT AS DOUBLE), 2) AS DELAY_SERIOUSITY FROM h)"""

_BB = _H + """
, bb AS (SELECT SK_ID_BUREAU, """ + ", ".join(
    f"count(*) FILTER (WHERE STATUS = '{s}') AS STATUS_{s}_SUM" for s in _STATUS) + """,
    count(*) AS n_months,
    CAST(coalesce(sum(STATUS_INT), 0) AS BIGINT) AS STATUS_INT_SUM,
    coalesce(sum(DELAY_SERIOUSITY), 0) AS DELAY_SERIOUSITY_SUM,
    max(CASE WHEN STATUS IS DISTINCT FROM 'C' THEN MONTHS_BALANCE END) AS ACTIVE_LAST_MONTH
  FROM h2 GROUP BY SK_ID_BUREAU)
, bb2 AS (SELECT * EXCLUDE (n_months, STATUS_C_SUM), n_months - STATUS_C_SUM AS ACTIVE_MONTHS,
    STATUS_1_SUM + STATUS_2_SUM + STATUS_2_SUM + STATUS_3_SUM + STATUS_4_SUM + STATUS_5_SUM AS DELAYED_ONCE_OR_MORE,
    1 * STATUS_1_SUM + 2 * STATUS_2_SUM + 3 * STATUS_3_SUM + 4 * STATUS_4_SUM + 5 * STATUS_5_SUM AS WEIGHTED_DELAY_SUM
  FROM bb)
, bb3 AS (SELECT *, """ + ", ".join(
    f"CAST({b}_SUM AS DOUBLE) / nullif(ACTIVE_MONTHS, 0) AS {b}_RATIO" for b in _RATIOS) + """,
    CAST(DELAYED_ONCE_OR_MORE AS DOUBLE) / nullif(ACTIVE_MONTHS, 0) AS DLYED_OOM_RATIO
  FROM bb2)"""

_BB_COLS = ([f"STATUS_{s}_SUM" for s in _STATUS if s != "C"]
            + ["STATUS_INT_SUM", "DELAY_SERIOUSITY_SUM", "ACTIVE_LAST_MONTH", "ACTIVE_MONTHS",
               "DELAYED_ONCE_OR_MORE", "WEIGHTED_DELAY_SUM", "DLYED_OOM_RATIO"]
            + [f"{b}_RATIO" for b in _RATIOS])
_BB_DOUBLES = {"DELAY_SERIOUSITY_SUM", "DLYED_OOM_RATIO"} | {f"{b}_RATIO" for b in _RATIOS}


def _loans_sql(fix_active: bool) -> str:
    relabel = ("CASE WHEN ACTIVE_LAST_MONTH < 0 AND CREDIT_ACTIVE IS DISTINCT FROM 'Closed' THEN 'Closed' "
               "ELSE CREDIT_ACTIVE END") if fix_active else "CREDIT_ACTIVE"
    return _BB + f"""
, loans0 AS (SELECT credit.* REPLACE ({relabel} AS CREDIT_ACTIVE), bb3.* EXCLUDE (SK_ID_BUREAU)
  FROM credit LEFT JOIN bb3 ON credit.SK_ID_BUREAU = bb3.SK_ID_BUREAU)
, loans1 AS (SELECT * REPLACE (coalesce(AMT_CREDIT_SUM_DEBT, 0) AS AMT_CREDIT_SUM_DEBT,
      coalesce(AMT_CREDIT_SUM, 0) AS AMT_CREDIT_SUM, coalesce(CNT_CREDIT_PROLONG, 0) AS CNT_CREDIT_PROLONG),
    CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 ELSE 1 END AS CREDIT_ACTIVE_BINARY,
    CASE WHEN DAYS_CREDIT_ENDDATE < 0 THEN 0 ELSE 1 END AS CREDIT_ENDDATE_BINARY
  FROM loans0)
, per_cust AS (SELECT SK_ID_CURR, count(DAYS_CREDIT) AS BUREAU_LOAN_COUNT,
    count(DISTINCT CREDIT_TYPE) AS BUREAU_LOAN_TYPE,
    avg(CREDIT_ACTIVE_BINARY) AS ACTIVE_LOANS_PERCENTAGE, avg(CREDIT_ENDDATE_BINARY) AS CREDIT_ENDDATE_PERCENTAGE,
    coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS TOTAL_CUSTOMER_DEBT, coalesce(sum(AMT_CREDIT_SUM), 0) AS TOTAL_CUSTOMER_CREDIT,
    coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS TOTAL_CUSTOMER_OVERDUE, avg(CNT_CREDIT_PROLONG) AS AVG_CREDITDAYS_PROLONGED
  FROM loans1 GROUP BY SK_ID_CURR)
, loans2 AS (SELECT loans1.*, p.BUREAU_LOAN_COUNT, p.BUREAU_LOAN_TYPE, p.ACTIVE_LOANS_PERCENTAGE,
    p.CREDIT_ENDDATE_PERCENTAGE, p.AVG_CREDITDAYS_PROLONGED,
    CAST(p.BUREAU_LOAN_COUNT AS DOUBLE) / nullif(p.BUREAU_LOAN_TYPE, 0) AS AVERAGE_LOAN_TYPE,
    p.TOTAL_CUSTOMER_DEBT / nullif(p.TOTAL_CUSTOMER_CREDIT, 0) AS DEBT_CREDIT_RATIO,
    p.TOTAL_CUSTOMER_OVERDUE / nullif(p.TOTAL_CUSTOMER_DEBT, 0) AS OVERDUE_DEBT_RATIO
  FROM loans1 JOIN per_cust p ON loans1.SK_ID_CURR = p.SK_ID_CURR)
, g1 AS (SELECT SK_ID_BUREAU AS id1, coalesce(lag(DAYS_CREDIT) OVER (PARTITION BY SK_ID_CURR
      ORDER BY DAYS_CREDIT DESC NULLS LAST, SK_ID_BUREAU) - DAYS_CREDIT, 0) AS DAYS_DIFF FROM loans2)
, g2 AS (SELECT SK_ID_BUREAU AS id2, coalesce(DAYS_CREDIT_ENDDATE - lag(DAYS_CREDIT_ENDDATE) OVER (PARTITION BY SK_ID_CURR
      ORDER BY DAYS_CREDIT_ENDDATE ASC NULLS LAST, SK_ID_BUREAU), 0) AS DAYS_ENDDATE_DIFF
  FROM loans2 WHERE CREDIT_ENDDATE_BINARY = 1)
, loans AS (SELECT loans2.*, CAST(g1.DAYS_DIFF AS BIGINT) AS DAYS_DIFF, CAST(g2.DAYS_ENDDATE_DIFF AS BIGINT) AS DAYS_ENDDATE_DIFF
  FROM loans2 LEFT JOIN g1 ON loans2.SK_ID_BUREAU = g1.id1 LEFT JOIN g2 ON loans2.SK_ID_BUREAU = g2.id2)"""


_BH_INTS = INT_COLS | {f"STATUS_{s}_SUM" for s in _STATUS} | {
    "STATUS_INT_SUM", "ACTIVE_MONTHS", "DELAYED_ONCE_OR_MORE", "WEIGHTED_DELAY_SUM", "ACTIVE_LAST_MONTH",
    "DAYS_DIFF", "DAYS_ENDDATE_DIFF", "BUREAU_LOAN_COUNT", "BUREAU_LOAN_TYPE"}


def _behaviour_sql(fix_active: bool) -> str:
    def spec(prefix):
        return ", ".join(f"{sql_stat(c, s, c in _BH_INTS)} AS {prefix}{c}_{s.upper()}"
                         for c, stats in _AGG.items() for s in stats)
    return with_roles("credit", "hist") + ", " + _loans_sql(fix_active) + f"""
, buro AS (SELECT SK_ID_CURR, {spec('BURO_')} FROM loans GROUP BY SK_ID_CURR)
, clo AS (SELECT SK_ID_CURR, {spec('CLOSED_')} FROM loans WHERE CREDIT_ACTIVE = 'Closed' GROUP BY SK_ID_CURR)
SELECT buro.*, clo.* EXCLUDE (SK_ID_CURR) FROM buro LEFT JOIN clo ON buro.SK_ID_CURR = clo.SK_ID_CURR"""


@query("bureau_behaviour_full", _behaviour_sql(False))
def bureau_behaviour_full(spark, base):
    """B-3 behavioural credit features (with B-18 per-loan features inside)."""
    return finish(BH.bureau_behaviour(roles.credit(spark, base), roles.history(spark, base)))


@query("bureau_behaviour_false_active", _behaviour_sql(True))
def bureau_behaviour_false_active(spark, base):
    """B-4: B-3 after relabelling falsely active credits as Closed."""
    return finish(BH.bureau_behaviour(roles.credit(spark, base), roles.history(spark, base), fix_active=True))


@query("delay_seriousity", with_roles("hist") + ", " + _H + f"""
SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS, STATUS_INT, {r('DELAY_SERIOUSITY')} AS DELAY_SERIOUSITY FROM h2""")
def delay_seriousity(spark, base):
    """B-5 / W-5 / K-9 / K-10 per monthly row."""
    return finish(BH.with_delay_seriousness(roles.history(spark, base)))


def _bb_select():
    return ", ".join((r(c) if c in _BB_DOUBLES else c) + f" AS {c}" for c in _BB_COLS)


@query("history_behaviour", with_roles("hist") + ", " + _BB + f"\nSELECT SK_ID_BUREAU, {_bb_select()} FROM bb3")
def history_behaviour(spark, base):
    """Month -> credit roll-up: W-4 last non-closed month, A-12 status counts,
    K-11 weighted sum, A-16 ratios."""
    return finish(BH.monthly_behaviour(roles.history(spark, base)))


@query("false_active_fix", with_roles("credit", "hist") + ", " + _BB + """
SELECT c.SK_ID_BUREAU, c.SK_ID_CURR, b.ACTIVE_LAST_MONTH,
  CASE WHEN b.ACTIVE_LAST_MONTH < 0 AND c.CREDIT_ACTIVE IS DISTINCT FROM 'Closed' THEN 'Closed' ELSE c.CREDIT_ACTIVE END AS CREDIT_ACTIVE
FROM credit c LEFT JOIN bb3 b ON c.SK_ID_BUREAU = b.SK_ID_BUREAU""")
def false_active_fix(spark, base):
    """P-11 conditional update of selected rows, F-2 compound predicate."""
    loans = roles.credit(spark, base).select("SK_ID_BUREAU", "SK_ID_CURR", "CREDIT_ACTIVE").join(
        BH.monthly_behaviour(roles.history(spark, base)).select("SK_ID_BUREAU", "ACTIVE_LAST_MONTH"),
        "SK_ID_BUREAU", "left")
    return finish(BH.fix_false_active(loans))


@query("credit_binary_shares", with_roles("credit") + f"""
SELECT SK_ID_CURR,
  {r("avg(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 ELSE 1 END)")} AS ACTIVE_LOANS_PERCENTAGE,
  {r("avg(CASE WHEN DAYS_CREDIT_ENDDATE < 0 THEN 0 ELSE 1 END)")} AS CREDIT_ENDDATE_PERCENTAGE,
  {r("avg(coalesce(CNT_CREDIT_PROLONG, 0))")} AS AVG_CREDITDAYS_PROLONGED
FROM credit GROUP BY SK_ID_CURR""")
def credit_binary_shares(spark, base):
    """K-6/K-7 binaries, K-2 zero fill, A-5 mean per applicant (B-18 F4, F6, F10)."""
    loans = BH.loan_flags(roles.credit(spark, base))
    c = BH.applicant_constants()
    return finish(loans.groupBy("SK_ID_CURR").agg(*[
        c[n].alias(n) for n in ("ACTIVE_LOANS_PERCENTAGE", "CREDIT_ENDDATE_PERCENTAGE", "AVG_CREDITDAYS_PROLONGED")]))


@query("loan_counts_types", with_roles("credit") + f"""
, p AS (SELECT SK_ID_CURR AS k, count(DAYS_CREDIT) AS BUREAU_LOAN_COUNT, count(DISTINCT CREDIT_TYPE) AS BUREAU_LOAN_TYPE
        FROM credit GROUP BY SK_ID_CURR)
SELECT c.SK_ID_BUREAU, c.SK_ID_CURR, p.BUREAU_LOAN_COUNT, p.BUREAU_LOAN_TYPE,
  {r('CAST(p.BUREAU_LOAN_COUNT AS DOUBLE) / nullif(p.BUREAU_LOAN_TYPE, 0)')} AS AVERAGE_LOAN_TYPE
FROM credit c JOIN p ON c.SK_ID_CURR = p.k""")
def loan_counts_types(spark, base):
    """A-3 count, A-4 distinct count, A-16 ratio, J-8 merged back onto every credit (B-18 F1-F3)."""
    loans = roles.credit(spark, base).select("SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT", "CREDIT_TYPE")
    c = BH.applicant_constants()
    out = attach_group_stats(loans, "SK_ID_CURR", {n: c[n] for n in
                                                  ("BUREAU_LOAN_COUNT", "BUREAU_LOAN_TYPE", "AVERAGE_LOAN_TYPE")})
    return finish(out.drop("DAYS_CREDIT", "CREDIT_TYPE"))


@query("days_between_credits", with_roles("credit") + """
SELECT SK_ID_BUREAU, SK_ID_CURR, DAYS_CREDIT,
  CAST(coalesce(lag(DAYS_CREDIT) OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT DESC NULLS LAST, SK_ID_BUREAU)
       - DAYS_CREDIT, 0) AS BIGINT) AS DAYS_DIFF
FROM credit""")
def days_between_credits(spark, base):
    """W-1 gap to the previous credit (newest first), W-6 order within group, J-6 kept per row."""
    loans = roles.credit(spark, base).select("SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT")
    from ..operators.series import gap_to_previous
    out = gap_to_previous(loans, "SK_ID_CURR", "DAYS_CREDIT", "SK_ID_BUREAU", "DAYS_DIFF", descending=True)
    return finish(out.withColumn("DAYS_DIFF", F.col("DAYS_DIFF").cast("bigint")))


@query("future_enddate_gaps", with_roles("credit") + """
, q AS (SELECT SK_ID_BUREAU AS id, coalesce(DAYS_CREDIT_ENDDATE - lag(DAYS_CREDIT_ENDDATE) OVER (
      PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT_ENDDATE ASC NULLS LAST, SK_ID_BUREAU), 0) AS g
  FROM credit WHERE NOT (DAYS_CREDIT_ENDDATE < 0) OR DAYS_CREDIT_ENDDATE IS NULL)
SELECT c.SK_ID_BUREAU, c.SK_ID_CURR, c.DAYS_CREDIT_ENDDATE, CAST(q.g AS BIGINT) AS DAYS_ENDDATE_DIFF
FROM credit c LEFT JOIN q ON c.SK_ID_BUREAU = q.id""")
def future_enddate_gaps(spark, base):
    """W-2 gap over the subset of credits ending in the future (NULL outside it)."""
    loans = BH.loan_flags(roles.credit(spark, base)).select(
        "SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT_ENDDATE", "CREDIT_ENDDATE_BINARY")
    from ..operators.series import gap_to_previous
    out = gap_to_previous(loans, "SK_ID_CURR", "DAYS_CREDIT_ENDDATE", "SK_ID_BUREAU", "DAYS_ENDDATE_DIFF",
                          where=F.col("CREDIT_ENDDATE_BINARY") == 1)
    return finish(out.drop("CREDIT_ENDDATE_BINARY")
                  .withColumn("DAYS_ENDDATE_DIFF", F.col("DAYS_ENDDATE_DIFF").cast("bigint")))


@query("debt_overdue_ratios", with_roles("credit") + f"""
, t AS (SELECT SK_ID_CURR, coalesce(sum(coalesce(AMT_CREDIT_SUM_DEBT, 0)), 0) AS d,
          coalesce(sum(coalesce(AMT_CREDIT_SUM, 0)), 0) AS c, coalesce(sum(coalesce(AMT_CREDIT_SUM_OVERDUE, 0)), 0) AS o
        FROM credit GROUP BY SK_ID_CURR)
SELECT SK_ID_CURR, {r('d')} AS TOTAL_CUSTOMER_DEBT, {r('c')} AS TOTAL_CUSTOMER_CREDIT, {r('o')} AS TOTAL_CUSTOMER_OVERDUE,
  {r('d / nullif(c, 0)')} AS DEBT_CREDIT_RATIO, {r('o / nullif(d, 0)')} AS OVERDUE_DEBT_RATIO FROM t""")
def debt_overdue_ratios(spark, base):
    """A-16 ratio of group sums with K-2 zero fills (B-18 F8, F9 notebook variant)."""
    loans = BH.loan_flags(roles.credit(spark, base))
    c = BH.applicant_constants(overdue_filled=True)
    debt = F.coalesce(F.sum("AMT_CREDIT_SUM_DEBT"), F.lit(0.0))
    cred = F.coalesce(F.sum("AMT_CREDIT_SUM"), F.lit(0.0))
    over = F.coalesce(F.sum(F.coalesce(F.col("AMT_CREDIT_SUM_OVERDUE"), F.lit(0.0))), F.lit(0.0))
    return finish(loans.groupBy("SK_ID_CURR").agg(
        debt.alias("TOTAL_CUSTOMER_DEBT"), cred.alias("TOTAL_CUSTOMER_CREDIT"), over.alias("TOTAL_CUSTOMER_OVERDUE"),
        c["DEBT_CREDIT_RATIO"].alias("DEBT_CREDIT_RATIO"), c["OVERDUE_DEBT_RATIO"].alias("OVERDUE_DEBT_RATIO")))

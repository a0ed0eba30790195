"""Check queries for the child-table builders (B-2 helpers, B-6..B-12) and
the encoding / grouping operators they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggspec import AggSpec
from ..operators.encode import category_long, listed, one_hot
from ..plans import application as A
from ..plans import behaviour as BH
from ..plans import bureau as B
from ..plans import history as HI
from ..plans import wide as WI
from ..sources import roles
from .common import finish, query, r, sql_stat
from .sqlroles import INT_COLS, with_roles

# Fixed values, written out once more for the oracle.
_STATUS = ["0", "1", "2", "3", "4", "5", "C", "X"]
_SENTINEL_DAYS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
                  "DAYS_LAST_DUE", "DAYS_TERMINATION"]
_PREV_AGG = {
    "AMT_ANNUITY": ["max", "mean"], "AMT_APPLICATION": ["max", "mean"], "AMT_CREDIT": ["max", "mean"],
    "APP_CREDIT_PERC": ["max", "mean"], "AMT_DOWN_PAYMENT": ["max", "mean"], "AMT_GOODS_PRICE": ["max", "mean"],
    "HOUR_APPR_PROCESS_START": ["max", "mean"], "RATE_DOWN_PAYMENT": ["max", "mean"],
    "DAYS_DECISION": ["max", "mean"], "CNT_PAYMENT": ["mean", "sum"],
}
_POS_AGG = {
    "MONTHS_BALANCE": ["max", "mean", "size"], "SK_DPD": ["max", "mean"], "SK_DPD_DEF": ["max", "mean"],
}
_INSTAL_AGG = {
    "NUM_INSTALMENT_VERSION": ["nunique"], "DPD": ["max", "mean", "sum"], "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["mean", "var"], "PAYMENT_DIFF": ["mean", "var"], "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"], "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
}
_CARD_STATS = ["max", "mean", "sum", "var"]
PREV_STATUS = ["Approved", "Canceled", "Refused"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAGS = ["A", "N", "R"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _q(n: str) -> str:
    return '"' + n + '"'


def _dummies(col: str, levels, nan: bool = True) -> tuple[list[str], list[str]]:
    exprs = [f"CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS {_q(col + '_' + v)}" for v in levels]
    names = [f"{col}_{v}" for v in levels]
    if nan:
        exprs.append(f"CASE WHEN {col} IS NULL THEN 1 ELSE 0 END AS {_q(col + '_nan')}")
        names.append(f"{col}_nan")
    return exprs, names


def _items(spec: dict, prefix: str, ints: set) -> str:
    return ", ".join(f"{sql_stat(c, s, c in ints, _q(c))} AS {_q(prefix + c + '_' + s.upper())}"
                     for c, stats in spec.items() for s in stats)


def _effective(declared: dict, mean_cols) -> dict:
    spec = {k: list(v) for k, v in declared.items()}
    for c in mean_cols:
        spec[c] = ["mean"]
    return spec


# ------------------------------------------------------------------ B-6
_PREV_NUM = ["AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
             "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "DAYS_DECISION", "CNT_PAYMENT",
             *_SENTINEL_DAYS]


def _prev_sql() -> str:
    d1, n1 = _dummies("NAME_CONTRACT_TYPE", PRIORITIES)
    d2, n2 = _dummies("NAME_CONTRACT_STATUS", PREV_STATUS)
    ints = INT_COLS | set(n1) | set(n2)
    spec = _effective(_PREV_AGG, _PREV_NUM + n1 + n2)
    repl = ", ".join(f"CASE WHEN {c} = 365243 THEN NULL ELSE {c} END AS {c}" for c in _SENTINEL_DAYS)
    return with_roles("prev") + f"""
, p AS (SELECT prev.* EXCLUDE (NAME_CONTRACT_TYPE, NAME_CONTRACT_STATUS) REPLACE ({repl}),
        {', '.join(d1 + d2)}, AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS APP_CREDIT_PERC FROM prev)
, a AS (SELECT SK_ID_CURR, {_items(spec, 'PREV_', ints)} FROM p GROUP BY SK_ID_CURR)
, ap AS (SELECT SK_ID_CURR, {_items(_PREV_AGG, 'APPROVED_', ints)} FROM p WHERE "NAME_CONTRACT_STATUS_Approved" = 1 GROUP BY SK_ID_CURR)
, rf AS (SELECT SK_ID_CURR, {_items(_PREV_AGG, 'REFUSED_', ints)} FROM p WHERE "NAME_CONTRACT_STATUS_Refused" = 1 GROUP BY SK_ID_CURR)
SELECT a.*, ap.* EXCLUDE (SK_ID_CURR), rf.* EXCLUDE (SK_ID_CURR)
FROM a LEFT JOIN ap ON a.SK_ID_CURR = ap.SK_ID_CURR LEFT JOIN rf ON a.SK_ID_CURR = rf.SK_ID_CURR"""


@query("prev_features", _prev_sql())
def prev_features(spark, base):
    """B-6 previous applications (K-14, K-3, K-1, A-11, A-13)."""
    return finish(HI.previous_applications(roles.previous(spark, base)))


# ------------------------------------------------------------------ B-7..B-9
_POS_NUM = ["MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"]


def _pos_sql() -> str:
    d, n = _dummies("NAME_CONTRACT_STATUS", RETURN_FLAGS)
    spec = _effective(_POS_AGG, _POS_NUM + n)
    return with_roles("pos") + f"""
, p AS (SELECT pos.* EXCLUDE (NAME_CONTRACT_STATUS), {', '.join(d)} FROM pos)
SELECT SK_ID_CURR, {_items(spec, 'POS_', INT_COLS | set(n))}, count(*) AS POS_COUNT FROM p GROUP BY SK_ID_CURR"""


@query("pos_features", _pos_sql())
def pos_features(spark, base):
    """B-7 point-of-sale features (A-1, A-2, K-14)."""
    return finish(HI.pos_cash(roles.pos_cash(spark, base)))


@query("pos_changed_contract", with_roles("pos") + f"""
, c AS (SELECT SK_ID_CURR, count(*) AS POS_COUNT FROM pos GROUP BY SK_ID_CURR)
, k AS (SELECT SK_ID_PREV, max(SK_ID_CURR) AS cust,
        CASE WHEN max(CNT_INSTALMENT) = min(CNT_INSTALMENT) THEN 0 ELSE 1 END AS ch FROM pos GROUP BY SK_ID_PREV)
SELECT c.SK_ID_CURR, {r('avg(c.POS_COUNT)')} AS POS_COUNT, {r('avg(k.ch)')} AS POS_CHANGED_CONTRACT
FROM c LEFT JOIN k ON c.SK_ID_CURR = k.cust GROUP BY c.SK_ID_CURR""")
def pos_changed_contract(spark, base):
    """B-8 (A-15 two-level roll-up, K-8 null-aware inequality, J-2 left join then re-group)."""
    return finish(HI.pos_changed_contract(roles.pos_cash(spark, base)))


@query("pos_n_contract", with_roles("pos") + """
SELECT SK_ID_CURR, count(*) AS POS_COUNT, count(DISTINCT SK_ID_PREV) AS POS_N_CONTRACT FROM pos GROUP BY SK_ID_CURR""")
def pos_n_contract(spark, base):
    """B-9 (A-2 group size, A-4 distinct count)."""
    return finish(HI.pos_n_contract(roles.pos_cash(spark, base)))


# ------------------------------------------------------------------ B-10
_INSTAL_RAW = ["NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT",
               "AMT_INSTALMENT", "AMT_PAYMENT"]


def _instal_sql() -> str:
    spec = _effective(_INSTAL_AGG, _INSTAL_RAW)
    return with_roles("instal") + f"""
, i AS (SELECT *, AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
        greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0) AS DPD, greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0) AS DBD
        FROM instal)
SELECT SK_ID_CURR, {_items(spec, 'INSTAL_', INT_COLS)}, count(*) AS INSTAL_COUNT FROM i GROUP BY SK_ID_CURR"""


@query("installment_features", _instal_sql())
def installment_features(spark, base):
    """B-10 instalment features (K-1, K-5 clip, A-1, A-8 variance)."""
    return finish(HI.installments(roles.instalments(spark, base)))


# ------------------------------------------------------------------ B-11
def _card_sql() -> str:
    d, n = _dummies("NAME_CONTRACT_STATUS", EVENT_TYPES)
    cols = ["MONTHS_BALANCE", "AMT_BALANCE", "CNT_DRAWINGS_CURRENT"] + n
    spec = {c: _CARD_STATS for c in cols}
    return with_roles("card") + f"""
, c AS (SELECT card.* EXCLUDE (NAME_CONTRACT_STATUS, SK_ID_PREV), {', '.join(d)} FROM card)
SELECT SK_ID_CURR, {_items(spec, 'CC_', INT_COLS | set(n))}, count(*) AS CC_COUNT FROM c GROUP BY SK_ID_CURR"""


@query("card_all_column_agg", _card_sql())
def card_all_column_agg(spark, base):
    """B-11 (A-10 all numeric columns x statistics, P-3 drop, A-2)."""
    return finish(HI.credit_card(roles.card(spark, base)))


# ------------------------------------------------------------------ B-12
def _assemble_sql() -> str:
    from .application import _application_features_sql
    from .credit import _bureau_full_sql
    parts = [_application_features_sql(), _bureau_full_sql(), _prev_sql(), _pos_sql(), _instal_sql(), _card_sql()]
    sql = f"SELECT * FROM ({parts[0]}) a0"
    for i, p in enumerate(parts[1:], 1):
        sql += f"\nLEFT JOIN ({p}) a{i} USING (SK_ID_CURR)"
    return sql


@query("assemble_wide", _assemble_sql())
def assemble_wide(spark, base):
    """B-12: applicant features left-joined with the five child feature tables."""
    return finish(WI.applicant_table(
        roles.application_train(spark, base), roles.application_test(spark, base), roles.credit(spark, base), roles.history(spark, base),
        roles.previous(spark, base), roles.pos_cash(spark, base), roles.instalments(spark, base), roles.card(spark, base)))


# ------------------------------------------------------------------ A-14 / A-11 / A-12 / J-4
@query("history_rollup", with_roles("app", "credit", "hist") + f"""
, m AS (SELECT SK_ID_BUREAU, count(*) AS n, min(MONTHS_BALANCE) AS lo, max(MONTHS_BALANCE) AS hi FROM hist GROUP BY 1)
, l AS (SELECT c.SK_ID_CURR, c.SK_ID_BUREAU, m.n, m.lo, m.hi FROM credit c LEFT JOIN m ON c.SK_ID_BUREAU = m.SK_ID_BUREAU)
, g AS (SELECT SK_ID_CURR, count(*) AS BURO_CREDITS, CAST(coalesce(sum(n), 0) AS BIGINT) AS BURO_MONTHS_SIZE_SUM,
        {r('avg(n)')} AS BURO_MONTHS_SIZE_MEAN, min(lo) AS BURO_MONTHS_MIN_MIN, max(hi) AS BURO_MONTHS_MAX_MAX
        FROM l GROUP BY 1)
SELECT app.SK_ID_CURR, g.* EXCLUDE (SK_ID_CURR) FROM app LEFT JOIN g ON app.SK_ID_CURR = g.SK_ID_CURR""")
def history_rollup(spark, base):
    """A-14 month -> credit -> applicant roll-up, J-1 left joins, J-5 count in the same aggregate."""
    months = roles.history(spark, base).groupBy("SK_ID_BUREAU").agg(
        F.count(F.lit(1)).alias("n"), F.min("MONTHS_BALANCE").alias("lo"), F.max("MONTHS_BALANCE").alias("hi"))
    loans = roles.credit(spark, base).select("SK_ID_CURR", "SK_ID_BUREAU").join(months, "SK_ID_BUREAU", "left")
    per = loans.groupBy("SK_ID_CURR").agg(
        F.count(F.lit(1)).alias("BURO_CREDITS"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("BURO_MONTHS_SIZE_SUM"),
        F.avg("n").alias("BURO_MONTHS_SIZE_MEAN"),
        F.min("lo").alias("BURO_MONTHS_MIN_MIN"), F.max("hi").alias("BURO_MONTHS_MAX_MAX"))
    return finish(roles.application(spark, base).select("SK_ID_CURR").join(per, "SK_ID_CURR", "left"))


@query("category_share", with_roles("credit") + ", s AS (SELECT SK_ID_CURR, " + ", ".join(
    [f"{r(f'avg(CASE WHEN CREDIT_TYPE = {chr(39) + v + chr(39)} THEN 1 ELSE 0 END)')} AS {_q('CREDIT_TYPE_' + v + '_MEAN')}"
     for v in PRIORITIES] + [f"{r('avg(CASE WHEN CREDIT_TYPE IS NULL THEN 1 ELSE 0 END)')} AS CREDIT_TYPE_nan_MEAN"])
    + " FROM credit GROUP BY SK_ID_CURR) SELECT * FROM s")
def category_share(spark, base):
    """A-11: one-hot mean = share of each category per applicant (dummies fused into the aggregate)."""
    oh, names = one_hot(roles.credit(spark, base).select("SK_ID_CURR", "CREDIT_TYPE"), ["CREDIT_TYPE"], dummy_na=True)
    return finish(oh.groupBy("SK_ID_CURR").agg(*AggSpec.every(names, ["mean"]).exprs()))


@query("category_counts", with_roles("hist") + "SELECT SK_ID_BUREAU, " + ", ".join(
    f"count(*) FILTER (WHERE STATUS = '{s}') AS STATUS_{s}_COUNT" for s in _STATUS)
    + " FROM hist GROUP BY SK_ID_BUREAU")
def category_counts(spark, base):
    """A-12: count of each category per credit via pivot over a fixed vocabulary (no discovery job)."""
    months = roles.history(spark, base).withColumn("STATUS", listed("STATUS", BH.STATUS_CODES))
    p = months.groupBy("SK_ID_BUREAU").pivot("STATUS", BH.STATUS_CODES).count().na.fill(0)
    return finish(p.withColumnsRenamed({s: f"STATUS_{s}_COUNT" for s in BH.STATUS_CODES}))   # P-4 rename by map


@query("category_long", with_roles("credit") + """
, l AS (SELECT SK_ID_CURR, 'CREDIT_TYPE' AS "column", CREDIT_TYPE AS value FROM credit
        UNION ALL SELECT SK_ID_CURR, 'CREDIT_ACTIVE', CREDIT_ACTIVE FROM credit)
, n AS (SELECT SK_ID_CURR, count(*) AS n FROM credit GROUP BY SK_ID_CURR)
SELECT l.SK_ID_CURR, l."column", l.value, count(*) AS count, """ + r("count(*) / any_value(n.n)") + """ AS share
FROM l JOIN n ON n.SK_ID_CURR = l.SK_ID_CURR GROUP BY 1, 2, 3""")
def category_long_q(spark, base):
    """A-11, A-12 as rows, for columns with too many levels for dummy columns."""
    credit = roles.credit(spark, base).select("SK_ID_CURR", "CREDIT_TYPE", "CREDIT_ACTIVE")
    return finish(category_long(credit, "SK_ID_CURR"))


@query("semi_join_latest_status", with_roles("credit", "hist") + """
SELECT STATUS, count(SK_ID_BUREAU) AS N_MONTHS, count(DISTINCT SK_ID_BUREAU) AS N_CREDITS
FROM hist WHERE SK_ID_BUREAU IN (SELECT SK_ID_BUREAU FROM credit WHERE CREDIT_ACTIVE = 'Active')
GROUP BY STATUS""")
def semi_join_latest_status(spark, base):
    """J-4 semi join (isin), A-22 count per category of the monthly rows of active credits."""
    active = roles.credit(spark, base).filter(F.col("CREDIT_ACTIVE") == "Active").select("SK_ID_BUREAU")
    months = roles.history(spark, base).join(active, "SK_ID_BUREAU", "left_semi")
    return finish(months.groupBy("STATUS").agg(F.count("SK_ID_BUREAU").alias("N_MONTHS"),
                                               F.count_distinct("SK_ID_BUREAU").alias("N_CREDITS")))


# ------------------------------------------------------------------ K-14 / K-15
_CREDIT_STR = {"CREDIT_ACTIVE": ["Active", "Closed", "Sold"], "CREDIT_CURRENCY": ["currency 1", "currency 2"],
               "CREDIT_TYPE": PRIORITIES}


def _one_hot_sql() -> str:
    exprs = []
    for c, lv in _CREDIT_STR.items():
        exprs += _dummies(c, lv)[0]
    return with_roles("credit") + f"SELECT SK_ID_BUREAU, SK_ID_CURR, {', '.join(exprs)} FROM credit"


@query("one_hot_encode", _one_hot_sql())
def one_hot_encode(spark, base):
    """K-14 one-hot of every string column (P-7 select by type) with a NaN indicator."""
    df = roles.credit(spark, base).select("SK_ID_BUREAU", "SK_ID_CURR", *_CREDIT_STR)
    return finish(one_hot(df, None, dummy_na=True)[0])


@query("one_hot_listed", with_roles("credit") + "SELECT SK_ID_BUREAU, CREDIT_ACTIVE, CREDIT_CURRENCY, "
       + ", ".join(_dummies("CREDIT_TYPE", PRIORITIES, nan=False)[0]) + " FROM credit")
def one_hot_listed(spark, base):
    """K-15 one-hot restricted to listed columns, no NaN indicator."""
    df = roles.credit(spark, base).select("SK_ID_BUREAU", *_CREDIT_STR)
    return finish(one_hot(df, ["CREDIT_TYPE"], dummy_na=False)[0])

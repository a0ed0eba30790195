"""Check queries over the external-credit roles (credit, hist)."""

from __future__ import annotations

from ..plans import bureau as B
from ..sources import roles
from .common import finish, query, sql_spec, sql_stat
from .sqlroles import INT_COLS, with_roles

# ---------------------------------------------------------------- flagship

_S = {"SK_ID_BUREAU": ["size"], "DAYS_CREDIT": ["mean", "var", "min", "max"], "AMT_CREDIT_SUM": ["mean", "sum", "max"],
      "AMT_CREDIT_SUM_DEBT": ["mean", "sum"], "CNT_CREDIT_PROLONG": ["sum", "count"]}


def _summary_sql() -> str:
    base = ", ".join(sql_spec(_S, "BURO_"))
    act = ", ".join(sql_spec(_S, "ACTIVE_"))
    clo = ", ".join(sql_spec(_S, "CLOSED_"))
    return with_roles("app", "credit") + f"""
, b AS (SELECT SK_ID_CURR, {base} FROM credit GROUP BY SK_ID_CURR)
, a AS (SELECT SK_ID_CURR, {act} FROM credit WHERE CREDIT_ACTIVE = 'Active' GROUP BY SK_ID_CURR)
, c AS (SELECT SK_ID_CURR, {clo} FROM credit WHERE CREDIT_ACTIVE = 'Closed' GROUP BY SK_ID_CURR)
SELECT app.SK_ID_CURR, b.* EXCLUDE (SK_ID_CURR), a.* EXCLUDE (SK_ID_CURR), c.* EXCLUDE (SK_ID_CURR)
FROM app LEFT JOIN b ON app.SK_ID_CURR = b.SK_ID_CURR
LEFT JOIN a ON app.SK_ID_CURR = a.SK_ID_CURR
LEFT JOIN c ON app.SK_ID_CURR = c.SK_ID_CURR"""


@query("credit_cohort_agg", _summary_sql())
def credit_cohort_agg(spark, base):
    return finish(B.credit_summary(roles.credit(spark, base), roles.application(spark, base)))


# ---------------------------------------------------------------- B-2

_STATUS = ["0", "1", "2", "3", "4", "5", "C", "X"]
_CREDIT_CATS = {
    "CREDIT_ACTIVE": ["Active", "Closed", "Sold"],
    "CREDIT_CURRENCY": ["currency 1", "currency 2"],
    "CREDIT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}
# The declared statistics once more, as the oracle's own values.
_DECLARED = {
    "DAYS_CREDIT": ["mean", "var"], "DAYS_CREDIT_ENDDATE": ["mean"], "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["mean"], "AMT_CREDIT_MAX_OVERDUE": ["mean"], "AMT_CREDIT_SUM": ["mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"], "AMT_CREDIT_SUM_OVERDUE": ["mean"], "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"], "CNT_CREDIT_PROLONG": ["sum"], "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"], "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
_CREDIT_NUM = ["DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT",
               "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM",
               "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE",
               "DAYS_CREDIT_UPDATE", "AMT_ANNUITY"]


def _q(name: str) -> str:
    return '"' + name + '"'


def _dummy_sql(col: str, levels: list[str], as_double: bool = False) -> list[str]:
    one, zero = ("CAST(1 AS DOUBLE)", "CAST(0 AS DOUBLE)") if as_double else ("1", "0")
    out = [f"CASE WHEN {col} = '{v}' THEN {one} ELSE {zero} END AS {_q(col + '_' + v)}" for v in levels]
    out.append(f"CASE WHEN {col} IS NULL THEN {one} ELSE {zero} END AS {_q(col + '_nan')}")
    return out


def _bureau_full_sql(union: bool = False) -> str:
    status_means = [f"avg(CASE WHEN STATUS = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS STATUS_{v}_MEAN"
                    for v in _STATUS]
    status_means.append("avg(CASE WHEN STATUS IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS STATUS_nan_MEAN")
    dummies = []
    dummy_names = []
    for c, lv in _CREDIT_CATS.items():
        dummies += _dummy_sql(c, lv)
        dummy_names += [f"{c}_{v}" for v in lv] + [f"{c}_nan"]
    # Effective BURO_ spec: declared numeric spec overridden by mean-of-everything (or joined with it).
    spec = {k: list(v) for k, v in _DECLARED.items()}
    for c in _CREDIT_NUM + dummy_names + [f"STATUS_{v}_MEAN" for v in _STATUS] + ["STATUS_nan_MEAN", "MONTHS_BALANCE_MEAN"]:
        spec[c] = list(dict.fromkeys([*spec.get(c, []), "mean"])) if union else ["mean"]
    ints = INT_COLS | {"MONTHS_BALANCE_MIN", "MONTHS_BALANCE_MAX", "MONTHS_BALANCE_SIZE"} | set(dummy_names)
    buro = ", ".join(f"{sql_stat(k, s, k in ints, _q(k))} AS {_q('BURO_' + k + '_' + s.upper())}"
                     for k, stats in spec.items() for s in stats)
    act = ", ".join(sql_spec(_DECLARED, "ACTIVE_", ints))
    clo = ", ".join(sql_spec(_DECLARED, "CLOSED_", ints))
    return with_roles("credit", "hist") + f"""
, bb AS (SELECT SK_ID_BUREAU, {', '.join(status_means)},
         min(MONTHS_BALANCE) AS MONTHS_BALANCE_MIN, max(MONTHS_BALANCE) AS MONTHS_BALANCE_MAX,
         count(*) AS MONTHS_BALANCE_SIZE, avg(MONTHS_BALANCE) AS MONTHS_BALANCE_MEAN
         FROM hist GROUP BY SK_ID_BUREAU)
, loans AS (SELECT credit.*, {', '.join(dummies)}, bb.* EXCLUDE (SK_ID_BUREAU)
            FROM credit LEFT JOIN bb ON credit.SK_ID_BUREAU = bb.SK_ID_BUREAU)
, buro AS (SELECT SK_ID_CURR, {buro} FROM loans GROUP BY SK_ID_CURR)
, act AS (SELECT SK_ID_CURR, {act} FROM loans WHERE "CREDIT_ACTIVE_Active" = 1 GROUP BY SK_ID_CURR)
, clo AS (SELECT SK_ID_CURR, {clo} FROM loans WHERE "CREDIT_ACTIVE_Closed" = 1 GROUP BY SK_ID_CURR)
SELECT buro.*, act.* EXCLUDE (SK_ID_CURR), clo.* EXCLUDE (SK_ID_CURR)
FROM buro LEFT JOIN act ON buro.SK_ID_CURR = act.SK_ID_CURR
LEFT JOIN clo ON buro.SK_ID_CURR = clo.SK_ID_CURR"""


@query("bureau_full", _bureau_full_sql())
def bureau_full(spark, base):
    return finish(B.bureau_and_balance(roles.credit(spark, base), roles.history(spark, base)))


@query("bureau_union", _bureau_full_sql(union=True))
def bureau_union(spark, base):
    """B-2 with `policy="union"`: the declared statistics beside the means."""
    return finish(B.bureau_and_balance(roles.credit(spark, base), roles.history(spark, base), policy="union"))

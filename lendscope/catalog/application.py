"""Check queries over the applicant role (B-1, B-19 and their operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sentinel_to_zero
from ..operators.encode import label_encode, lookup_join
from ..plans import application as A
from ..sources import roles
from .common import finish, query, r
from .sqlroles import with_roles


def _cleaned(spark, base):
    return A.clean(A.union_train_test(roles.application_train(spark, base),
                                      roles.application_test(spark, base)))


# SQL: the cleaned applicant union (XNA dropped, NULL gender kept, sentinel -> NULL).
_CLEAN = """c AS (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED)
         FROM app WHERE CODE_GENDER IS DISTINCT FROM 'XNA')"""

_DOCS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
_LIVE = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"]
_EXT = "list_value(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)"
_APP_DOUBLES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "OWN_CAR_AGE",
                "DAYS_LAST_PHONE_CHANGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def _div(a: str, b: str) -> str:
    return r(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)")


_RATIOS = {
    "NEW_CREDIT_TO_ANNUITY_RATIO": ("AMT_CREDIT", "AMT_ANNUITY"),
    "NEW_CREDIT_TO_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "NEW_CREDIT_TO_INC_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "NEW_INC_CHI": ("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)"),
    "NEW_EMPLOY_TO_BIRTH_RATIO": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "NEW_ANNUITY_TO_INCOME_RATIO": ("AMT_ANNUITY", "(1 + AMT_INCOME_TOTAL)"),
    "NEW_CAR_TO_BIRTH_RATIO": ("OWN_CAR_AGE", "DAYS_BIRTH"),
    "NEW_CAR_TO_EMPLOY_RATIO": ("OWN_CAR_AGE", "DAYS_EMPLOYED"),
    "NEW_PHONE_TO_BIRTH_RATIO": ("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "NEW_PHONE_TO_BIRTH_RATIO_EMPLOYER": ("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    "NEW_CREDIT_TO_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "NEW_ANNUAL_PAYMENT": ("AMT_CREDIT", "(36500 + DAYS_BIRTH)"),
}
_RATIO_SQL = ",\n  ".join(f"{_div(a, b)} AS {n}" for n, (a, b) in _RATIOS.items())

_KURT = f"""CASE WHEN list_count(list_value({', '.join(_DOCS)})) < 4 THEN NULL
     WHEN list_aggregate(list_value({', '.join(_DOCS)}), 'var_pop') = 0 THEN CAST(0 AS DOUBLE)
     ELSE list_aggregate(list_value({', '.join(_DOCS)}), 'kurtosis') END"""

_ROWSTATS = {
    "NEW_DOC_IND_KURT": r(_KURT),
    "NEW_LIVE_IND_SUM": r("CAST(" + " + ".join(f"coalesce({c}, 0)" for c in _LIVE) + " AS DOUBLE)"),
    "NEW_SOURCES_PROD": r("EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3"),
    "NEW_EXT_SOURCES_MEAN": r(f"list_aggregate({_EXT}, 'avg')"),
    "NEW_SCORES_STD": r(f"list_aggregate({_EXT}, 'stddev_samp')"),
    "NDOC": " + ".join(_DOCS),
}
_ROW_SQL = ",\n  ".join(f"{e} AS {n}" for n, e in _ROWSTATS.items())


@query("app_union_clean", with_roles("app") + """
SELECT SK_ID_CURR, TARGET, CODE_GENDER,
  CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED,
  CASE WHEN DAYS_EMPLOYED = 365243 THEN 0 ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED_ZERO,
  CAST(TARGET IS NOT NULL AS INTEGER) AS IS_TRAIN
FROM app WHERE CODE_GENDER IS DISTINCT FROM 'XNA'""")
def app_union_clean(spark, base):
    """U-1 union by name, F-1 NULL-keeping filter, K-3/K-4 sentinels, F-9 split flag, P-3 drop."""
    u = A.union_train_test(roles.application_train(spark, base), roles.application_test(spark, base))
    u = u.withColumn("DAYS_EMPLOYED_ZERO", sentinel_to_zero("DAYS_EMPLOYED"))
    c = A.clean(u).withColumn("IS_TRAIN", F.col("TARGET").isNotNull().cast("int"))
    keep = {"SK_ID_CURR", "TARGET", "CODE_GENDER", "DAYS_EMPLOYED", "DAYS_EMPLOYED_ZERO", "IS_TRAIN"}
    return finish(c.drop(*[x for x in c.columns if x not in keep]))


@query("app_ratio_features", with_roles("app", extra=_CLEAN) + f"SELECT SK_ID_CURR,\n  {_RATIO_SQL}\nFROM c")
def app_ratio_features(spark, base):
    df = _cleaned(spark, base)
    return finish(df.select("SK_ID_CURR", *[e.alias(n) for n, e in A.ratio_features(df).items()]))


@query("app_row_stats", with_roles("app", extra=_CLEAN) + f"SELECT SK_ID_CURR,\n  {_ROW_SQL}\nFROM c")
def app_row_stats(spark, base):
    df = A.with_row_features(_cleaned(spark, base))
    return finish(df.select("SK_ID_CURR", *A.ROW_FEATURES))


@query("app_std_fill_global_mean", with_roles("app", extra=_CLEAN) + f"""
, s AS (SELECT SK_ID_CURR, list_aggregate({_EXT}, 'stddev_samp') AS sd FROM c)
SELECT SK_ID_CURR, {r('coalesce(sd, (SELECT avg(sd) FROM s))')} AS NEW_SCORES_STD FROM s""")
def app_std_fill_global_mean(spark, base):
    df = A.with_row_features(_cleaned(spark, base)).select("SK_ID_CURR", "NEW_SCORES_STD")
    return finish(A.fill_with_global_mean(df, "NEW_SCORES_STD"))


@query("income_by_org_median", with_roles("app", extra=_CLEAN) + f"""
, m AS (SELECT ORGANIZATION_TYPE, median(AMT_INCOME_TOTAL) AS med FROM c GROUP BY ORGANIZATION_TYPE)
SELECT c.SK_ID_CURR, c.ORGANIZATION_TYPE, {r('m.med')} AS NEW_INC_BY_ORG,
       {r('c.AMT_INCOME_TOTAL / nullif(m.med, 0)')} AS INCOME_TO_ORG_MEDIAN
FROM c LEFT JOIN m ON c.ORGANIZATION_TYPE = m.ORGANIZATION_TYPE""")
def income_by_org_median(spark, base):
    """A-9 median per group, J-3 lookup join, J-7 row value over its group's median."""
    df = _cleaned(spark, base).select("SK_ID_CURR", "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL")
    med = A.median_by(df, "AMT_INCOME_TOTAL", "ORGANIZATION_TYPE", "NEW_INC_BY_ORG")
    out = lookup_join(df, med, ["ORGANIZATION_TYPE"]).select(
        "SK_ID_CURR", "ORGANIZATION_TYPE", "NEW_INC_BY_ORG",
        F.try_divide(F.col("AMT_INCOME_TOTAL"), F.col("NEW_INC_BY_ORG")).alias("INCOME_TO_ORG_MEDIAN"))
    return finish(out)


def _label_sql(cols):
    ctes, sel, joins = [], [], []
    for i, c in enumerate(cols):
        ctes.append(f"v{i} AS (SELECT {c} AS val, row_number() OVER (ORDER BY {c}) - 1 AS code "
                    f"FROM (SELECT DISTINCT {c} FROM c WHERE {c} IS NOT NULL))")
        sel.append(f"CASE WHEN c.{c} IS NULL THEN CAST(-1 AS BIGINT) ELSE v{i}.code END AS {c}")
        joins.append(f"LEFT JOIN v{i} ON c.{c} = v{i}.val")
    return (with_roles("app", extra=_CLEAN) + ", " + ", ".join(ctes)
            + f"\nSELECT c.SK_ID_CURR, {', '.join(sel)} FROM c " + " ".join(joins))


@query("label_encode", _label_sql(A.LABEL_ENCODED))
def label_encode_q(spark, base):
    """K-13 stable label codes (sorted vocabulary, missing -> -1)."""
    df = _cleaned(spark, base).select("SK_ID_CURR", *A.LABEL_ENCODED)
    return finish(label_encode(df, A.LABEL_ENCODED))


def _application_features_sql(nan: bool = False) -> str:
    dropped = ", ".join(f"FLAG_DOCUMENT_{i}" for i in range(2, 22) if i != 3)
    lab = []
    for c in A.LABEL_ENCODED:
        lab.append(f"(SELECT count(DISTINCT x.{c}) FROM c x WHERE x.{c} < f.{c}) AS {c}")
    nans = "" if not nan else ",\n  " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_nan" for c in ("NAME_CONTRACT_TYPE", "ORGANIZATION_TYPE"))
    return with_roles("app", extra=_CLEAN) + f"""
, m AS (SELECT ORGANIZATION_TYPE AS org, median(AMT_INCOME_TOTAL) AS NEW_INC_BY_ORG FROM c GROUP BY 1)
, f AS (SELECT c.*,
  {_RATIO_SQL},
  {_ROW_SQL.replace(r(f"list_aggregate({_EXT}, 'stddev_samp')") + " AS NEW_SCORES_STD", f"list_aggregate({_EXT}, 'stddev_samp') AS NEW_SCORES_STD")},
  {r('m.NEW_INC_BY_ORG')} AS NEW_INC_BY_ORG,
  {r("CAST(AMT_INCOME_TOTAL AS DOUBLE) / nullif(CAST(AMT_CREDIT AS DOUBLE) / nullif(CAST(36500 + DAYS_BIRTH AS DOUBLE), 0), 0)")} AS NEW_ANNUAL_PERCENT
  FROM c LEFT JOIN m ON c.ORGANIZATION_TYPE = m.org)
, g AS (SELECT f.* REPLACE ({r('coalesce(NEW_SCORES_STD, (SELECT avg(NEW_SCORES_STD) FROM f))')} AS NEW_SCORES_STD,
  CASE WHEN CODE_GENDER IS NULL THEN -1 ELSE (SELECT count(DISTINCT x.CODE_GENDER) FROM c x WHERE x.CODE_GENDER < f.CODE_GENDER) END AS CODE_GENDER,
  CASE WHEN FLAG_OWN_CAR IS NULL THEN -1 ELSE (SELECT count(DISTINCT x.FLAG_OWN_CAR) FROM c x WHERE x.FLAG_OWN_CAR < f.FLAG_OWN_CAR) END AS FLAG_OWN_CAR,
  CASE WHEN FLAG_OWN_REALTY IS NULL THEN -1 ELSE (SELECT count(DISTINCT x.FLAG_OWN_REALTY) FROM c x WHERE x.FLAG_OWN_REALTY < f.FLAG_OWN_REALTY) END AS FLAG_OWN_REALTY)
  FROM f)
SELECT g.* EXCLUDE ({dropped}, NAME_CONTRACT_TYPE, ORGANIZATION_TYPE)
     REPLACE ({', '.join(r(x) + ' AS ' + x for x in _APP_DOUBLES)}),
  CASE WHEN NAME_CONTRACT_TYPE = 'Cash loans' THEN 1 ELSE 0 END AS "NAME_CONTRACT_TYPE_Cash loans",
  CASE WHEN NAME_CONTRACT_TYPE = 'Revolving loans' THEN 1 ELSE 0 END AS "NAME_CONTRACT_TYPE_Revolving loans",
  CASE WHEN ORGANIZATION_TYPE = 'AUTOMOBILE' THEN 1 ELSE 0 END AS ORGANIZATION_TYPE_AUTOMOBILE,
  CASE WHEN ORGANIZATION_TYPE = 'BUILDING' THEN 1 ELSE 0 END AS ORGANIZATION_TYPE_BUILDING,
  CASE WHEN ORGANIZATION_TYPE = 'FURNITURE' THEN 1 ELSE 0 END AS ORGANIZATION_TYPE_FURNITURE,
  CASE WHEN ORGANIZATION_TYPE = 'HOUSEHOLD' THEN 1 ELSE 0 END AS ORGANIZATION_TYPE_HOUSEHOLD,
  CASE WHEN ORGANIZATION_TYPE = 'MACHINERY' THEN 1 ELSE 0 END AS ORGANIZATION_TYPE_MACHINERY{nans}
FROM g"""


@query("application_features", _application_features_sql())
def application_features(spark, base):
    """B-1 full applicant builder."""
    return finish(A.application_features(roles.application_train(spark, base),
                                         roles.application_test(spark, base)))


@query("application_nan_category", _application_features_sql(nan=True))
def application_nan_category(spark, base):
    """B-1 with `nan_as_category=True`: a `_nan` indicator per one-hot column."""
    return finish(A.application_features(roles.application_train(spark, base), roles.application_test(spark, base),
                                         nan_as_category=True))


@query("pd_nine_variables", with_roles("app") + f"""
, t AS (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED = 365243 THEN 0 ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED)
        FROM app WHERE TARGET IS NOT NULL AND AMT_GOODS_PRICE IS NOT NULL AND AMT_ANNUITY IS NOT NULL)
, reg AS (SELECT REGION_POPULATION_RELATIVE AS k, avg(TARGET) AS m FROM t GROUP BY 1)
, org AS (SELECT ORGANIZATION_TYPE AS k, avg(TARGET) AS m FROM t GROUP BY 1)
SELECT SK_ID_CURR, TARGET, DAYS_EMPLOYED,
  {_div('AMT_CREDIT', 'AMT_INCOME_TOTAL')} AS CREDIT_INCOME_RATIO,
  {_div('AMT_CREDIT', 'AMT_GOODS_PRICE')} AS CREDIT_GOODS_RATIO,
  {_div('AMT_CREDIT', 'AMT_ANNUITY')} AS CREDIT_ANNUITY_RATIO,
  {r('reg.m')} AS REGION_TARGET_ENCODED, DAYS_BIRTH,
  {_div('DAYS_EMPLOYED', 'DAYS_BIRTH')} AS EMPLOYED_BIRTH_RATIO, DAYS_ID_PUBLISH,
  {r('org.m')} AS ORGANIZATION_TARGET_ENCODED
FROM t LEFT JOIN reg ON t.REGION_POPULATION_RELATIVE = reg.k LEFT JOIN org ON t.ORGANIZATION_TYPE = org.k""")
def pd_nine_variables(spark, base):
    """B-19 (F-4 dropna on a subset, K-4, K-17 target encoding fit+transform)."""
    return finish(A.pd_dataset(roles.application_train(spark, base)))

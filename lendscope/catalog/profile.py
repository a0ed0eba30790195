"""Check queries for profiling (A-17..A-25, B-17), filters (F-5..F-7),
sorting / top-k / sampling (L-1..L-6) and sources / sinks (S-1..S-7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import hash_hex8
from ..operators import evaluation as EV
from ..operators import profile as PR
from ..session import checkpoint_path
from ..sources import roles, tables
from .common import finish, query, r
from .sqlroles import with_roles

# Every column of the two roles, written out as the oracle's own list.
_APP_COLS = ["SK_ID_CURR", "TARGET", "NAME_CONTRACT_TYPE", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "CNT_CHILDREN",
             "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "ORGANIZATION_TYPE",
             "REGION_POPULATION_RELATIVE", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "OWN_CAR_AGE",
             "DAYS_LAST_PHONE_CHANGE", "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE",
             "FLAG_EMAIL", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", *[f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]]
_CREDIT_COLS = ["SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", "CREDIT_CURRENCY", "DAYS_CREDIT", "CREDIT_DAY_OVERDUE",
                "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG",
                "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE",
                "CREDIT_TYPE", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY"]


def _null_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column, {r(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} "
        f"AS null_ratio FROM {table}" for c in cols)


@query("null_profile", with_roles("app", "credit") + "SELECT * FROM (" + _null_sql("app", _APP_COLS)
       + " UNION ALL " + _null_sql("credit", _CREDIT_COLS) + ") WHERE null_ratio > 0")
def null_profile(spark, base):
    """A-18 / B-17: share of missing values of every column that has any."""
    app, cr = PR.null_ratios(roles.application(spark, base)), PR.null_ratios(roles.credit(spark, base))
    return finish(app.select(F.lit("app").alias("table_name"), "*")
                  .unionByName(cr.select(F.lit("credit").alias("table_name"), "*")))


@query("value_counts", with_roles("credit") + """
SELECT CREDIT_TYPE, count(*) AS count FROM credit WHERE CREDIT_TYPE IS NOT NULL GROUP BY CREDIT_TYPE""")
def value_counts(spark, base):
    """A-19 value counts (missing dropped)."""
    return finish(PR.value_counts(roles.credit(spark, base), "CREDIT_TYPE"))


@query("binarised_counts", with_roles("credit") + """
SELECT CASE WHEN CREDIT_DAY_OVERDUE = 0 THEN 0 ELSE 1 END AS is_nonzero, count(*) AS count FROM credit GROUP BY 1""")
def binarised_counts(spark, base):
    """A-20 counts of (x != 0), missing counted as non-zero."""
    return finish(PR.binarised_counts(roles.credit(spark, base), "CREDIT_DAY_OVERDUE"))


@query("distinct_profile", with_roles("credit") + "SELECT DISTINCT CNT_CREDIT_PROLONG FROM credit")
def distinct_profile(spark, base):
    """A-25 / U-3 distinct values, NULL included as a value."""
    return finish(PR.distinct_values(roles.credit(spark, base), "CNT_CREDIT_PROLONG"))


@query("count_of_counts", with_roles("pos") + """
SELECT rows_per_key, count(*) AS n_keys FROM (SELECT SK_ID_PREV, count(*) AS rows_per_key FROM pos GROUP BY 1) GROUP BY 1""")
def count_of_counts(spark, base):
    """A-21 distribution of monthly rows per contract."""
    return finish(PR.count_of_counts(roles.pos_cash(spark, base), "SK_ID_PREV"))


@query("category_row_counts", with_roles("credit") + """
SELECT CREDIT_ACTIVE, count(SK_ID_BUREAU) AS count FROM credit GROUP BY CREDIT_ACTIVE""")
def category_row_counts(spark, base):
    """A-22 ids per category (bar-chart data)."""
    return finish(PR.category_counts(roles.credit(spark, base), "CREDIT_ACTIVE", "SK_ID_BUREAU"))


@query("histogram_bins", with_roles("credit") + f"""
, mm AS (SELECT min(AMT_CREDIT_SUM) AS lo, max(AMT_CREDIT_SUM) AS hi FROM credit)
, b AS (SELECT CAST(least(floor((AMT_CREDIT_SUM - lo) * 100 / (hi - lo)), 99) AS INTEGER) AS bin, lo, hi FROM credit, mm)
SELECT bin, {r('any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 100')} AS lower,
       {r('any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 100')} AS upper, count(*) AS count
FROM b GROUP BY bin""")
def histogram_bins(spark, base):
    """A-23 equal-width histogram (100 bins) as a table."""
    return finish(PR.histogram(roles.credit(spark, base), "AMT_CREDIT_SUM", 100))


@query("global_stats", with_roles("credit") + f"""
SELECT {r('avg(DAYS_CREDIT)')} AS mean, min(DAYS_CREDIT) AS min, max(DAYS_CREDIT) AS max,
       count(DISTINCT DAYS_CREDIT) AS nunique, count(*) AS rows FROM credit""")
def global_stats(spark, base):
    """A-17 whole-column scalar aggregates."""
    return finish(PR.global_stats(roles.credit(spark, base), "DAYS_CREDIT"))


@query("column_vs_column", with_roles("credit") + """
SELECT SK_ID_BUREAU, SK_ID_CURR, DAYS_CREDIT_ENDDATE, DAYS_CREDIT_UPDATE,
       CAST(CREDIT_DAY_OVERDUE <> 0 AS INTEGER) AS HAS_OVERDUE_DAYS
FROM credit WHERE DAYS_CREDIT_ENDDATE > DAYS_CREDIT_UPDATE AND AMT_CREDIT_SUM_OVERDUE >= 0""")
def column_vs_column(spark, base):
    """F-5 column-vs-column predicate, F-6 numeric threshold."""
    c = roles.credit(spark, base)
    out = c.filter((F.col("DAYS_CREDIT_ENDDATE") > F.col("DAYS_CREDIT_UPDATE")) & (F.col("AMT_CREDIT_SUM_OVERDUE") >= 0))
    return finish(out.select("SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_UPDATE",
                             (F.col("CREDIT_DAY_OVERDUE") != 0).cast("int").alias("HAS_OVERDUE_DAYS")))


@query("accept_reject_split", with_roles("scored") + f"""
SELECT CAST(score / 1000 < 0.15 AS INTEGER) AS accepted, count(*) AS n, count(label) AS n_labelled,
       {r('avg(label)')} AS default_rate
FROM scored GROUP BY 1""")
def accept_reject_split(spark, base):
    """F-7 / M-15 threshold split into accepted and rejected sets."""
    s = roles.scored(spark, base).withColumn("pd", F.col("score") / 1000)
    return finish(s.groupBy(EV.accept_flag("pd").alias("accepted")).agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("n_labelled"), F.avg("label").alias("default_rate")))


@query("sort_topk", with_roles("credit") + """
SELECT SK_ID_BUREAU, SK_ID_CURR, AMT_CREDIT_SUM FROM credit WHERE CREDIT_ACTIVE = 'Active'
ORDER BY AMT_CREDIT_SUM DESC, SK_ID_BUREAU LIMIT 30""")
def sort_topk(spark, base):
    """L-1 multi-key sort, L-2/L-3 head after a filter (planned as TakeOrderedAndProject)."""
    c = roles.credit(spark, base).filter(F.col("CREDIT_ACTIVE") == "Active")
    return finish(c.orderBy(F.col("AMT_CREDIT_SUM").desc(), "SK_ID_BUREAU").limit(30)
                  .select("SK_ID_BUREAU", "SK_ID_CURR", "AMT_CREDIT_SUM"))


@query("kth_row", with_roles("credit") + """
SELECT SK_ID_BUREAU, DAYS_CREDIT FROM credit ORDER BY DAYS_CREDIT, SK_ID_BUREAU LIMIT 1 OFFSET 28""")
def kth_row(spark, base):
    """L-6 k-th element of an ordering (offset + limit)."""
    c = roles.credit(spark, base).select("SK_ID_BUREAU", "DAYS_CREDIT")
    return finish(c.orderBy("DAYS_CREDIT", "SK_ID_BUREAU").offset(28).limit(1))


@query("sample_hash", with_roles("credit") + """
SELECT SK_ID_BUREAU, SK_ID_CURR FROM credit
ORDER BY ('0x' || substr(md5(CAST(SK_ID_BUREAU AS VARCHAR) || '_' || '47'), 1, 8))::BIGINT, SK_ID_BUREAU LIMIT 100""")
def sample_hash(spark, base):
    """L-5 reproducible random sample of n rows (hash order + limit; S-3 positional slice)."""
    c = roles.credit(spark, base).select("SK_ID_BUREAU", "SK_ID_CURR")
    return finish(c.orderBy(hash_hex8("SK_ID_BUREAU", 47), "SK_ID_BUREAU").limit(100))


@query("csv_roundtrip", with_roles("scored") + f"""
SELECT id AS SK_ID_CURR, {r('score / 1000')} AS TARGET FROM scored WHERE label IS NULL""")
def csv_roundtrip(spark, base):
    """S-4 two-column prediction sink as CSV (header, no index), S-1 CSV scan
    with an explicit schema, S-7 schema introspection. Written under the
    session's checkpoint folder (shared storage on a cluster)."""
    s = roles.scored(spark, base).filter(F.col("label").isNull())
    sub = s.select(F.col("id").alias("SK_ID_CURR"), F.round(F.col("score") / 1000, 6).alias("TARGET"))
    path = checkpoint_path(spark, f"submission-{uuid.uuid4().hex}")
    tables.write_table(sub, path, fmt="csv")
    back = tables.read_csv(spark, path, schema=sub.schema)
    assert [f.name for f in back.schema.fields] == ["SK_ID_CURR", "TARGET"]
    return finish(back)


def _auc_sql(src: str, by: str) -> str:
    return f"""(SELECT {by}, (sum(rk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
        * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
        / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)) AS auc
   FROM (SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY score)
                + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS rk
         FROM {src} WHERE label IS NOT NULL) GROUP BY {by})"""


_FOLD = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || '_' || '47'), 1, 8))::BIGINT % 5 AS INTEGER)"


@query("metrics_log", with_roles("scored") + f"""
, f AS (SELECT *, {_FOLD} + 1 AS fold FROM scored)
SELECT fold, {r('auc')} AS auc FROM {_auc_sql('f', 'fold')}""")
def metrics_log(spark, base):
    """S-6 append-only metric log: the (fold, AUC) rows are appended, then the log
    table is read back."""
    s = EV.kfold(roles.scored(spark, base), "id", 5).withColumn("fold", F.col("fold") + 1)
    per_fold = EV.auc(s, "score", "label", by=["fold"]).select("fold", "auc")
    path = checkpoint_path(spark, f"metrics-{uuid.uuid4().hex}")
    tables.append_metrics(per_fold, path)
    return finish(spark.read.parquet(path))




@query("capped_scan", with_roles("app", "credit") + """
, a AS (SELECT SK_ID_CURR FROM app WHERE ('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '_' || '47'), 1, 8))::BIGINT / 4294967296.0 < 0.3)
SELECT c.SK_ID_CURR, c.SK_ID_BUREAU, c.AMT_CREDIT_SUM FROM credit c JOIN a ON c.SK_ID_CURR = a.SK_ID_CURR""")
def capped_scan(spark, base):
    """S-2 debug subset: two tables capped by the same key keep the same applicants, so
    the join of the capped tables is the cap of the join."""
    app = tables.capped_by_key(roles.application(spark, base), "SK_ID_CURR", 0.3).select("SK_ID_CURR")
    cr = tables.capped_by_key(roles.credit(spark, base), "SK_ID_CURR", 0.3)
    return finish(cr.select("SK_ID_CURR", "SK_ID_BUREAU", "AMT_CREDIT_SUM").join(app, "SK_ID_CURR"))


@query("point_lookup", with_roles("credit", "hist") + """
SELECT h.SK_ID_BUREAU, h.MONTHS_BALANCE, h.STATUS FROM hist h
WHERE h.SK_ID_BUREAU IN (SELECT SK_ID_BUREAU FROM credit WHERE SK_ID_CURR = 7)""")
def point_lookup(spark, base):
    """F-8 all monthly rows of one applicant's credits (filters pushed into both scans)."""
    one = roles.credit(spark, base).filter(F.col("SK_ID_CURR") == 7).select("SK_ID_BUREAU")
    return finish(roles.history(spark, base).join(one, "SK_ID_BUREAU", "left_semi"))


@query("table_shapes", with_roles("app", "credit", "hist", "scored") + """
SELECT 'app' AS table_name, count(*) AS n_rows, 47 AS n_columns FROM app
UNION ALL SELECT 'credit', count(*), 17 FROM credit UNION ALL SELECT 'hist', count(*), 3 FROM hist
UNION ALL SELECT 'scored', count(*), (SELECT count(*) FROM (DESCRIBE SELECT * FROM scored))::INTEGER FROM scored""")
def table_shapes(spark, base):
    """S-7 rows and columns of each role, counted in the plan."""
    named = {"app": roles.application, "credit": roles.credit, "hist": roles.history, "scored": roles.scored}
    out = None
    for name, role in named.items():
        df = role(spark, base)
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows",
                                                               F.lit(len(df.columns)).alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return finish(out)

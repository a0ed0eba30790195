"""Role views: the credit-data input roles derived from the driver's tables.

The builders in `lendscope.plans` are written against the reference's input
roles (applicant, external credits, monthly credit history, previous
applications, point-of-sale history, instalments, card balances, scored
population). The real credit files are not available, so each role is a lazy
projection of one driver table (or one equi-join), built only from
deterministic column arithmetic. Nothing here materialises; Catalyst fuses the
projection into whatever builder consumes it and prunes unused columns.

Fixed values of the mapping (documented in SURVEY 7.4): reference date
2001-12-01; status of monthly rows R -> '1'..'5', A -> '0', N/F -> 'C',
N/O -> 'X'; order status F/O/P -> Closed/Active/Sold (credits) and
Approved/Canceled/Refused (previous applications).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import DAYS_SENTINEL, days_since, months_before
from .tables import read_table

REF_DATE = "2001-12-01"
REF_YEAR, REF_MONTH = 2001, 12
N_DOC_FLAGS = range(2, 22)


def _d(c):
    return days_since(c, REF_DATE).cast("bigint")


def application(spark: SparkSession, base: str) -> DataFrame:
    """One row per applicant (train and test together; TARGET NULL = test)."""
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")

    def ext(mod, null_mod):
        return F.when(k % null_mod == 0, F.lit(None).cast("double")).otherwise((k % mod) / F.lit(float(mod)))

    cols = {
        "SK_ID_CURR": k,
        "TARGET": F.when(k % 5 == 0, F.lit(None).cast("int")).otherwise((F.col("c_acctbal") < 0).cast("int")),
        "NAME_CONTRACT_TYPE": F.when(k % 8 == 0, F.lit("Revolving loans")).otherwise(F.lit("Cash loans")),
        "CODE_GENDER": F.when(k % 50 == 0, F.lit("XNA")).when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")),
        "FLAG_OWN_CAR": F.when(F.col("c_nationkey") % 2 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "FLAG_OWN_REALTY": F.when(k % 3 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "CNT_CHILDREN": k % 4,
        "AMT_INCOME_TOTAL": F.col("c_acctbal") + F.lit(1000.0),
        "AMT_CREDIT": (F.lit(100) * (k % 97 + 1)).cast("double"),
        "AMT_ANNUITY": (F.lit(5) * (k % 13)).cast("double"),
        "AMT_GOODS_PRICE": F.nullif(F.lit(90) * (k % 89), F.lit(0)).cast("double"),
        "ORGANIZATION_TYPE": F.col("c_mktsegment"),
        "REGION_POPULATION_RELATIVE": F.col("c_nationkey"),
        "DAYS_BIRTH": -(F.lit(7000) + k % 18000),
        "DAYS_EMPLOYED": F.when(k % 6 == 0, F.lit(DAYS_SENTINEL).cast("bigint")).otherwise(-(k % 5000) - 1),
        "DAYS_ID_PUBLISH": -(k % 4000),
        "OWN_CAR_AGE": F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise((k % 25).cast("double")),
        "DAYS_LAST_PHONE_CHANGE": (-(k % 3000)).cast("double"),
        "FLAG_MOBIL": F.lit(1),
        "FLAG_EMP_PHONE": (k % 2 == 0).cast("int"),
        "FLAG_WORK_PHONE": (k % 7 == 0).cast("int"),
        "FLAG_CONT_MOBILE": (k % 9 != 0).cast("int"),
        "FLAG_PHONE": (k % 3 == 1).cast("int"),
        "FLAG_EMAIL": (k % 10 == 0).cast("int"),
        "EXT_SOURCE_1": ext(101, 3),
        "EXT_SOURCE_2": ext(89, 11),
        "EXT_SOURCE_3": ext(73, 4),
    }
    for i in N_DOC_FLAGS:
        cols[f"FLAG_DOCUMENT_{i}"] = (k % i == 0).cast("int")
    return c.select(*[v.alias(n) for n, v in cols.items()])


def application_train(spark, base) -> DataFrame:
    return application(spark, base).filter(F.col("TARGET").isNotNull())


def application_test(spark, base) -> DataFrame:
    """Test applicants carry no TARGET column at all (as in the source files)."""
    return application(spark, base).filter(F.col("TARGET").isNull()).drop("TARGET")


def credit(spark: SparkSession, base: str) -> DataFrame:
    """External credits, one row per credit (bureau role)."""
    o = read_table(spark, base, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    active = (F.when(F.col("o_orderstatus") == "F", F.lit("Closed"))
              .when(F.col("o_orderstatus") == "O", F.lit("Active"))
              .otherwise(F.lit("Sold")))
    days = _d("o_orderdate")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        k.alias("SK_ID_BUREAU"),
        active.alias("CREDIT_ACTIVE"),
        F.when(k % 4 == 0, F.lit("currency 2")).otherwise(F.lit("currency 1")).alias("CREDIT_CURRENCY"),
        days.alias("DAYS_CREDIT"),
        F.when(k % 23 == 0, k % 90).otherwise(F.lit(0).cast("bigint")).alias("CREDIT_DAY_OVERDUE"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
         .otherwise((days + F.lit(365) * (k % 7 + 1)).cast("double")).alias("DAYS_CREDIT_ENDDATE"),
        F.when(active == "Closed", (days + 300).cast("double")).alias("DAYS_ENDDATE_FACT"),
        F.when(k % 3 == 0, price / 7).alias("AMT_CREDIT_MAX_OVERDUE"),
        F.nullif(k % 4, F.lit(3)).alias("CNT_CREDIT_PROLONG"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(active == "Closed", F.lit(None).cast("double")).otherwise(price / 3).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(price / 9).alias("AMT_CREDIT_SUM_LIMIT"),
        F.when(k % 9 == 0, price / 11).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        (days + k % 60).alias("DAYS_CREDIT_UPDATE"),
        F.when(k % 2 == 0, F.lit(None).cast("double")).otherwise(price / 13).alias("AMT_ANNUITY"),
    )


def history(spark: SparkSession, base: str) -> DataFrame:
    """Monthly status rows per external credit (bureau_balance role)."""
    li = read_table(spark, base, "lineitem")
    status = (F.when(F.col("l_returnflag") == "R", (F.col("l_linenumber") % 5 + 1).cast("string"))
              .when(F.col("l_returnflag") == "A", F.lit("0"))
              .when(F.col("l_linestatus") == "F", F.lit("C"))
              .otherwise(F.lit("X")))
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        months_before("l_shipdate", REF_YEAR, REF_MONTH).cast("int").alias("MONTHS_BALANCE"),
        status.alias("STATUS"),
    )


def previous(spark: SparkSession, base: str) -> DataFrame:
    """Previous applications, one row per application."""
    o = read_table(spark, base, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    days = _d("o_orderdate")

    def sentinel_or(mod, value):
        return F.when(k % mod == 0, F.lit(float(DAYS_SENTINEL))).otherwise(value.cast("double"))

    return o.select(
        k.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Approved"))
         .when(F.col("o_orderstatus") == "P", F.lit("Refused"))
         .otherwise(F.lit("Canceled")).alias("NAME_CONTRACT_STATUS"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(price / 23).alias("AMT_ANNUITY"),
        price.alias("AMT_APPLICATION"),
        F.when(k % 13 == 0, F.lit(0.0)).otherwise(price / 1.1).alias("AMT_CREDIT"),
        F.when(k % 2 == 0, price / 11).alias("AMT_DOWN_PAYMENT"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(price).alias("AMT_GOODS_PRICE"),
        (k % 24).alias("HOUR_APPR_PROCESS_START"),
        F.when(k % 2 == 0, (k % 10) / F.lit(99.0)).alias("RATE_DOWN_PAYMENT"),
        days.alias("DAYS_DECISION"),
        F.when(k % 6 == 0, F.lit(None).cast("double")).otherwise((k % 36 + 1).cast("double")).alias("CNT_PAYMENT"),
        sentinel_or(3, days - 30).alias("DAYS_FIRST_DRAWING"),
        sentinel_or(4, days + 30).alias("DAYS_FIRST_DUE"),
        sentinel_or(5, days + 365).alias("DAYS_LAST_DUE_1ST_VERSION"),
        sentinel_or(10, days).alias("DAYS_LAST_DUE"),
        sentinel_or(8, days + 400).alias("DAYS_TERMINATION"),
    )


def _lines_with_orders(spark, base) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def pos_cash(spark: SparkSession, base: str) -> DataFrame:
    """Monthly point-of-sale contract rows (POS_CASH_balance role)."""
    j = _lines_with_orders(spark, base)
    dpd = F.greatest(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")), F.lit(0)).cast("bigint")
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        months_before("l_shipdate", REF_YEAR, REF_MONTH).cast("int").alias("MONTHS_BALANCE"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).cast("double").alias("CNT_INSTALMENT"),
        (F.lit(7) - F.col("l_linenumber")).cast("double").alias("CNT_INSTALMENT_FUTURE"),
        F.col("l_returnflag").alias("NAME_CONTRACT_STATUS"),
        dpd.alias("SK_DPD"),
        F.when(F.col("l_linenumber") % 3 == 0, dpd).otherwise(F.lit(0).cast("bigint")).alias("SK_DPD_DEF"),
    )


def instalments(spark: SparkSession, base: str) -> DataFrame:
    """Instalment payment rows (installments_payments role)."""
    j = _lines_with_orders(spark, base)
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        (F.col("l_suppkey") % 5).alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        _d("o_orderdate").cast("double").alias("DAYS_INSTALMENT"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
         .otherwise(_d("l_shipdate").cast("double")).alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) + F.col("l_linenumber") % 3).alias("AMT_PAYMENT"),
    )


def card(spark: SparkSession, base: str) -> DataFrame:
    """Monthly card balance rows (credit_card_balance role)."""
    e = read_table(spark, base, "events")
    return e.select(
        (F.col("event_id") % 20).alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        (-F.dayofmonth("ts")).alias("MONTHS_BALANCE"),
        F.col("value").alias("AMT_BALANCE"),
        (F.col("event_id") % 5).alias("CNT_DRAWINGS_CURRENT"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
    )


def scored(spark: SparkSession, base: str) -> DataFrame:
    """Scored population: id, label (NULL = unlabelled/test), score, categories."""
    d = read_table(spark, base, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, base, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("label"),
        (F.col("n_chars") % 1000).cast("double").alias("score"),
        F.col("lang").alias("cat"),
        F.col("source").alias("source"),
    )


ROLES = {
    "app": application, "app_train": application_train, "app_test": application_test,
    "credit": credit, "hist": history, "prev": previous, "pos": pos_cash,
    "instal": instalments, "card": card, "scored": scored,
}


def role(spark: SparkSession, base: str, name: str) -> DataFrame:
    return ROLES[name](spark, base)

"""Applicant feature builder (B-1) and the nine-variable PD data set (B-19).

Everything is a projection over the applicant table except two aggregates:
the median income per organisation (a group-by looked up by category) and the
global mean used to fill a missing row statistic (a scalar subquery).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import nullif_sentinel, safe_div, sentinel_to_zero, with_row_stats
from ..functions.scalar import neq_keep_null
from ..operators.series import group_median
from ..operators.encode import (label_encode, lookup_join, one_hot, string_columns, target_fit_transform,
                               vocabulary)

# Fixed values of the reference's applicant builder.
LABEL_ENCODED = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]
KEPT_DOC_FLAG = "FLAG_DOCUMENT_3"
EXT_SOURCES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
PD_COLUMNS = ["DAYS_EMPLOYED", "CREDIT_INCOME_RATIO", "CREDIT_GOODS_RATIO",
              "CREDIT_ANNUITY_RATIO", "REGION_TARGET_ENCODED", "DAYS_BIRTH",
              "EMPLOYED_BIRTH_RATIO", "DAYS_ID_PUBLISH", "ORGANIZATION_TARGET_ENCODED"]


def doc_flag_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains FLAG_DOC (P-8)."""
    return [c for c in df.columns if "FLAG_DOC" in c]


def live_flag_columns(df: DataFrame) -> list[str]:
    """Numeric FLAG_ columns that are neither document flags nor *_FLAG_* (P-8).
    String Y/N flags match the name rule but cannot contribute to a row sum."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    return [c for c in df.columns
            if "FLAG_" in c and "FLAG_DOC" not in c and "_FLAG_" not in c and c in numeric]


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Row union by column name; the test side's missing TARGET becomes NULL (U-1)."""
    return train.unionByName(test, allowMissingColumns=True)


def clean(df: DataFrame) -> DataFrame:
    """Drop XNA gender rows (keeping missing gender, F-1) and turn the
    DAYS_EMPLOYED sentinel into NULL (K-3)."""
    return (df.filter(neq_keep_null("CODE_GENDER", "XNA"))
              .withColumn("DAYS_EMPLOYED", nullif_sentinel("DAYS_EMPLOYED")))


def ratio_features(df: DataFrame) -> dict:
    """The derived ratio columns (K-1, K-18), NULL on a zero denominator."""
    c = F.col
    return {
        "NEW_CREDIT_TO_ANNUITY_RATIO": safe_div("AMT_CREDIT", "AMT_ANNUITY"),
        "NEW_CREDIT_TO_GOODS_RATIO": safe_div("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "NEW_CREDIT_TO_INC_RATIO": safe_div("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "NEW_INC_CHI": safe_div("AMT_INCOME_TOTAL", F.lit(1) + c("CNT_CHILDREN")),
        "NEW_EMPLOY_TO_BIRTH_RATIO": safe_div("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "NEW_ANNUITY_TO_INCOME_RATIO": safe_div("AMT_ANNUITY", F.lit(1) + c("AMT_INCOME_TOTAL")),
        "NEW_CAR_TO_BIRTH_RATIO": safe_div("OWN_CAR_AGE", "DAYS_BIRTH"),
        "NEW_CAR_TO_EMPLOY_RATIO": safe_div("OWN_CAR_AGE", "DAYS_EMPLOYED"),
        "NEW_PHONE_TO_BIRTH_RATIO": safe_div("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
        "NEW_PHONE_TO_BIRTH_RATIO_EMPLOYER": safe_div("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
        "NEW_CREDIT_TO_INCOME_RATIO": safe_div("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "NEW_ANNUAL_PAYMENT": safe_div("AMT_CREDIT", F.lit(36500) + c("DAYS_BIRTH")),
    }


ROW_FEATURES = ("NEW_DOC_IND_KURT", "NEW_LIVE_IND_SUM", "NEW_SOURCES_PROD", "NEW_EXT_SOURCES_MEAN",
                "NEW_SCORES_STD", "NDOC")


def with_row_features(df: DataFrame) -> DataFrame:
    """Row-wise statistics over flag and score columns (H-1..H-5, P-10, K-12)."""
    return with_row_stats(df, {
        "NEW_DOC_IND_KURT": ("kurtosis", doc_flag_columns(df)),
        "NEW_LIVE_IND_SUM": ("sum", live_flag_columns(df)),
        "NEW_SOURCES_PROD": ("product", EXT_SOURCES),
        "NEW_EXT_SOURCES_MEAN": ("mean", EXT_SOURCES),
        "NEW_SCORES_STD": ("std", EXT_SOURCES),
        "NDOC": ("total", [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]),
    })


def fill_with_global_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill missing values with the column's mean over the whole frame (H-6),
    a scalar subquery of the same plan."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean.cast("double")))


def median_by(df: DataFrame, value: str, group: str, out: str) -> DataFrame:
    """Exact median of `value` per `group` (A-9) with the skew-safe rank
    selection of `operators.series.group_median` (no group held by one task)."""
    return group_median(df, value, group, out)


def application_features(train: DataFrame, test: DataFrame, nan_as_category: bool = False,
                         vocab: dict | None = None) -> DataFrame:
    """B-1: one wide row per applicant (train and test)."""
    df = clean(union_train_test(train, test))
    # One vocabulary job for every categorical column, on the cleaned input
    # (only string columns are scanned), reused by both encoders below.
    vocab = dict(vocab or {})
    vocab.update(vocabulary(df, [c for c in string_columns(df) if c not in vocab]))
    inc_by_org = median_by(df, "AMT_INCOME_TOTAL", "ORGANIZATION_TYPE", "NEW_INC_BY_ORG")
    df = with_row_features(df.withColumns(ratio_features(df)))
    # Fill before the lookup join: same rows, and the scalar job stays a narrow scan.
    df = fill_with_global_mean(df, "NEW_SCORES_STD")
    df = lookup_join(df, inc_by_org, ["ORGANIZATION_TYPE"])
    df = df.withColumn("NEW_ANNUAL_PERCENT", safe_div("AMT_INCOME_TOTAL", "NEW_ANNUAL_PAYMENT"))
    df = label_encode(df, LABEL_ENCODED, vocab=vocab)
    df, _ = one_hot(df, None, dummy_na=nan_as_category, vocab=vocab)
    drop = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22) if f"FLAG_DOCUMENT_{i}" != KEPT_DOC_FLAG]
    return df.drop(*drop)


def pd_dataset(train: DataFrame) -> DataFrame:
    """B-19: the nine-variable PD data set with target-encoded region and
    organisation (encoder fitted on all rows, as in the reference)."""
    df = train.na.drop(subset=["AMT_GOODS_PRICE", "AMT_ANNUITY"])
    df = df.withColumn("DAYS_EMPLOYED", sentinel_to_zero("DAYS_EMPLOYED"))
    df = df.withColumns({
        "CREDIT_INCOME_RATIO": safe_div("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "CREDIT_GOODS_RATIO": safe_div("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "CREDIT_ANNUITY_RATIO": safe_div("AMT_CREDIT", "AMT_ANNUITY"),
        "EMPLOYED_BIRTH_RATIO": safe_div("DAYS_EMPLOYED", "DAYS_BIRTH"),
    })
    df = target_fit_transform(df, "REGION_POPULATION_RELATIVE", "TARGET", "REGION_TARGET_ENCODED")
    df = target_fit_transform(df, "ORGANIZATION_TYPE", "TARGET", "ORGANIZATION_TARGET_ENCODED")
    return df.select("SK_ID_CURR", "TARGET", *PD_COLUMNS)

"""Drift between two sets of rows (train and test): per feature, and population stability.

Every feature is judged by how well it alone tells the origin: the exact, tie-aware AUC of
its values against the origin, for all features in one long prefix sum. 0.5 is no shift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluation import auc


def with_origin(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """Both sets with `origin` (0: train, 1: test) and the columns as doubles."""
    return (train.select(F.lit(0).alias("origin"), *[F.col(c).cast("double").alias(c) for c in columns])
            .unionByName(test.select(F.lit(1).alias("origin"), *[F.col(c).cast("double").alias(c) for c in columns])))


def feature_drift(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, auc, mean_train, mean_test, null_train, null_test) per numeric column. The AUC
    is that of larger values in the test set; null where a set has no value. One pass in long
    form gives the shares and means, another the AUCs."""
    long = with_origin(train, test, columns).unpivot(["origin"], columns, "feature", "value")
    first, second = F.col("origin") == 0, F.col("origin") == 1
    missing = F.col("value").isNull().cast("double")
    stats = long.groupBy("feature").agg(
        F.avg(F.when(first, F.col("value"))).alias("mean_train"), F.avg(F.when(second, F.col("value"))).alias("mean_test"),
        F.avg(F.when(first, missing)).alias("null_train"), F.avg(F.when(second, missing)).alias("null_test"))
    told = auc(long, "value", "origin", by=["feature"]).select("feature", "auc")
    return stats.join(told, "feature", "left").select("feature", "auc", "mean_train", "mean_test", "null_train", "null_test")


def stability_index(df: DataFrame, band: str, origin: str = "origin") -> DataFrame:
    """(band, share_train, share_test, psi): population stability of a banded column; the index
    is the sum of the parts. An empty side counts as half a row."""
    first, second = F.col(origin) == 0, F.col(origin) == 1
    parts = df.groupBy(band).agg(F.count(F.when(first, 1)).alias("_a"), F.count(F.when(second, 1)).alias("_b"))
    totals = parts.agg(F.struct(F.sum("_a").alias("a"), F.sum("_b").alias("b"))).scalar()
    share = {n: F.greatest(F.col(c), F.lit(0.5)) / totals[t] for n, c, t in (("a", "_a", "a"), ("b", "_b", "b"))}
    return parts.select(band, share["a"].alias("share_train"), share["b"].alias("share_test"),
                        ((share["b"] - share["a"]) * F.ln(share["b"] / share["a"])).alias("psi"))

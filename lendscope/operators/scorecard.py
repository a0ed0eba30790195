"""Additive scorecards by bands, and the expected-loss roll-up (report of the reference).

Bands hold equal shares of the rows: the band of a value is floor(bands * rows below / rows),
exact by bucketed prefix sums, equal values together. The fitted table has a row per feature
and band, bounded by the parameters; scoring is a plain column expression of its bounds, so
new rows need neither a join nor a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import prefix_sums, quantile_bucket

MISSING_BAND = -1


def equal_bands(df: DataFrame, columns: list[str], bands: int, label: str) -> DataFrame:
    """(feature, band, low, high, n, bad) of the labelled rows: band bounds are values that
    occur, missing values are band -1 (bounds null). `label` 1 is bad."""
    known = df.filter(F.col(label).isNotNull())
    long = known.select(F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["_y"], columns, "feature", "value")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_y") == 1, 1)).alias("bad"))
    valued = counts.filter(F.col("value").isNotNull())
    total = valued.groupBy("feature").agg(F.sum("n").alias("_all"))
    ranked = prefix_sums(valued, ["value"], ["n"], quantile_bucket(valued, "value"), ["feature"]).join(F.broadcast(total), "feature")
    band = F.floor(F.lit(bands) * F.col("n_before") / F.col("_all")).cast("int")
    out = ranked.groupBy("feature", band.alias("band")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    nothing = F.lit(None).cast("double")
    missing = counts.filter(F.col("value").isNull()).select(
        "feature", F.lit(MISSING_BAND).alias("band"), nothing.alias("low"), nothing.alias("high"), "n", "bad")
    return out.unionByName(missing)


def scorecard(df: DataFrame, columns: list[str], label: str, bands: int = 10, base: float = 600.0, odds: float = 50.0,
              double_odds: float = 20.0) -> DataFrame:
    """(feature, band, low, high, n, bad, woe, points): weight of evidence ln(share of the good /
    share of the bad), each count with half a row added, and additive points: `base` points
    at `odds` good to one bad, `double_odds` points more for twice the odds, dealt evenly
    over the features."""
    card = equal_bands(df, columns, bands, label)
    totals = df.filter(F.col(label).isNotNull()).agg(F.struct(
        F.count(F.when(F.col(label) == 1, 1)).alias("bad"), F.count(F.when(F.col(label) != 1, 1)).alias("good"))).scalar()
    half = F.lit(0.5)
    woe = F.ln(((F.col("n") - F.col("bad") + half) / (totals["good"] + half)) / ((F.col("bad") + half) / (totals["bad"] + half)))
    factor = double_odds / math.log(2)
    prior = F.ln((totals["good"] + half) / (totals["bad"] + half))
    points = (F.lit(base - factor * math.log(odds)) + F.lit(factor) * prior) / F.lit(float(len(columns))) + F.lit(factor) * F.col("woe")
    return card.withColumn("woe", woe).withColumn("points", points)


def apply_scorecard(df: DataFrame, card: DataFrame, out: str = "score") -> DataFrame:
    """`df` with the sum of its features' points. A value lies in the last band whose low it
    reaches (the first, below all); a missing value without a band of its own gets the mean of
    its feature's points. The card is read once: a row per feature and band."""
    by_feature: dict[str, list] = {}
    for row in card.select("feature", "band", "low", "points").collect():       # features x bands
        by_feature.setdefault(row["feature"], []).append(row)
    total: Column = F.lit(0.0)
    for feature, rows in sorted(by_feature.items()):
        valued = sorted((r for r in rows if r["band"] != MISSING_BAND), key=lambda r: r["low"])
        gap = [r["points"] for r in rows if r["band"] == MISSING_BAND]
        value = F.col(feature).cast("double")
        points = F.when(value.isNull(), F.lit(gap[0] if gap else sum(r["points"] for r in rows) / len(rows)))
        for row in reversed(valued[1:]):
            points = points.when(value >= F.lit(row["low"]), F.lit(row["points"]))
        total = total + points.otherwise(F.lit(valued[0]["points"] if valued else 0.0))
    return df.withColumn(out, total)


def expected_loss(df: DataFrame, pd_col: str, exposure: str, loss_given_default: str | float, out: str = "expected_loss") -> DataFrame:
    """`df` with exposure x probability of default x loss given default per loan; null where one is missing."""
    lgd = F.lit(float(loss_given_default)) if isinstance(loss_given_default, (int, float)) else F.col(loss_given_default)
    return df.withColumn(out, F.col(exposure) * F.col(pd_col) * lgd)


def loss_by_band(df: DataFrame, pd_col: str, exposure: str, loss: str, cuts: list[float]) -> DataFrame:
    """(grade, loans, exposure, expected_loss, mean_pd, loss_rate) per grade of default probability
    (number of ascending `cuts` at or below it; null without one), and the portfolio total as
    grade -1. One aggregate per grade, pre-aggregated; the total adds up the grades."""
    p = F.col(pd_col)
    grade = F.when(p.isNotNull(), sum((F.when(p >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)))
    parts = df.groupBy(grade.alias("grade")).agg(
        F.count(F.lit(1)).alias("loans"), F.sum(exposure).alias("exposure"), F.sum(loss).alias("expected_loss"),
        F.sum(p).alias("_p"), F.count(p).alias("_n"))
    total = parts.agg(F.lit(-1).alias("grade"), *[F.sum(c).alias(c) for c in ("loans", "exposure", "expected_loss", "_p", "_n")])
    both = parts.unionByName(total.filter(F.col("loans").isNotNull()))
    return both.select("grade", "loans", "exposure", "expected_loss", F.try_divide(F.col("_p"), F.col("_n")).alias("mean_pd"),
                       F.try_divide("expected_loss", "exposure").alias("loss_rate"))

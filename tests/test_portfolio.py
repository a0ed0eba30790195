"""Blending, drift, bagging, scorecards and expected loss: hand cases, brute force, planted signals."""
import math
import random

import pytest
from pyspark.sql import functions as F

from lendscope.operators import blending as BL
from lendscope.operators import drift as DR
from lendscope.operators import scorecard as SCARD
from lendscope.plans import scoring as SC


def test_percent_ranks_with_ties_and_missing_scores(spark):
    rnd = random.Random(3)
    rows = [(i, 0.5 if i % 3 == 0 else rnd.random(), None if i % 4 == 0 else float(rnd.randint(0, 5)), None, 7.0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, none double, same double")
    got = {(r["id"], r["model"]): r["percent_rank"] for r in BL.percent_ranks(df, ["a", "b", "none", "same"], "id").collect()}
    for at, name in ((1, "a"), (2, "b"), (4, "same")):
        known = [r[at] for r in rows if r[at] is not None]
        for r in rows:
            if r[at] is None:
                assert (r[0], name) not in got
            else:
                assert got[r[0], name] == pytest.approx(sum(x < r[at] for x in known) / (len(known) - 1))
    assert not any(model == "none" for _, model in got)


def test_blend_of_rows_that_some_models_skip(spark):
    df = spark.createDataFrame([(1, 0.1, 0.9), (2, 0.2, None), (3, None, None), (4, 0.3, 0.1)], "id long, a double, b double")
    got = {r["id"]: r["blend"] for r in BL.blend_ranks(df, {"a": 3.0, "b": 1.0}, "id").collect()}
    assert got == {1: pytest.approx(0.25), 2: pytest.approx(0.5), 3: None, 4: pytest.approx(0.75)}
    one = BL.percent_ranks(df.limit(1), ["a"], "id").collect()
    assert [r["percent_rank"] for r in one] == [0.0]


def test_balanced_draws(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 9 == 8, None).when(F.col("id") % 9 == 0, 1).otherwise(0).cast("int").alias("y"))
    rare = df.filter("y = 1").count()
    got = BL.balanced_draws(df, "id", "y", 6)
    for r in got.groupBy("member").agg(F.sum("y").alias("ones"), F.count(F.when(F.col("y") == 0, 1)).alias("zeros")).collect():
        assert r["ones"] == rare and 0.8 * rare < r["zeros"] < 1.2 * rare
    assert got.filter("y is null").count() == 0 and got.select("member").distinct().count() == 6
    flipped = BL.balanced_draws(df.withColumn("y", 1 - F.col("y")), "id", "y", 2)
    assert flipped.filter("y = 0").count() == 2 * rare
    assert BL.balanced_draws(df.filter("y = 1"), "id", "y", 2).filter("y = 1").count() == 0        # one label alone: no ratio
    assert BL.balanced_draws(df.limit(0), "id", "y", 2).count() == 0


def test_bagging_finds_a_rare_label(spark):
    rnd = random.Random(4)
    rows = [(i, int(i % 20 == 0), rnd.random() + 0.8 * (i % 20 == 0), rnd.random()) for i in range(1200)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, y int, x double, z double")
    pred = {r["SK_ID_CURR"]: r["pred"] for r in SC.bagged_trees(df, ["x", "z"], "y", 5, depth=2, block=2).collect()}
    assert len(pred) == 1200
    ones, zeros = ([pred[r[0]] for r in rows if r[1] == y] for y in (1, 0))
    assert sum(ones) / len(ones) > 0.75 and sum(zeros) / len(zeros) < 0.35


def planted_shift(spark, shifted):
    base = spark.range(900).select(F.col("id").alias("SK_ID_CURR"), F.rand(1).alias("same"), F.rand(2).alias("moved"),
                                   F.when(F.rand(3) < 0.2, None).otherwise(F.rand(4)).alias("gaps"))
    train, test = base.filter("SK_ID_CURR < 600"), base.filter("SK_ID_CURR >= 600")
    return (train, test.withColumns({"moved": F.col("moved") + 0.6, "gaps": F.lit(None).cast("double")})) if shifted else (train, test)


@pytest.mark.parametrize("shifted", [True, False])
def test_planted_shift(spark, shifted):
    train, test = planted_shift(spark, shifted)
    table = {r["feature"]: r for r in DR.feature_drift(train, test, ["same", "moved", "gaps"]).collect()}
    out = SC.drift_classifier(train, test, ["same", "moved", "gaps"], trees=5, depth=3)
    told = out["auc"].first()["auc"]
    assert out["oof"].count() == 900
    assert abs(table["same"]["auc"] - 0.5) < 0.05
    if shifted:
        assert told > 0.95 and table["moved"]["auc"] > 0.85 and table["gaps"]["auc"] is None and table["gaps"]["null_test"] == 1
        assert table["moved"]["mean_test"] - table["moved"]["mean_train"] == pytest.approx(0.6, abs=0.06)
        best = out["importance"].groupBy("feature").agg(F.avg("importance").alias("v")).orderBy(F.desc("v")).first()["feature"]
        assert best in ("moved", "gaps")
    else:
        assert abs(told - 0.5) < 0.1 and abs(table["moved"]["auc"] - 0.5) < 0.06


def test_stability_index_of_an_empty_side(spark):
    df = spark.createDataFrame([(0, "a")] * 6 + [(1, "a")] * 3 + [(1, "b")] * 3, "origin int, band string")
    got = {r["band"]: r["psi"] for r in DR.stability_index(df, "band").collect()}
    assert got["a"] == pytest.approx((0.5 - 1) * math.log(0.5)) and got["b"] == pytest.approx((0.5 - 0.5 / 6) * math.log(0.5 / (0.5 / 6)))


def test_bands_are_equal_and_exact(spark):
    rnd = random.Random(6)
    rows = [(i, None if i % 11 == 0 else round(rnd.gauss(0, 1), 2), 3.0, int(rnd.random() < 0.3) if i % 13 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, x double, flat double, y int")
    card = {(r["feature"], r["band"]): r for r in SCARD.scorecard(df, ["x", "flat"], "y", bands=4).collect()}
    known = [r for r in rows if r[3] is not None]
    values = sorted(r[1] for r in known if r[1] is not None)
    for b in range(4):
        mine = [v for v in values if 4 * sum(w < v for w in values) // len(values) == b]
        r = card["x", b]
        assert (r["n"], r["low"], r["high"]) == (len(mine), min(mine), max(mine))
    assert card["x", -1]["n"] == sum(r[1] is None for r in known) and card["flat", 0]["n"] == len(known) and ("flat", -1) not in card


def test_scores_of_new_and_missing_values(spark):
    df = spark.createDataFrame([(i, float(i), int(i < 30)) for i in range(100)], "id long, x double, y int")
    card = SCARD.scorecard(df, ["x"], "y", bands=2)
    points = {r["band"]: r["points"] for r in card.collect()}
    new = spark.createDataFrame([(1, -99.0), (2, 50.0), (3, 1e9), (4, None), (5, 49.5)], "id long, x double")
    got = {r["id"]: r["score"] for r in SCARD.apply_scorecard(new, card).collect()}
    assert got == {1: points[0], 2: points[1], 3: points[1], 4: pytest.approx((points[0] + points[1]) / 2), 5: points[0]}
    assert points[1] > points[0]                                       # fewer bad, more points
    nobody = SCARD.scorecard(df.limit(0), ["x"], "y")
    assert nobody.count() == 0 and SCARD.apply_scorecard(new, nobody).agg(F.sum("score")).first()[0] == 0


def test_points_double_the_odds(spark):
    """The sum of points is base + double_odds * log2(odds / given odds) for one feature."""
    df = spark.createDataFrame([(i, 1.0 if i < 50 else 2.0, int(i % 10 == 0) if i < 50 else int(i % 2 == 0)) for i in range(100)], "id long, x double, y int")
    got = {r["low"]: r for r in SCARD.scorecard(df, ["x"], "y", bands=2, base=600, odds=1, double_odds=20).collect()}
    for r in got.values():
        assert r["points"] == pytest.approx(600 + 20 * math.log2((r["n"] - r["bad"] + 0.5) / (r["bad"] + 0.5)))


def test_losses_add_up(spark):
    df = spark.createDataFrame([(0.1, 100.0, 0.5), (0.3, 200.0, 0.4), (0.5, None, 0.5), (None, 50.0, 0.5), (0.2, 10.0, 1.0)], "p double, e double, l double")
    got = {r["grade"]: r for r in SCARD.loss_by_band(SCARD.expected_loss(df, "p", "e", "l"), "p", "e", "expected_loss", [0.2, 0.4]).collect()}
    assert {g: r["loans"] for g, r in got.items()} == {0: 1, 1: 2, 2: 1, None: 1, -1: 5}
    assert got[-1]["expected_loss"] == pytest.approx(5 + 24 + 2) and got[-1]["exposure"] == 360 and got[2]["expected_loss"] is None
    assert got[1]["mean_pd"] == pytest.approx(0.25) and got[-1]["loss_rate"] == pytest.approx(31 / 360)
    assert SCARD.loss_by_band(SCARD.expected_loss(df.limit(0), "p", "e", 0.45), "p", "e", "expected_loss", [0.5]).count() == 0

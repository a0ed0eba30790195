"""Encoders and evaluation operators: hand cases, properties, brute force."""
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from lendscope.operators import evaluation as EV
from lendscope.operators.encode import label_encode, one_hot, target_encode_oof


def test_one_hot_nan_column_always_emitted(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    out, names = one_hot(df, ["c"], dummy_na=True)
    assert names == ["c_a", "c_b", "c_nan"]
    assert [tuple(r) for r in out.orderBy("c_a").collect()] == [(0, 1, 0), (1, 0, 0)]


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([(x,) for x in ["a", "b", None, "c", "a"]], "c string")
    out, names = one_hot(df, ["c"], dummy_na=True)
    assert all(v == 1 for v in out.select(sum(F.col(n) for n in names)).toPandas().iloc[:, 0])


def test_label_encode_stable(spark):
    df = spark.createDataFrame([(1, "M"), (2, "F"), (3, None), (4, "M")], "i int, g string")
    got = [r["g"] for r in label_encode(df, ["g"]).orderBy("i").collect()]
    assert got == [1, 0, -1, 1]


def test_target_oof_excludes_own_fold(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice("xyz"), rnd.randint(0, 1), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, cat string, y int, fold int")
    got = {r["id"]: r["enc"] for r in target_encode_oof(df, "cat", "y", "fold", "enc").collect()}
    for i, cat, _, fold in rows:
        others = [y for (_, c, y, f) in rows if c == cat and f != fold]
        assert got[i] == pytest.approx(sum(others) / len(others))


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.1, 0)], "s double, y int")
    assert EV.auc(df, "s", "y", n_buckets=4).first()["auc"] == pytest.approx(0.75)


def test_auc_matches_pairwise_brute_force_and_symmetry(spark):
    rnd = random.Random(9)
    rows = [(float(rnd.randint(0, 30)), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    exp = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in product(pos, neg)) / (len(pos) * len(neg))
    a = EV.auc(df, "s", "y", n_buckets=8).first()["auc"]
    b = EV.auc(df.withColumn("s", -F.col("s")), "s", "y", n_buckets=8).first()["auc"]
    assert a == pytest.approx(exp) and a + b == pytest.approx(1.0)


def test_roc_endpoints(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.random(), rnd.randint(0, 1)) for _ in range(200)], "s double, y int")
    pts = EV.roc_points(df, "s", "y", n_buckets=8).orderBy(F.col("threshold").desc()).collect()
    assert pts[-1]["fpr"] == pytest.approx(1.0) and pts[-1]["tpr"] == pytest.approx(1.0)
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(pts, pts[1:]))


def test_stratified_folds_balanced(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(1000)]       # skewed label
    df = spark.createDataFrame(rows, "id long, y int")
    out = EV.stratified_kfold(df, "id", "y", 5, n_buckets=8)
    counts = out.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        c = [r["count"] for r in counts if r["y"] == y]
        assert len(c) == 5 and max(c) - min(c) <= 1
    assert out.count() == 1000


def test_reject_rows(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.9)], "id int, pd double")
    exp = EV.expected_reject_rows(df, "pd").groupBy("id").agg(F.sum("weight").alias("w")).collect()
    assert all(r["w"] == pytest.approx(1.0) for r in exp)
    sim = EV.simulate_reject_labels(df, "id", "pd", 50)
    assert sim.count() == 100

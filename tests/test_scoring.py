"""Model runs: out-of-fold contract, outputs, planted signal, reject inference with sampled labels."""
import random
import uuid

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from lendscope.operators import evaluation as EV
from lendscope.plans import scoring as SC
from lendscope.session import shared_dir


def planted(spark, n=400, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x, z = rnd.random(), rnd.random()
        y = int(rnd.random() < (0.9 if x > 0.5 else 0.1))
        rows.append((i, None if i % 10 == 0 else y, x, z if rnd.random() < 0.8 else None))
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x double, z double")


@pytest.mark.parametrize("stratified", [False, True])
def test_scoring_run_outputs(spark, stratified):
    df, folder = planted(spark), f"{shared_dir(spark)}/scoring-{uuid.uuid4().hex}"
    child = df.select("SK_ID_CURR", (F.col("x") * 0).alias("c"))
    out = SC.scoring_run(df, [child], folder, "one", top_features=2, k=3, max_iter=5, max_depth=2, stratified=stratified)
    SC.append_metrics(out["fold_auc"].select(F.lit("two").alias("run"), "fold", "auc"), f"{folder}/metrics")
    train = df.filter("TARGET is not null")
    folds = EV.stratified_kfold(train, "SK_ID_CURR", "TARGET", 3) if stratified else EV.kfold(train, "SK_ID_CURR", 3)
    assert {(r[0], r[1]) for r in out["oof"].select("SK_ID_CURR", "fold").collect()} == {
        (r[0], r[1]) for r in folds.select("SK_ID_CURR", "fold").collect()} and out["oof"].count() == train.count()
    submission = spark.read.option("header", True).csv(f"{folder}/submission")
    assert submission.columns == ["SK_ID_CURR", "TARGET"] and submission.count() == 40
    log = spark.read.parquet(f"{folder}/metrics")
    assert log.groupBy("run").count().count() == 2 and log.count() == 8
    assert {r["feature"] for r in spark.read.parquet(f"{folder}/importance").collect()} <= {"x", "z", "c"}
    auc = {r["fold"]: r["auc"] for r in out["fold_auc"].collect()}
    assert auc[-1] > 0.8                                              # the planted signal
    best = out["importance"].groupBy("feature").agg(F.avg("importance").alias("v")).orderBy(F.desc("v")).first()
    assert best["feature"] == "x"


def test_best_round_waits_for_its_patience():
    loss = [5.0, 4.0, 4.5, 4.2, 3.0, 3.5, 3.4, 3.3, 1.0]
    assert SC.best_round(loss, 2) == (2, True) and SC.best_round(loss, 3) == (5, True) and SC.best_round(loss, 4) == (9, False)


def test_folds_train_past_their_best_round_and_keep_it(spark):
    """Rounds that go on from stored margins give the trees of one long run."""
    df, k, patience = planted(spark), 2, 4
    out = SC.kfold_gbt(df, k=k, max_depth=2, patience=patience, subsampling=1.0, feature_subset="all", block=3)
    rounds = {r["fold"]: (r["best"], r["trained"]) for r in out["rounds"].collect()}
    pred = {r["SK_ID_CURR"]: r["pred"] for r in out["oof"].collect()}
    train = SC._assemble(EV.kfold(df.filter("TARGET is not null"), "SK_ID_CURR", k), ["x", "z"]).withColumn("_y", F.col("TARGET").cast("double"))
    for f in range(k):
        best, trained = rounds[f]
        assert trained - best == patience                             # no cap bound
        gbt = GBTClassifier(labelCol="_y", maxIter=best, maxDepth=2, stepSize=0.1, seed=EV.DEFAULT_SEED)
        valid = train.filter(F.col("fold") == f)
        got = gbt.fit(train.filter(F.col("fold") != f)).transform(valid)
        assert {r[0]: r[1] for r in got.select("SK_ID_CURR", SC.vector_to_array("probability")[1]).collect()} == pytest.approx(
            {r["SK_ID_CURR"]: pred[r["SK_ID_CURR"]] for r in valid.collect()})


def test_block_size_changes_no_tree(spark):
    df = planted(spark, 200)
    runs = [SC.kfold_gbt(df, k=2, max_iter=4, max_depth=2, patience=9, subsampling=0.8, block=b)["oof"].collect() for b in (1, 3, 50)]
    first = {r["SK_ID_CURR"]: r["pred"] for r in runs[0]}
    for run in runs[1:]:
        assert {r["SK_ID_CURR"]: r["pred"] for r in run} == pytest.approx(first)


@pytest.mark.parametrize("labels", ["sampled", "expected"])
def test_reject_inference(spark, labels):
    df = planted(spark, 600).na.drop(subset=["TARGET"]).na.fill(0.5)
    got = {r["metric"]: r["value"] for r in SC.reject_inference(df, ["x", "z"], trees=5, old_depth=3, new_depth=2, cut=0.5,
                                                               labels=labels, draws=3).collect()}
    assert set(got) == {"auc_old_model_fold2", "auc_p_all_fold3", "auc_p_acc_fold3", "auc_p_ri_fold3", "capture_rate",
                        "n_disagree", "n_accepted", "n_rejected"}
    assert got["n_accepted"] + got["n_rejected"] == pytest.approx(180, abs=2)
    assert got["auc_p_all_fold3"] > 0.8 and got["auc_p_ri_fold3"] > 0.7


def test_sampled_ensemble_is_the_mean_of_its_draws(spark):
    df = SC._assemble(planted(spark, 200).na.drop(subset=["TARGET"]).na.fill(0.5).withColumn("_y", F.col("TARGET").cast("double")), ["x", "z"])
    accepted, rejected = df.filter("x <= 0.5").withColumn("pd", F.lit(0.1)), df.filter("x > 0.5").withColumn("pd", F.lit(0.8))
    run = lambda draws, block: {r["SK_ID_CURR"]: r["p_ri"] for r in SC.sampled_label_ensemble(
        accepted, rejected, df, "pd", 47, 3, 2, draws, block=block).collect()}
    assert run(3, 2) == pytest.approx(run(3, 3))


def test_unknown_label_form(spark):
    with pytest.raises(ValueError, match="labels must be"):
        SC.reject_inference(planted(spark, 100).na.drop(), ["x"], trees=1, labels="other")

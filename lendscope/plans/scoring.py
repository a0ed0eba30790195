"""Model training and evaluation plans (B-13, B-14, B-20; M-4..M-8, M-12..M-15).

The reference trains a leaf-wise boosting library per fold and a random
forest for the reject-inference experiment. Here both are Spark ML learners
(single trees joined to boosted ensembles, RandomForestRegressor) fitted on DataFrames; the
learner differs, so model quality is reported, not matched.

Scale notes: the assembled feature table is checkpointed once to the shared
checkpoint folder before the k fits (every fit re-reads it, and a lost
executor re-reads files instead of recomputing the whole feature DAG). Early
stopping looks at the held-out fold with a patience and keeps its best round, like the
reference's eval-set early stopping. Spark's boosted trees know no patience and cannot go
on from a trained model, so the rounds are run here, one Spark tree each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import hash01
from ..operators import evaluation as EV
from ..operators.blending import balanced_draws
from ..session import drop_stored, materialize, store
from ..sources.tables import append_metrics, write_table
from .history import assemble

EXCLUDED = ("TARGET", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "index")
CELLS = 1 << 22      # matrix cells (rows x features) of a training task
MISSING = -999.0     # trees split on it like any value; Spark ML trees reject NaN


def feature_columns(df: DataFrame, exclude: Iterable[str] = EXCLUDED) -> list[str]:
    """Every numeric column except ids and the label (M-4)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def _assemble(df: DataFrame, feats: list[str]) -> DataFrame:
    filled = df.na.fill(MISSING, subset=feats)
    return VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep").transform(filled)


def vector_size(column: str) -> Column:
    return F.size(vector_to_array(F.col(column)))


def best_round(loss: list[float], patience: int) -> tuple[int, bool]:
    """(best round from 1, whether `patience` rounds after it brought no better one)."""
    best = 0
    for i, v in enumerate(loss):
        if v < loss[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def ensemble(kind: type, trees: list, weights: list[float], **columns: str):
    """A model of `kind` (a GBT model class of Spark ML) that adds up weighted trees, by the
    public constructor of its JVM class."""
    sc = SparkSession.active().sparkContext
    ml = sc._jvm.org.apache.spark.ml
    package = ml.classification if kind is GBTClassificationModel else ml.regression
    held = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    factors = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        held[i], factors[i] = tree, weight
    model = kind(getattr(package, kind.__name__)(f"trees_{uuid.uuid4().hex}", held, factors)).setFeaturesCol("features")
    return model.setPredictionCol(columns["prediction"]) if columns else model


def _with_margin(rows: DataFrame, fold: int, fresh: list, step: float) -> DataFrame:
    """`_f`: the stored margin of the fold's model plus its trees since then. Trees take the
    step as weight; a model's first tree counts whole."""
    if not fresh:
        return rows.withColumn("_f", F.col("_m")[fold])
    weights = [1.0 if number == 0 else step for number, _ in fresh]
    model = ensemble(GBTRegressionModel, [tree for _, tree in fresh], weights, prediction="_new")
    return model.transform(rows).withColumn("_f", F.col("_m")[fold] + F.col("_new"))


def boost_folds(matrix: DataFrame, k: int, learner: RandomForestRegressor, max_iter: int, patience: int, step: float,
                subsampling: float = 1.0, block: int = 25, folder: str | None = None) -> tuple[list[list], list[list[float]]]:
    """Boosted trees of k fold models under log loss: (trees, held-out losses), per fold a list
    by round.

    `matrix` has `features`, `_y` (+1 or -1), `fold` and `_id`; model f trains on the other folds.
    It is stored with a column of the k margins. A round fits one tree per model to what its margins
    leave over (the negative gradient), the folds side by side (of a share `subsampling` of the
    rows, by a hash of id and round), and takes the loss of the held-out rows; a model stops when `patience` rounds brought no better one. After `block` rounds the
    new margins are stored in place of the old ones: nothing is trained twice, a plan holds at
    most `block` trees, and a lost executor reads the last stored margins again.
    """
    spark = matrix.sparkSession
    # A round runs some ten jobs over the matrix: no more tasks than its cells need.
    cells = matrix.agg(F.sum(F.lit(1)), F.max(vector_size("features"))).first()
    parts = max(1, -(-(cells[0] or 0) * (cells[1] or 0) // CELLS))
    state, path = store(matrix.withColumn("_m", F.array_repeat(F.lit(0.0), k)).coalesce(parts), "boost", folder)
    trees: list[list] = [[] for _ in range(k)]
    losses: list[list[float]] = [[] for _ in range(k)]
    active, kept = list(range(k)), 0
    y = F.col("_y")

    def one(f: int) -> None:
        number = len(trees[f])
        since = list(enumerate(trees[f]))[kept:]
        left = y if number == 0 else 4.0 * y / (1.0 + F.exp(2.0 * y * F.col("_f")))
        rows = state.filter(F.col("fold") != f)
        if subsampling < 1:
            rows = rows.filter(F.pmod(F.xxhash64("_id", F.lit(learner.getSeed() + number)), F.lit(1 << 20)) < subsampling * (1 << 20))
        rows = _with_margin(rows, f, since, step).select("features", left.alias("_r"))
        fitted = learner.copy({learner.seed: learner.getSeed() + number}).fit(rows)
        trees[f].append(fitted._java_obj.trees()[0])
        held = _with_margin(state.filter(F.col("fold") == f), f, [*since, (number, trees[f][-1])], step)
        x = -2.0 * y * F.col("_f")
        loss = 2.0 * (F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x))))
        losses[f].append(held.agg(F.avg(loss)).first()[0])

    while active:
        with ThreadPool(len(active)) as pool:
            pool.map(inheritable_thread_target(spark)(one), active)
        rounds = len(trees[active[0]])
        active = [f for f in active if rounds < max_iter and losses[f][-1] is not None and not best_round(losses[f], patience)[1]]
        if active and rounds - kept == block:
            moved = state
            for f in active:
                moved = _with_margin(moved, f, list(enumerate(trees[f]))[kept:], step).withColumnRenamed("_f", f"_f{f}").drop("_new")
            margins = F.array(*[F.col(f"_f{f}") if f in active else F.col("_m")[f] for f in range(k)])
            old, (state, path) = path, store(moved.withColumn("_m", margins).select(*state.columns), "boost", folder)
            drop_stored(spark, old)
            kept = rounds
    drop_stored(spark, path)
    return trees, losses


def kfold_gbt(df: DataFrame, k: int = 5, seed: int = EV.DEFAULT_SEED, max_iter: int = 10_000, patience: int = 200,
              max_depth: int = 5, step_size: float = 0.1, subsampling: float = 0.87,
              feature_subset: str = "0.95", id_col: str = "SK_ID_CURR", label: str = "TARGET",
              stratified: bool = False, folder: str | None = None, block: int = 25) -> dict[str, DataFrame]:
    """B-13: k-fold boosted trees on the train rows (label not NULL).

    Each fold trains until `patience` rounds bring no better log loss of the held-out fold
    (at most `max_iter` rounds) and keeps its best round; the folds train side by side (see
    `boost_folds`). A fold without rows keeps one round. `stratified` deals the folds inside
    each label. Returns frames: `oof` (id, fold, label, pred), `test` (id, fold-averaged pred),
    `fold_auc` (fold, auc; fold -1 = all out-of-fold rows), `importance` (feature, importance,
    fold) and `rounds` (fold, best, trained). The feature table and the predictions are
    checkpointed in the shared folder (`folder`, else the session's): each model scores its
    rows once.
    """
    feats = feature_columns(df)
    base = materialize(df, folder)
    train = base.filter(F.col(label).isNotNull())
    train = EV.stratified_kfold(train, id_col, label, k, seed) if stratified else EV.kfold(train, id_col, k, seed)
    train_v, test_v = _assemble(train, feats), _assemble(base.filter(F.col(label).isNull()), feats)
    learner = forest(seed, 1, max_depth).setBootstrap(False).setFeatureSubsetStrategy(feature_subset).setLabelCol("_r")
    signed = train_v.select(F.col(id_col).alias("_id"), "fold", "features", F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("_y"))
    trees, losses = boost_folds(signed, k, learner, max_iter, patience, step_size, subsampling, block, folder)

    oof_parts, test_parts, importances, rounds = [], [], [], []
    for f in range(k):
        best = best_round(losses[f], patience)[0]
        model = ensemble(GBTClassificationModel, trees[f][:best], [1.0] + [step_size] * (best - 1))
        prob1 = vector_to_array(F.col("probability"))[1]
        valid = model.transform(train_v.filter(F.col("fold") == f))
        oof_parts.append(valid.select(id_col, "fold", F.col(label).alias("label"), prob1.alias("pred")))
        test_parts.append(model.transform(test_v).select(id_col, prob1.alias("pred")))
        values = dict(enumerate(model.featureImportances.toArray().tolist()))
        importances += [(name, values.get(i, 0.0), f + 1) for i, name in enumerate(feats)]
        rounds.append((f, best, len(trees[f])))
    oof = materialize(reduce(DataFrame.unionByName, oof_parts), folder)
    return {
        "oof": oof,
        "test": materialize(EV.fold_average(test_parts, id_col, "pred"), folder),
        "fold_auc": EV.auc_by_fold(oof, "pred", "label"),
        "importance": df.sparkSession.createDataFrame(importances, "feature string, importance double, fold int"),
        "rounds": df.sparkSession.createDataFrame(rounds, "fold int, best int, trained int"),
    }


def scoring_run(applicants: DataFrame, children: Iterable[DataFrame], out_dir: str, name: str = "run",
                top_features: int = 40, **training) -> dict[str, DataFrame]:
    """B-13 as users run it: the applicant features with every child table, the k-fold
    training, and its outputs under `out_dir`:

    `submission` (CSV, id and averaged prediction), `metrics` (appended: run, fold, auc) and
    `importance` (fold importances of the best features, B-14). Returns the training's frames."""
    out = kfold_gbt(assemble(applicants, *children), **training)
    label, id_col = training.get("label", "TARGET"), training.get("id_col", "SK_ID_CURR")
    write_table(out["test"].select(id_col, F.col("pred").alias(label)), f"{out_dir}/submission", fmt="csv")
    append_metrics(out["fold_auc"].select(F.lit(name).alias("run"), "fold", "auc"), f"{out_dir}/metrics")
    write_table(EV.top_k_groups(out["importance"], "feature", "importance", top_features), f"{out_dir}/importance")
    return out


def forest(seed: int, trees: int, depth: int, weight: str | None = None) -> RandomForestRegressor:
    """Regression forest whose splits look at all features, as the reference's does."""
    kw = {"weightCol": weight} if weight else {}
    return RandomForestRegressor(featuresCol="features", labelCol="_y", numTrees=trees, maxDepth=depth,
                                 featureSubsetStrategy="all", seed=seed, **kw)


def mean_prediction(fit, members: int, scored: DataFrame, out: str, block: int, parallel: int, folder: str | None) -> DataFrame:
    """`scored` with the mean prediction of `members` models. `fit(number)` trains one (numbers
    from 1); `parallel` of them train side by side. After `block` models their sum is
    stored in place of the one before, so neither the plan nor the driver grows with them, and
    each model scores its rows once."""
    spark = scored.sparkSession
    state, path = store(scored.withColumn("_s", F.lit(0.0)), "members", folder)
    for first in range(1, members + 1, block):
        numbers = range(first, min(first + block, members + 1))
        with ThreadPool(parallel) as pool:
            models = pool.map(inheritable_thread_target(spark)(fit), numbers)
        moved = state
        for i, model in enumerate(models):
            moved = model.setPredictionCol(f"_p{i}").transform(moved)
        total = reduce(lambda x, y: x + y, [F.col(f"_p{i}") for i in range(len(models))], F.col("_s"))
        old, (state, path) = path, store(moved.withColumn("_s", total).select(*state.columns), "members", folder)
        drop_stored(spark, old)
    return state.withColumn(out, F.col("_s") / F.lit(float(members))).drop("_s")


def sampled_label_ensemble(accepted: DataFrame, rejected: DataFrame, scored: DataFrame, pd_col: str, seed: int,
                           trees: int, depth: int, draws: int, id_col: str = "SK_ID_CURR",
                           folder: str | None = None, block: int = 20, parallel: int = 4, bootstrap: bool = True) -> DataFrame:
    """M-13: one forest per draw of Bernoulli(pd) labels for the rejected rows; (id, p_ri) is
    the mean of their predictions for `scored`. Both sets are stored once as one matrix; a draw
    is a column expression over it (see `mean_prediction`)."""
    both = accepted.withColumn("_pd", F.lit(None).cast("double")).drop(pd_col).unionByName(
        rejected.withColumn("_pd", F.col(pd_col).cast("double")).drop(pd_col))
    matrix, path = store(both.select(id_col, "features", "_y", "_pd"), "draws", folder)

    def fit(draw: int):
        drawn = (hash01(id_col, EV.DEFAULT_SEED if seed is None else seed, F.lit(draw)) < F.col("_pd")).cast("double")
        rows = matrix.withColumn("_y", F.when(F.col("_pd").isNull(), F.col("_y")).otherwise(drawn))
        return forest(seed + draw, trees, depth).setBootstrap(bootstrap).fit(rows)

    out = mean_prediction(fit, draws, scored.select(id_col, "features"), "p_ri", block, parallel, folder).select(id_col, "p_ri")
    drop_stored(matrix.sparkSession, path)
    return out


def bagged_trees(df: DataFrame, features: list[str], label: str, members: int, depth: int = 5, seed: int = EV.DEFAULT_SEED,
                 id_col: str = "SK_ID_CURR", folder: str | None = None, block: int = 20, parallel: int = 4) -> DataFrame:
    """(id, pred) of all rows: mean of trees that each train on a balanced draw of the labelled
    rows (`operators.blending.balanced_draws`). The matrix is stored once with the drawing
    members of each row."""
    draws = balanced_draws(df.select(id_col, label), id_col, label, members, seed).groupBy(id_col).agg(F.collect_set("member").alias("_in"))
    rows = _assemble(df, features).select(id_col, "features", F.col(label).cast("double").alias("_y")).join(draws, id_col, "left")
    matrix, path = store(rows, "bagged", folder)

    def fit(member: int):
        mine = matrix.filter(F.array_contains("_in", member))
        return forest(seed + member, 1, depth).setBootstrap(False).fit(mine)

    out = mean_prediction(fit, members, matrix.select(id_col, "features"), "pred", block, parallel, folder).select(id_col, "pred")
    drop_stored(matrix.sparkSession, path)
    return out


def drift_classifier(train: DataFrame, test: DataFrame, features: list[str], k: int = 3, trees: int = 20, depth: int = 5,
                     seed: int = EV.DEFAULT_SEED, id_col: str = "SK_ID_CURR", folder: str | None = None) -> dict[str, DataFrame]:
    """Adversarial validation: forests learn the origin of a row (0 train, 1 test) and judge the
    rows of the fold that they have not seen. Returns `auc` (0.5: the sets look alike), `oof`
    (id, origin, pred) and `importance` (feature, importance, fold)."""
    rows = train.select(id_col, *features).withColumn("_y", F.lit(0.0)).unionByName(test.select(id_col, *features).withColumn("_y", F.lit(1.0)))
    matrix, path = store(_assemble(EV.kfold(rows, id_col, k, seed), features).select(id_col, "fold", "_y", "features"), "drift", folder)

    def fit(f: int):
        return forest(seed + f, trees, depth).fit(matrix.filter(F.col("fold") != f))

    with ThreadPool(k) as pool:
        models = pool.map(inheritable_thread_target(matrix.sparkSession)(fit), range(k))
    parts = [m.transform(matrix.filter(F.col("fold") == f)).select(id_col, F.col("_y").cast("int").alias("origin"), F.col("prediction").alias("pred"))
             for f, m in enumerate(models)]
    oof = materialize(reduce(DataFrame.unionByName, parts), folder)
    drop_stored(matrix.sparkSession, path)
    rows = [(name, float(v), f + 1) for f, m in enumerate(models) for name, v in zip(features, m.featureImportances.toArray(), strict=True)]
    return {"auc": EV.auc(oof, "pred", "origin").select("auc"), "oof": oof,
            "importance": oof.sparkSession.createDataFrame(rows, "feature string, importance double, fold int")}


def reject_inference(pd_data: DataFrame, features: list[str], seed: int = EV.DEFAULT_SEED,
                     trees: int = 100, old_depth: int = 10, new_depth: int = 5, cut: float = 0.15,
                     gap: float = 0.1, labels: str = "sampled", draws: int = 1000,
                     folder: str | None = None) -> DataFrame:
    """B-20: old model on fold1 scores fold2; fold2 is split at PD `cut` into
    accepted / rejected; three new models are evaluated on fold3:
    trained on all of fold2 (true labels), on accepted rows only, and with inferred labels of
    the rejected rows: `labels="sampled"` averages one forest per draw of simulated labels,
    `labels="expected"` fits one forest on both labels of each, weighted by pd and 1 - pd.
    Returns (metric, value) rows: the AUCs and the disagreement capture rate.
    """
    parts = EV.nested_split(pd_data, "SK_ID_CURR", "TARGET", seed)
    v = materialize(_assemble(parts.withColumn("_y", F.col("TARGET").cast("double")), features), folder)
    f1, f2, f3 = (v.filter(F.col("part") == p) for p in ("fold1", "fold2", "fold3"))
    old = forest(seed, trees, old_depth).fit(f1)
    scored2 = materialize(old.transform(f2).withColumnRenamed("prediction", "pd"), folder)
    accepted = scored2.filter(EV.accept_flag("pd", cut) == 1)
    rejected = scored2.filter(EV.accept_flag("pd", cut) == 0)
    m_all = forest(seed, trees, new_depth).fit(f2)
    m_acc = forest(seed, trees, new_depth).fit(accepted.drop("pd"))
    if labels == "sampled":
        inferred = sampled_label_ensemble(accepted, rejected, f3, "pd", seed, trees, new_depth, draws, folder=folder)
    elif labels == "expected":
        rows = (accepted.drop("pd").withColumn("weight", F.lit(1.0))
                .unionByName(EV.expected_reject_rows(rejected, "pd", "_lab", "weight")
                             .withColumn("_y", F.col("_lab").cast("double")).drop("_lab", "pd")))
        inferred = forest(seed, trees, new_depth, "weight").fit(rows).transform(f3).select(
            "SK_ID_CURR", F.col("prediction").alias("p_ri"))
    else:
        raise ValueError('labels must be "sampled" or "expected"')
    p3 = materialize(m_all.transform(f3).select("SK_ID_CURR", "TARGET", F.col("prediction").alias("p_all"))
                     .join(m_acc.transform(f3).select("SK_ID_CURR", F.col("prediction").alias("p_acc")), "SK_ID_CURR")
                     .join(inferred, "SK_ID_CURR"), folder)
    named = [("auc_old_model_fold2", EV.auc(scored2, "pd", "TARGET"))]
    named += [(f"auc_{name}_fold3", EV.auc(p3, name, "TARGET")) for name in ("p_all", "p_acc", "p_ri")]
    out = reduce(DataFrame.unionByName, [f.select(F.lit(n).alias("metric"), F.col("auc").alias("value")) for n, f in named])
    capture = EV.capture_rate(p3, "p_all", "p_acc", "p_ri", gap, cut)
    split = scored2.agg(F.count(F.when(EV.accept_flag("pd", cut) == 1, 1)).cast("double").alias("n_accepted"),
                        F.count(F.when(EV.accept_flag("pd", cut) == 0, 1)).cast("double").alias("n_rejected"))
    capture = capture.select("capture_rate", F.col("n_disagree").cast("double").alias("n_disagree"))
    return (out.unionByName(capture.unpivot([], ["capture_rate", "n_disagree"], "metric", "value"))
            .unionByName(split.unpivot([], ["n_accepted", "n_rejected"], "metric", "value")))

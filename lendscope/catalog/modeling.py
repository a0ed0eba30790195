"""Check queries for folds, exact metrics, reject inference, target encoding
and model runs (M-1..M-15, A-24, K-16, K-17, B-13, B-14, B-20). The full k-fold run over all
tables is `plans.scoring.scoring_run`; it takes too long for a check query (README)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import hash01
from ..operators import evaluation as EV
from ..operators.encode import target_encode_oof, target_fit_transform
from ..plans import application as A
from ..plans import scoring as SC
from ..session import checkpoint_path
from ..sources import roles
from .common import finish, query, r
from .application import _application_features_sql
from .profile import _FOLD, _auc_sql
from .sqlroles import with_roles

_H = "('0x' || substr(md5(CAST(id AS VARCHAR) || '_' || '47'), 1, 8))::BIGINT"


def _h01(*parts: str) -> str:
    s = " || '_' || ".join(parts)
    return f"(('0x' || substr(md5({s}), 1, 8))::BIGINT / 4294967296.0)"


@query("kfold_assign", with_roles("scored") + f"SELECT id, {_FOLD} AS fold FROM scored")
def kfold_assign(spark, base):
    """M-1 shuffled k-fold (k=5, seed 47) as a hash of the id."""
    return finish(EV.kfold(roles.scored(spark, base).select("id"), "id", 5))


@query("stratified_fold", with_roles("scored") + f"""
SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_H}, id) - 1) % 5 AS INTEGER) AS fold
FROM scored WHERE label IS NOT NULL""")
def stratified_fold(spark, base):
    """M-2 stratified k-fold: rows dealt round-robin inside each label by hash order."""
    s = roles.scored(spark, base).filter(F.col("label").isNotNull()).select("id", "label")
    return finish(EV.stratified_kfold(s, "id", "label", 5))


@query("nested_split", with_roles("scored") + f"""
, s AS (SELECT id, label, (row_number() OVER (PARTITION BY label ORDER BY {_H}, id) - 1) % 3 AS f3
        FROM scored WHERE label IS NOT NULL)
, t AS (SELECT id, label, (row_number() OVER (PARTITION BY label ORDER BY {_H}, id) - 1) % 2 AS f2 FROM s WHERE f3 <> 2)
SELECT id, label, CASE WHEN f2 = 1 THEN 'fold2' ELSE 'fold1' END AS part FROM t
UNION ALL SELECT id, label, 'fold3' AS part FROM s WHERE f3 = 2""")
def nested_split(spark, base):
    """M-3 three-way stratified split (fold1 train / fold2 scored / fold3 hold-out)."""
    s = roles.scored(spark, base).filter(F.col("label").isNotNull()).select("id", "label")
    return finish(EV.nested_split(s, "id", "label"))


@query("auc_exact", with_roles("scored") + f"""
, f AS (SELECT *, {_FOLD} AS fold FROM scored)
, a AS (SELECT fold, auc FROM {_auc_sql('f', 'fold')}
        UNION ALL SELECT -1 AS fold, auc FROM {_auc_sql('(SELECT *, 0 AS g FROM f)', 'g')})
SELECT CAST(fold AS INTEGER) AS fold, {r('auc')} AS auc FROM a""")
def auc_exact(spark, base):
    """M-9 exact tie-aware ROC-AUC per fold and overall (fold -1)."""
    return finish(EV.auc_by_fold(EV.kfold(roles.scored(spark, base), "id", 5), "score", "label"))


@query("roc_points", with_roles("scored") + f"""
, g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
        FROM scored WHERE label IS NOT NULL GROUP BY score)
SELECT score AS threshold,
  {r('CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(neg) FROM g)')} AS fpr,
  {r('CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(pos) FROM g)')} AS tpr
FROM g""")
def roc_points(spark, base):
    """M-10 ROC curve points, one per distinct score."""
    return finish(EV.roc_points(roles.scored(spark, base), "score", "label"))


@query("score_threshold_counts", with_roles("scored") + """
SELECT count(*) FILTER (WHERE score / 1000 > 0.3) AS n_above_0_3,
       count(*) FILTER (WHERE score / 1000 < 0.15) AS n_below_0_15,
       count(*) FILTER (WHERE score / 1000 >= 0.15) AS n_at_or_above_0_15 FROM scored""")
def score_threshold_counts(spark, base):
    """M-11 number of scores above / below thresholds."""
    from ..operators.profile import count_where
    p = F.col("score") / 1000
    return finish(roles.scored(spark, base).agg(count_where(p > 0.3).alias("n_above_0_3"),
                                                count_where(p < 0.15).alias("n_below_0_15"),
                                                count_where(p >= 0.15).alias("n_at_or_above_0_15")))


_D = 1000  # draws per rejected row, as in the reference


@query("reject_simulate", with_roles("scored") + f"""
, rej AS (SELECT id, score / 1000 AS pd FROM scored WHERE label IS NOT NULL AND score / 1000 >= 0.15)
, x AS (SELECT id, pd, d.draw FROM rej, (SELECT range AS draw FROM range(1, {_D + 1})) d)
SELECT CAST(draw AS INTEGER) AS draw, count(*) AS n_rows,
       count(*) FILTER (WHERE {_h01('CAST(id AS VARCHAR)', "'47'", 'CAST(draw AS VARCHAR)')} < pd) AS n_pos
FROM x GROUP BY draw""")
def reject_simulate(spark, base):
    """M-13 reject inference by simulated Bernoulli(pd) labels, 1000 draws."""
    s = roles.scored(spark, base).filter(F.col("label").isNotNull()).withColumn("pd", F.col("score") / 1000)
    rej = s.filter(EV.accept_flag("pd") == 0)
    sim = EV.simulate_reject_labels(rej, "id", "pd", _D)
    return finish(sim.groupBy("draw").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sim_label").alias("n_pos")))


@query("reject_weighted", with_roles("scored") + f"""
, s AS (SELECT id, label, score / 1000 AS pd FROM scored WHERE label IS NOT NULL)
SELECT id, label, CAST(1 AS DOUBLE) AS weight FROM s WHERE pd < 0.15
UNION ALL SELECT id, 1 AS label, {r('pd')} AS weight FROM s WHERE pd >= 0.15
UNION ALL SELECT id, 0 AS label, {r('1 - pd')} AS weight FROM s WHERE pd >= 0.15""")
def reject_weighted(spark, base):
    """M-13 exact-expectation reject inference: accepted rows weight 1, each
    rejected row as (1, pd) and (0, 1 - pd)."""
    s = (roles.scored(spark, base).filter(F.col("label").isNotNull())
         .select("id", "label", (F.col("score") / 1000).alias("pd")))
    acc = s.filter(EV.accept_flag("pd") == 1).select("id", "label", F.lit(1.0).alias("weight"))
    rej = EV.expected_reject_rows(s.filter(EV.accept_flag("pd") == 0).drop("label"), "pd").select("id", "label", "weight")
    return finish(acc.unionByName(rej))


@query("capture_rate", with_roles("scored") + f"""
, s AS (SELECT id, {_h01('CAST(id AS VARCHAR)', "'2'")} AS p2, score / 1000 AS p3, {_h01('CAST(id AS VARCHAR)', "'4'")} AS p4 FROM scored)
SELECT count(*) AS n_disagree, {r('avg(CAST(p2 > 0.15 AS DOUBLE))')} AS capture_rate FROM s WHERE p4 - p3 > 0.1""")
def capture_rate(spark, base):
    """M-14 disagreement capture rate over three derived scores."""
    s = roles.scored(spark, base).select(hash01("id", 2).alias("p2"), (F.col("score") / 1000).alias("p3"),
                                         hash01("id", 4).alias("p4"))
    return finish(EV.capture_rate(s, "p4", "p3", "p2"))


@query("fold_average", with_roles("scored") + f"""
, t AS (SELECT id FROM scored WHERE label IS NULL)
, u AS (""" + " UNION ALL ".join(f"SELECT id, {_h01('CAST(id AS VARCHAR)', repr(str(f)))} AS pred FROM t" for f in range(1, 6)) + f""")
SELECT id, {r('avg(pred)')} AS pred FROM u GROUP BY id""")
def fold_average(spark, base):
    """M-8 fold-averaged test prediction over the union (U-2) of 5 fold outputs."""
    t = roles.scored(spark, base).filter(F.col("label").isNull()).select("id")
    frames = [t.select("id", hash01("id", f).alias("pred")) for f in range(1, 6)]
    return finish(EV.fold_average(frames, "id", "pred"))


@query("importance_topk", """
WITH imp AS (SELECT p_name AS feature, CAST(p_size AS DOUBLE) AS importance, CAST(p_partkey % 5 + 1 AS INTEGER) AS fold FROM part)
, top AS (SELECT feature FROM imp GROUP BY feature ORDER BY avg(importance) DESC, feature LIMIT 40)
SELECT * FROM imp WHERE feature IN (SELECT feature FROM top)""")
def importance_topk(spark, base):
    """M-12 / B-14 / L-4: per-fold importances, mean per feature, top 40 rows kept."""
    from ..sources.tables import read_table
    imp = read_table(spark, base, "part").select(
        F.col("p_name").alias("feature"), F.col("p_size").cast("double").alias("importance"),
        (F.col("p_partkey") % 5 + 1).cast("int").alias("fold"))
    return finish(EV.top_k_groups(imp, "feature", "importance", 40))


@query("target_encode_mean", with_roles("scored") + f"""
, e AS (SELECT cat AS k, avg(label) AS m FROM scored WHERE cat IS NOT NULL GROUP BY cat)
SELECT id, cat, {r('e.m')} AS cat_TARGET_MEAN FROM scored LEFT JOIN e ON scored.cat = e.k""")
def target_encode_mean(spark, base):
    """A-24 fit (mean label per category), K-16 transform, K-17 fit_transform (J-3 lookup join)."""
    s = roles.scored(spark, base).select("id", "cat", "label")
    return finish(target_fit_transform(s, "cat", "label", "cat_TARGET_MEAN").drop("label"))


@query("target_encode_oof", with_roles("scored") + f"""
, s AS (SELECT id, cat, label, {_FOLD} AS fold FROM scored)
, pf AS (SELECT cat, fold, sum(CAST(label AS DOUBLE)) AS sm, count(label) AS n FROM s WHERE cat IS NOT NULL GROUP BY cat, fold)
, tot AS (SELECT cat, sum(sm) AS tsm, sum(n) AS tn FROM pf GROUP BY cat)
SELECT s.id, s.cat, s.fold, {r('(tot.tsm - pf.sm) / nullif(CAST(tot.tn - pf.n AS DOUBLE), 0)')} AS cat_TARGET_OOF
FROM s LEFT JOIN pf ON s.cat = pf.cat AND s.fold = pf.fold LEFT JOIN tot ON s.cat = tot.cat""")
def target_encode_oof_q(spark, base):
    """Out-of-fold target encoding (the leakage-free variant of K-17)."""
    s = EV.kfold(roles.scored(spark, base).select("id", "cat", "label"), "id", 5)
    return finish(target_encode_oof(s, "cat", "label", "fold", "cat_TARGET_OOF").drop("label"))


# ----------------------------------------------------------------- closed forms of the learners
_ONE_FEATURE = with_roles("scored") + f"""
, s AS (SELECT id AS SK_ID_CURR, label AS TARGET, CASE WHEN cat = 'en' THEN 1 ELSE 0 END AS x, {_FOLD} AS fold FROM scored)
, t AS (SELECT * FROM s WHERE TARGET IS NOT NULL)"""


def _one_feature(spark, base):
    return roles.scored(spark, base).select(F.col("id").alias("SK_ID_CURR"), F.col("label").alias("TARGET"),
                                            F.coalesce(F.col("cat") == "en", F.lit(False)).cast("int").alias("x"))


@query("gbt_stump_oof", _ONE_FEATURE + f"""
, f AS (SELECT fold, x, 1 / (1 + exp(-2 * (2 * m - 1))) AS p FROM (
    SELECT k.fold, t.x, avg(t.TARGET) AS m FROM (SELECT range AS fold FROM range(5)) k JOIN t ON t.fold <> k.fold GROUP BY 1, 2))
SELECT t.SK_ID_CURR, t.fold, t.TARGET AS label, {r('f.p')} AS pred FROM t JOIN f ON t.fold = f.fold AND t.x = f.x
UNION ALL SELECT s.SK_ID_CURR, -1 AS fold, NULL AS label, {r('avg(f.p)')} AS pred
FROM s JOIN f ON s.x = f.x WHERE s.TARGET IS NULL GROUP BY s.SK_ID_CURR""")
def gbt_stump_oof(spark, base):
    """M-4, M-5, M-7, B-13 in closed form: one tree of depth 1 on a 0/1 feature predicts the
    logistic of its group's mean over the other folds. Every train row appears once, in its
    hash fold; every test row with the mean of k predictions."""
    out = SC.kfold_gbt(_one_feature(spark, base), k=5, max_iter=1, max_depth=1, subsampling=1.0, feature_subset="all")
    test = out["test"].select("SK_ID_CURR", F.lit(-1).alias("fold"), F.lit(None).cast("int").alias("label"), "pred")
    return finish(out["oof"].unionByName(test))


def _boosted_sql(rounds: int, step: float) -> str:
    """Margins of `rounds` trees of depth 1 on the 0/1 feature: per fold model and group, the mean
    of what the margin leaves over; the first tree counts whole. A fold keeps the round with the
    least log loss of its held-out rows."""
    out = """
, g AS (SELECT k.fold, t.x, avg(t.TARGET) AS m FROM (SELECT range AS fold FROM range(5)) k JOIN t ON t.fold <> k.fold GROUP BY 1, 2)
, f1 AS (SELECT *, 2 * m - 1 AS f FROM g)"""
    for i in range(2, rounds + 1):
        out += f"""
, f{i} AS (SELECT * REPLACE (f + {step} * (m * 4 / (1 + exp(2 * f)) - (1 - m) * 4 / (1 + exp(-2 * f))) AS f) FROM f{i - 1})"""
    rows = " UNION ALL ".join(f"SELECT {i} AS round, fold, x, f FROM f{i}" for i in range(1, rounds + 1))
    return out + f"""
, r AS ({rows})
, loss AS (SELECT r.fold, r.round, avg(ln(1 + exp(-2 * (2 * t.TARGET - 1) * r.f))) AS loss FROM r JOIN t ON t.fold = r.fold AND t.x = r.x GROUP BY 1, 2)
, best AS (SELECT fold, arg_min(round, loss) AS round FROM loss GROUP BY fold)
, f AS (SELECT r.fold, r.x, 1 / (1 + exp(-2 * r.f)) AS p FROM r JOIN best ON best.fold = r.fold AND best.round = r.round)"""


@query("gbt_rounds_oof", _ONE_FEATURE + _boosted_sql(3, 0.1) + f"""
SELECT t.SK_ID_CURR, t.fold, t.TARGET AS label, {r('f.p')} AS pred FROM t JOIN f ON t.fold = f.fold AND t.x = f.x
UNION ALL SELECT s.SK_ID_CURR, -1 AS fold, NULL AS label, {r('avg(f.p)')} AS pred
FROM s JOIN f ON s.x = f.x WHERE s.TARGET IS NULL GROUP BY s.SK_ID_CURR""")
def gbt_rounds_oof(spark, base):
    """M-5, B-13 in closed form over several rounds: three trees of depth 1 on a 0/1 feature,
    the last from stored margins."""
    out = SC.kfold_gbt(_one_feature(spark, base), k=5, max_iter=3, max_depth=1, subsampling=1.0, feature_subset="all", block=2)
    test = out["test"].select("SK_ID_CURR", F.lit(-1).alias("fold"), F.lit(None).cast("int").alias("label"), "pred")
    return finish(out["oof"].unionByName(test))


@query("scoring_outputs", _ONE_FEATURE + _boosted_sql(2, 0.1) + f"""
, o AS (SELECT t.fold, t.TARGET AS label, f.p AS score FROM t JOIN f ON t.fold = f.fold AND t.x = f.x)
SELECT 'submission' AS output, CAST(s.SK_ID_CURR AS VARCHAR) AS name, -1 AS fold, {r('avg(f.p)')} AS value
FROM s JOIN f ON s.x = f.x WHERE s.TARGET IS NULL GROUP BY s.SK_ID_CURR
UNION ALL SELECT 'metrics', 'closed form', CAST(fold AS INTEGER), {r('auc')} FROM {_auc_sql('o', 'fold')}
UNION ALL SELECT 'metrics', 'closed form', -1, {r('auc')} FROM {_auc_sql('(SELECT *, 0 AS g FROM o)', 'g')}
UNION ALL SELECT 'importance', 'x', CAST(fold + 1 AS INTEGER), 1.0 FROM g GROUP BY fold HAVING max(m) > min(m)
""")
def scoring_outputs(spark, base):
    """S-4, S-6, B-13, B-14: what a scoring run writes, read back from its files: the submission,
    the metric log and the importances, here of two trees of depth 1 on one 0/1 feature."""
    folder = checkpoint_path(spark, f"scoring-{uuid.uuid4().hex}")
    SC.scoring_run(_one_feature(spark, base), [], folder, "closed form", k=5, max_iter=2, max_depth=1, subsampling=1.0, feature_subset="all")
    submission = spark.read.option("header", True).schema("SK_ID_CURR long, TARGET double").csv(f"{folder}/submission")
    return finish(
        submission.select(F.lit("submission").alias("output"), F.col("SK_ID_CURR").cast("string").alias("name"),
                          F.lit(-1).alias("fold"), F.col("TARGET").alias("value"))
        .unionByName(spark.read.parquet(f"{folder}/metrics").select(F.lit("metrics").alias("output"), F.col("run").alias("name"), "fold", F.col("auc").alias("value")))
        .unionByName(spark.read.parquet(f"{folder}/importance").filter("importance > 0").select(
            F.lit("importance").alias("output"), F.col("feature").alias("name"), "fold", F.col("importance").alias("value"))))


@query("forest_stump", _ONE_FEATURE + f"""
SELECT t.SK_ID_CURR, {r('m.v')} AS pred FROM t JOIN (SELECT x, avg(TARGET) AS v FROM t GROUP BY x) m ON t.x = m.x""")
def forest_stump(spark, base):
    """M-6 in closed form: a forest of one tree of depth 1 on a 0/1 feature predicts group means."""
    train = _one_feature(spark, base).filter(F.col("TARGET").isNotNull()).withColumn("_y", F.col("TARGET").cast("double"))
    v = SC._assemble(train, ["x"])
    return finish(SC.forest(47, 1, 1).setBootstrap(False).fit(v).transform(v).select("SK_ID_CURR", F.col("prediction").alias("pred")))


@query("feature_matrix", f"""
WITH a AS ({_application_features_sql()})
, u AS (UNPIVOT (SELECT COLUMNS(* EXCLUDE (SK_ID_CURR, TARGET))::DOUBLE FROM a) ON COLUMNS(*) INTO NAME feature VALUE value)
, n AS (SELECT count(*) AS n FROM a)
, f AS (SELECT feature, count(*) AS present, sum(value) AS total FROM u GROUP BY feature)
SELECT feature, n.n, {r('total - 999 * (n.n - present)')} AS total FROM f, n""")
def feature_matrix(spark, base):
    """M-4: the assembled matrix, as sums per feature with missing values at -999."""
    from pyspark.ml.functions import vector_to_array
    app = finish(A.application_features(roles.application_train(spark, base), roles.application_test(spark, base)))
    feats = SC.feature_columns(app)
    cells = SC._assemble(app, feats).select(F.posexplode(vector_to_array("features")).alias("at", "value"))
    names = F.array(*[F.lit(c) for c in feats])
    return finish(cells.groupBy(F.element_at(names, F.col("at") + 1).alias("feature")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


# ----------------------------------------------------------------- model run (rows-only)
@query("rf_pd")
def rf_pd(spark, base):
    """B-20 reject-inference experiment on the nine-variable PD data set (M-6, M-13..M-15),
    with the expected labels; one forest per draw, a thousand draws, is no check query."""
    data = A.pd_dataset(roles.application_train(spark, base))
    return finish(SC.reject_inference(data, A.PD_COLUMNS, labels="expected"))

"""Check queries of the notes' extensions: rank-average blending, train/test drift,
undersampling with bagging, scorecards by bands, expected loss; and the closed form of the
ensemble over label draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hash01
from ..operators import blending as BL
from ..operators import drift as DR
from ..operators import evaluation as EV
from ..operators import scorecard as SCARD
from ..plans import scoring as SC
from ..sources import roles
from .common import finish, query, r
from .modeling import _h01, _one_feature
from .profile import _auc_sql
from .sqlroles import with_roles

_MODELS = {"m1": 0.5, "m2": 0.3, "m3": 0.2}
_THREE = with_roles("scored") + f"""
, s AS (SELECT id, score / 1000 AS m1, CASE WHEN id % 7 = 0 THEN NULL ELSE {_h01('CAST(id AS VARCHAR)', "'2'")} END AS m2,
          CAST(id % 10 AS DOUBLE) AS m3 FROM scored)
, l AS (""" + " UNION ALL ".join(f"SELECT id, '{m}' AS model, {w} AS w, {m} AS score FROM s WHERE {m} IS NOT NULL" for m, w in _MODELS.items()) + """)
, p AS (SELECT id, model, w, percent_rank() OVER (PARTITION BY model ORDER BY score) AS pr FROM l)"""


def _three_models(spark, base):
    s = roles.scored(spark, base)
    return s.select("id", (F.col("score") / 1000).alias("m1"), F.when(F.col("id") % 7 != 0, hash01("id", 2)).alias("m2"),
                    (F.col("id") % 10).cast("double").alias("m3"))


@query("percent_ranks", _THREE + f"SELECT id, model, {r('pr')} AS percent_rank FROM p")
def percent_ranks(spark, base):
    """Percent ranks of three score sets, ties and missing scores among them."""
    return finish(BL.percent_ranks(_three_models(spark, base), list(_MODELS), "id"))


@query("rank_blend", _THREE + f"SELECT id, {r('sum(w * pr) / sum(w)')} AS blend FROM p GROUP BY id")
def rank_blend(spark, base):
    """Rank-average blending of three models with weights."""
    return finish(BL.blend_ranks(_three_models(spark, base), _MODELS, "id"))


_SHIFT = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_GOODS_PRICE", "DAYS_BIRTH", "EXT_SOURCE_1", "EXT_SOURCE_3", "OWN_CAR_AGE"]


@query("feature_drift", with_roles("app") + f"""
, u AS (SELECT * FROM (SELECT CAST(TARGET IS NULL AS INTEGER) AS label, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _SHIFT)} FROM app) UNPIVOT INCLUDE NULLS (score FOR feature IN ({', '.join(_SHIFT)})))
, a AS (SELECT feature, auc FROM {_auc_sql('(SELECT * FROM u WHERE score IS NOT NULL)', 'feature')})
SELECT u.feature, {r('any_value(a.auc)')} AS auc, {r('avg(score) FILTER (WHERE label = 0)')} AS mean_train, {r('avg(score) FILTER (WHERE label = 1)')} AS mean_test,
  {r('avg(CAST(score IS NULL AS DOUBLE)) FILTER (WHERE label = 0)')} AS null_train, {r('avg(CAST(score IS NULL AS DOUBLE)) FILTER (WHERE label = 1)')} AS null_test
FROM u JOIN a ON a.feature = u.feature GROUP BY u.feature""")
def feature_drift(spark, base):
    """Per feature, how well it alone tells train from test, means and missing shares."""
    return finish(DR.feature_drift(roles.application_train(spark, base), roles.application_test(spark, base), _SHIFT))


@query("stability_index", with_roles("app") + f"""
, b AS (SELECT CAST(floor(AMT_CREDIT / 1000) AS INTEGER) AS band, count(*) FILTER (WHERE TARGET IS NOT NULL) AS a, count(*) FILTER (WHERE TARGET IS NULL) AS b FROM app GROUP BY 1)
, s AS (SELECT band, greatest(a, 0.5) / (SELECT sum(a) FROM b) AS x, greatest(b, 0.5) / (SELECT sum(b) FROM b) AS y FROM b)
SELECT band, {r('x')} AS share_train, {r('y')} AS share_test, {r('(y - x) * ln(y / x)')} AS psi FROM s""")
def stability_index(spark, base):
    """Population stability of a banded column between train and test."""
    both = DR.with_origin(roles.application_train(spark, base), roles.application_test(spark, base), ["AMT_CREDIT"])
    return finish(DR.stability_index(both.withColumn("band", F.floor(F.col("AMT_CREDIT") / 1000).cast("int")), "band"))


_DRAWN = with_roles("scored") + f"""
, c AS (SELECT count(*) FILTER (WHERE label = 1) AS ones, count(*) FILTER (WHERE label <> 1) AS rest FROM scored)
, d AS (SELECT id, label, cat, CAST(m.range AS INTEGER) AS member FROM scored, range(1, 6) m, c
        WHERE label IS NOT NULL AND ((label = 1) <> (ones > rest)
          OR {_h01('CAST(id AS VARCHAR)', "'47'", 'CAST(m.range AS VARCHAR)')} < CAST(least(ones, rest) AS DOUBLE) / greatest(ones, rest)))"""


@query("balanced_draws", _DRAWN + "SELECT id, label, member FROM d")
def balanced_draws(spark, base):
    """Undersampling for a bag of five: all rows of the rarer label, hash-keyed draws of the other."""
    return finish(BL.balanced_draws(roles.scored(spark, base).select("id", "label"), "id", "label", 5))


@query("bagged_stumps", _DRAWN + f"""
, g AS (SELECT member, CASE WHEN cat = 'en' THEN 1 ELSE 0 END AS x, avg(label) AS m FROM d GROUP BY 1, 2)
, p AS (SELECT x, avg(m) AS p FROM g GROUP BY x)
SELECT s.id AS SK_ID_CURR, {r('p.p')} AS pred FROM scored s JOIN p ON p.x = CASE WHEN s.cat = 'en' THEN 1 ELSE 0 END""")
def bagged_stumps(spark, base):
    """Bagging in closed form: trees of depth 1 on a 0/1 feature predict group means of their draws."""
    return finish(SC.bagged_trees(_one_feature(spark, base), ["x"], "TARGET", 5, depth=1, block=2))


@query("reject_ensemble", with_roles("scored") + f"""
, s AS (SELECT id, label, score / 1000 AS pd, CASE WHEN cat = 'en' THEN 1 ELSE 0 END AS x FROM scored)
, d AS (SELECT m.range AS draw, x, CASE WHEN pd < 0.15 THEN label
          ELSE CAST({_h01('CAST(id AS VARCHAR)', "'47'", 'CAST(m.range AS VARCHAR)')} < pd AS INTEGER) END AS y FROM s, range(1, 8) m WHERE label IS NOT NULL)
, g AS (SELECT draw, x, avg(y) AS m FROM d GROUP BY 1, 2)
, p AS (SELECT x, avg(m) AS p FROM g GROUP BY x)
SELECT s.id AS SK_ID_CURR, {r('p.p')} AS p_ri FROM s JOIN p ON p.x = s.x""")
def reject_ensemble(spark, base):
    """M-13, B-20: the ensemble over label draws of the rejected rows, in closed form: forests
    of one tree of depth 1 on a 0/1 feature predict group means, averaged over seven draws."""
    s = roles.scored(spark, base).select(
        F.col("id").alias("SK_ID_CURR"), F.col("label").cast("double").alias("_y"), (F.col("score") / 1000).alias("pd"),
        F.coalesce(F.col("cat") == "en", F.lit(False)).cast("int").alias("x"))
    v = SC._assemble(s, ["x"])
    known = v.filter(F.col("_y").isNotNull())
    accepted, rejected = (known.filter(EV.accept_flag("pd") == a) for a in (1, 0))
    return finish(SC.sampled_label_ensemble(accepted, rejected, v, "pd", EV.DEFAULT_SEED, 1, 1, 7, block=3, bootstrap=False))


_CARD = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "EXT_SOURCE_1", "OWN_CAR_AGE"]
_CARD_SQL = with_roles("app") + f"""
, k AS (SELECT * FROM app WHERE TARGET IS NOT NULL)
, l AS (SELECT * FROM (SELECT TARGET, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _CARD)} FROM k) UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(_CARD)})))
, b AS (SELECT *, CASE WHEN value IS NULL THEN -1 ELSE CAST(floor(5 * (rank() OVER (PARTITION BY feature, value IS NULL ORDER BY value) - 1)
          / CAST(count(*) OVER (PARTITION BY feature, value IS NULL) AS DOUBLE)) AS INTEGER) END AS band FROM l)
, t AS (SELECT count(*) FILTER (WHERE TARGET = 1) AS bad, count(*) FILTER (WHERE TARGET <> 1) AS good FROM k)
, c AS (SELECT feature, band, min(value) AS low, max(value) AS high, count(*) AS n, count(*) FILTER (WHERE TARGET = 1) AS bad FROM b GROUP BY 1, 2)
, w AS (SELECT c.*, ln(((n - c.bad + 0.5) / (t.good + 0.5)) / ((c.bad + 0.5) / (t.bad + 0.5))) AS woe, ln((t.good + 0.5) / (t.bad + 0.5)) AS prior FROM c, t)
, card AS (SELECT feature, band, low, high, n, bad, woe,
    (600 - 20 / ln(2) * ln(50) + 20 / ln(2) * prior) / {float(len(_CARD))} + 20 / ln(2) * woe AS points FROM w)"""


@query("scorecard_bands", _CARD_SQL + f"SELECT feature, band, {r('low')} AS low, {r('high')} AS high, n, bad, {r('woe')} AS woe, {r('points')} AS points FROM card")
def scorecard_bands(spark, base):
    """An additive scorecard: equal-frequency bands, weights of evidence, points per band."""
    return finish(SCARD.scorecard(roles.application(spark, base), _CARD, "TARGET", bands=5))


@query("scorecard_scores", _CARD_SQL + f"""
, u AS (SELECT * FROM (SELECT SK_ID_CURR, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _CARD)} FROM app) UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(_CARD)})))
, f AS (SELECT feature, avg(points) AS mean_points, any_value(points) FILTER (WHERE band = -1) AS gap, min(band) FILTER (WHERE band >= 0) AS first_band FROM card GROUP BY feature)
, h AS (SELECT u.SK_ID_CURR, u.feature, u.value, max(card.band) AS band FROM u LEFT JOIN card ON card.feature = u.feature AND card.band >= 0 AND u.value >= card.low GROUP BY ALL)
SELECT h.SK_ID_CURR, {r('sum(CASE WHEN h.value IS NULL THEN coalesce(f.gap, f.mean_points) ELSE card.points END)')} AS score
FROM h JOIN f ON f.feature = h.feature LEFT JOIN card ON card.feature = h.feature AND card.band = coalesce(h.band, f.first_band) AND h.value IS NOT NULL GROUP BY h.SK_ID_CURR""")
def scorecard_scores(spark, base):
    """Every applicant's score by the card fitted on the labelled ones; unseen and missing values included."""
    app = roles.application(spark, base)
    return finish(SCARD.apply_scorecard(app, SCARD.scorecard(app, _CARD, "TARGET", bands=5)).select("SK_ID_CURR", "score"))


_CUTS = [0.2, 0.4, 0.6, 0.8]


@query("expected_loss", with_roles("app") + f"""
, e AS (SELECT EXT_SOURCE_1 AS pd, AMT_CREDIT AS ead, AMT_CREDIT * EXT_SOURCE_1 * 0.45 AS el,
          CASE WHEN EXT_SOURCE_1 IS NOT NULL THEN {' + '.join(f'CAST(EXT_SOURCE_1 >= {c} AS INTEGER)' for c in _CUTS)} END AS grade FROM app)
, g AS (SELECT grade, count(*) AS loans, sum(ead) AS exposure, sum(el) AS expected_loss, avg(pd) AS mean_pd FROM e GROUP BY grade
        UNION ALL SELECT -1, count(*), sum(ead), sum(el), avg(pd) FROM e)
SELECT grade, loans, {r('exposure')} AS exposure, {r('expected_loss')} AS expected_loss, {r('mean_pd')} AS mean_pd,
  {r('expected_loss / nullif(exposure, 0)')} AS loss_rate FROM g""")
def expected_loss(spark, base):
    """Loan-level exposure x PD x LGD, rolled up by grade with the portfolio total as grade -1."""
    loans = SCARD.expected_loss(roles.application(spark, base), "EXT_SOURCE_1", "AMT_CREDIT", 0.45)
    return finish(SCARD.loss_by_band(loans, "EXT_SOURCE_1", "AMT_CREDIT", "expected_loss", _CUTS))

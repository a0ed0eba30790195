"""Folds and exact evaluation metrics (M-1..M-3, M-8..M-15).

Everything here is data-parallel:

* fold ids come from a hash of the row id (reproducible in any engine);
  stratified folds rank rows inside each stratum by that hash with bucketed
  prefix sums, so a stratum holding most rows is still spread over many tasks;
* ROC-AUC is computed exactly (tie-aware, mid-rank) from per-score label counts
  and a global prefix sum of negatives, never by sorting all rows in one task;
* reject inference draws simulated labels with a hash of (row, draw), so each
  draw is a reproducible column expression rather than a driver-side loop.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hash01, hash_hex8
from .series import N_BUCKETS, prefix_sums, quantile_bucket, uniform_bucket

DEFAULT_SEED = 47           # fixed value: the reference's fold seed


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = DEFAULT_SEED, out: str = "fold") -> DataFrame:
    """Shuffled k-fold assignment (M-1): fold = hash(id, seed) mod k. A pure
    projection (no shuffle); fold sizes are balanced in expectation."""
    return df.withColumn(out, F.pmod(hash_hex8(id_col, seed), F.lit(k)).cast("int"))


def stratified_kfold(df: DataFrame, id_col: str, label_col: str, k: int = 5, seed: int = DEFAULT_SEED,
                     out: str = "fold", n_buckets: int | None = None) -> DataFrame:
    """Stratified k-fold (M-2): rank rows inside each label by (hash, id) and
    deal them round-robin, so every fold gets the same share (+-1) of each label."""
    nb = n_buckets or N_BUCKETS
    tmp = df.withColumns({"_h": hash_hex8(id_col, seed), "_one": F.lit(1).cast("bigint")})
    ranked = prefix_sums(tmp, ["_h", id_col], ["_one"], uniform_bucket(F.col("_h"), nb), [label_col])
    return ranked.withColumn(out, F.pmod(F.col("_one_before"), F.lit(k)).cast("int")).drop("_h", "_one", "_one_before")


def nested_split(df: DataFrame, id_col: str, label_col: str, seed: int = DEFAULT_SEED,
                 out: str = "part", n_buckets: int | None = None) -> DataFrame:
    """Three-way stratified split (M-3): a stratified 3-fold split keeps its
    last fold as `fold3`; the remaining rows are split 2-fold into `fold1`
    (training) and `fold2` (the fold that is scored and thresholded).

    One rank r inside each label gives all three parts: r mod 3 = 2 is fold3, and of the
    rows before r, (r + 1) div 3 are in it, so r - (r + 1) div 3 is the rank among the rest."""
    nb = n_buckets or N_BUCKETS
    tmp = df.withColumns({"_h": hash_hex8(id_col, seed), "_one": F.lit(1).cast("bigint")})
    ranked = prefix_sums(tmp, ["_h", id_col], ["_one"], uniform_bucket(F.col("_h"), nb), [label_col])
    r = F.col("_one_before")
    rest = r - F.floor((r + 1) / 3)
    part = F.when(r % 3 == 2, F.lit("fold3")).when(rest % 2 == 1, F.lit("fold2")).otherwise(F.lit("fold1"))
    return ranked.withColumn(out, part).select(*df.columns, out)


def score_label_counts(df: DataFrame, score: str, label: str, by: Iterable[str] = ()) -> DataFrame:
    by = list(by)
    lab = F.col(label)
    return (df.filter(lab.isNotNull() & F.col(score).isNotNull())
            .groupBy(*by, score).agg(F.count(F.when(lab == 1, F.lit(1))).alias("pos"),
                                     F.count(F.when(lab != 1, F.lit(1))).alias("neg")))


def auc(df: DataFrame, score: str, label: str, by: Iterable[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC (M-9) with ties counted as one half, per group of `by`.

    AUC = sum over scores s of pos(s) * (neg(score < s) + neg(s) / 2) / (P * N).
    """
    return auc_of_counts(score_label_counts(df, score, label, by), score, by, n_buckets)


def auc_of_counts(g: DataFrame, score: str, by: Iterable[str] = (), n_buckets: int | None = None) -> DataFrame:
    """`auc` from the counts of `score_label_counts`."""
    by = list(by)
    p = prefix_sums(g, [score], ["neg"], quantile_bucket(g, score, n_buckets), by)
    contrib = F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    return p.groupBy(*by).agg(
        F.try_divide(F.sum(contrib), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def auc_by_fold(df: DataFrame, score: str, label: str, fold: str = "fold", n_buckets: int | None = None) -> DataFrame:
    """(fold, auc) of every fold and, as fold -1, of all rows: the input is counted once by
    (fold, score), each count stands for its fold and for all rows, one prefix sum."""
    g = score_label_counts(df, score, label, [fold])
    both = g.withColumn(fold, F.explode(F.array(F.col(fold).cast("int"), F.lit(-1))))
    both = both.groupBy(fold, score).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return auc_of_counts(both, score, [fold], n_buckets).select(fold, "auc")


def roc_points(df: DataFrame, score: str, label: str, by: Iterable[str] = (),
               n_buckets: int | None = None) -> DataFrame:
    """ROC curve points (M-10): for every distinct score t (taken as threshold
    `score >= t`), the false and true positive rates."""
    by = list(by)
    g = score_label_counts(df, score, label, by)
    p = prefix_sums(g, [F.col(score).desc()], ["pos", "neg"], -quantile_bucket(g, score, n_buckets), by)
    if by:
        j = p.join(g.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N")), by)
    else:  # one global pair of totals, as scalars of the plan
        j = p.withColumns({"_P": g.agg(F.sum("pos")).scalar(), "_N": g.agg(F.sum("neg")).scalar()})
    return j.select(*by, F.col(score).alias("threshold"),
                    F.try_divide((F.col("neg_before") + F.col("neg")).cast("double"), F.col("_N").cast("double")).alias("fpr"),
                    F.try_divide((F.col("pos_before") + F.col("pos")).cast("double"), F.col("_P").cast("double")).alias("tpr"))


def capture_rate(df: DataFrame, new_col: str, base_col: str, probe_col: str,
                 gap: float = 0.1, cut: float = 0.15) -> DataFrame:
    """Disagreement capture rate (M-14): among rows where the new score exceeds
    the baseline by more than `gap`, the share whose probe score exceeds `cut`."""
    sel = df.filter(F.col(new_col) - F.col(base_col) > gap)
    return sel.agg(F.count(F.lit(1)).alias("n_disagree"),
                   F.avg((F.col(probe_col) > cut).cast("double")).alias("capture_rate"))


def accept_flag(pd_col: str | Column, cut: float = 0.15) -> Column:
    """Accept/reject decision by PD threshold (F-7, M-15): 1 = accepted (pd < cut)."""
    c = F.col(pd_col) if isinstance(pd_col, str) else pd_col
    return (c < cut).cast("int")


def simulate_reject_labels(rejected: DataFrame, id_col: str, pd_col: str, draws: int,
                           seed: int = DEFAULT_SEED, out: str = "sim_label") -> DataFrame:
    """Reject inference by simulation (M-13): each rejected row is repeated for
    draws 1..`draws` with a Bernoulli(pd) label from a hash of (id, seed, draw).
    Output grows by the fixed factor `draws`; no pairing between rows."""
    x = rejected.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    return x.withColumn(out, (hash01(id_col, seed, "draw") < F.col(pd_col)).cast("int"))


def expected_reject_rows(rejected: DataFrame, pd_col: str, label_out: str = "label",
                         weight_out: str = "weight") -> DataFrame:
    """Exact-expectation form of reject inference (M-13): every rejected row
    becomes (label 1, weight pd) and (label 0, weight 1 - pd)."""
    pairs = F.explode(F.array(
        F.struct(F.lit(1).alias("l"), F.col(pd_col).cast("double").alias("w")),
        F.struct(F.lit(0).alias("l"), (F.lit(1.0) - F.col(pd_col)).alias("w"))))
    return (rejected.select("*", pairs.alias("_lw"))
            .withColumn(label_out, F.col("_lw.l")).withColumn(weight_out, F.col("_lw.w")).drop("_lw"))


def fold_average(frames: Iterable[DataFrame], id_col: str, pred_col: str, out: str | None = None) -> DataFrame:
    """Average per id of the predictions of several fold models (M-8, U-2)."""
    frames = list(frames)
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy(id_col).agg(F.avg(pred_col).alias(out or pred_col))


def top_k_groups(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """Rows of the k groups with the highest mean `value` (L-4, M-12):
    mean per group, top k (ties broken by group name), semi join back."""
    means = df.groupBy(group).agg(F.avg(value).alias("_m"))
    top = means.orderBy(F.col("_m").desc(), F.col(group).asc()).limit(k).select(group)
    return df.join(top, group, "left_semi")

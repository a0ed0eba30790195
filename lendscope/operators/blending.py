"""Blending of score sets and balanced draws of a skewed label (notes of the reference: rank
averages of several models, undersampling with bagging).

* Percent ranks come from counts per distinct score and bucketed prefix sums: no task sorts a
  whole score set, and equal scores, however many, are one row of the ranking.
* A balanced draw is a hash of (id, member): a column expression, the same in any engine and
  after any recomputation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hash01
from .evaluation import DEFAULT_SEED
from .series import prefix_sums, quantile_bucket


def percent_ranks(df: DataFrame, scores: Mapping[str, float] | list[str], id_col: str) -> DataFrame:
    """(id, model, percent_rank) in long form: (rank - 1) / (n - 1) among the model's non-null
    scores, ties with the smallest rank; 0 where a model has one score. Null scores have no row."""
    long = df.select(id_col, F.explode(F.array(*[F.struct(F.lit(s).alias("model"), F.col(s).cast("double").alias("score")) for s in scores])).alias("m")) \
        .select(id_col, "m.model", "m.score").filter(F.col("score").isNotNull())
    counts = long.groupBy("model", "score").agg(F.count(F.lit(1)).alias("_n"))
    ranked = prefix_sums(counts, ["score"], ["_n"], quantile_bucket(counts, "score"), ["model"])
    total = counts.groupBy("model").agg(F.sum("_n").alias("_all"))
    ranks = ranked.join(F.broadcast(total), "model").select(                     # a row per model
        "model", "score", F.coalesce(F.try_divide(F.col("_n_before").cast("double"), (F.col("_all") - 1).cast("double")), F.lit(0.0)).alias("percent_rank"))
    return long.join(ranks, ["model", "score"]).select(id_col, "model", "percent_rank")


def blend_ranks(df: DataFrame, weights: Mapping[str, float], id_col: str, out: str = "blend") -> DataFrame:
    """(id, blend): weighted mean of the percent ranks of several score columns, over the models
    that scored the row; null where none did. Ids are unique."""
    of_model = F.element_at(F.create_map(*[x for s, w in weights.items() for x in (F.lit(s), F.lit(float(w)))]), F.col("model"))
    ranks = percent_ranks(df, list(weights), id_col).withColumn("_w", of_model)
    mean = ranks.groupBy(id_col).agg(F.try_divide(F.sum(F.col("_w") * F.col("percent_rank")), F.sum("_w")).alias(out))
    return df.select(id_col).join(mean, id_col, "left")


def balanced_draws(df: DataFrame, id_col: str, label: str, members: int, seed: int = DEFAULT_SEED, out: str = "member") -> DataFrame:
    """Undersampling for a bag of models: `df` with a row per member (from 1) that draws it. Every
    row of the rarer label is in all draws; a row of the other label is drawn where the hash of
    (id, seed, member) lies below the ratio of the two counts. Rows without a label are in none."""
    y = F.col(label)
    both = df.agg(F.count(F.when(y == 1, 1)).alias("ones"), F.count(F.when(y != 1, 1)).alias("rest"))
    ones, rest = F.col("ones"), F.col("rest")
    ratio = both.select(F.struct(F.try_divide(F.least(ones, rest).cast("double"), F.greatest(ones, rest).cast("double")).alias("share"),
                                 (ones > rest).alias("ones_are_many"))).scalar()
    drawn = df.filter(y.isNotNull()).withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(members))))
    many = (y == 1) == ratio["ones_are_many"]
    return drawn.filter(~many | (hash01(id_col, seed, out) < ratio["share"]))

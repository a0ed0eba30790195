"""Child-table builders keyed by applicant: previous applications (B-6),
point-of-sale history (B-7, B-8, B-9), instalments (B-10), card balances
(B-11), and the final assembly of all feature tables (B-12).

Each builder is ONE partial+final aggregate on SK_ID_CURR (cohorts fused as
conditional aggregates), except the two-level POS roll-up (contract, then
applicant) which needs two. The assembly is a chain of left joins on the same
key; every feature table is already hash-partitioned on SK_ID_CURR by its
aggregate, so Spark reuses that partitioning and only the applicant table is
shuffled (or the small sides are broadcast by AQE).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clip0, differs_or_missing, nullif_sentinel, safe_div
from ..operators.aggspec import AggSpec, aggregate
from ..operators.encode import one_hot, string_columns

KEYS = ("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV")

# Declared statistics of the reference's builders.
PREV_NUM_AGG = {
    "AMT_ANNUITY": ["max", "mean"],
    "AMT_APPLICATION": ["max", "mean"],
    "AMT_CREDIT": ["max", "mean"],
    "APP_CREDIT_PERC": ["max", "mean"],
    "AMT_DOWN_PAYMENT": ["max", "mean"],
    "AMT_GOODS_PRICE": ["max", "mean"],
    "HOUR_APPR_PROCESS_START": ["max", "mean"],
    "RATE_DOWN_PAYMENT": ["max", "mean"],
    "DAYS_DECISION": ["max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
}
PREV_SENTINEL_DAYS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
                      "DAYS_LAST_DUE", "DAYS_TERMINATION"]
POS_AGG = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
INSTAL_AGG = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["mean", "var"],
    "PAYMENT_DIFF": ["mean", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
}
CARD_STATS = ["max", "mean", "sum", "var"]


def _mean_of_everything(columns: Iterable[str], keep_key_means: bool) -> AggSpec:
    return AggSpec.every([c for c in columns if keep_key_means or c not in KEYS], ["mean"])


def previous_applications(prev: DataFrame, policy: str = "override", keep_key_means: bool = False,
                          vocab: dict | None = None) -> DataFrame:
    """B-6: PREV_ over all applications, APPROVED_ and REFUSED_ cohorts."""
    texts = string_columns(prev)
    oh, _ = one_hot(prev, None, dummy_na=True, vocab=vocab, keep_original=True)
    raw_columns = [c for c in oh.columns if c not in texts]       # before the derived ratio (as in the reference)
    oh = oh.withColumns({c: nullif_sentinel(c) for c in PREV_SENTINEL_DAYS})
    oh = oh.withColumn("APP_CREDIT_PERC", safe_div("AMT_APPLICATION", "AMT_CREDIT"))
    num = AggSpec(PREV_NUM_AGG)
    spec = num.merge(_mean_of_everything(raw_columns, keep_key_means), policy=policy)
    return aggregate(oh, "SK_ID_CURR", spec, "PREV_", cohorts={
        "APPROVED_": (F.col("NAME_CONTRACT_STATUS") == "Approved", num),
        "REFUSED_": (F.col("NAME_CONTRACT_STATUS") == "Refused", num),
    })


def pos_cash(pos: DataFrame, policy: str = "override", keep_key_means: bool = False,
             vocab: dict | None = None) -> DataFrame:
    """B-7: POS_ statistics plus POS_COUNT (rows per applicant)."""
    oh, _ = one_hot(pos, None, dummy_na=True, vocab=vocab)
    spec = AggSpec(POS_AGG).merge(_mean_of_everything(oh.columns, keep_key_means), policy=policy)
    return aggregate(oh, "SK_ID_CURR", spec, "POS_", extra=[F.count(F.lit(1)).alias("POS_COUNT")])


def pos_changed_contract(pos: DataFrame) -> DataFrame:
    """B-8: per contract, whether its instalment count ever changed (missing
    comparison counts as changed); per applicant, POS_COUNT and the mean of
    that flag over its contracts. Two-level roll-up (A-15) + left join (J-2).

    The rows are read once, into counts and bounds per (applicant, contract); one further
    aggregate rolls those up by applicant and by contract side by side. A contract with
    several applicants belongs to the largest id."""
    pairs = pos.groupBy("SK_ID_CURR", "SK_ID_PREV").agg(
        F.count(F.lit(1)).alias("n"), F.min("CNT_INSTALMENT").alias("lo"), F.max("CNT_INSTALMENT").alias("hi"))
    by_applicant = F.struct(F.col("SK_ID_CURR").alias("c"), F.lit(None).alias("p"), "n", F.lit(None).alias("own"),
                            F.lit(None).alias("lo"), F.lit(None).alias("hi"))
    by_contract = F.struct(F.lit(None).alias("c"), F.col("SK_ID_PREV").alias("p"), F.lit(None).alias("n"),
                           F.col("SK_ID_CURR").alias("own"), "lo", "hi")
    both = (pairs.select(F.explode(F.array(by_applicant, by_contract)).alias("x")).select("x.*").groupBy("c", "p")
            .agg(F.sum("n").alias("n"), F.max("own").alias("own"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    flag = F.when(F.col("c").isNull(), differs_or_missing(F.col("hi"), F.col("lo")))
    return (both.select(F.coalesce("c", "own").alias("SK_ID_CURR"), "n", flag.alias("flag")).groupBy("SK_ID_CURR")
            .agg(F.sum("n").cast("double").alias("POS_COUNT"), F.avg("flag").alias("POS_CHANGED_CONTRACT")))


def pos_n_contract(pos: DataFrame) -> DataFrame:
    """B-9: rows and distinct contracts per applicant (A-2, A-4), columns
    renamed positionally (P-6)."""
    return (pos.groupBy("SK_ID_CURR").agg(F.count(F.lit(1)), F.count_distinct("SK_ID_PREV"))
            .toDF("SK_ID_CURR", "POS_COUNT", "POS_N_CONTRACT"))


def installments(instal: DataFrame, policy: str = "override", keep_key_means: bool = False,
                 vocab: dict | None = None) -> DataFrame:
    """B-10: INSTAL_ statistics of payment ratios, days past / before due, and counts."""
    oh, _ = one_hot(instal, None, dummy_na=True, vocab=vocab)
    raw_columns = list(oh.columns)
    oh = oh.withColumns({
        "PAYMENT_PERC": safe_div("AMT_PAYMENT", "AMT_INSTALMENT"),
        "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "DPD": clip0(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")),
        "DBD": clip0(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT")),
    })
    spec = AggSpec(INSTAL_AGG).merge(_mean_of_everything(raw_columns, keep_key_means), policy=policy)
    return aggregate(oh, "SK_ID_CURR", spec, "INSTAL_", extra=[F.count(F.lit(1)).alias("INSTAL_COUNT")])


def credit_card(card: DataFrame, vocab: dict | None = None) -> DataFrame:
    """B-11: every numeric column (and dummy) x {max, mean, sum, var} plus CC_COUNT."""
    oh, _ = one_hot(card, None, dummy_na=True, vocab=vocab)
    oh = oh.drop("SK_ID_PREV")
    spec = AggSpec.all_numeric(oh, CARD_STATS, exclude=["SK_ID_CURR"])
    return aggregate(oh, "SK_ID_CURR", spec, "CC_", extra=[F.count(F.lit(1)).alias("CC_COUNT")])


def assemble(applicants: DataFrame, *features: DataFrame) -> DataFrame:
    """B-12: left-join every feature table onto the applicant rows (J-1).
    Row count and key uniqueness of `applicants` are preserved because every
    feature table has exactly one row per SK_ID_CURR."""
    out = applicants
    for f in features:
        out = out.join(f, "SK_ID_CURR", "left")
    return out

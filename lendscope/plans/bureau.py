"""External-credit feature builders (B-2 and the flagship credit summary).

Plan shape (B-2): monthly rows -> one partial+final aggregate per credit ->
left join to the credits on the credit id -> ONE aggregate per applicant that
computes the all-credit spec and the Active/Closed cohort specs together.
The reference runs three filtered group-bys and two joins for the cohorts;
here they are conditional aggregates in the same pass (one exchange on the
applicant key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggspec import AggSpec, aggregate
from ..operators.encode import listed, one_hot, string_columns
from .behaviour import STATUS_CODES

# Declared statistics of the reference's credit builder.
BUREAU_NUM_AGG = {
    "DAYS_CREDIT": ["mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["mean"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}

KEYS = ("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV")

# Flagship summary: per applicant, all credits and the open / closed cohorts.
SUMMARY_SPEC = {
    "SK_ID_BUREAU": ["size"],
    "DAYS_CREDIT": ["mean", "var", "min", "max"],
    "AMT_CREDIT_SUM": ["mean", "sum", "max"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "CNT_CREDIT_PROLONG": ["sum", "count"],
}


def credit_summary(credit: DataFrame, applicants: DataFrame) -> DataFrame:
    """Per applicant: size/mean/var/sum/min/max over all credits, plus the same
    over Active and Closed credits, attached to every applicant (left join)."""
    spec = AggSpec(SUMMARY_SPEC)
    feats = aggregate(credit, "SK_ID_CURR", spec, "BURO_", cohorts={
        "ACTIVE_": (F.col("CREDIT_ACTIVE") == "Active", spec),
        "CLOSED_": (F.col("CREDIT_ACTIVE") == "Closed", spec),
    })
    return applicants.select("SK_ID_CURR").join(feats, "SK_ID_CURR", "left")


def balance_per_credit(hist: DataFrame, policy: str = "override", dummy_na: bool = True,
                       vocab: dict | None = None) -> tuple[DataFrame, list[str]]:
    """Month -> credit roll-up: share of each status and month min/max/size/mean.

    STATUS is a closed domain of the data model, so its levels are fixed
    (STATUS_CODES) instead of discovered: discovery would cost a full scan of
    the monthly table, the largest input. A status outside the list stops the job.
    Pass `vocab={"STATUS": None}` to discover the levels from the data instead."""
    vocab = dict(vocab or {})
    if vocab.get("STATUS", STATUS_CODES) is None:
        del vocab["STATUS"]
    else:
        levels = vocab.setdefault("STATUS", STATUS_CODES)
        hist = hist.withColumn("STATUS", listed("STATUS", levels))
    oh, status_cols = one_hot(hist, ["STATUS"], dummy_na=dummy_na, vocab=vocab)
    spec = AggSpec.every(status_cols + ["MONTHS_BALANCE"], ["mean"]).merge(
        {"MONTHS_BALANCE": ["min", "max", "size", "mean"]}, policy="override")
    agg = oh.groupBy("SK_ID_BUREAU").agg(*spec.exprs())
    return agg, spec.names()


def bureau_and_balance(credit: DataFrame, hist: DataFrame, policy: str = "override",
                       keep_key_means: bool = False, dummy_na: bool = True,
                       vocab: dict | None = None) -> DataFrame:
    """B-2. `policy="override"` reproduces the reference's effective columns
    (every raw credit column and dummy aggregated by mean only under BURO_);
    `policy="union"` keeps the declared statistics as well."""
    bb, bb_names = balance_per_credit(hist, dummy_na=dummy_na, vocab=vocab)
    # Cohorts are told by the raw status, so a level that no row holds is an empty cohort.
    texts = string_columns(credit)
    oh, _ = one_hot(credit, None, dummy_na=dummy_na, vocab=vocab, keep_original=True)
    loans = oh.join(bb, "SK_ID_BUREAU", "left")

    raw = [c for c in oh.columns if c not in texts and (keep_key_means or c not in KEYS)]
    cat_spec = AggSpec.every(raw + [n for n in bb_names if not n.startswith("MONTHS_BALANCE_")
                                    or n == "MONTHS_BALANCE_MEAN"], ["mean"])
    num = AggSpec(BUREAU_NUM_AGG)
    spec = num.merge(cat_spec, policy=policy)
    return aggregate(loans, "SK_ID_CURR", spec, "BURO_", cohorts={
        "ACTIVE_": (F.col("CREDIT_ACTIVE") == "Active", num),
        "CLOSED_": (F.col("CREDIT_ACTIVE") == "Closed", num),
    })

"""The whole applicant table (B-12): every builder, with one vocabulary discovery for all."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.encode import vocabularies
from . import application as A
from . import bureau as B
from . import history as HI


def applicant_table(train: DataFrame, test: DataFrame, credit: DataFrame, months: DataFrame, previous: DataFrame,
                    pos: DataFrame, instalments: DataFrame, card: DataFrame) -> DataFrame:
    """Applicant features left-joined with the features of the five child tables. The levels of
    all text columns of all tables are read in one job before the plan is made."""
    found = vocabularies({"app": A.clean(A.union_train_test(train, test)), "credit": credit, "previous": previous, "pos": pos,
                          "instalments": instalments, "card": card})
    return HI.assemble(
        A.application_features(train, test, vocab=found["app"]),
        B.bureau_and_balance(credit, months, vocab=found["credit"]),
        HI.previous_applications(previous, vocab=found["previous"]),
        HI.pos_cash(pos, vocab=found["pos"]),
        HI.installments(instalments, vocab=found["instalments"]),
        HI.credit_card(card, vocab=found["card"]),
    )

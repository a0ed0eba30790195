"""Builder options documented in the README: merge policy, key means, ACTIVE_ cohort."""
from conftest import SF_SMALL
from lendscope.plans import behaviour as BH
from lendscope.plans import bureau as B
from lendscope.plans import history as HI
from lendscope.sources import roles


def test_union_policy_is_superset_of_override(spark):
    credit, hist = roles.credit(spark, SF_SMALL), roles.history(spark, SF_SMALL)
    over = set(B.bureau_and_balance(credit, hist, policy="override").columns)
    union = set(B.bureau_and_balance(credit, hist, policy="union").columns)
    assert over < union
    assert "BURO_DAYS_CREDIT_VAR" in union and "BURO_DAYS_CREDIT_VAR" not in over
    assert "BURO_DAYS_CREDIT_MEAN" in over


def test_key_means_only_on_request(spark):
    prev = roles.previous(spark, SF_SMALL)
    assert "PREV_SK_ID_PREV_MEAN" not in HI.previous_applications(prev).columns
    assert "PREV_SK_ID_PREV_MEAN" in HI.previous_applications(prev, keep_key_means=True).columns


def test_active_cohort_and_compat(spark):
    credit, hist = roles.credit(spark, SF_SMALL), roles.history(spark, SF_SMALL)
    base = BH.bureau_behaviour(credit, hist)
    full = BH.bureau_behaviour(credit, hist, emit_active=True)
    assert not any(c.startswith("ACTIVE_") for c in base.columns)
    assert {c for c in full.columns if c.startswith("ACTIVE_")} == {
        "ACTIVE_" + c[len("BURO_"):] for c in base.columns if c.startswith("BURO_")}
    a = {r["SK_ID_CURR"]: r["BURO_DELAYED_ONCE_OR_MORE_SUM"] for r in base.collect()}
    b = {r["SK_ID_CURR"]: r["BURO_DELAYED_ONCE_OR_MORE_SUM"]
         for r in BH.bureau_behaviour(credit, hist, compat=False).collect()}
    assert all(b[k] <= a[k] for k in a) and any(b[k] < a[k] for k in a)

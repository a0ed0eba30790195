"""Golden loan histories (FIXTURES 2) through the month -> credit roll-up."""
import pytest

from lendscope.plans.behaviour import monthly_behaviour


def _loans(spark):
    hist = []
    def add(loan, spec):
        for months, status in spec:
            for m in months:
                hist.append((loan, m, status))
    add(5001729, [([0], "C"), (range(-1, -7, -1), "0")])
    add(5001711, [([0], "X"), (range(-1, -4, -1), "0"), ([-4], "1")])
    add(5001722, [([-38], "C"), ([-39, -40], "0"), ([-41, -42], "1"), ([-43], "0"), (range(-44, -47, -1), "1")])
    add(5001797, [([-54], "C"), ([-55, -56], "5"), ([-57], "4"), ([-58], "3"), ([-59], "2"), ([-60, -61], "1"),
                  ([-62], "0"), ([-63], "1"), ([-64], "0"), ([-65], "1"), (range(-66, -70, -1), "0")])
    add(9000001, [([-3, -2], "C")])                      # all months closed
    return spark.createDataFrame(hist, "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")


GOLDEN = {  # ACTIVE_MONTHS, DELAY_SERIOUSITY_SUM, STATUS_INT_SUM, DELAYED (compat), DLYED_OOM_RATIO, WEIGHTED, LAST
    5001729: (6, 0.0, 0, 0, 0.0, 0, -1),
    5001711: (5, 0.716531, 1, 1, 0.2, 1, 0),
    5001722: (8, 0.133736, 5, 5, 0.625, 5, -39),
    5001797: (15, 0.752596, 23, 10, 0.666667, 23, -55),
}


def test_golden_histories(spark):
    out = {r["SK_ID_BUREAU"]: r for r in monthly_behaviour(_loans(spark)).collect()}
    for loan, exp in GOLDEN.items():
        r = out[loan]
        got = (r["ACTIVE_MONTHS"], r["DELAY_SERIOUSITY_SUM"], r["STATUS_INT_SUM"], r["DELAYED_ONCE_OR_MORE"],
               r["DLYED_OOM_RATIO"], r["WEIGHTED_DELAY_SUM"], r["ACTIVE_LAST_MONTH"])
        assert got[0] == exp[0] and got[2:4] == exp[2:4] and got[5:] == exp[5:], loan
        assert got[1] == pytest.approx(exp[1], abs=1e-6) and got[4] == pytest.approx(exp[4], abs=1e-6), loan


def test_compat_flag_fixes_double_count(spark):
    out = {r["SK_ID_BUREAU"]: r for r in monthly_behaviour(_loans(spark), compat=False).collect()}
    assert out[5001797]["DELAYED_ONCE_OR_MORE"] == 9


def test_all_closed_loan(spark):
    r = [x for x in monthly_behaviour(_loans(spark)).collect() if x["SK_ID_BUREAU"] == 9000001][0]
    assert r["ACTIVE_MONTHS"] == 0 and r["ACTIVE_LAST_MONTH"] is None
    assert r["STATUS_0_RATIO"] is None and r["DLYED_OOM_RATIO"] is None

"""Specification-driven aggregation: null rules (T5), cohorts, merge policies."""
from pyspark.sql import functions as F

from lendscope.operators.aggspec import AggSpec, aggregate


def test_all_null_group_and_single_row(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5.0)], "k int, v double")
    spec = AggSpec({"v": ["sum", "mean", "max", "var", "size", "count"]})
    got = {r["k"]: r for r in aggregate(df, "k", spec).collect()}
    a = got[1]
    assert (a["v_SUM"], a["v_MEAN"], a["v_MAX"], a["v_VAR"], a["v_SIZE"], a["v_COUNT"]) == (0.0, None, None, None, 2, 0)
    assert got[2]["v_VAR"] is None and got[2]["v_SUM"] == 5.0


def test_empty_cohort_is_null_even_for_sum(spark):
    df = spark.createDataFrame([(1, "Active", 1.0), (2, "Closed", None), (2, "Active", 4.0)], "k int, s string, v double")
    spec = AggSpec({"v": ["sum", "mean", "size", "count"]})
    out = {r["k"]: r for r in aggregate(df, "k", spec, "ALL_", cohorts={
        "CLOSED_": (F.col("s") == "Closed", spec)}).collect()}
    assert out[1]["CLOSED_v_SUM"] is None and out[1]["CLOSED_v_SIZE"] is None and out[1]["CLOSED_v_COUNT"] is None
    assert out[2]["CLOSED_v_SUM"] == 0.0 and out[2]["CLOSED_v_SIZE"] == 1 and out[2]["CLOSED_v_COUNT"] == 0
    assert out[2]["ALL_v_SUM"] == 4.0


def test_merge_policies():
    declared = AggSpec({"a": ["max", "mean"], "b": ["sum"]})
    everything = AggSpec.every(["a", "c"], ["mean"])
    over = declared.merge(everything, "override")
    union = declared.merge(everything, "union")
    assert over.spec == {"a": ["mean"], "b": ["sum"], "c": ["mean"]}
    assert union.spec == {"a": ["max", "mean"], "b": ["sum"], "c": ["mean"]}
    assert set(over.names()) <= set(union.names())


def test_single_exchange_for_fused_cohorts(spark):
    """Base spec + two cohorts compile into one aggregate: one shuffle, not three."""
    df = spark.createDataFrame([(i % 7, "Active" if i % 2 else "Closed", float(i)) for i in range(100)],
                               "k int, s string, v double")
    spec = AggSpec({"v": ["sum", "mean", "var"]})
    out = aggregate(df, "k", spec, "B_", cohorts={"A_": (F.col("s") == "Active", spec),
                                                  "C_": (F.col("s") == "Closed", spec)})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1
    assert out.count() == 7

"""Forms that must hold at any setting or size: bucketed orders, encoders, look-ups."""
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lendscope.operators import encode as EN
from lendscope.operators import evaluation as EV
from lendscope.operators.aggspec import AggSpec
from lendscope.operators.series import group_median
from lendscope.plans import behaviour as BH
from lendscope.plans import bureau as B
from lendscope.plans import history as HI
from lendscope.sources import roles


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n", [200, 2000, 10000])
def test_global_orders_at_any_partition_count(spark, partitions, n):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 4000) / 7, rnd.randint(0, 1), rnd.choice("abc")) for _ in range(3000)]
    df = spark.createDataFrame(rows, "s double, y int, g string")
    small = EV.auc(df, "s", "y").first()["auc"]
    roc = len(plan_of(EV.roc_points(df, "s", "y")))
    partitions(n)
    frames = [EV.auc(df, "s", "y"), EV.roc_points(df, "s", "y"), group_median(df, "s", "g", "m")]
    assert len(plan_of(frames[1])) < 1.2 * roc                       # the plan does not grow with the setting
    partitions(8)                                                     # planned above; run with few tasks
    assert frames[0].first()["auc"] == pytest.approx(small)
    assert frames[1].count() == len({s for s, _, _ in rows})
    got = {r["g"]: r["m"] for r in frames[2].collect()}
    assert got == {g: pytest.approx(statistics.median(s for s, _, h in rows if h == g)) for g in "abc"}


def test_auc_by_fold_reads_its_input_once(spark):
    df = EV.kfold(roles.scored(spark, SF_SMALL), "id", 5)
    out = EV.auc_by_fold(df, "score", "label")
    out._jdf.collectToPython()
    want = {r["fold"]: r["auc"] for r in EV.auc(df, "score", "label", ["fold"]).collect()} | {-1: EV.auc(df, "score", "label").first()["auc"]}
    assert {r["fold"]: r["auc"] for r in out.collect()} == pytest.approx(want)
    assert plan_of(out).count("FileScan") <= 2 * 1 * 2               # the two tables of the role, at most once more for the bounds


def test_label_codes_of_100000_levels(spark):
    df = spark.range(100_000).select(F.concat(F.lit("user_"), F.col("id")).alias("c"), "id").withColumn(
        "c", F.when(F.col("id") % 1000 == 7, None).otherwise(F.col("c")))
    got = EN.label_encode(df, ["c"])
    levels = sorted(f"user_{i}" for i in range(100_000) if i % 1000 != 7)
    rank = {v: i for i, v in enumerate(levels)}
    rows = got.filter("id % 997 = 0 or id % 1000 = 7").collect()
    assert all(r["c"] == rank.get(f"user_{r['id']}", -1) for r in rows) and got.count() == 100_000
    assert got.agg(F.max("c")).first()[0] == len(levels) - 1


def test_levels_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, "a.b", 1.0), (1, "c`d", 2.0), (2, None, 3.0)], "k int, t string, v double")
    wide, names = EN.one_hot(df, ["t"], dummy_na=True)
    assert names == ["t_a.b", "t_c`d", "t_nan"]
    out = wide.groupBy("k").agg(*AggSpec.every(names, ["mean"]).exprs()).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, 0.5, 0.5, 0.0), (2, 0.0, 0.0, 1.0)]


def test_long_form_equals_the_dummies(spark):
    df = roles.credit(spark, SF_SMALL).select("SK_ID_CURR", "CREDIT_TYPE", "CREDIT_ACTIVE")
    long = EN.category_long(df, "SK_ID_CURR", ["CREDIT_TYPE"])
    wide, names = EN.one_hot(df.select("SK_ID_CURR", "CREDIT_TYPE"), ["CREDIT_TYPE"])
    share = wide.groupBy("SK_ID_CURR").agg(*[F.avg(f"`{n}`").alias(n) for n in names]).unpivot(
        ["SK_ID_CURR"], [F.col(f"`{n}`") for n in names], "name", "share").filter("share > 0").collect()
    assert {(r["SK_ID_CURR"], f"CREDIT_TYPE_{r['value']}"): r["share"] for r in long.collect()} == pytest.approx(
        {(r["SK_ID_CURR"], r["name"]): r["share"] for r in share})


def test_absent_cohort_levels_are_empty_cohorts(spark):
    credit, hist = roles.credit(spark, SF_SMALL), roles.history(spark, SF_SMALL)
    out = B.bureau_and_balance(credit.filter("CREDIT_ACTIVE <> 'Active'"), hist)
    assert out.filter("ACTIVE_DAYS_CREDIT_MEAN is not null").count() == 0 and out.count() > 0
    prev = roles.previous(spark, SF_SMALL).filter("NAME_CONTRACT_STATUS <> 'Refused'")
    assert HI.previous_applications(prev).filter("REFUSED_AMT_CREDIT_MAX is not null").count() == 0


@pytest.mark.parametrize("build", [lambda h: B.balance_per_credit(h)[0], BH.monthly_behaviour])
def test_unknown_status_is_never_lost(spark, build):
    hist = roles.history(spark, SF_SMALL).withColumn("STATUS", F.when(F.col("MONTHS_BALANCE") == -30, "9").otherwise(F.col("STATUS")))
    with pytest.raises(Exception, match="STATUS has a level outside the given list: 9"):
        build(hist).collect()


def test_statuses_can_be_discovered(spark):
    hist = roles.history(spark, SF_SMALL).withColumn("STATUS", F.when(F.col("MONTHS_BALANCE") == -30, "9").otherwise(F.col("STATUS")))
    out, names = B.balance_per_credit(hist, vocab={"STATUS": None})
    assert "STATUS_9_MEAN" in names
    shares = [c for c in out.columns if c.startswith("STATUS_")]
    assert out.filter(F.abs(sum(F.col(c) for c in shares) - 1) > 1e-9).count() == 0


def test_lookups_do_not_shuffle_the_fact_side(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("cat"))
        enc = fact.groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
        want = {(r["id"], r["n"]) for r in fact.join(enc, "cat").select("id", "n").collect()}
        small = EN.lookup_join(fact, enc, ["cat"])
        assert "Exchange hashpartitioning" not in plan_of(small) and "BroadcastHashJoin" in plan_of(small)
        salted = EN.lookup_join(fact, enc, ["cat"], broadcast_rows=5)
        assert "_salt" in plan_of(salted)
        for out in (small, salted):
            assert {(r["id"], r["n"]) for r in out.select("id", "n").collect()} == want
        hot = salted.filter("cat = 'hot'")
        assert {r["_salt"] for r in fact.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(EN.SALTS)))
                .filter("cat = 'hot'").select("_salt").distinct().collect()} == set(range(EN.SALTS))
        assert hot.count() == 1667
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_behaviour_plan_size(spark):
    out = BH.bureau_behaviour(roles.credit(spark, SF_SMALL), roles.history(spark, SF_SMALL))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(out.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") <= 8
    assert plan.count("orders.parquet") <= 3


def test_contract_rollup_reads_its_rows_once(spark):
    rows = [(1, 10, 5.0), (1, 10, 5.0), (1, 11, 3.0), (1, 11, 4.0), (2, 11, 4.0), (2, 12, None), (3, 13, 1.0)]
    pos = spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_PREV long, CNT_INSTALMENT double")
    got = {r[0]: (r[1], r[2]) for r in HI.pos_changed_contract(pos).collect()}
    assert got == {1: (4.0, 0.0), 2: (2.0, 1.0), 3: (1.0, 0.0)}      # contract 11 belongs to applicant 2


def test_contract_rollup_plan(spark):
    out = HI.pos_changed_contract(roles.pos_cash(spark, SF_SMALL))
    out._jdf.collectToPython()
    plan = plan_of(out)
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1

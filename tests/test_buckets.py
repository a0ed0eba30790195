"""Buckets of a global order: near-equal in rows whatever repeats, any number of them."""
import pytest
from pyspark.sql import functions as F

from lendscope.operators import evaluation as EV
from lendscope.operators.encode import label_codes
from lendscope.operators.series import group_median, prefix_sums, quantile_bucket


def sizes(df, column, *args, **kw):
    rows = df.withColumn("b", quantile_bucket(df, column, *args, **kw)).groupBy("b").count().collect()
    return {r["b"]: r["count"] for r in rows}


def test_values_shared_by_many_groups(spark):
    """2,000 groups of the same 200 values: all buckets in use, none above twice the mean."""
    df = spark.range(400_000).select((F.col("id") % 2000).alias("g"), (F.floor(F.col("id") / 2000) * 1.5).alias("v"))
    for wanted in (None, 25, 100):
        got = sizes(df, "v", wanted)
        mean = 400_000 / len(got)
        assert len(got) == max(got) + 1 >= (wanted or 400_000 // 4096) and max(got.values()) <= 2 * mean


def test_number_of_buckets_follows_the_rows(spark):
    df = spark.range(200_000).select(F.rand(7).alias("v"))
    few, many = sizes(df, "v", bucket_rows=50_000), sizes(df, "v", bucket_rows=500)
    assert 3 <= len(few) <= 5 and 350 <= len(many) <= 410
    for got in (few, many, sizes(df, "v", 1000)):
        assert max(got.values()) <= 2 * 200_000 / len(got)
    assert len(sizes(df.limit(10), "v")) == 1


def test_a_hot_value_keeps_to_itself(spark):
    """A third of the rows with one value: the rest stays divided as before."""
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(8)).alias("v"))
    got = sorted(sizes(df, "v", 90).values())
    assert got[-1] >= 30_000 and got[-2] <= 2 * 1000 and len(got) >= 55


def test_strings(spark):
    df = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("v"))
    got = sizes(df, "v", bucket_rows=1000)
    assert len(got) >= 50 and max(got.values()) <= 2 * 60_000 / len(got)


def test_order_is_kept(spark):
    df = spark.createDataFrame([(x,) for x in (3, -5, 3, 0, 2**53, -(2**53), 7, 7, 7, None)], "v long")
    rows = df.withColumn("b", quantile_bucket(df, "v", 5)).collect()
    known = sorted((r["v"], r["b"]) for r in rows if r["v"] is not None)
    assert [b for _, b in known] == sorted(b for _, b in known) and len({r["b"] for r in rows}) > 2


@pytest.mark.parametrize("kw", [{}, {"n_buckets": 3}, {"n_buckets": 300}])
def test_results_do_not_depend_on_buckets(spark, kw):
    df = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(40)) / 8).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                  (F.col("id") % 7).alias("g"))
    rows = df.collect()
    pos, neg = [r["s"] for r in rows if r["y"] == 1], [r["s"] for r in rows if r["y"] == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert EV.auc(df, "s", "y", **kw).first()["auc"] == pytest.approx(want)
    median = {r["g"]: r["m"] for r in group_median(df, "s", "g", "m", **kw).collect()}
    for g in range(7):
        mine = sorted(r["s"] for r in rows if r["g"] == g)
        n = len(mine)
        assert median[g] == (mine[(n - 1) // 2] + mine[n // 2]) / 2


def test_running_sums_over_a_stored_order(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("v"), F.lit(1).cast("long").alias("one"))
    ranked = prefix_sums(df, ["v"], ["one"], quantile_bucket(df, "v", bucket_rows=100))
    by_value = [r["one_before"] for r in ranked.orderBy("v").collect()]
    assert by_value == list(range(5000))


def test_label_codes_of_many_levels(spark):
    df = spark.range(40_000).select(F.md5((F.col("id") % 20_000).cast("string")).alias("c"))
    got = [(r["c"], r["code"]) for r in label_codes(df, "c").orderBy("c").collect()]
    assert [code for _, code in got] == list(range(20_000))

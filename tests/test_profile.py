"""Profiling operators and vocabularies."""
import pytest
from pyspark.sql import functions as F

from lendscope.operators import profile as PR
from lendscope.operators.encode import category_long, one_hot, vocabularies, vocabulary


def test_vocabulary_guards_the_driver(spark):
    """A million levels, very long ones and just too many are found without leaving the executors."""
    n = F.col("id")
    df = spark.range(1_000_000).select(
        F.concat(F.lit("level "), n.cast("string")).alias("million"), F.when(n % 3 > 0, (n % 2000).cast("string")).alias("most"),
        (n % 2001).cast("string").alias("more"), F.when(n == 5, F.repeat(F.lit("long "), 60)).otherwise("short").alias("text"),
        F.when(n % 2 == 0, (n % 7).cast("string")).alias("few"), F.lit(None).cast("string").alias("none"))
    got = vocabulary(df, df.columns)
    assert set(got) == {"most", "few", "none"}
    assert got["most"] == sorted(str(i) for i in range(2000)) and got["few"] == list("0123456") and got["none"] == []
    with pytest.raises(ValueError, match="million.*category_long"):
        one_hot(df, ["million", "few"])


def test_vocabularies_of_several_tables(spark):
    a = spark.createDataFrame([("x", "1"), (None, "2")], "c string, d string")
    b = spark.createDataFrame([("y", 1)], "c string, n int")
    assert vocabularies({"a": a, "b": b, "some": (a, ["d"]), "empty": a.limit(0), "numbers": b.select("n")}) == {
        "a": {"c": ["x"], "d": ["1", "2"]}, "b": {"c": ["y"]}, "some": {"d": ["1", "2"]}, "empty": {"c": [], "d": []}, "numbers": {}}
    assert vocabularies({}) == {}


def test_category_long_of_many_levels(spark):
    df = spark.range(20_000).select((F.col("id") % 10).alias("k"), F.when(F.col("id") >= 10, F.col("id").cast("string")).alias("c"))
    got = category_long(df, "k")
    assert got.count() == 20_000 and got.filter("value is null").count() == 10
    assert got.agg(F.min("share"), F.max("share")).first() == (1 / 2000, 1 / 2000)


def test_value_counts_most_frequent_first(spark):
    df = spark.createDataFrame([(c,) for c in "abcbcc"], "c string")
    assert [tuple(r) for r in PR.value_counts(df, "c").collect()] == [("c", 3), ("b", 2), ("a", 1)]


def test_null_ratios_long_table(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 1.0), (4, 2.0)], "a int, b double")
    got = {r["column"]: r["null_ratio"] for r in PR.null_ratios(df).collect()}
    assert got == {"a": 0.25, "b": 0.5}


def test_histogram_edges_and_constant_column(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "v double")
    h = {r["bin"]: r["count"] for r in PR.histogram(df, "v", 5).collect()}
    assert sum(h.values()) == 6 and h[4] == 1          # max value falls in the last, closed bin
    const = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in PR.histogram(const, "v", 3).select("bin", "count").collect()] == [(0, 2)]


def test_counts_and_distinct(spark):
    df = spark.createDataFrame([("a", 0), ("a", 3), (None, None), ("b", 0)], "c string, x int")
    assert {r["c"]: r["count"] for r in PR.value_counts(df, "c").collect()} == {"a": 2, "b": 1}
    assert {r["is_nonzero"]: r["count"] for r in PR.binarised_counts(df, "x").collect()} == {0: 2, 1: 2}
    assert PR.distinct_values(df, "c").count() == 3               # NULL is a value
    assert {r["rows_per_key"]: r["n_keys"] for r in PR.count_of_counts(df, "c").collect()} == {2: 1, 1: 2}

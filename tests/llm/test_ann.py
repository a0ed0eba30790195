import corpus  # noqa: F401
import numpy as np
import pytest

from lendscope.llm import ann


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        near = sorted((float(ann.distances(np.array([w], float), np.array(v, float))[0]), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return sorted(out)


def vectors(seed, n, dims=8):
    rnd = np.random.default_rng(seed)
    return [(i, rnd.normal(size=dims).tolist()) for i in range(n)]


def table(spark, rows):
    return ann.usable(spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "vec_id long, embedding array<double>, id string, v string"),
                      "vec_id", "embedding")


@pytest.mark.parametrize("shard_rows,leaf", [(8192, 256), (60, 4)])
def test_exact_at_factor_one(spark, shard_rows, leaf):
    rows = vectors(1, 400) + [(1000 + i, [1.0] * 8) for i in range(150)]          # a third are copies
    df = table(spark, rows)
    got = ann.search(ann.build_index(df, shard_rows, leaf), df.filter("id % 20 = 0"), 10).collect()
    assert sorted(map(tuple, got)) == brute(rows, [r for r in rows if r[0] % 20 == 0], 10)


def test_relaxed_factor_keeps_recall(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(20, 16)) * 3
    rows = [(i, (centres[i % 20] + rnd.normal(size=16)).tolist()) for i in range(1500)]
    df = table(spark, rows)
    index = ann.build_index(df, 500, 16)
    want = {(q, i) for q, _, i, _ in brute(rows, [r for r in rows if r[0] % 25 == 0], 10)}
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(index, df.filter("id % 25 = 0"), 10, factor=0.8).collect()}
    assert len(got & want) / len(want) >= 0.9


def test_pruning_skips_work():
    rnd = np.random.default_rng(3)
    v = np.concatenate([rnd.normal(size=(300, 4)) + 100 * j for j in range(6)])
    order, tree = ann.build_tree(v, 8)
    seen = []
    original = np.einsum
    ids = np.arange(len(v))[order]
    try:
        ann.np.einsum = lambda *a: seen.append(len(a[1])) or original(*a)
        near, _ = ann.search_tree(v[order], ids, tree, v[0], 0, 5, 1.0)
    finally:
        ann.np.einsum = original
    assert sum(seen) < 400 and set(near) <= set(range(1, 300))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 0.0]), (20, None), (40, []), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (None, [1.0, 1.0]),
            (120, [1.0, 0.0]), (121, [0.0, 1.0]), (121, [0.0, 1.0]), (122, [1.0, 2.0, 3.0])]
    df = table(spark, rows)
    got = sorted(map(tuple, ann.search(ann.build_index(df), df.filter("id % 20 = 0"), 10).collect()))
    assert got == [(120, 1, 121, 2 ** 0.5), (120, 2, 121, 2 ** 0.5)]


def test_empty_tables(spark):
    none, some = table(spark, []), table(spark, vectors(4, 30))
    assert ann.search(ann.build_index(none), some).count() == 0
    assert ann.search(ann.build_index(some), none).count() == 0


def test_a_third_with_one_id(spark):
    """One id on a third of the rows, copies among them: no shard far above its share."""
    rnd = np.random.default_rng(8)
    rows = [(7 if i % 3 == 0 else i, [1.0] * 4 if i % 6 == 0 else rnd.normal(size=4).tolist()) for i in range(3000)]
    df = table(spark, rows)
    index = ann.build_index(df, 300, 16)
    sizes = [len(r["ids"]) // 8 for r in index.collect()]
    assert sum(sizes) == 3000 and max(sizes) < 450
    got = sorted(map(tuple, ann.search(index, df.filter("id in (7, 100, 202)"), 10).collect()))
    first = min(v for i, v in rows if i == 7)
    assert got == brute(rows, [(7, first), (100, rows[100][1]), (202, rows[202][1])], 10)

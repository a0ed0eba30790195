"""Centroid clustering against plain integer arithmetic."""
import hashlib
import math
import random

import numpy as np
import pytest

from lendscope.llm import centroids
from lendscope.llm.centroids import cluster, nearest, restore, transform

SCHEMA = "vec_id long, embedding array<float>, cluster int, coefs string, distance string"


def plain(rows, clusters=8, rounds=10):
    """(id, cluster, distance, cluster inertia, inertia, components) by whole distances."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else ""))
    at = [list(v) for _, v in order[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in at]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for k in range(len(at)):
            mine = [v for (_, v), (c, _) in zip(kept, got, strict=True) if c == k]
            if mine:
                at[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    got = assign()
    per = {k: sum(d for c, d in got if c == k) for k in range(len(at))}
    return [(i, c, d, per[c], sum(per.values()), at[c]) for (i, _), (c, d) in zip(kept, got, strict=True)]


def rows_of(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], list(r["centroid"]))
                  for r in df.collect())


def expected(rows):
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in rows)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 9, "clash", "clash") for i, v in rows], SCHEMA)


def test_transform_is_exact():
    x = np.random.default_rng(1).integers(-5000, 5000, (50, 64))
    assert (restore(transform(x)) == x).all()
    assert ((transform(x) ** 2).sum(axis=1) == 64 * (x ** 2).sum(axis=1)).all()
    big = x.astype(object) * 10**15
    assert (restore(transform(big)) == big).all()


def test_search_with_ties():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3, 3, (400, 64)), rng.integers(-3, 3, (8, 64))
    c[5] = c[2]
    number, value = nearest(transform(x), transform(c))
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (value == 64 * d.min(axis=1)).all()


def test_rounds(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 0.2) + (i % 5) * 0.3 for _ in range(64)]) for i in range(300)]
    assert rows_of(cluster(table(spark, rows))) == expected(plain(rows))


def test_odd_rows(spark):
    rnd = random.Random(6)
    good = [rnd.uniform(-1, 1) for _ in range(64)]
    rows = [(1, good), (1, good), (2, [0.0] * 64), (None, [0.5] * 64), (3, None), (4, []), (5, good[:63]), (6, [*good[:63], None]),
            (7, [*good[:63], float("nan")]), (8, [*good[:63], float("inf")]), (9, [-1e6] * 64), (10, [-1e6 + 7.0] * 64)]
    assert rows_of(cluster(table(spark, rows))) == expected(plain(rows))
    assert rows_of(cluster(table(spark, rows[2:3]))) == expected(plain(rows[2:3]))
    nothing = cluster(table(spark, []))
    assert nothing.count() == 0 and "cluster_inertia" in nothing.columns


def test_a_third_alike(spark):
    """Equal vectors, and equal seeds: ties to the smaller number, empty clusters keep theirs."""
    rnd = random.Random(7)
    rows = [(i, [0.25] * 64) for i in range(100)] + [(i, [rnd.choice([0.0, 0.25]) for _ in range(64)]) for i in range(100, 300)]
    assert rows_of(cluster(table(spark, rows))) == expected(plain(rows))


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        cluster(table(spark, [(1, [1e30] * 64)])).collect()


def test_coefficients_beyond_64_bit_sums():
    rows = np.array([[2**30] * 64, [-(2**30)] + [3] * 63])
    coefs = transform(rows)
    packed = __import__("pyarrow").array([r.astype("<i8").tobytes() for r in coefs])
    number, value = nearest(*centroids._coefs(packed, 64, coefs[::-1].copy()))
    assert number.tolist() == [1, 0] and value.tolist() == [0, 0]

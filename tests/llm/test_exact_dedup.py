import hashlib
from collections import defaultdict

import corpus
import pytest
from pyspark.sql import functions as F

from lendscope.llm.exact_dedup import exact_dedup


def brute(rows, keep):
    groups = defaultdict(list)
    norm = {chr(c): chr(c + 32) for c in range(65, 91)}
    for i, t in rows:
        groups["".join(norm.get(c, c) for c in t or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        out += [(i, best, len(ids), i == best, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in exact_dedup(df, **kw).collect()), key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_matches_brute_force(spark, keep):
    rows = corpus.odd_rows() + [(9, None), (3, "one"), (None, "only without id"), (None, "one")]
    assert run(corpus.table(spark, rows), keep=keep) == brute(rows, keep)


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    rows = corpus.odd_rows()
    got = run(corpus.table(spark, rows), hash128=lambda c: F.crc32(c.cast("binary")) % 3)
    assert got == brute(rows, "smallest")


def test_hot_group_and_empty_table(spark):
    rows = [(i, "Same TEXT" if i % 3 else f"text {i}") for i in range(600)]
    assert run(corpus.table(spark, rows)) == brute(rows, "smallest")
    assert exact_dedup(corpus.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_dedup(corpus.table(spark, corpus.odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

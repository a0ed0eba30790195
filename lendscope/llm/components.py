"""Connected components by alternating large-star and small-star steps.

Every step is a join with a grouped minimum, which is pre-aggregated, and the table never
leaves the executors. The minima are dealt anew before the join, so that both of its sides
are plain shuffles: adaptive execution then splits the edges of a node with very many
neighbours over tasks. Before the first step each task
joins the edges that it holds to stars, which are fewer and shallower. Each round is
written to the shared folder; the number of rounds is logarithmic in practice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import map_batches, stored, tasks_for

EDGES = 1 << 20       # edges that a task joins at a time


def stars(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node reachable) for the nodes of the pairs, smallest ones left out."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in root if root[x] != x]


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for batch in batches:
        held += zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)
        if len(held) >= EDGES:
            held = stars(held)
            if len(held) >= EDGES // 2:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in held], pa.schema([("a", pa.int64()), ("b", pa.int64())]))
                held = []
    held = stars(held)
    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in held], pa.int64()), pa.array([b for _, b in held], pa.int64())], ["a", "b"])


def _written(edges: DataFrame, most: int) -> tuple[DataFrame, tuple]:
    """The stored edges (`most` rows or fewer), and a mark of their set that the writing job takes along."""
    seen = Observation()
    marked = edges.coalesce(tasks_for(edges, most)).observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
    table = stored(marked, "star")
    return table, (seen.get["n"], seen.get["x"])


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """`edges` with the least neighbour `m` of their end `a`."""
    return edges.join(least.repartition("a"), "a")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.
    `edges` should be a stored table: its rows are counted first."""
    local = map_batches(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b"),
                        _local_stars, "a long, b long")
    now, mark = _written(local.distinct(), edges.count())
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = _with_least(both, least).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (_with_least(large, least).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        before = mark
        now, mark = _written(small, 2 * mark[0])
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

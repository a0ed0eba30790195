"""Nearest neighbours by vantage-point trees, one per shard.

Index. Vectors are dealt by a hash of id, vector and row to shards of about `shard_rows`; each shard
becomes one row of a stored table: its vectors in tree order plus the tree's nodes. A node
splits its vectors by the median distance to a vantage point; a node that no distance
splits (copies) or of at most `leaf` vectors is a leaf, looked at as one block.

Search. The stated queries travel in blocks to every shard, where the tree comes first: it is
decoded once, and the blocks stream past it. For a query at distance d of a
node's vantage point, whose subtree lies in distances [lo, hi] of it, the triangle
inequality says no vector there is nearer than max(d - hi, lo - d). A subtree is skipped
if that bound exceeds `factor` times the query's k-th best distance in this shard so far: factor 1
skips nothing that could matter (exact), a smaller one skips more.

Each shard returns its k best candidates per query, with exact double distances; the k
best of those are the answer, ties to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, only, ship_package, stored, table

INDEX = "shard long, dims int, ids binary, vectors binary, nodes binary"
QUERY_BLOCK = 256
SHARDS_A_TASK = 2

NODE = np.dtype([("first", "<i4"), ("end", "<i4"), ("vantage", "<i4"), ("inner", "<i4"), ("outer", "<i4"),
                 ("inner_lo", "<f8"), ("inner_hi", "<f8"), ("outer_lo", "<f8"), ("outer_hi", "<f8")])


def distances(block: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row of `block` to `q`, summed from the first
    component to the last in double precision."""
    total = np.zeros(len(block))
    for j in range(block.shape[1]):
        diff = block[:, j] - q[j]
        total += diff * diff
    return np.sqrt(total)


def build_tree(vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the vectors, nodes). A node covers order[first:end]."""
    order = np.arange(len(vectors))
    nodes: list[tuple] = []
    todo = [(0, len(vectors), -1, "")]
    while todo:
        first, end, parent, side = todo.pop()
        me = len(nodes)
        if parent >= 0:
            row = list(nodes[parent])
            row[3 if side == "inner" else 4] = me
            nodes[parent] = tuple(row)
        node = (first, end, -1, -1, -1, 0.0, 0.0, 0.0, 0.0)
        if end - first > leaf:
            mine = order[first:end]
            # The vantage point: of a few evenly spaced candidates the one whose distances spread most.
            spaced = mine[np.linspace(0, len(mine) - 1, 5).astype(int)]
            looked = mine[:: max(1, len(mine) // 256)]
            vantage = max(spaced, key=lambda v: np.linalg.norm(vectors[looked] - vectors[v], axis=1).std())
            d = np.linalg.norm(vectors[mine] - vectors[vantage], axis=1)
            by = np.argsort(d, kind="stable")
            order[first:end], d = mine[by], d[by]
            # Split where the distance changes, nearest to the middle.
            steps = np.flatnonzero(d[1:] > d[:-1]) + 1
            if len(steps):
                cut = int(steps[np.abs(steps - len(d) // 2).argmin()])
                node = (first, end, int(vantage), -1, -1, d[0], d[cut - 1], d[cut], d[-1])
                todo += [(first + cut, end, me, "outer"), (first, first + cut, me, "inner")]
        nodes.append(node)
    tree = np.array(nodes, dtype=NODE)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    inside = tree["vantage"] >= 0
    tree["vantage"][inside] = place[tree["vantage"][inside]]
    return order, tree


def search_tree(vectors: np.ndarray, ids: np.ndarray, tree: np.ndarray, q: np.ndarray, own: int,
                k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest (ids, distances) in a shard, nearest first, ties to the smaller id.

    A leaf's distances are taken as one block; whatever may be among the k nearest by them,
    up to rounding, gets its exact distance at the end."""
    near = 1 + 1e-9                  # rounding must not drop an equal distance
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0)]
    worst = np.inf                   # k-th best squared distance so far
    todo = [(0.0, 0)]
    while todo:
        bound, at = todo.pop()
        if bound > 0 and bound * bound > factor * factor * worst * near:
            continue
        node = tree[at]
        if node["vantage"] < 0:
            first, end = int(node["first"]), int(node["end"])
            diff = vectors[first:end] - q
            d = np.einsum("ij,ij->i", diff, diff)
            kept = np.flatnonzero((d <= worst * near) & (ids[first:end] != own))
            if len(kept):
                rows.append(kept + first)
                found.append(d[kept])
                merged = np.concatenate(found)
                if len(merged) >= k:
                    worst = np.partition(merged, k - 1)[k - 1]
                    stay = merged <= worst * near
                    rows, found = [np.concatenate(rows)[stay]], [merged[stay]]
            continue
        diff = vectors[node["vantage"]] - q
        d = float(np.sqrt(diff @ diff))
        inner = (max(bound, d - node["inner_hi"], node["inner_lo"] - d), int(node["inner"]))
        outer = (max(bound, d - node["outer_hi"], node["outer_lo"] - d), int(node["outer"]))
        todo += [outer, inner] if inner[0] <= outer[0] else [inner, outer]
    last = np.concatenate(rows)
    exact = distances(vectors[last], q)
    by = np.lexsort((ids[last], exact))[:k]
    return ids[last][by], exact[by]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part: a null id, a null or empty vector, one that
    holds a null, NaN or infinite component, or a zero vector does not."""
    v = only(vectors, id_col, vector_col).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.filter(F.col("id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))


def build_index(rows: DataFrame, shard_rows: int = 8192, leaf: int = 256) -> DataFrame:
    """The stored index over `usable` rows. A hash of id, vector and row number deals rows
    evenly whatever repeats, copies of a whole row too."""
    spark = rows.sparkSession
    ship_package(spark)
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(shards)))

    def tree_of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dims, part in pdf.groupby(pdf["v"].map(len)):          # vectors of another width share no distance
            vectors = np.stack(part["v"].to_numpy())
            order, tree = build_tree(vectors, leaf)
            out.append((int(key[0]), int(dims), part["id"].to_numpy(np.int64)[order].tobytes(),
                        np.ascontiguousarray(vectors[order]).tobytes(), tree.tobytes()))
        return pd.DataFrame(out, columns=["shard", "dims", "ids", "vectors", "nodes"])

    return stored(dealt.groupBy("shard").applyInPandas(tree_of, INDEX), "vp-trees")


def search(index: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest of all indexed rows but those
    of its own id. Queries (id, v) of a width that the index lacks return nothing; of several
    vectors of one query id the smallest (in array order) is asked. Repeated candidate rows
    are candidates each."""
    # A block of queries goes to every shard: blocks x shards rows, each a bounded piece of work.
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    one = queries.groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-one.count() // QUERY_BLOCK))
    dealt = (one.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
             .groupBy("block").agg(F.collect_list(F.struct("id", "v")).alias("queries")))
    asked = dealt.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(True).alias("asks"), "queries")
    work = (index.withColumn("asks", F.lit(False)).unionByName(asked, allowMissingColumns=True)
            .repartition(-(-shards // SHARDS_A_TASK), "shard").sortWithinPartitions("shard", "asks"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trees = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                if batch["shard"][row].as_py() != shard:
                    shard, trees = batch["shard"][row].as_py(), []
                if not batch["asks"][row].as_py():
                    dims = batch["dims"][row].as_py()
                    ids, vectors, nodes = (np.frombuffer(batch[c][row].as_py(), kind)
                                           for c, kind in (("ids", np.int64), ("vectors", np.float64), ("nodes", NODE)))
                    trees.append((vectors.reshape(-1, dims), ids, nodes))
                    continue
                q_of, i_of, d_of = [], [], []
                for q in batch["queries"][row].as_py():
                    for vectors, ids, tree in trees:
                        if len(q["v"]) == vectors.shape[1]:
                            near, far = search_tree(vectors, ids, tree, np.array(q["v"]), q["id"], k, factor)
                            q_of.append(np.full(len(near), q["id"], np.int64))
                            i_of.append(near)
                            d_of.append(far)
                if q_of:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (q_of, i_of, d_of)],
                                                     ["query_id", "vec_id", "score"])

    found = map_batches(work, look, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(build_index(rows), rows.filter(F.col("id") % 100 == 0), k=10, factor=1.0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
WHERE rank <= 10
"""

QUERIES = {"op9_nearest_neighbours": (op9_nearest_neighbours, OP9_SQL)}

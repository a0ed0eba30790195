"""Centroid clustering by Walsh-Hadamard progressive search, in exact integers.

Components become integers floor(scale * x). The integer Walsh-Hadamard transform keeps
squared distances up to the factor `dims`: with the coefficients in order of sequency, the
sum of the first squared coefficient differences (coarse) is a lower bound of the whole sum
(fine). The search of a vector:

1. sums over the first 8 coefficients for every centroid; the leader is finished at once,
   its whole sum is the bound;
2. the others go on by blocks of coefficients, and a centroid whose sum so far is strictly
   above the bound is out;
3. what is left after all coefficients has exact distances; equal ones go to the smaller
   number.

The transform is linear, so a cluster's sum of vectors is the inverse transform of its sum of
coefficients: one stored table of coefficients serves all rounds. A round is one pass over
it; every task returns a row of sums per centroid, and only clusters x dims numbers reach the
driver, where the new centroids are the exact floors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, ship_package, stored, table

COMPONENT_LIMIT = 1 << 31       # beyond it squared distances leave 64 bits
SAFE = 1 << 30                  # coefficients below it cannot overflow 64-bit sums of squares


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two wide), coarse to fine."""
    n, dims = rows.shape
    out, half = rows, 1
    while half < dims:
        pairs = out.reshape(n, -1, 2, half)
        out = np.concatenate([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dims)
        half *= 2
    return out[:, by_sequency(dims)]


def restore(coefs: np.ndarray) -> np.ndarray:
    """Inverse of `transform`; exact, as `dims` divides what the transform gives back."""
    dims = coefs.shape[1]
    natural = np.empty_like(coefs)
    natural[:, by_sequency(dims)] = coefs
    back = np.empty_like(coefs)
    back[:, by_sequency(dims)] = transform(natural)
    return back // dims


def by_sequency(dims: int) -> np.ndarray:
    """The rows of the Hadamard matrix in order of their number of sign changes."""
    at = np.arange(dims)
    bits = at[:, None] & at[None, :]
    odd = np.array([[bin(b).count("1") & 1 for b in row] for row in bits.tolist()])
    return np.argsort((odd[:, 1:] != odd[:, :-1]).sum(axis=1), kind="stable")


def _squares(diff: np.ndarray) -> np.ndarray:
    return (diff * diff).sum(axis=1)


def nearest(coefs: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, dims * squared distance) for each row."""
    n, dims = coefs.shape
    cuts = [min(8, dims)]
    while cuts[-1] < dims:
        cuts.append(2 * cuts[-1])
    each = np.arange(n)
    sums = np.stack([_squares(coefs[:, :cuts[0]] - c[:cuts[0]]) for c in centres], axis=1)
    leader = sums.argmin(axis=1)
    bound = sums[each, leader] + _squares(coefs[:, cuts[0]:] - centres[leader][:, cuts[0]:])
    alive = sums <= bound[:, None]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        for number, centre in enumerate(centres):
            rows = np.flatnonzero(alive[:, number])
            sums[rows, number] += _squares(coefs[rows, a:b] - centre[a:b])
            alive[rows, number] = sums[rows, number] <= bound[rows]
    found = np.where(alive, sums, bound[:, None] + 1).argmin(axis=1)
    return found, sums[each, found]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, coefs) of the vectors that take part; coefs are little-endian 64-bit integers."""
    rows = only(vectors, id_col, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") == dims) & finite)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = np.floor(scale * batch["v"].flatten().to_numpy(zero_copy_only=False))
                if np.abs(flat).max() >= COMPONENT_LIMIT:
                    raise OverflowError("a component is too large for squared distances of 64 bits")
                coefs = transform(flat.astype("<i8").reshape(-1, dims))
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array([r.tobytes() for r in coefs], pa.binary())], ["id", "coefs"])

    return map_batches(rows, turn, f"id {rows.schema['id'].dataType.simpleString()}, coefs binary")


def _coefs(column: pa.Array, dims: int, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of a batch and the centres, as Python integers where 64 bits might not do."""
    rows = np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)
    if max(np.abs(rows).max(initial=0), np.abs(centres).max(initial=0)) < SAFE:
        return rows, centres
    return rows.astype(object), centres.astype(object)


def seeds(coefs: DataFrame, clusters: int, seed: int, dims: int) -> np.ndarray:
    """Coefficients of the `clusters` vectors with the smallest sha256 of `seed:id`; rows of
    one id by their coefficients, rows without an id last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = coefs.orderBy(order.asc_nulls_last(), "coefs").limit(clusters).collect()      # `clusters` rows
    return np.array([np.frombuffer(r["coefs"], "<i8") for r in first], np.int64).reshape(-1, dims)


def cluster_sums(coefs: DataFrame, centres: np.ndarray, dims: int) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (vectors, sums of their coefficients)} of one assignment."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centres), np.int64)
        sums = np.zeros((len(centres), dims), object)
        for batch in batches:
            if batch.num_rows:
                rows, at = _coefs(batch["coefs"], dims, centres)
                number, _ = nearest(rows, at)
                for c in np.unique(number).tolist():
                    mine = rows[number == c]
                    counts[c] += len(mine)
                    sums[c] += mine.sum(axis=0).astype(object)
        for c in np.flatnonzero(counts).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * (dims + 1), pa.int32()), pa.array(range(-1, dims), pa.int32()),
                 pa.array([str(x) for x in (counts[c], *sums[c])])], ["cluster", "at", "part"])

    parts = map_batches(coefs.select("coefs"), task, "cluster int, at int, part string")
    total = parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).cast("string").alias("total"))
    held: dict[int, dict[int, int]] = {}
    for row in total.collect():                                        # clusters x (dims + 1) numbers
        held.setdefault(row["cluster"], {})[row["at"]] = int(row["total"])
    return {c: (of[-1], [of[i] for i in range(dims)]) for c, of in held.items()}


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector that takes part: id, cluster, distance (squared), cluster_inertia,
    inertia, centroid (its final components).

    Vectors of another width, null ones and those with a null or non-finite component are left
    out. Repeated rows are vectors of their own; a null id is clustered like any other. Ties go
    to the smaller centroid; an empty cluster keeps its centroid. With fewer vectors than
    `clusters`, each starts a centroid; an empty table gives an empty result. Components of
    2^31 and more, or a squared distance beyond 64 bits, are an error.
    """
    if dims & (dims - 1):
        raise ValueError("dims must be a power of two")
    spark = vectors.sparkSession
    ship_package(spark)
    coefs = stored(integer_vectors(vectors, id_col, vector_col, dims, scale), "cluster-coefs")
    id_type = coefs.schema["id"].dataType.simpleString()
    at = seeds(coefs, clusters, seed, dims)
    schema = f"`{id_col}` {id_type}, cluster int, distance long"
    if not len(at):
        return spark.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid array<long>")
    components = restore(at)
    for _ in range(rounds):
        for number, (count, sums) in cluster_sums(coefs, at, dims).items():
            components[number] = [x // count for x in restore(np.array([sums], object))[0]]
        at = transform(components)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, value = nearest(*_coefs(batch["coefs"], dims, at))
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(number, pa.int32()), pa.array((value // dims).tolist(), pa.int64())],
                                                 [id_col, "cluster", "distance"])

    assigned = stored(map_batches(coefs, assign, schema), "cluster-assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.sum("distance")).scalar()
    final = spark.createDataFrame([(i, c) for i, c in enumerate(components.tolist())], "cluster int, centroid array<long>")
    return (assigned.join(F.broadcast(inertia.join(F.broadcast(final), "cluster")), "cluster")      # `clusters` rows
            .select(id_col, "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"))


def _rounds_sql(rounds: int) -> str:
    """One assignment (a) and its centroids (c) per round, as chained tables."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""
a{i} AS MATERIALIZED (SELECT rid, k, d FROM (
  SELECT v.rid, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{i} c ON c.j = v.j GROUP BY v.rid, c.k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)""")
        if i < rounds:
            out.append(f"""
m{i} AS (SELECT a.k, v.j, sum(v.x) AS s, count(*) AS n FROM a{i} a JOIN v ON v.rid = a.rid GROUP BY a.k, v.j),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.j, CAST(CASE WHEN n IS NULL THEN c.x
  ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k AND m.j = c.j)""")
    return ",".join(out)


OP12_SQL = f"""
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT rid, unnest(range(64)) AS j, CAST(floor(1024 * unnest(e)) AS BIGINT) AS x FROM e),
s AS (SELECT rid, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS k FROM e),
c0 AS MATERIALIZED (SELECT s.k, v.j, v.x FROM s JOIN v USING (rid) WHERE s.k < 8),{_rounds_sql(10)}
SELECT e.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a10 a JOIN e USING (rid)
JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c10 GROUP BY k) h USING (k)
"""

QUERIES = {"op12_centroids": (op12_centroids, OP12_SQL)}

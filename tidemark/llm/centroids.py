"""Centroid clustering with exact assignments and geometric drift tightening.

Integer vectors, integer centroids: each round assigns every vector to its nearest centroid
and replaces every centroid by the floored mean of its vectors; after the last round the
vectors are assigned once more.

A vector carries its cluster and a lower bound of its distance to every other centroid.
When centroids move from p to q, a bound need not fall by the whole drift |q - p|: the
vectors of a cluster lie in a sphere about its old centroid, and in the plane through the
sphere's centre, p and q, the points that come nearer by t lie within the asymptotes of a
hyperbola with the foci p and q, a cone about the drift's middle with the cosine t / |q - p|.
The sphere's smallest angle to the drift, seen from that middle, thus limits what any of
its vectors can lose (``loosening``): |q - p| only if the sphere holds the middle or meets
the axis, nothing at right angles and beyond. A vector whose exact distance to its own
centroid stays below its lower bound keeps its cluster; every other one is scanned against
all centroids exactly, in whole numbers (ties: the smaller number).

Vectors stay in their tasks: a round rewrites the state table in the shared folder without a
shuffle, and k x dims sums come to the driver. The table of the round before is removed then.

Vectors that are null, of another length than ``dims`` or hold null or non-finite
components are left out. Ids may be null or repeat; of equal ids the lesser vector comes
first among the start centroids, null ids come last. Fewer vectors than ``k`` give fewer
centroids; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, stored, table
from .integer_vectors import SCALE, matrix, whole_vectors

K, ROUNDS, DIMS, SEED = 40, 5, 64, 2
#: distances of a block of vectors to all centroids, held at once
BLOCK = 1 << 21


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i]: how much nearer any other centroid can have come to a vector of cluster i.

    ``radius`` bounds the distance of a cluster's vectors to its old centroid. Angles and
    lengths are rounded to the safe side.
    """
    k = len(old)
    old, new = old.astype(np.float64), new.astype(np.float64)
    drift = new - old
    length = np.sqrt((drift ** 2).sum(axis=1))
    worst = np.zeros(k)
    for j in np.flatnonzero(length):
        to = old - (old[j] + new[j]) / 2
        reach = np.sqrt((to ** 2).sum(axis=1))
        along = to @ drift[j] / length[j]
        across = np.sqrt(np.maximum(0, reach ** 2 - along ** 2))
        outside = reach > radius * (1 + 1e-9) + 1e-9
        spread = np.arcsin(np.where(outside, radius / np.maximum(reach, 1e-300), 1.0))
        angle = np.arctan2(across, along) - spread - 1e-6
        lost = np.where(outside, length[j] * np.cos(np.clip(angle, 0, np.pi / 2)), length[j])
        lost[j] = 0  # its own centroid is measured exactly
        worst = np.maximum(worst, lost)
    return worst * (1 + 1e-9) + np.where(worst > 0, 1e-9, 0)


def _squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centroids, exactly."""
    most = max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.float64 if 4 * points.shape[1] * int(most) ** 2 < 2 ** 53 else np.int64
    p, c = points.astype(kind), centroids.astype(kind)
    if kind is np.float64:  # whole numbers below 2^53: products in doubles are exact
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((p - row) ** 2).sum(axis=1) for row in c], axis=1)


class _Assign:
    """State of the next round: vec, id, cluster, distance, lower, scans."""

    def __init__(self, centroids: np.ndarray, fall: np.ndarray | None):
        self.centroids, self.fall = centroids, fall

    def scan(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        squared = _squared(points, self.centroids)
        own = squared.argmin(axis=1)
        best = squared[np.arange(len(points)), own]
        if squared.shape[1] > 1:
            second = np.partition(squared, 1, axis=1)[:, 1]
        else:
            second = np.full(len(points), np.iinfo(np.int64).max)
        return own, best, np.sqrt(second.astype(np.float64)) * (1 - 1e-12)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // self.centroids.size)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                points = matrix(batch.column(0), self.centroids.shape[1])
                if self.fall is None:
                    cluster = np.zeros(len(points), np.int64)
                    squared, lower = np.zeros(len(points), np.int64), np.zeros(len(points))
                    scans, open_ = np.zeros(len(points), np.int64), np.arange(len(points))
                else:
                    cluster = batch.column(2).to_numpy().astype(np.int64)
                    scans = batch.column(5).to_numpy().astype(np.int64)
                    gap = points - self.centroids[cluster]
                    squared = (gap * gap).sum(axis=1)
                    lower = batch.column(4).to_numpy() - self.fall[cluster]
                    open_ = np.flatnonzero(np.sqrt(squared) * (1 + 1e-12) + 1e-9 >= lower)
                if len(open_):
                    lower = lower.copy()
                    cluster[open_], squared[open_], lower[open_] = self.scan(points[open_])
                    scans[open_] += 1
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)),
                                       pa.array(squared), pa.array(lower), pa.array(scans.astype(np.int32))],
                                      names=["vec", "id", "cluster", "distance", "lower", "scans"])


def _moved(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids after their vectors' means, and the clusters' radii before."""
    dims = centroids.shape[1]
    rows = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("distance").alias("far"),
                                        F.array(*(F.sum(F.get("vec", F.lit(i))) for i in range(dims))).alias("sums"))
    new, radius = centroids.copy(), np.zeros(len(centroids))
    for row in rows.collect():  # at most k rows
        new[row.cluster] = [s // row.n for s in row.sums]
        radius[row.cluster] = np.sqrt(float(row.far)) * (1 + 1e-9)
    return new, radius


def centroid_clusters(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id",
                      vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS,
                      seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """One row per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256, scans.

    ``scans`` counts how often the vector was compared with all centroids.
    """
    fitting = vectors.where(F.size(vec_col) == dims)
    kept = stored(spark, whole_vectors(fitting, vec_col, {"id": id_col}, scale), "clusters-vectors")
    start = (kept.select("id", "vec", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
                         .alias("hash"))
             .orderBy(F.col("hash").asc_nulls_last(), "id", "vec").limit(k).select("vec").toArrow())
    centroids = matrix(start["vec"], dims)
    if not len(centroids):
        return kept.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"),
                           *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
                           F.lit("").alias("centroid_sha256"), F.lit(0).alias("scans"))
    schema = f"vec array<int>, id {kept.schema['id'].dataType.simpleString()}, " \
             "cluster int, distance long, lower double, scans int"
    state, fall = kept, None
    for turn in range(rounds + 1):
        after = stored(spark, state.mapInArrow(_Assign(centroids, fall), schema), "clusters-state")
        forget(spark, state)
        state = after
        if turn < rounds:
            moved, radius = _moved(state, centroids)
            fall, centroids = loosening(centroids, moved, radius), moved
    inertia = {r.cluster: r.s for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, s, sum(inertia.values()),
              hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, s in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(facts), "cluster").select(  # at most k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(spark, table(spark, sf_dir, "embeddings")).drop("scans")


def _oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED, scale: int = SCALE) -> str:
    """The same clusters by comparing every vector with every centroid."""
    steps = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
item AS MATERIALIZED (SELECT r, i, v[i] AS x FROM kept, range(1, {dims + 1}) AS t(i)),
cent0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, vec_id, v) - 1 AS c, v AS m
  FROM kept QUALIFY c < {k})"""]
    near = """near{n} AS MATERIALIZED (
  SELECT r, min(d * 1024 + c) % 1024 AS c, min(d * 1024 + c) // 1024 AS d FROM (
    SELECT r, c, CAST(list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m) AS BIGINT) AS d
    FROM kept, cent{n}) GROUP BY r)"""
    for n in range(rounds):
        steps.append(near.format(n=n))
        steps.append(f"""mean{n} AS (
  SELECT c, list(m ORDER BY i) AS m FROM (
    SELECT c, i, floor(sum(x) / count(*)) AS m FROM near{n} JOIN item USING (r) GROUP BY c, i) GROUP BY c),
cent{n + 1} AS MATERIALIZED (SELECT c, coalesce(a.m, b.m) AS m FROM cent{n} b LEFT JOIN mean{n} a USING (c))""")
    steps.append(near.format(n=rounds))
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM kept JOIN near{rounds} USING (r) JOIN cent{rounds} USING (c)"""


ORACLE = _oracle()

"""Centroid clustering in whole numbers, with bounds that drift geometry loosens little.

A vector keeps an upper bound of the distance to its centroid and a lower bound of
that to any other. When centroids move, the upper bound grows by the drift of its
own centroid. All vectors of a cluster lie in a sphere around its centroid, so the
lower bound needs to shrink only by the most that a moved centroid can come nearer to
a point of that sphere; in the plane of the three points this is the drift times
the cosine of the least angle under which the sphere is seen from the middle of the
move. A vector whose upper bound stays below its lower bound, or below half the way
from its centroid to the next one, keeps its cluster; all others are compared with
every centroid in exact whole numbers, so the result is that of full scans.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.sources.workspace import settle

COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
MOST_CLUSTERS = 64  # the driver sees at most clusters^2 rows of sums in a round
LARGEST = 1 << 27  # of a whole component, so that 64 squared differences fit 63 bits
SAFE = 1e-9  # relative widening of bounds, far above the error of double arithmetic
_STATE = "vec_id bigint, v array<int>, cluster int, before int, upper double, lower double"


@dataclass(frozen=True)
class Move:
    """Centroids to assign to, and how far bounds must be loosened since the last ones."""

    centroids: np.ndarray
    drift: np.ndarray
    loss: np.ndarray
    half_gap: np.ndarray


@dataclass(frozen=True)
class Clustering:
    """Rows ``vec_id, cluster, distance`` and the final centroids."""

    rows: DataFrame
    centroids: np.ndarray


def whole_vectors(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` of the vectors of the right length with finite components only.

    A component beyond 2^27 after scaling is an error: its distances would not fit a long.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    x = F.transform("embedding", lambda e: e.cast("double"))
    kept = embeddings.where(F.size("embedding") == components).withColumn("_x", x)
    kept = kept.where(F.forall("_x", fine))

    def whole(e):
        y = F.floor(e * scale)
        too_large = F.raise_error(F.lit("a component is too large")).cast("int")
        return F.when(F.abs(e) * scale < LARGEST, y.cast("int")).otherwise(too_large)

    return kept.select("vec_id", F.transform("_x", whole).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors of the least hashes of their ids; fewer if there are fewer."""
    name = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    order = [F.sha2(name, 256).asc_nulls_last(), F.col("v")]
    rows = vectors.orderBy(*order).limit(clusters).collect()  # at most ``clusters`` rows
    return np.array([r["v"] for r in rows], np.int64)


def approach(center: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """Most by which a centroid moving from old to new comes nearer to a point of a sphere.

    With v a point seen from the middle of the move, its distances to both ends differ
    by 2 (drift . v) over their sum, and their sum is at least 2 |v| and at least the
    drift. So the difference is at most the drift times the cosine of the angle between
    v and the move, which over the sphere is least at its edge towards the move, and
    at most twice the reach of the sphere along the move.
    """
    move = new - old
    drift = float(np.linalg.norm(move))
    if drift == 0.0:
        return 0.0
    v = center - (old + new) / 2
    far = float(np.linalg.norm(v))
    along = float(v @ move) / drift
    reach = max(0.0, 2 * (along + radius))
    if far > radius:
        angle = np.arccos(np.clip(along / far, -1, 1)) - np.arcsin(radius / far)
        cosine = max(0.0, float(np.cos(max(0.0, angle))))
    else:
        cosine = 1.0
    slack = SAFE * (drift + far + radius)
    return min(drift * (1 + SAFE), drift * cosine + slack, reach + slack)


def moved(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Move:
    """Drift of each centroid, and per cluster the largest approach of another one."""
    k = len(old)
    a, b = old.astype(float), new.astype(float)
    loss = np.array(
        [max((approach(a[i], radius[i], a[j], b[j]) for j in range(k) if j != i), default=0.0) for i in range(k)]
    )
    drift = np.linalg.norm(b - a, axis=1) * (1 + SAFE)
    return Move(new, drift, loss, _half_gap(new))


def _half_gap(centroids: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the nearest other one."""
    x = centroids.astype(float)
    gaps = np.array([np.linalg.norm(x - c, axis=1) for c in x])
    np.fill_diagonal(gaps, np.inf)
    return gaps.min(axis=1) / 2 * (1 - SAFE)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _scan(x: np.ndarray, centroids: np.ndarray):
    """Nearest centroid (the smaller of ties), and bounds from exact distances."""
    squared = _distances(x, centroids)
    nearest = squared.argmin(axis=1)
    rows = np.arange(len(x))
    upper = np.sqrt(squared[rows, nearest].astype(float)) * (1 + SAFE)
    if len(centroids) == 1:
        return nearest, upper, np.full(len(x), np.inf)
    others = squared.astype(float)
    others[rows, nearest] = np.inf
    return nearest, upper, np.sqrt(others.min(axis=1)) * (1 - SAFE)


def reassigned(x, cluster, upper, lower, move: Move):
    """Clusters and bounds after a move, and how many vectors were scanned."""
    cluster = cluster.copy()
    upper = upper + move.drift[cluster]
    lower = lower - move.loss[cluster]
    limit = np.maximum(lower, move.half_gap[cluster])
    near = np.flatnonzero(upper >= limit)
    own = ((x[near] - move.centroids[cluster[near]]) ** 2).sum(axis=1)
    upper[near] = np.sqrt(own.astype(float)) * (1 + SAFE)
    unsure = near[upper[near] >= limit[near]]
    if len(unsure):
        cluster[unsure], upper[unsure], lower[unsure] = _scan(x[unsure], move.centroids)
    return cluster, upper, lower, len(unsure)


def _matrix(batch: pa.RecordBatch, components: int) -> np.ndarray:
    return np.asarray(batch.column("v").flatten(), np.int64).reshape(-1, components)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _state(batch: pa.RecordBatch, cluster, before, upper, lower) -> pa.RecordBatch:
    new = [pa.array(cluster, pa.int32()), pa.array(before, pa.int32()), pa.array(upper), pa.array(lower)]
    names = ["vec_id", "v", "cluster", "before", "upper", "lower"]
    return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), *new], names=names)


def _assign_first(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            cluster, upper, lower = _scan(_matrix(batch, centroids.shape[1]), centroids)
            yield _state(batch, cluster, np.full(len(cluster), -1), upper, lower)

    return vectors.mapInArrow(run, _STATE)


def _assign_again(state: DataFrame, move: Move) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = _matrix(batch, move.centroids.shape[1])
            old, upper, lower = (_numbers(batch, c) for c in ("cluster", "upper", "lower"))
            cluster, upper, lower, _ = reassigned(x, old, upper, lower, move)
            yield _state(batch, cluster, old, upper, lower)

    return state.mapInArrow(run, _STATE)


def _changes(state: DataFrame, sums: np.ndarray, counts: np.ndarray):
    """Sums and counts per cluster after the vectors that changed theirs, and radii.

    One aggregation, combined before its shuffle, gives a row per (cluster, cluster before).
    """
    components = sums.shape[1]
    changed = F.col("cluster") != F.col("before")
    each = [F.sum(F.when(changed, F.get("v", F.lit(i)).cast("bigint"))) for i in range(components)]
    found = state.groupBy("cluster", "before").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("upper").alias("radius"),
        F.array(*each).alias("sums"),
    )
    sums, counts, radius = sums.copy(), counts.copy(), np.zeros(len(counts))
    for row in found.collect():  # at most clusters * (clusters + 1) rows
        now, was = row["cluster"], row["before"]
        radius[now] = max(radius[now], row["radius"])
        if now != was:
            for at, sign in ((now, 1), (was, -1)):
                if at >= 0:
                    sums[at] += sign * np.array(row["sums"], np.int64)
                    counts[at] += sign * row["n"]
    return sums, counts, radius


def _centroids(sums: np.ndarray, counts: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean; an empty cluster keeps its centroid."""
    return np.where((counts > 0)[:, None], sums // np.maximum(counts, 1)[:, None], old)


def cluster_vectors(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
) -> Clustering | None:
    """Clusters after ``rounds`` rounds of assignment and update and one more assignment.

    Each round's state is cached, the previous one dropped; a lost partition is computed
    anew from the checkpointed vectors with the centroids of each round. The driver sees
    centroids, sums and radii only. None if no vector is kept.

    Vectors of another length, or with a NULL, NaN or infinite component, are left out;
    repeated vectors and ids count as often; a NULL vec_id comes last in the choice of
    first centroids. Fewer vectors than clusters give as many clusters as vectors.
    """
    if not 1 <= clusters <= MOST_CLUSTERS:
        raise ValueError(f"from 1 to {MOST_CLUSTERS} clusters, not {clusters}")
    vectors = settle(whole_vectors(embeddings, components, scale))
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return None
    sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
    state = _assign_first(vectors, centroids).persist(StorageLevel.MEMORY_AND_DISK)
    previous = None
    for _ in range(rounds):
        sums, counts, radius = _changes(state, sums, counts)  # computes the state
        if previous:
            previous.unpersist()
        new = _centroids(sums, counts, centroids)
        following = _assign_again(state, moved(centroids, new, radius))
        previous, state = state, following.persist(StorageLevel.MEMORY_AND_DISK)
        centroids = new
    rows = settle(_with_distance(state, centroids))
    for kept in filter(None, (previous, state)):
        kept.unpersist()
    return Clustering(rows, centroids)


def _with_distance(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            x, cluster = _matrix(batch, centroids.shape[1]), _numbers(batch, "cluster")
            distance = ((x - centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"), pa.array(distance, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return state.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster_digest(embeddings: DataFrame) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector."""
    spark = embeddings.sparkSession
    fields = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    found = cluster_vectors(embeddings)
    if found is None:
        return spark.createDataFrame([], f"vec_id bigint, distance bigint, {fields}").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
        )
    totals = found.rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # per cluster
    inertia = sum(r["d"] for r in totals)
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    known = [(r["cluster"], r["d"], inertia, sha(found.centroids[r["cluster"]])) for r in totals]
    per_cluster = spark.createDataFrame(known, fields)
    return found.rows.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

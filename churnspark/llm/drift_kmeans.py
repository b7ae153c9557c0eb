"""Centroid clustering with geometrically tightened drift bounds.

Lloyd's rounds on integer vectors, without comparing every vector with every
centroid. Each vector carries its cluster, an upper bound ``u`` of the distance
to its centroid and a lower bound ``l`` of the distance to any other one. While
``u < l`` the cluster cannot change and nothing is computed for it.

When centroids move, ``u`` grows by the own centroid's drift and ``l`` shrinks by
what some other centroid can have come nearer. For a centroid that went from a
to b that is at most its drift p = |ab|, but the cluster's vectors all lie in the
sphere around the old centroid c with radius R (the largest ``u``), and in the plane
through a, b and c the sphere is a disc. With the origin in the middle of ab and X
the coordinate along ab, any point x has

    |xa| - |xb| = 2 p X / (|xa| + |xb|) <= p cos(angle of x against ab)   for X > 0,
    |xa| - |xb| <= 0                                                      for X <= 0,

since |xa| + |xb| is at least twice the distance from the origin. Seen from the
origin, the disc's smallest angle is the centre's angle less asin(R / D), D the
centre's distance; so the loosening is p times the cosine of that angle, zero if
the whole disc lies on a's side, and p only if the disc holds the origin or
touches the ray ahead. Where ``u`` and ``l`` still meet, ``u`` is made exact, and a vector
that stays ambiguous is compared with all centroids in integers. Bounds are doubles with a
slack far above their rounding, and equal distances always count as ambiguous,
so clusters are exactly those of the full comparison (ties: smaller number).

Spark does the passes: vectors and bounds are a written table each round (no
lineage grows, a lost executor repeats one pass), sums come from per-task partial
sums, and only numbers of the size clusters x dimensions reach the driver.

Edge cases: a null vector, another number of components, and a null or non-finite
component leave a row out. Null ids are kept (their hash text is ``seed:``); repeated
rows count each; equal ids tie by their components. Fewer vectors than clusters
give as many clusters as vectors; an empty table an empty result. Equal centroids
leave the larger number empty, it stays where it is. Other columns are not read.
A component beyond ``LARGEST`` after scaling raises, as squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, written

LARGEST = 1 << 26
EXACT_IN_DOUBLES = 1 << 22    # 64 products of such numbers add up below 2^53
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int, scale: int) -> DataFrame:
    """``(id, v)``: usable vectors with components ``floor(scale * x)``."""
    x = F.transform(col(vec_col), lambda e: e.cast("double"))
    usable = (F.size(x) == dim) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    v = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e))
    fits = F.forall(F.col("v"), lambda e: F.abs(e) <= LARGEST)
    kept = vectors.filter(F.coalesce(usable, F.lit(False))).select(col(id_col).alias("id"), v.alias("v"))
    checked = F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")))
    return kept.select("id", checked.alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = kept.orderBy(digest, "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (vectors x centroids)."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT_IN_DOUBLES // 2 and x.shape[1] <= 64:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        d = (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)
        return d.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def full_scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, distance to its centroid, distance to the nearest other one (infinite if there is none)."""
    d = squared_distances(x, centroids)
    best = d.argmin(axis=1)
    own = np.sqrt(d[np.arange(len(d)), best])
    d[np.arange(len(d)), best] = np.iinfo(np.int64).max
    other = np.sqrt(d.min(axis=1)) if len(centroids) > 1 else np.full(len(d), np.inf)
    return best, own, other


@dataclass(frozen=True)
class Move:
    """What one round's move of the centroids does to the bounds of each cluster."""

    centroids: np.ndarray     # after the move
    drift: np.ndarray         # of the own centroid: u grows by it
    loosening: np.ndarray     # l shrinks by it


def loosening(centre: np.ndarray, radius: float, a: np.ndarray, b: np.ndarray) -> float:
    """How much nearer a centroid that went from ``a`` to ``b`` can have come to a point of the sphere."""
    step = (b - a).astype(np.float64)
    p = float(np.sqrt(step @ step))
    if p == 0.0:
        return 0.0
    mid = centre - (a + b) / 2.0
    far = float(np.sqrt(mid @ mid))
    if radius >= far:
        return p
    angle = np.arccos(np.clip(mid @ step / (far * p), -1.0, 1.0)) - np.arcsin(radius / far)
    return 0.0 if angle >= np.pi / 2 + SLACK else p * float(np.cos(max(0.0, angle - SLACK)))


def move(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> Move:
    """Bounds for every cluster; ``radius`` is the largest ``u`` of its vectors (negative: it has none)."""
    k = len(before)
    drift = np.sqrt(((after - before).astype(np.float64) ** 2).sum(axis=1))
    loose = np.array([max((loosening(before[i], radius[i], before[j], after[j]) for j in range(k) if j != i), default=0.0)
                      if radius[i] >= 0 else 0.0 for i in range(k)])
    return Move(after, drift, loose)


def tightened(x: np.ndarray, cluster: np.ndarray, u: np.ndarray, low: np.ndarray, m: Move
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """New cluster, ``u``, ``l`` and whether all centroids were compared."""
    slack = SLACK * (1.0 + u + np.where(np.isfinite(low), low, 0.0) + m.drift[cluster])
    u, low = u + m.drift[cluster] + slack, low - m.loosening[cluster] - slack
    unsure = np.flatnonzero(u >= low)
    gap = (x[unsure] - m.centroids[cluster[unsure]]).astype(np.float64)
    u[unsure] = np.sqrt((gap * gap).sum(axis=1)) * (1 + SLACK)
    unsure = unsure[u[unsure] >= low[unsure]]
    cluster, scanned = cluster.copy(), np.zeros(len(x), bool)
    scanned[unsure] = True
    if len(unsure):
        cluster[unsure], u[unsure], low[unsure] = full_scan(x[unsure], m.centroids)
    return cluster, u, low, scanned


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


STATE = "id long, v array<bigint>, cluster int, u double, l double, scans int"


def _passed(table: DataFrame, dim: int, step) -> DataFrame:
    """One pass over vectors and bounds; ``step`` gives cluster, u, l and whether it compared all centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                old = [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]
                cluster, u, low, scanned = step(_matrix(batch.column(1), dim), *old[:3])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(u, pa.float64()),
                     pa.array(low, pa.float64()), pa.array(old[3] + scanned, pa.int32())], schema=batch.schema)

    return table.mapInArrow(run, STATE)


def _totals(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per cluster: vectors, componentwise sums (Python integers), largest ``u`` (-1 if empty)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, top = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), np.full(k, -1.0)
        for batch in batches:
            x, cluster, u = _matrix(batch.column(0), dim), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])
            n += np.bincount(cluster, minlength=k)
            np.maximum.at(top, cluster, u)
            order = np.argsort(cluster, kind="stable")
            present, at = np.unique(cluster[order], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(x[order], at, axis=0)
        have = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), pa.array(n[have]), pa.array(top[have]),
                                          pa.array(sums[have].tolist(), pa.list_(pa.int64()))], names=["c", "n", "top", "s"])

    parts = state.select("v", "cluster", "u").mapInArrow(partial, "c int, n long, top double, s array<bigint>")
    parts = parts.select("c", "n", "top", F.posexplode("s").alias("pos", "x"))
    rows = parts.groupBy("c", "pos").agg(F.sum("n").alias("n"), F.max("top").alias("top"),
                                         F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    n, sums, top = np.zeros(k, object), np.zeros((k, dim), object), np.full(k, -1.0)
    for r in rows:
        n[r["c"]], top[r["c"]], sums[r["c"], r["pos"]] = r["n"], r["top"], int(r["x"])
    return n, sums, top


@dataclass(frozen=True)
class Clustering:
    """``assigned``: (id, v, cluster, u, l, scans), u exact in the last pass; ``scans`` counts full comparisons of a vector."""

    assigned: DataFrame
    centroids: np.ndarray


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: int = 64,
            k: int = 16, rounds: int = 3, seed: int = 1) -> Clustering | None:
    """``rounds`` of assignment and floor-mean update, and one more assignment; None if no vector is usable."""
    kept = integer_vectors(vectors, id_col, vec_col, dim, scale)
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return None
    k = len(centroids)
    start = kept.select("id", "v", F.lit(0).alias("cluster"), F.lit(0.0).alias("u"), F.lit(0.0).alias("l"), F.lit(0).alias("scans"))
    state = written(_passed(start, dim, lambda x, *_, c=centroids: (*full_scan(x, c), True)))
    for _ in range(rounds):
        n, sums, top = _totals(state, k, dim)
        after = np.array([[int(s) // int(n[c]) for s in sums[c]] if n[c] else centroids[c].tolist() for c in range(k)], np.int64)
        m = move(centroids, after, top)
        state = written(_passed(state, dim, lambda *old, m=m: tightened(*old, m)))
        centroids = after
    return Clustering(state, centroids)


def distances(done: Clustering) -> DataFrame:
    """``(id, cluster, distance)``: the exact squared distance of each vector to its centroid."""
    table, dim = done.centroids, done.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gap = _matrix(batch.column(1), dim) - table[batch.column(2).to_numpy()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array((gap * gap).sum(axis=1))],
                                                 names=["id", "cluster", "distance"])

    return done.assigned.select("id", "v", "cluster").mapInArrow(run, "id long, cluster int, distance long")


def report(done: Clustering) -> DataFrame:
    """``distances`` with the inertia of the cluster and of all, and the SHA-256 of the centroid's components."""
    found = distances(done)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in done.centroids.tolist()]
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most k rows
    spark = found.sparkSession
    total = sum(r["cluster_inertia"] for r in per)
    table = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], total, names[r["cluster"]]) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster")

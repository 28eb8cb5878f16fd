"""Clusters around centroids, by bounds that moved centroids loosen as little as geometry allows.

``clustered`` runs rounds of assignment and update on integer vectors, so that results are
exact and alike on every cluster. Every vector keeps an upper bound of the distance to its own
centroid and a lower bound of that to all others. When centroids move, the upper bound grows
by its own centroid's drift. The lower bound would shrink by the largest drift of the others;
instead the sphere around the old centroid that holds the whole cluster is looked at in the
plane through its centre and the two places of a moved centroid: seen from the middle of the
move, points at the angle phi from its direction come nearer by at most drift * cos(phi)
(``loosening``). A vector whose upper bound stays below the lower bound, or below half the way
to the nearest other centroid, keeps its cluster unseen. Every other, ambiguous one has its
distance taken exactly, and if that does not decide, is scanned against all centroids.

Vectors and bounds are one written table per round, read and written without a shuffle. What
is gathered is bounded by centroids and components: partial sums of the vectors that changed
their cluster, and the radius of each cluster.

Defined results: vectors that are null, of another size or with a component that is null or not
finite are left out; fewer vectors than centroids give as many centroids as vectors; ties go to
the smaller number; repeated rows are vectors of their own; an empty table has no rows; further
columns are kept under any names, but the vector and those named like a result. Components
beyond 2^22 are exact but slow; distances whose sum exceeds 64 bits are an error.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.common import discarded, number, numbered, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
#: Share and amount added to bounds, far beyond the rounding errors of doubles.
_SLACK, _LEAST = 1e-12, 1e-9
#: Floats hold integers up to here exactly.
_EXACT = 1 << 53


def _wide(value: np.ndarray | float) -> np.ndarray | float:
    return value * (1 + _SLACK) + _LEAST


def _narrow(value: np.ndarray | float) -> np.ndarray | float:
    return value * (1 - _SLACK) - _LEAST


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all centroids."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if points.shape[1] * (2 * top) ** 2 < _EXACT:
        x, c = points.astype(np.float64), centroids.astype(np.float64)
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        return d.astype(np.int64)
    x, c = points.astype(object), centroids.astype(object)
    return np.array([[int(((p - q) ** 2).sum()) for q in c] for p in x], dtype=np.int64).reshape(len(x), len(c))


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """By how much a centroid that moves from ``old`` to ``new`` can come nearer to a point of
    the sphere of ``radius`` around ``centre``.

    For a point x at the angle phi from the direction of the move, seen from its middle,
    |x - old| - |x - new| = 2 drift |x| cos(phi) / (|x - old| + |x - new|), and the sum below is at
    least 2 |x|. The largest cosine in the sphere is that of the tangent in the plane of its centre.
    """
    move = new - old
    drift = float(np.sqrt((move * move).sum()))
    if drift == 0.0:
        return 0.0
    way = centre - (old + new) / 2
    far = float(np.sqrt((way * way).sum()))
    if radius >= far:
        return drift
    cosine = float(np.clip((way * move).sum() / (far * drift), -1.0, 1.0))
    angle = np.arccos(cosine) - np.arcsin(min(1.0, radius / far))
    return drift * float(np.clip(np.cos(max(angle, 0.0)), 0.0, 1.0))


def movement(old: np.ndarray, new: np.ndarray, radius: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per cluster: its centroid's drift, what lower bounds lose, half the way to the next centroid."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    k = len(a)
    drift = _wide(np.sqrt(((a - b) ** 2).sum(1)))
    loss, half = np.zeros(k), np.full(k, np.inf)
    for i in range(k):
        others = [j for j in range(k) if j != i]
        loss[i] = _wide(max((loosening(a[i], _wide(radius[i]), a[j], b[j]) for j in others), default=0.0))
        half[i] = _narrow(min((float(np.sqrt(((b[i] - b[j]) ** 2).sum())) for j in others), default=np.inf) / 2)
    return drift, loss, half


def assigned(points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray,
             centroids: np.ndarray, moved: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster and bounds of each point under ``centroids``, and how many were scanned."""
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    if moved is None:
        scan = np.arange(len(points))
    else:
        drift, loss, half = moved
        upper += drift[cluster]
        lower -= loss[cluster]
        safe = np.maximum(lower, half[cluster])
        near = np.flatnonzero(upper >= safe)
        upper[near] = _wide(np.sqrt(_own(points[near], cluster[near], centroids).astype(np.float64)))
        scan = near[upper[near] >= safe[near]]
    if len(scan):
        d = squared(points[scan], centroids)
        best = d.argmin(1)  # the first of equal ones
        rows = np.arange(len(scan))
        cluster[scan] = best
        upper[scan] = _wide(np.sqrt(d[rows, best].astype(np.float64)))
        rest = d.astype(np.float64)
        rest[rows, best] = np.inf
        lower[scan] = _narrow(np.sqrt(rest.min(1)))
    return cluster, upper, lower, len(scan)


def _own(points: np.ndarray, cluster: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each point to the centroid of its cluster."""
    d = np.zeros(len(points), dtype=np.int64)
    for c in np.unique(cluster):
        rows = cluster == c
        d[rows] = squared(points[rows], centroids[c : c + 1])[:, 0]
    return d


def _points(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("point").flatten().to_numpy().reshape(batch.num_rows, size)


def _step(centroids: np.ndarray, moved: tuple | None, last: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch, centroids.shape[1])
            before = batch.column("cluster").to_numpy()
            bounds = (batch.column(c).to_numpy() for c in ("upper", "lower"))
            cluster, upper, lower, _ = assigned(points, before, *bounds, centroids, moved)
            own = _own(points, cluster, centroids) if last else np.zeros(len(points), dtype=np.int64)
            new = {"cluster": cluster, "before": before, "upper": upper, "lower": lower, "distance": own}
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[f.name]) if f.name in new else batch.column(f.name) for f in batch.schema], schema=batch.schema
            )

    return run


def _changes(k: int, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What points that changed their cluster add to sums and counts, once per task."""
        total, n = np.zeros((k, size), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            points = _points(batch, size)
            for column, sign in (("cluster", 1), ("before", -1)):
                of = batch.column(column).to_numpy()
                for c in np.unique(of[of >= 0]):
                    total[c] += sign * points[of == c].sum(0).astype(object)
                    n[c] += sign * int((of == c).sum())
        hit = [c for c in range(k) if n[c] or total[c].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(hit, size + 1), pa.int32()), pa.array(list(range(size + 1)) * len(hit), pa.int32()),
             pa.array([int(v) for c in hit for v in (*total[c], n[c])], pa.int64())], names=["c", "at", "value"],
        )

    return run


def integers(df: DataFrame, vector: str, size: int, scale: int) -> DataFrame:
    """The rows whose vector is whole and finite, with its integers as ``point``."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = df.where((F.size(vector) == size) & whole)
    return kept.withColumn("point", F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def clustered(df: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 64,
              k: int = 16, rounds: int = 3, seed: str = "1") -> DataFrame:
    """The kept rows of ``df`` with ``cluster``, squared ``distance`` to its centroid, the sums of
    it over the cluster (``cluster_inertia``) and over all (``inertia``) and the digest of the centroid.

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed:key``.
    """
    rows, names = numbered(df)
    own = number(names, vector)
    plain = integers(rows, own, size, scale)
    tail = [F.lit(-1).alias("cluster"), F.lit(-1).alias("before"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"),
            F.lit(0).cast("long").alias("distance")]
    state = written(plain.drop(own).select("*", *tail), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(number(names, key)).cast("string"), F.lit(""))), 256)
    first = state.select(order.alias("order"), "point").orderBy("order", "point").limit(k).collect()
    centroids = np.array([r["point"] for r in first], dtype=np.int64).reshape(len(first), size)
    sums, moved = np.zeros((len(first), size + 1), dtype=object), None
    for turn in range(rounds + 1):
        if not len(first):
            break
        last = turn == rounds
        before, state = state, written(state.mapInArrow(_step(centroids, moved, last), state.schema), "vectors")
        discarded(before)
        if last:
            break
        changed = state.where("cluster <> before").select("cluster", "before", "point")
        parts = changed.mapInArrow(_changes(len(first), size), "c int, at int, value long")
        for r in parts.groupBy("c", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
            sums[r["c"], r["at"]] += int(r["value"])
        radius = {r["cluster"]: r["radius"] for r in state.groupBy("cluster").agg(F.max("upper").alias("radius")).collect()}
        old, centroids = centroids, centroids.copy()
        for c, row in enumerate(sums):
            if row[size]:
                centroids[c] = [int(v) // int(row[size]) for v in row[:size]]
        moved = movement(old, centroids, [radius.get(c, 0.0) for c in range(len(first))])
    inertia = state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    shown = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = [(r["cluster"], r["d"], sum(x["d"] for x in inertia), shown[r["cluster"]]) for r in inertia]
    schema = "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    side = F.broadcast(df.sparkSession.createDataFrame(of, schema))  # a row per centroid
    found = state.join(side, state["cluster"] == side["_cluster"])
    others = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n != vector and n.lower() not in RESULTS]
    return found.select(*others, *RESULTS)

"""Centroid clustering by k-means with the Shallot search (operator 12).

Vectors become whole numbers; centroids are whole numbers too, so every comparison that decides is exact.
Each row carries its nearest centroid, the centroid that was second, an upper bound of the distance to
the first and a lower bound of the distance to any other.  In a round the bounds move by what the
centroids moved; a row whose upper bound lies below its lower bound, or below half the way to the next
centroid, keeps its centroid unseen.  The rest (survivors) are compared in integers: with their first and
their remembered second centroid, then, from the closer of the two, with that centroid's neighbours in
order of distance.  The scan ends at the first neighbour outside the ball of radius (distance to the
start + distance to the second best so far), which shrinks with each better second.  Bounds are floats
with a slack on the safe side; ties go to the smaller number.

A round is one map over the rows, written to the shared folder, and one grouped sum that is combined
before the shuffle; the driver sees k sums of the vectors' width, so a cluster with most rows costs no
more than others.

Rows whose vector is null, of another width, or holds a null or a non-finite component take no part.
Repeated rows count each, as vectors of their own.  A null id takes part, but starts no centroid.  Of
rows with one id the smaller vector comes first as a start.  Fewer usable rows than ``k``: as many
centroids as there are; an empty table gives an empty result.  Components beyond 2^61, and sums or
squared distances that a long can't hold, raise an error.  Other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sha, written

#: Relative slack of the float bounds; far above their rounding errors, far below what they save.
SLACK = 1e-9
#: Below this size of components int64 holds all squared distances of up to 64 components.
SMALL = 1 << 27
ROWS = 4096


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows; ``x`` and ``y`` are int64 of small numbers, or Python integers."""
    gap = x - y
    return (gap * gap).sum(axis=-1)


def root(d) -> np.ndarray:
    return np.sqrt(np.asarray(d, dtype=np.float64))


class Centres:
    """Centroids with their distances and each one's neighbours in order of distance."""

    def __init__(self, points: list[list[int]], moved: list[float] | None = None):
        self.points = points
        exact = np.array(points, dtype=object)
        k = len(points)
        self.gap = np.array([[float(squared(exact[i], exact[j])) for j in range(k)] for i in range(k)]) ** .5
        self.order = np.argsort(self.gap, axis=1, kind="stable")
        apart = self.gap + np.diag(np.full(k, np.inf))
        self.half = apart.min(axis=1) / 2
        moved = np.zeros(k) if moved is None else np.array(moved)
        self.moved = moved * (1 + SLACK)
        # the largest move of any other centroid
        far = np.argsort(-moved, kind="stable")[:2]
        self.others = np.array([self.moved[far[0] if far[0] != i else far[-1]] if k > 1 else 0.0 for i in range(k)])


def assign(x: np.ndarray, centres: Centres, first, second, upper, lower) -> int:
    """Bring the state of the rows ``x`` (four arrays, changed in place) up to ``centres``; returns the
    number of distances computed."""
    points = np.array(centres.points, dtype=x.dtype)
    upper += centres.moved[first]
    lower -= centres.others[first]
    if len(points) == 1:
        return 0

    def open_rows(rows):
        # bounds that meet only within the slack count as met, so a tie is never skipped
        return rows[~(upper[rows] * (1 + SLACK) < np.maximum(lower[rows], centres.half[first[rows]]) * (1 - SLACK))]

    rows = open_rows(np.arange(len(x)))
    near = squared(x[rows], points[first[rows]])
    upper[rows] = root(near)
    seen = len(rows)
    keep = np.isin(rows, open_rows(rows))
    rows, near = rows[keep], near[keep]
    far = squared(x[rows], points[second[rows]])
    seen += len(rows)
    swap = (far < near) | ((far == near) & (second[rows] < first[rows]))
    old = first[rows]
    first[rows], second[rows] = np.where(swap, second[rows], old), np.where(swap, old, second[rows])
    near, far = np.where(swap, far, near), np.where(swap, near, far)
    start, reach = first[rows].copy(), root(near)  # the ball's centre stays; its radius shrinks with ``far``
    other = second[rows].copy()
    for c in np.unique(start):
        mine = np.flatnonzero(start == c)
        for j in centres.order[c]:
            if j == c:
                continue
            mine = mine[centres.gap[c, j] * (1 - SLACK) <= (reach[mine] + root(far[mine])) * (1 + SLACK)]
            if not len(mine):
                break
            new = mine[other[mine] != j]
            at = rows[new]
            d = squared(x[at], points[j])
            seen += len(at)
            best = (d < near[new]) | ((d == near[new]) & (j < first[at]))
            next_best = ~best & (d < far[new])
            far[new] = np.where(best, near[new], np.where(next_best, d, far[new]))
            second[at] = np.where(best, first[at], np.where(next_best, j, second[at]))
            near[new] = np.where(best, d, near[new])
            first[at] = np.where(best, j, first[at])
    upper[rows], lower[rows] = root(near), root(far)
    return seen


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<long>) of the rows that take part: v holds floor(scale * x), x as double."""
    x = F.col(vector_col).cast("array<double>")
    usable = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    big = F.raise_error(F.lit("a component is too large for exact distances")).cast("long")
    return vectors.where(F.col(vector_col).isNotNull()).where(usable).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.when(F.abs(c * scale) < float(1 << 61), F.floor(c * scale).cast("long")).otherwise(big)).alias("v"))


def _pass(state: DataFrame, centres: Centres) -> DataFrame:
    """One round over all rows; ``distance`` is the exact squared one to the row's centroid."""
    bc = state.sparkSession.sparkContext.broadcast(centres)  # k centroids, k x k distances

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                part = whole.slice(at, ROWS)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                x = flat.reshape(part.num_rows, -1)
                most = max(int(np.abs(flat).max(initial=0)), max(abs(c) for p in bc.value.points for c in p))
                if most >= SMALL or x.shape[1] > 64:
                    x = x.astype(object)
                first, second, upper, lower = (part.column(i).to_numpy(zero_copy_only=False).copy() for i in range(2, 6))
                seen = assign(x, bc.value, first, second, upper, lower)
                own = squared(x, np.array(bc.value.points, dtype=x.dtype)[first])
                cols = [part.column(0), part.column(1), *map(pa.array, (first, second, upper, lower)),
                        pa.array(own.tolist(), pa.int64()), pa.array([seen] + [0] * (part.num_rows - 1), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "v", "first", "second", "upper", "lower", "distance", "seen"])

    return state.select("id", "v", "first", "second", "upper", "lower").mapInArrow(
        run, "id long, v array<long>, first int, second int, upper double, lower double, distance long, seen long")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(rows, centroids): per vector id, v, cluster (``first``), ``second``, squared ``distance`` and, in
    ``seen``, distances computed in the last pass (summed by batch, on the batch's first row)."""
    rows = written(whole_vectors(vectors, dims, scale, id_col, vector_col))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = rows.where("id IS NOT NULL").orderBy(mark, "id", "v").limit(k).select("v").collect()  # k vectors
    points = [list(r["v"]) for r in starts]
    if not points:
        if not rows.isEmpty():
            raise ValueError("no row with an id to start a centroid from")
        empty = rows.select("id", "v", *(F.lit(None).cast(t).alias(n) for n, t in
                            (("first", "int"), ("second", "int"), ("upper", "double"), ("lower", "double"), ("distance", "long"), ("seen", "long"))))
        return empty, []
    state = rows.select("id", "v", F.lit(0).alias("first"), F.lit(min(1, len(points) - 1)).alias("second"),
                        F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    moved = None
    for _ in range(rounds):
        state = written(_pass(state, Centres(points, moved)))
        sums = state.groupBy("first").agg(F.count("*").alias("n"), *(F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims))).collect()  # k rows
        new = list(points)
        for r in sums:
            new[r["first"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
        moved = [float(sum((a - b) ** 2 for a, b in zip(p, q))) ** .5 for p, q in zip(points, new)]
        points = new
    return written(_pass(state, Centres(points, moved))), points


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row a vector."""
    rows, points = cluster(vectors, **options)
    spark = vectors.sparkSession
    sums = {r["first"]: r["s"] for r in rows.groupBy("first").agg(F.sum("distance").alias("s")).collect()}  # k rows
    per = spark.createDataFrame([(c, sums[c], sha(",".join(map(str, points[c])))) for c in sums] if points else [],
                                "cluster int, cluster_inertia long, centroid_sha256 string")
    return rows.select(F.col("id").alias("vec_id"), F.col("first").alias("cluster"), "distance").join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("long").alias("inertia"), "centroid_sha256")

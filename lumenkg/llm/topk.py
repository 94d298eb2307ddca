"""Exact top-k by inner product with dual cover trees (operator 5).

The top of one cover tree, fitted on a bounded sample by farthest-first traversal, cuts the space into
cells; every vector goes to its nearest centre, and a cell keeps the true radius of what it covers.  A
cell beyond SHARD_ROWS rows is split into parts by hash, so no cell is too large for a task.

1. Every query searches the cell that promises most, in all its parts; its k-th best score there is a
   threshold.
2. A query goes on only to cells that may hold a score as high: by <q, c> + |q| s for a cell with centre
   c and radius s.

A task takes a part of a cell and a block of queries, indexes both by cover trees and walks pairs of
nodes.  For a query node (centre p, radius r) and a data node (centre c, radius s) no inner product
exceeds <p,c> + |p| s + |c| r + r s; the pair is pruned when that is below the worst k-th score of the
node's queries, which starts at their thresholds.  At a leaf pair each query is held to its own bound
once more.  Only pruned pairs are skipped, and ties at the k-th score are walked, so results are exact.

Trees are built level by level by farthest-first traversal: centres of a level are at least as far apart
as its covering radius, and each node keeps the true radius of what it covers.  A node that a split would
hardly shrink stays a leaf, whose scores are one matrix product.  Of equal vectors in a
part only the k + 1 smallest ids can be in a result, so the rest are dropped before the tree.

The tasks' best k by query are merged by a ranked window.  Where vectors do not cluster, nothing can be
pruned and the work is queries x vectors by its nature.  Vectors that are null, empty, or hold a null or a
non-finite component take no part, nor do null ids; vectors of different lengths do not meet; rows
that repeat an id count once, with the smallest vector.  An empty table gives an empty result.  Numbers
too large for 64-bit sums are compared as Python integers; a score that a long can't hold raises an error.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARD_ROWS = 8192
QUERY_ROWS = 4096
FANOUT = 16
#: Rows of a leaf; up to WIDE of them where a split hardly shrinks the radius, as in vectors without clusters.
LEAF, WIDE, SHRINK = 64, 1024, 0.7
#: Vectors that the cells are fitted on, and cells at most.
SAMPLE, CELLS = 20_000, 1024
#: Below every number that Best holds.
NONE = np.iinfo(np.int64).min


class Node:
    __slots__ = ("rows", "centre", "radius", "norm", "children")

    def __init__(self, points, rows, centre, radius):
        self.rows, self.centre, self.radius, self.children = rows, points[centre], radius, []
        self.norm = float(np.sqrt(points[centre] @ points[centre]))


def farthest_first(points: np.ndarray, rows: np.ndarray, centre: int, most: int, until: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres among ``rows``, at most ``most`` and as long as a row is farther than ``until`` from them; each
    row's nearest centre and its distance."""
    def spread(c):
        d = points[rows] - points[c]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    best = spread(centre)
    centres, near = [centre], np.zeros(len(rows), dtype=np.int64)
    while len(centres) < most and best.max() > until:
        centres.append(int(rows[best.argmax()]))
        d = spread(centres[-1])
        closer = d < best
        near[closer], best[closer] = len(centres) - 1, d[closer]
    return centres, near, best


def cover_tree(points: np.ndarray) -> Node:
    """Tree over the rows of ``points`` (floats)."""
    rows = np.arange(len(points))
    d = points - points[0]
    root = Node(points, rows, 0, float(np.sqrt(np.einsum("ij,ij->i", d, d)).max()))
    todo = [(root, 0)]
    while todo:
        node, centre = todo.pop()
        if len(node.rows) <= LEAF or node.radius == 0:
            continue
        centres, near, dist = farthest_first(points, node.rows, centre, FANOUT, node.radius / 4)
        reach = np.zeros(len(centres))
        np.maximum.at(reach, near, dist)
        if len(node.rows) <= WIDE and reach[near].mean() > SHRINK * node.radius:
            continue
        for i, c in enumerate(centres):
            mine = near == i
            if mine.any():
                child = Node(points, node.rows[mine], c, float(dist[mine].max()))
                node.children.append(child)
                todo.append((child, c))
    return root


class Best:
    """The k best of every query as whole numbers score * n + (n - 1 - place of the id), so that higher
    scores and then smaller ids are larger numbers, and no two are equal.

    ``floor`` holds scores that each query has k of already: lower ones are of no use."""

    def __init__(self, own: np.ndarray, n: int, k: int, floor: np.ndarray, dtype=np.int64):
        self.own, self.n, self.k, self.dtype, self.scored = own, n, k, dtype, 0
        self.key = np.full((len(own), k), NONE if dtype is np.int64 else -(1 << 200), dtype=dtype)
        self.none = self.key.flat[0] if self.key.size else None
        self.floor = np.array([self.none if f is None else int(f) * n - 1 for f in floor], dtype=dtype)
        self.least = self.floor.copy()

    def worst(self, rows: np.ndarray) -> int:
        """The least k-th number of these queries."""
        return int(self.least[rows].min())

    def _top(self, keys: np.ndarray) -> np.ndarray:
        keys = np.partition(keys, keys.shape[1] - self.k, axis=1) if self.dtype is np.int64 else np.sort(keys, axis=1)
        return keys[:, -self.k:]

    def add(self, rows: np.ndarray, scores: np.ndarray, places: np.ndarray) -> None:
        self.scored += scores.size
        keys = scores.astype(self.dtype) * self.n + (self.n - 1 - places).astype(self.dtype)
        keys[self.own[rows][:, None] == places] = self.none
        hot = np.flatnonzero(keys.max(axis=1) > self.least[rows])
        if not len(hot):
            return
        rows, keys = rows[hot], keys[hot]
        if keys.shape[1] > self.k:
            keys = self._top(keys)
        both = self._top(np.hstack([self.key[rows], keys]))
        self.key[rows], self.least[rows] = both, np.maximum(both.min(axis=1), self.floor[rows])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, place, score) of all that were found."""
        row, at = np.nonzero(self.key > self.none)
        key = self.key[row, at]
        return row, (self.n - 1 - key % self.n).astype(np.int64), key // self.n


def dual_search(own, queries, points, k, floor) -> Best:
    """Walk pairs of nodes, the most promising first.

    ``queries`` and ``points`` (in order of their ids) hold whole numbers, as floats where those hold all sums
    and as Python integers else; ``own`` is each query's place among the points, or -1."""
    exact = np.int64 if queries.dtype == np.float64 else object
    best = Best(own, len(points), k, floor, exact)
    q_float, d_float = queries.astype(np.float64), points.astype(np.float64)
    q_norm = np.sqrt(np.einsum("ij,ij->i", q_float, q_float))
    q_root, d_root = cover_tree(q_float), cover_tree(d_float)
    slack = 1 + 1e-9

    def bound(q, d):
        return float(q.centre @ d.centre) + (q.norm * d.radius + d.norm * q.radius + q.radius * d.radius) * slack + q.norm * d.norm * 1e-12 + 1e-6

    todo = [(bound(q_root, d_root), q_root, d_root)]
    while todo:
        most, q, d = todo.pop()
        if (int(np.floor(most)) + 1) * best.n <= best.worst(q.rows):
            continue
        if not q.children and not d.children:
            each = (q_float[q.rows] @ d.centre + q_norm[q.rows] * (d.radius * slack + d.norm * 1e-12) + 1e-6).astype(np.float64)
            if exact is np.int64:
                rows = q.rows[(np.floor(each).astype(np.int64) + 1) * best.n > best.least[q.rows]]
            else:
                rows = q.rows[np.array([(int(np.floor(x)) + 1) * best.n > int(t) for x, t in zip(each, best.least[q.rows])], dtype=bool)]
            if len(rows):
                best.add(rows, queries[rows] @ points[d.rows].T, d.rows)
            continue
        pairs = [(a, b) for a in (q.children or [q]) for b in (d.children or [d])]
        todo += sorted(((bound(a, b), a, b) for a, b in pairs), key=lambda x: x[0])
    return best


def whole(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): usable vectors with components floor(scale * x), x as double."""
    v = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where((F.size(v) > 0) & usable)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v")))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def fit_cells(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Centres of the cells by the vectors' length, from at most SAMPLE vectors: those with the smallest hash
    of the id.  A length that the sample lacks has one cell, round zero."""
    drawn = rows.orderBy(F.xxhash64("id", F.lit("cells")), "id").limit(SAMPLE).select("v").toArrow()["v"]
    by: dict[int, list] = {}
    for v in drawn:
        by.setdefault(len(v), []).append(v.values.to_numpy(zero_copy_only=False))
    out = {}
    for dims, vs in by.items():
        points = np.array(vs, dtype=np.float64)
        most = min(CELLS, max(1, -(-n * len(vs) // (len(drawn) * SHARD_ROWS))))
        out[dims] = points[farthest_first(points, np.arange(len(points)), 0, most, 0.0)[0]]
    return out


def _in_cells(rows: DataFrame, centres) -> DataFrame:
    """(id, v, dims, cell, dist): each vector's cell and its distance from the centre."""
    def run(batches):
        for b in batches:
            size = b.column(1).value_lengths().to_numpy(zero_copy_only=False)
            cell, dist = np.zeros(len(size), dtype=np.int32), np.zeros(len(size))
            for dims in np.unique(size):
                at = np.flatnonzero(size == dims)
                x = _matrix(b.column(1).take(pa.array(at))).astype(np.float64)
                c = centres.value.get(int(dims), np.zeros((1, dims)))
                best = np.full(len(at), np.inf)
                for i in range(len(c)):
                    d = x - c[i]
                    d = np.sqrt(np.einsum("ij,ij->i", d, d))
                    closer = d < best
                    cell[at[closer]], best[closer] = i, d[closer]
                dist[at] = best
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size.astype(np.int32)), pa.array(cell), pa.array(dist)], names=["id", "v", "dims", "cell", "dist"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<long>, dims int, cell int, dist double")


def _routes(asked: DataFrame, centres, cells, first: bool) -> DataFrame:
    """(id, v, dims, cell, least): queries with the cells they go to.  First the most promising one; then
    all others whose bound reaches the query's k-th score ``least``."""
    def run(batches):
        for b in batches:
            row, cell, dims = [], [], []
            for i, (v, least) in enumerate(zip(b.column(1), b.column(2).to_pylist())):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                number, radius = cells.value[len(x)]
                c = centres.value.get(len(x), np.zeros((1, len(x))))[number]
                norm = float(np.sqrt(x @ x))
                dots = c @ x
                reach = dots + norm * radius * (1 + 1e-9) + norm * np.sqrt(np.einsum("ij,ij->i", c, c)) * 1e-12 + 1e-6
                best = int(dots.argmax())
                to = [best] if first else [j for j in range(len(number)) if j != best and (least is None or reach[j] >= least)]
                row += [i] * len(to)
                cell += number[to].tolist()
                dims += [len(x)] * len(to)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(dims, pa.int32()), pa.array(cell, pa.int32()), b.column(2).take(at)],
                                             names=["id", "v", "dims", "cell", "least"])

    return asked.select("id", "v", "least").mapInArrow(run, "id long, v array<long>, dims int, cell int, least long")


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def search_part(q: pa.Table, d: pa.Table, k: int) -> pa.Table:
    """The k best in one part of a cell for a block of queries; a row without a query holds the number of
    pairs that were scored."""
    if not q.num_rows or not d.num_rows:
        return FOUND.empty_table()
    query_ids, ids = q["id"].to_numpy(), d["id"].to_numpy()
    queries, points = _matrix(q["v"]), _matrix(d["v"])
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], points[order]
    _, inverse = np.unique(points, axis=0, return_inverse=True)
    by = np.argsort(inverse.ravel(), kind="stable")  # within a vector by id
    same = inverse.ravel()[by]
    place = np.arange(len(by)) - np.searchsorted(same, same)
    keep = np.sort(by[place <= k])
    ids, points = ids[keep], points[keep]
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(points).max(initial=0)) * points.shape[1]
    # sums that doubles hold, times the part's rows, that longs hold; else Python integers
    kind = np.float64 if most < 1 << 48 else object
    place = np.searchsorted(ids, query_ids)
    own = np.where(ids[np.minimum(place, len(ids) - 1)] == query_ids, place, -1)
    best = dual_search(own, queries.astype(kind), points.astype(kind), k, q["least"].to_pylist())
    row, at, score = best.result()
    return pa.table([pa.array([*query_ids[row].tolist(), None], pa.int64()), pa.array([*ids[at].tolist(), None], pa.int64()),
                     pa.array([*map(int, score), best.scored], pa.int64())], schema=FOUND)


def _searched(routes: DataFrame, data: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the queries' best in the cells that they were sent to."""
    routes = written(routes)
    # blocks of queries and parts of rows by cell: small tables, a row a cell
    blocks = routes.groupBy("dims", "cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    sizes = blocks.join(cells.select("dims", "cell", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("parts")), ["dims", "cell"])

    def hashed(count):
        return F.pmod(F.xxhash64("id"), F.col(count)).cast("int")

    def every(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    q = routes.join(F.broadcast(sizes), ["dims", "cell"]).select("id", "v", "least", "dims", "cell", hashed("blocks").alias("block"), "parts") \
        .select("id", "v", "least", "dims", "cell", "block", every("parts").alias("part"))
    d = data.join(F.broadcast(sizes), ["dims", "cell"]).select("id", "v", "dims", "cell", hashed("parts").alias("part"), "blocks") \
        .select("id", "v", "dims", "cell", every("blocks").alias("block"), "part")
    keys = ("dims", "cell", "part", "block")
    return written(q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(lambda a, b: search_part(a, b, k), "query_id long, vec_id long, score long"))


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> tuple[DataFrame, DataFrame]:
    """(results as of :func:`top_k`, one row (scored): the pairs whose score was computed)."""
    spark = vectors.sparkSession
    rows = written(whole(vectors, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v")))
    n = rows.count()
    centres = spark.sparkContext.broadcast(fit_cells(rows, n) if n else {})  # CELLS centres a length at most
    data = written(_in_cells(rows, centres))
    cells = data.groupBy("dims", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius"))
    by: dict[int, list] = {}
    for r in cells.orderBy("dims", "cell").collect():  # a row a cell
        by.setdefault(r["dims"], []).append((r["cell"], r["radius"]))
    shape = spark.sparkContext.broadcast({d: (np.array([c for c, _ in x]), np.array([r for _, r in x])) for d, x in by.items()})
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    def best(found):
        return found.where("query_id IS NOT NULL").withColumn("rank", rank).where(F.col("rank") <= k)

    asked = rows.where(is_query).withColumn("least", F.lit(None).cast("long"))
    near = _searched(_routes(asked, centres, shape, True), data, cells, k)
    least = best(near).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    rest = asked.drop("least").join(least, "id", "left")
    far = _searched(_routes(rest, centres, shape, False), data, cells, k)
    result = best(near.unionByName(far)).select("query_id", "rank", "vec_id", "score")
    work = near.unionByName(far).where("query_id IS NULL").agg(F.coalesce(F.sum("score"), F.lit(0)).alias("scored"))
    return result, work


def top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank from 1, vec_id, score long): for the rows where ``is_query`` (a condition on
    ``id``) holds, the k highest inner products with all other rows; all of them if there are fewer."""
    return search(vectors, is_query, k, id_col, vector_col, scale)[0]

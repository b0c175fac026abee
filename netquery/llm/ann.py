"""Nearest neighbours by inner product with stable projections and kd-trees.

A vector x gets one more component so that all have the largest norm, and a query
one of 0; then the largest inner product is the smallest distance. `DIMS` Gaussian
(2-stable) projections map distances d to projected distances whose square over
d squared follows the chi-square law with `DIMS` degrees. A kd-tree over projected
vectors cuts the table into cells, and every cell into leaves. A query visits
leaves by rising projected distance and verifies their vectors by the true inner
product, until the projected distance of the next leaf, squared, exceeds the
chi-square quantile of `CHANCE` times the squared distance of its k-th best so
far: a nearer vector still unseen is then less likely than 1 - CHANCE. It visits
cells in rounds, the nearest first; the k-th best so far decides which cells of the
next round it still visits, and what they may return.

The planes of the upper tree come from about `SAMPLE` projected vectors; every
vector is indexed. Of equal vectors only the k + 1 of smallest id can be among
any query's k nearest, so others leave the index without changing a result.

Defined results: rows with a null id, a null or zero vector, null or non-finite
components, or another length than the most frequent one take no part; rows that
repeat an id count once, with the smallest of their vectors (component by component);
lengths are taken after division by the largest component, so very large and very
small vectors take part, and a product beyond the range of a double is infinite, as in
double precision, while one that is not a number is not found; ties go to the smaller id;
fewer candidates than k are all returned; an empty table gives no rows; other columns play no part."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

DIMS = 8
CHANCE = 0.98
CELL, LEAF = 2048, 128       # vectors of a block in a cell, and of a leaf of its tree
CELLS = 16_384               # at most so many cells; larger ones hold several blocks
SAMPLE = 20_000
ROUNDS = (1, 4, 12)          # nearest cells that a query has visited after each round but the last
BLOCK = 256                  # queries that visit a block at once
MEET = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees."""
    cdf = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list<double> column of equal lengths."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def lengths(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(largest component, length after division by it) of every row: squares neither overflow nor vanish."""
    top = np.abs(x).max(1)
    y = x / top[:, None]
    return top, np.sqrt((y * y).sum(1))


class Projection:
    """Of vectors divided by `scale`, the largest component of all; `norm` is the largest length after that."""

    def __init__(self, dim: int, scale: float, norm: float, dims: int = DIMS, seed: int = 17):
        self.axes, self.scale, self.norm = np.random.default_rng(seed).standard_normal((dim + 1, dims)), scale, norm

    def rows(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest]) @ self.axes

    def queries(self, q: np.ndarray) -> np.ndarray:
        top, length = lengths(q)
        return (q / top[:, None] * (self.norm / length)[:, None]) @ self.axes[:-1]

    def distance2(self, score: float, q: np.ndarray) -> float:
        """Squared distance of the widened vectors with this inner product; of one that
        overflowed, so large that no search ends for it."""
        top, length = lengths(q[None, :])
        return 2 * self.norm ** 2 - 2 * self.norm / length[0] * (score / self.scale / top[0]) if np.isfinite(score) else math.inf


class Planes:
    """A kd-tree of cutting planes: leaves are numbered cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.axis, self.cut, self.below, self.above = [], [], [], []
        self.cells = 0
        self.root = self._grow(points, max(1, cells))

    def _grow(self, points: np.ndarray, cells: int) -> int:
        spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(1)
        if cells <= 1 or spread.max() <= 0:
            self.cells += 1
            return -self.cells
        axis = int(spread.argmax())
        cut = float(np.quantile(points[:, axis], (cells // 2) / cells))
        low = points[:, axis] <= cut
        if low.all():
            cut = float((points[:, axis].min() + points[:, axis].max()) / 2)
            low = points[:, axis] <= cut
        node = len(self.axis)
        self.axis.append(axis), self.cut.append(cut), self.below.append(0), self.above.append(0)
        self.below[node] = self._grow(points[low], cells // 2)
        self.above[node] = self._grow(points[~low], cells - cells // 2)
        return node

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), self.root)
        axis, cut, below, above = map(np.array, (self.axis, self.cut, self.below, self.above))
        while len(axis) and (at >= 0).any():
            i = np.flatnonzero(at >= 0)
            n = at[i]
            at[i] = np.where(points[i, axis[n]] <= cut[n], below[n], above[n])
        return -at - 1


def box_distance2(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of point q from boxes."""
    d = np.maximum(0, np.maximum(low - q, q - high))
    return (d * d).sum(1)


class Block:
    """A kd-tree over some projected vectors, and the incremental search in it."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, projection: Projection):
        p = projection.rows(x)
        order, bounds = np.arange(len(ids)), []
        todo = [(0, len(ids))]
        while todo:
            a, b = todo.pop()
            part = p[order[a:b]]
            if b - a <= LEAF or not np.ptp(part, axis=0).max() > 0:
                bounds.append((a, b))
                continue
            axis = int(np.ptp(part, axis=0).argmax())
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], half)]
            todo += [(a, a + half), (a + half, b)]
        bounds.sort()
        self.ids, self.x, self.p, self.bounds, self.projection = ids[order], x[order], p[order], bounds, projection
        self.low = np.array([self.p[a:b].min(0) for a, b in bounds])
        self.high = np.array([self.p[a:b].max(0) for a, b in bounds])

    def search(self, own: np.ndarray, q: np.ndarray, pq: np.ndarray, k: int, reach: float, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query (ids, scores) of the best k found that are not below `floor`,
        the k-th best score known before. All queries go to their next leaf together;
        a product of matrices finds what may enter, whose scores are then taken exactly."""
        near = np.array([box_distance2(p, self.low, self.high) for p in pq])
        order = np.argsort(near, axis=1, kind="stable")
        limit = lambda i, score: self.projection.distance2(score, q[i]) * (1 + 1e-9) + 1e-12
        kth = np.array([limit(i, f) if np.isfinite(f) else np.inf for i, f in enumerate(floor)])
        top, length = lengths(q)
        with np.errstate(over="ignore", invalid="ignore"):
            slack = 1e-9 * self.projection.norm * self.projection.scale * (top * length)         # what a product of matrices may differ by
        floor = floor.copy()
        out = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q]
        active = np.arange(len(q))
        for r in range(len(self.bounds)):
            leaf = order[active, r]
            active, leaf = (x[near[active, leaf] <= reach * kth[active]] for x in (active, leaf))
            for one in np.unique(leaf):
                rows = active[leaf == one]
                a, b = self.bounds[one]
                hit, at = np.nonzero(~(q[rows] @ self.x[a:b].T < (floor[rows] - slack[rows])[:, None]))
                exact = (self.x[a:b][at] * q[rows][hit]).sum(1)
                cuts = np.searchsorted(hit, np.arange(len(rows) + 1))
                for j, i in enumerate(rows.tolist()):
                    some = slice(cuts[j], cuts[j + 1])
                    ids, scores = self.ids[a:b][at[some]], exact[some]
                    keep = (ids != own[i]) & (scores >= floor[i])
                    if not keep.any():
                        continue
                    ids, scores = np.concatenate([out[i][0], ids[keep]]), np.concatenate([out[i][1], scores[keep]])
                    if len(ids) >= k:
                        keep = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[keep], scores[keep]
                        floor[i] = scores[-1]
                        kth[i] = limit(i, floor[i])
                    out[i] = ids, scores
        return out


def _search(shared, k: int):
    """Rows (block of a cell, block of queries) to the neighbours found there."""
    def run(batches):
        projection, reach = shared.value
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.array(r["ids"], np.int64)
                block = Block(ids, np.frombuffer(r["vectors"]).reshape(len(ids), -1), projection)
                q = np.array([x["v"] for x in r["queries"]])
                own = np.array([x["query_id"] for x in r["queries"]])
                found = block.search(own, q, projection.queries(q), k, reach, np.array([-np.inf if x["floor"] is None else x["floor"] for x in r["queries"]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])),
                                                  pa.array(np.concatenate([f[1] for f in found]))], ["query_id", "vec_id", "score"])
    return run


def _visit(blocks: DataFrame, visits: DataFrame, shared, k: int) -> DataFrame:
    """Neighbours from every (query, cell) of `visits` (cell, query_id, v, floor)."""
    place = F.row_number().over(W.partitionBy("cell").orderBy("query_id"))
    groups = (visits.withColumn("g", F.floor((place - 1) / BLOCK)).groupBy("cell", "g")
              .agg(F.collect_list(F.struct("query_id", "v", "floor")).alias("queries")))           # at most BLOCK each
    return blocks.join(groups, "cell").select("ids", "vectors", "queries").mapInArrow(_search(shared, k), MEET)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): the rows that take part, vectors as doubles."""
    v = F.col("v")
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(rows: DataFrame, queries, key: str = "vec_id", vector: str = "embedding", k: int = 20, chance: float = CHANCE,
            cell: int = CELL, seed: int = 17) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every usable row where
    `queries` (a condition on vec_id) holds, among all other usable rows."""
    spark = rows.sparkSession
    rows = written(usable(rows, key, vector), "vectors")
    largest = F.array_max(F.transform("v", F.abs))
    top = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("scale")).orderBy(F.col("n").desc(), "dim").first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == top.dim)
    norm = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / top.scale) * (x / top.scale)))).first()[0] ** 0.5
    projection = Projection(top.dim, top.scale, norm, seed=seed)
    # equal vectors: the k + 1 smallest ids
    some = rows.withColumn("copy", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("copy") <= k + 1).drop("copy")
    some = written(some, "candidates")
    n = some.count()
    cells = min(CELLS, -(-n // cell))
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    points = some.where(draw < int((1 << 30) * min(1.0, SAMPLE / max(1, n)))).toPandas()        # about SAMPLE rows
    planes = Planes(projection.rows(np.stack(points["v"].to_numpy())), cells)
    shared = spark.sparkContext.broadcast((projection, planes))

    def placed(batches):
        p, t = shared.value
        for b in batches:
            x = matrix(b.column(1))
            if len(x):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(t.cell_of(p.rows(x)))], ["vec_id", "v", "cell"])

    def blocks_of(pdf):
        import pandas as pd
        x = np.stack(pdf["v"].to_numpy())
        p = shared.value[0].rows(x)
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "ids": [pdf["vec_id"].to_numpy()], "vectors": [x.tobytes()], "low": [p.min(0)], "high": [p.max(0)]})
    inside = F.floor((F.row_number().over(W.partitionBy("cell").orderBy(F.xxhash64("vec_id"), "vec_id")) - 1) / cell)
    cut = some.mapInArrow(placed, "vec_id long, v array<double>, cell long").withColumn("block", inside)
    blocks = written(cut.groupBy("cell", "block").applyInPandas(blocks_of, "cell long, ids array<long>, vectors binary, low array<double>, high array<double>"), "blocks")

    asked = written(rows.where(queries).withColumnRenamed("vec_id", "query_id"), "queries")
    reach = chi_square_quantile(chance, DIMS)
    first = spark.sparkContext.broadcast((projection, reach))
    boxes = blocks.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x")).groupBy("cell", "i").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high")).toPandas()
    boxes = boxes.sort_values(["cell", "i"])                      # at most CELLS boxes
    number = boxes["cell"].to_numpy()[::DIMS]
    edges = spark.sparkContext.broadcast((projection, reach, number, boxes["low"].to_numpy().reshape(-1, DIMS), boxes["high"].to_numpy().reshape(-1, DIMS)))

    def visits_of(begin: int, end: int):
        """(query, cell) of the begin-th to the (end - 1)-th nearest cells that may still hold a nearer vector."""
        def run(batches):
            p, r, cell_no, low, high = edges.value
            for b in batches:
                x = matrix(b.column(1))
                if not len(x):
                    continue
                pq, kth = p.queries(x), b.column(2).to_pylist()
                to = []
                for i in range(len(x)):
                    d = box_distance2(pq[i], low, high)
                    near = np.argsort(d, kind="stable")[begin:end]
                    limit = math.inf if kth[i] is None else float(p.distance2(kth[i], x[i])) * (1 + 1e-9) + 1e-12
                    to.append(cell_no[near[d[near] <= r * limit]])
                rows = b.take(pa.array(np.repeat(np.arange(len(x)), [len(t) for t in to])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(to)), *rows.columns], ["cell", "query_id", "v", "floor"])
        return run
    found, begin = None, 0
    for end in (*ROUNDS, len(number)):
        if begin >= len(number):
            break
        known = asked.withColumn("floor", F.lit(None).cast("double"))
        if found is not None:
            kth = found.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).drop("n")
            known = asked.join(kth, "query_id", "left").select("query_id", "v", "floor")
        visits = known.mapInArrow(visits_of(begin, end), "cell long, query_id long, v array<double>, floor double")
        more = _visit(blocks, visits, first, k)
        found = written(_best(more if found is None else found.unionByName(more), k).drop("rank"), "found")
        begin = end
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def op8_nearest_neighbours(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return nearest(rows, F.col("vec_id") % 20 == 0)

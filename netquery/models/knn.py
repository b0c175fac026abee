"""ML12: exact k-nearest-neighbour classification by pivot cells.

Every train row belongs to the cell of its nearest pivot (at most `PIVOTS` train
rows, the smallest by hash of their keys). A test row first meets the nearest cells
that hold k rows together; its k-th distance there bounds the search, and it goes on
only to cells that the triangle inequality and the bisecting planes between pivots
leave. Cells and their visitors meet by a cogroup on (cell, block, group), whose
parts hold at most `block_rows` train rows and `visit_rows` visits; each visit
returns its k best of a block, and a window by test row merges them. Only pivots
and one row of figures for each cell pass through the driver.

Defined results: rows without vector take no part; ties go to the smaller train
key; fewer train rows than k are all returned; without train rows there are no
neighbours; rows that repeat a train key are neighbours of their own."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

PIVOTS = 1024
AT_ONCE = 8192               # visits that a task holds at once, and those of one row more
SLACK = 1 + 1e-9             # distances are compared with this margin, so rounding loses no neighbour


def distances(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - x) ** 2).sum(axis=1))            # differences first: exact for large coordinates too


class Cells:
    """The train rows by nearest pivot: `rows` (cell, far, turn, __k, __v, __y) and,
    for each cell, its number of rows and the least and largest distance from the pivot."""

    def __init__(self, train: DataFrame, key: str, vec: str, label: str, cell_rows: int):
        ensure_checkpoint_dir(train.sparkSession)
        base = train.where(F.col(vec).isNotNull()).select(F.col(key).alias("__k"), F.col(vec).cast("array<double>").alias("__v"), F.col(label).alias("__y"))
        some = base.orderBy(F.xxhash64("__k"), "__k").select("__v").limit(max(1, min(PIVOTS, math.ceil(base.count() / cell_rows)))).collect()
        self.pivots = np.unique(np.array([r["__v"] for r in some], dtype="float64"), axis=0) if some else np.zeros((0, 1))
        self.shared = train.sparkSession.sparkContext.broadcast(self.pivots)
        self.rows = base.mapInPandas(_placed(self.shared), T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType()), T.StructField("turn", T.LongType()),
                                                                         *base.schema.fields])).checkpoint(eager=True)
        self.size, self.least, self.most = np.zeros(len(self.pivots), "int64"), np.full(len(self.pivots), np.inf), np.full(len(self.pivots), -np.inf)
        for r in self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("a"), F.max("far").alias("b")).collect():        # a row for each cell
            self.size[r["cell"]], self.least[r["cell"]], self.most[r["cell"]] = r["n"], r["a"], r["b"]

    def visits(self, test: DataFrame, k: int, first: bool) -> DataFrame:
        """(cell, turn, test_key, v, bound): first the nearest cells that hold k rows together;
        then, with each row's `bound`, all others that may hold a row no farther away."""
        between = np.array([distances(p, self.pivots) for p in self.pivots])
        shared = test.sparkSession.sparkContext.broadcast((self.pivots, self.size, self.least, self.most, between))
        schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("turn", T.LongType()), *test.schema.fields])
        return test.mapInPandas(_visits(shared, k, first), schema)


def _placed(shared):
    def run(batches):
        turn = 0
        for pdf in batches:
            cell, far = np.zeros(len(pdf), "int32"), np.zeros(len(pdf))
            for i, v in enumerate(pdf["__v"]):
                d = distances(np.asarray(v), shared.value)
                cell[i] = d.argmin()
                far[i] = d[cell[i]]
            yield pd.DataFrame({"cell": cell, "far": far, "turn": np.arange(turn, turn + len(pdf)), **{c: pdf[c] for c in pdf.columns}})
            turn += len(pdf)
    return run


def near_cells(d: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """The nearest cells, by distance d from their pivots, that hold k rows together."""
    order = np.argsort(d, kind="stable")
    return order[:int(np.searchsorted(np.cumsum(size[order]), k)) + 1]


def open_cells(d: np.ndarray, bound: float, size: np.ndarray, least: np.ndarray, most: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Cells that may hold a row within `bound` of a point at distances d from the pivots."""
    home = int(d.argmin())
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(between[home] > 0, (d ** 2 - d[home] ** 2) / (2 * between[home]), 0)      # distance from the bisecting plane
    slack = (SLACK - 1) * (d + np.where(size > 0, most, 0) + d[home])
    return np.flatnonzero((size > 0) & (np.maximum(d - most, least - d) <= bound + slack) & (plane <= bound + slack * (1 + d / np.maximum(between[home], 1e-300))))


def _visits(shared, k: int, first: bool, at_once: int = AT_ONCE):
    def run(batches):
        pivots, size, least, most, between = shared.value
        turn = 0

        def out(pdf, to):
            nonlocal turn
            n = [len(t) for t in to]
            rows = pdf.loc[np.repeat(pdf.index, n)].reset_index(drop=True)
            rows.insert(0, "cell", np.concatenate(to).astype("int32") if to else np.zeros(0, "int32"))
            rows.insert(1, "turn", np.arange(turn, turn + len(rows)))
            turn += len(rows)
            return rows
        for pdf in batches:
            to, held, start = [], 0, 0
            for i, (v, bound) in enumerate(zip(pdf["v"], pdf["bound"])):
                d = distances(np.asarray(v), pivots)
                near = near_cells(d, size, k)
                to.append(near if first else np.setdiff1d(open_cells(d, bound, size, least, most, between), near))
                held += len(to[-1])
                if held >= at_once:
                    yield out(pdf.iloc[start:i + 1], to)
                    to, held, start = [], 0, i + 1
            yield out(pdf.iloc[start:], to)
    return run


def _meet(k: int):
    """The k best rows of a block for each of its visits, none beyond the visit's bound."""
    def run(block, visits):
        if block.empty or visits.empty:
            return pd.DataFrame({"test_key": visits["test_key"][:0], "train_key": block["__k"][:0], "dist": np.zeros(0), "train_label": block["__y"][:0]})
        keys, x, y = np.array(block["__k"].tolist()), np.stack(block["__v"].to_numpy()), block["__y"].to_numpy()
        kk, to, at, far = min(k, len(keys)), [], [], []
        for i, (v, bound) in enumerate(zip(visits["v"], visits["bound"])):
            d = distances(np.asarray(v), x)
            near = np.flatnonzero(d <= min(np.partition(d, kk - 1)[kk - 1], bound))
            best = near[np.lexsort((keys[near], d[near]))[:kk]]
            to.append(np.full(len(best), i)), at.append(best), far.append(d[best])
        to, at = np.concatenate(to), np.concatenate(at)
        return pd.DataFrame({"test_key": visits["test_key"].to_numpy()[to], "train_key": block["__k"].to_numpy()[at], "dist": np.concatenate(far), "train_label": y[at]})
    return run


def _found(cells: Cells, visits: DataFrame, k: int, block_rows: int, visit_rows: int, schema) -> DataFrame:
    spark, part = visits.sparkSession, ["cell", "block", "g"]
    figures = [(r["cell"], math.ceil(int(cells.size[r["cell"]]) / block_rows), math.ceil(r["count"] / visit_rows)) for r in visits.groupBy("cell").count().collect()]
    parts = F.broadcast(spark.createDataFrame(figures, "cell int, blocks int, groups int"))        # at most PIVOTS rows
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod("turn", F.col(n)).cast("int")
    blocks = cells.rows.join(parts, "cell").select("cell", own("blocks").alias("block"), each("groups").alias("g"), "__k", "__v", "__y")
    guests = visits.join(parts, "cell").select("cell", each("blocks").alias("block"), own("groups").alias("g"), "test_key", "v", "bound")
    return blocks.groupBy(*part).cogroup(guests.groupBy(*part)).applyInPandas(_meet(k), schema)


def knn_neighbours(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int = 5, cell_rows: int = 1024,
                   block_rows: int = 4096, visit_rows: int = 4096) -> DataFrame:
    """(test_key, train_key, dist, train_label, rank): the k nearest train rows of
    every test row (Euclidean; ties by train key)."""
    schema = T.StructType([T.StructField("test_key", test.schema[key].dataType), T.StructField("train_key", train.schema[key].dataType),
                           T.StructField("dist", T.DoubleType()), T.StructField("train_label", train.schema[label].dataType)])
    w = Window.partitionBy("test_key").orderBy("dist", "train_key")
    best = lambda found: found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    cells = Cells(train, key, vec, label, cell_rows)
    if not len(cells.pivots):
        return best(train.sparkSession.createDataFrame([], schema))
    asked = test.where(F.col(vec).isNotNull()).select(F.col(key).alias("test_key"), F.col(vec).cast("array<double>").alias("v"))
    everywhere = asked.withColumn("bound", F.lit(math.inf))
    home = best(_found(cells, cells.visits(everywhere, k, True), k, block_rows, visit_rows, schema)).drop("rank").checkpoint(eager=True)
    known = home.groupBy("test_key").agg(F.max("dist").alias("bound"))
    more = _found(cells, cells.visits(asked.join(known, "test_key"), k, False), k, block_rows, visit_rows, schema)
    return best(home.unionByName(more))


def knn_predict(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int = 5, **parts) -> DataFrame:
    """Majority vote of the k neighbours (binary 0/1 label); ties go to class 0."""
    nb = knn_neighbours(train, test, key, vec, label, k, **parts)
    return nb.groupBy("test_key").agg(F.sum(F.col("train_label").cast("long")).alias("n_pos"),
                                      F.count(F.lit(1)).alias("n")).select(
        F.col("test_key").alias(key), "n_pos", (F.col("n_pos") * 2 > F.col("n")).cast("int").alias("prediction"))

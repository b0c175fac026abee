"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


CHUNK = 1 << 19         # links that a task looks at together


def _forest(batches):
    """Of (a, b) rows, taken CHUNK at a time, those that join what is not joined yet."""
    def kept(held):
        a, b = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = list(range(len(nodes)))
        keep = []
        for i, (x, y) in enumerate(zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True)):
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[max(x, y)] = min(x, y)
                keep.append(i)
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])
    held, n = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        n += batch.num_rows
        if n >= CHUNK:
            yield kept(held)
            held, n = [], 0
    if n:
        yield kept(held)


def spanning(links: DataFrame, by: str) -> DataFrame:
    """Links (a, b) that connect what all `links` connect. Those of one group of nodes, which share a value of `by`, meet in
    a task, which keeps a forest of them: fewer links than the group has nodes, and not their square."""
    return links.repartition(by).select("a", "b").mapInArrow(_forest, "a long, b long")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each node of `links` reaches. Labels
    go to neighbours as minima, then jump to their own label's label, so chains
    shorten by halves; every round is a written table."""
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = written(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))), "links")
    labels = written(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("m"))
        step = labels.join(near, "node").select("node", F.least("label", "m").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = written(step.join(jump, "next").select("node", F.least("next", "far").alias("label"), F.col("label").alias("was")), "labels")
        labels = new.select("node", "label")
        if not new.where("label <> was").limit(1).count():
            return labels

"""Quality by a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Learned
filters slide over the embedded bytes of a chunk; every filter's largest and mean
response go through a small hidden layer to a chunk score, and a text's largest
and mean chunk scores are combined into one probability. Chunks at the border of
two others see the same bytes twice, so nothing is cut out of sight.

The network is fitted on the driver by Adam on at most `TRAIN_ROWS` labelled rows of
each class (those of the smallest hashed ids with texts up to `TRAIN_CHARS`
characters), and the bias is set to the labels' own odds afterwards. Scoring
reads every whole text.

Defined results: null and empty texts are one chunk of padding and get its score;
a null id counts as the empty text for the split and has no label; of several
labels for an id the largest counts; without labels of both classes the score is
the share of label 1 (0.5 without labels); an empty table gives no rows; other
columns play no part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_split, text_bytes, text_slices

CHUNK, STEP = 256, 192          # bytes of a chunk, and from one chunk to the next
WIDTH, STRIDE = 8, 4            # of a filter
EMBED, FILTERS, HIDDEN = 4, 24, 16
TRAIN_ROWS, TRAIN_CHARS = 1000, 12_000
EPOCHS, BATCH, RATE = 14, 24, 4e-3
THRESHOLD = 0.5
PLACES = (CHUNK - WIDTH) // STRIDE + 1


def chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes, first chunk of every text + total); the last chunk of a text is padded with 0."""
    size = np.diff(off)
    n = 1 + np.maximum(0, -(-(size - CHUNK) // STEP))
    first = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(size)), n)
    start = off[text] + (np.arange(first[-1]) - first[text]) * STEP
    at = start[:, None] + np.arange(CHUNK)
    inside = at < off[text + 1][:, None]
    padded = np.concatenate([data, np.zeros(1, np.uint8)])
    return np.where(inside, padded[np.where(inside, at, len(data))], 0).astype(np.uint8), first


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *shape: (r.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)
        self.p = {"embed": r.standard_normal((256, EMBED)).astype(np.float32) * 0.5, "conv": f(WIDTH * EMBED, FILTERS), "conv_b": np.zeros(FILTERS, np.float32),
                  "hidden": f(2 * FILTERS, HIDDEN), "hidden_b": np.zeros(HIDDEN, np.float32), "out": f(HIDDEN, 1)[:, 0], "out_b": np.zeros(1, np.float32),
                  "mix": np.array([1.0, 0.2], np.float32), "mix_b": np.zeros(1, np.float32)}
        self.p["embed"][0] = 0
        self.shift = 0.0

    def _convolved(self, x: np.ndarray):
        """(windows, responses) of chunks x."""
        e = self.p["embed"][x]
        s = e.strides
        w = np.lib.stride_tricks.as_strided(e, (len(x), PLACES, WIDTH * EMBED), (s[0], STRIDE * s[1], s[2]))
        w = np.ascontiguousarray(w).reshape(-1, WIDTH * EMBED)
        a = np.maximum(w @ self.p["conv"] + self.p["conv_b"], 0).reshape(len(x), PLACES, FILTERS)
        return w, a

    def chunk_scores(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.float32)
        for i in range(0, len(x), 512):           # bounds the work arrays
            _, a = self._convolved(x[i:i + 512])
            pooled = np.concatenate([a.max(1), a.mean(1)], 1)
            out[i:i + 512] = np.maximum(pooled @ self.p["hidden"] + self.p["hidden_b"], 0) @ self.p["out"] + self.p["out_b"]
        return out

    def logits(self, u: np.ndarray, first: np.ndarray) -> np.ndarray:
        top = np.maximum.reduceat(u, first[:-1])
        mean = np.add.reduceat(u, first[:-1]) / np.diff(first)
        return top * self.p["mix"][0] + mean * self.p["mix"][1] + self.p["mix_b"][0] + self.shift

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        w, a = self._convolved(x)
        arg = a.argmax(1)
        pooled = np.concatenate([np.take_along_axis(a, arg[:, None, :], 1)[:, 0], a.mean(1)], 1)
        h = np.maximum(pooled @ p["hidden"] + p["hidden_b"], 0)
        u = h @ p["out"] + p["out_b"]
        z = self.logits(u, first)
        dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y).astype(np.float32) / len(y)
        size = np.diff(first)
        best = np.array([first[i] + u[first[i]:first[i + 1]].argmax() for i in range(len(y))])
        mean = np.add.reduceat(u, first[:-1]) / size
        g = {"mix": np.array([(dz * u[best]).sum(), (dz * mean).sum()], np.float32), "mix_b": dz.sum(keepdims=True)}
        du = np.repeat(dz * p["mix"][1] / size, size)
        du[best] += dz * p["mix"][0]
        g["out"], g["out_b"] = h.T @ du, du.sum(keepdims=True)
        dh = du[:, None] * p["out"] * (h > 0)
        g["hidden"], g["hidden_b"] = pooled.T @ dh, dh.sum(0)
        dp = dh @ p["hidden"].T
        da = np.broadcast_to(dp[:, None, FILTERS:] / PLACES, a.shape).copy()
        np.put_along_axis(da, arg[:, None, :], np.take_along_axis(da, arg[:, None, :], 1) + dp[:, None, :FILTERS], 1)
        da = (da * (a > 0)).reshape(-1, FILTERS)
        g["conv"], g["conv_b"] = w.T @ da, da.sum(0)
        dw = (da @ p["conv"].T).reshape(n, PLACES, WIDTH, EMBED)
        de = np.zeros((n, CHUNK, EMBED), np.float32)
        for j in range(WIDTH):
            de[:, j:j + STRIDE * (PLACES - 1) + 1:STRIDE] += dw[:, :, j]
        flat = x.reshape(-1)
        g["embed"] = np.stack([np.bincount(flat, de[..., k].reshape(-1), 256) for k in range(EMBED)], 1).astype(np.float32)
        g["embed"][0] = 0
        return g

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        t, rounds = 0, EPOCHS * -(-len(y) // BATCH)
        for _ in range(EPOCHS):
            order = r.permutation(len(y))
            for i in range(0, len(y), BATCH):
                some = order[i:i + BATCH]
                rows = np.concatenate([np.arange(first[j], first[j + 1]) for j in some])
                starts = np.concatenate([[0], np.cumsum(first[some + 1] - first[some])])
                g = self.gradients(x[rows], starts, y[some])
                t += 1
                rate = RATE * (0.05 + 0.95 * (1 + np.cos(np.pi * t / rounds)) / 2)
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, train) -> Network | float:
    """A network from labelled rows where `train` holds; the share of label 1 without both classes."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.max("quality").cast("int").alias("label")).where(train))
    n, good = lab.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or good in (0, n):
        return good / n if n else 0.5
    some = [lab.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS * 2) for c in (0, 1)]
    few = F.broadcast(some[0].unionByName(some[1]))                     # at most 4 * TRAIN_ROWS rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= TRAIN_CHARS).join(few, "doc_id")
    rows = [rows.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(TRAIN_ROWS) for c in (0, 1)]
    got = rows[0].unionByName(rows[1]).toPandas()
    y = got["label"].to_numpy(np.float32)
    if not 0 < y.sum() < len(y):
        return good / n
    # whole texts, and the first sentences of every third good one, so that a short text is no fault by itself
    short = [t.partition(".")[0][:100] + "." for t in got["text"][y == 1][::3]]
    y = np.concatenate([y, np.ones(len(short), np.float32)])
    data, off = text_bytes(pa.array([*got["text"], *short]))
    x, first = chunks(data, off)
    net = Network()
    net.fit(x, first, y)
    net.shift = float(np.log(good / (n - good)) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def score(docs: DataFrame, fitted, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    if isinstance(fitted, float):
        return docs.select("doc_id", F.lit(fitted).alias("score"))
    net = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        for b in text_slices(batches, "text", 1 << 20):
            x, first = chunks(*text_bytes(b.column(1)))
            z = net.value.logits(net.value.chunk_scores(x), first).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def op6_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    fitted = fit(docs, labels, crc_split("doc_id", 3) != 1)
    return (score(docs, fitted).select("doc_id", (crc_split("doc_id", 3) == 1).alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))

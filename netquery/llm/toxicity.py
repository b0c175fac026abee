"""Toxicity by class-conditional Kneser-Ney language models.

Two models, one of toxic and one of ordinary labelled texts, count words by the
texts they stand in (their contexts, as Kneser-Ney's lower orders do), take an
absolute discount off and give what it frees to one backoff distribution that both
share: in how many texts of the whole corpus a word stands. Expressions that at
most `DISCOUNT` labelled texts of a class have get their probability from the
backoff alone, so a rare word that only one class happens to have is no evidence.
A text's evidence is the length-normalised difference of its two log-likelihoods:
over the whole text, over its most toxic passage of `WINDOW` words and at its most
toxic word; all words count. Weights and a bias turn these into a probability;
they are fitted on labelled rows that the models have not counted. At most
`LABELLED_ROWS` labelled rows are learnt from; the backoff counts all texts.

Words are counted in Spark by their full 64-bit hash. Only words that bear evidence,
all of them words of the labelled rows, reach the driver and the tasks.

Defined results: null, empty and wordless texts have no evidence and get the
score of the bias alone; a null id counts as the empty text for the split and
has no label; of several labels for an id the largest counts; without labels of
both classes every score is 0; an empty table gives no rows; repeated rows are
scored alike; other columns play no part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_split, text_bytes, text_slices, word_hashes, written

WINDOW = 16
DISCOUNT = 4
THRESHOLD = 0.3
LABELLED_ROWS = 50_000        # at most so many labelled rows are learnt from
CALIBRATION_ROWS = 12_000     # about so many labelled rows fit the weights; the models count all others
FEATURES = ("whole", "passage", "peak")


def _tokens(b: pa.RecordBatch, text: int):
    """(hash of every word, first word of every text)."""
    h, _, first = word_hashes(*text_bytes(b.column(text)), kind="alnum")
    return h, first


def _texts_with(word: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, in how many texts it stands) of every distinct word."""
    order = np.lexsort((owner, word))
    w, o = word[order], owner[order]
    once = np.ones(len(w), bool)
    once[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    return np.unique(w[once], return_counts=True)


def _word_counts(by_class: bool):
    """(kind, word, n) of every slice of texts: kind 0 counts texts; by class, kinds 1 and 2."""
    def run(batches):
        for b in text_slices(batches, "text"):
            word, first = _tokens(b, 0)
            owner = np.repeat(np.arange(b.num_rows), np.diff(first))
            label = np.asarray(b.column(1), np.int64)[owner] if by_class else np.full(len(owner), -1)
            for c in (0, 1) if by_class else (-1,):
                w, n = _texts_with(word[label == c], owner[label == c])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), 1 + c, np.int32)), pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], ["kind", "word", "n"])
    return run


class KneserNey:
    """Evidence of a word: log P(word | toxic) - log P(word | ordinary). Where
    no class has more texts than the discount takes, both probabilities are the
    shared backoff and the evidence is 0, so only the other words are needed."""

    def __init__(self, word: np.ndarray, texts: np.ndarray, classes: np.ndarray, kinds: int, places: int, sure: tuple, total: int, words: int):
        rest = min(0.9, max(0.1, DISCOUNT * kinds / max(1, places)))        # what the discounts leave to the shared backoff, alike for both
        shared = (texts + 1.0) / (total + words)
        ordinary, toxic = (np.log((1 - rest) * np.maximum(classes[c] - DISCOUNT, 0) / max(1, sure[c]) + rest * shared) for c in (0, 1))
        h = word.astype(np.int64).view(np.uint64)
        order = np.argsort(h)
        self.words, self.evidence = h[order], (toxic - ordinary)[order].astype(np.float32)

    def of(self, h: np.ndarray) -> np.ndarray:
        """Evidence of words by their hashes; 0 of all that are not among `words`."""
        if not len(self.words):
            return np.zeros(len(h))
        h, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.evidence[at], 0).astype(np.float64)[back]

    def features(self, b: pa.RecordBatch, text: int) -> np.ndarray:
        """Evidence a word of every text: whole, of its most toxic passage, and at its most toxic word."""
        word, first = _tokens(b, text)
        e = self.of(word)
        run = np.concatenate([[0.0], np.cumsum(e)])
        out = np.zeros((len(first) - 1, 3))
        for i in range(len(first) - 1):
            lo, hi = first[i], first[i + 1]
            if hi > lo:
                w = min(WINDOW, hi - lo)
                out[i] = (run[hi] - run[lo]) / (hi - lo), (run[lo + w:hi + 1] - run[lo:hi + 1 - w]).max() / w, e[lo:hi].max()
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights and bias by Newton steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (p - y) + ridge * w
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, name: str, train, most: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, label) of documents that have a label `name` and meet `train`: all,
    or about `most` by the hash of their ids. So few labels are broadcast, and no text is shuffled."""
    lab = written(labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                  .agg(F.max(name).cast("int").alias("label")).where(train), "labels")
    share = min(1.0, most / max(1, lab.count()))
    lab = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * share)).limit(int(most * 1.1))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(lab), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, train):
    """(broadcast models, weights) from the labelled rows where `train` holds, with all
    texts as shared backoff; None without both classes."""
    spark = docs.sparkSession
    rows = written(labelled(docs, labels, "toxic", train).select("doc_id", "text", "label"), "labelled")
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or not toxic or toxic == n:
        return None
    # every fourth row, or fewer of many, for the weights
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(0.25, CALIBRATION_ROWS / n))
    counted = rows.where(~apart).select("text", "label")
    n_of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    words = written(docs.select("text").mapInArrow(_word_counts(False), "kind int, word long, n long")
                    .unionByName(counted.mapInArrow(_word_counts(True), "kind int, word long, n long"))
                    .groupBy("word").agg(n_of(0).alias("texts"), n_of(1).alias("ordinary"), n_of(2).alias("toxic")), "word-counts")
    over = lambda c: F.sum(F.greatest(F.col(c) - DISCOUNT, F.lit(0)))
    t = words.agg(F.sum("texts").alias("total"), F.sum(F.col("ordinary") + F.col("toxic")).alias("places"), over("ordinary").alias("o"), over("toxic").alias("t"),
                  (F.count_if(F.col("ordinary") > 0) + F.count_if(F.col("toxic") > 0)).alias("kinds"), F.count(F.lit(1)).alias("words")).first()
    some = words.where((F.col("ordinary") > DISCOUNT) | (F.col("toxic") > DISCOUNT)).toPandas()        # words of the labelled rows
    model = spark.sparkContext.broadcast(KneserNey(some["word"].to_numpy(), some["texts"].to_numpy(), some[["ordinary", "toxic"]].to_numpy().T,
                                                   t["kinds"], t["places"], (t["o"], t["t"]), t["total"], t["words"]))
    held = rows.where(apart).select("label", "text").mapInArrow(_feature_rows(model), "key int, whole double, passage double, peak double").toPandas()
    x, y = held[list(FEATURES)].to_numpy(), held["key"].to_numpy(float)
    if 0 < y.sum() < len(y):
        return model, fit_logistic(x, y)
    return model, np.array([0.0, 0.0, 1.0, np.log(toxic / (n - toxic))])


def _feature_rows(model):
    """(key, features) of rows (key, text)."""
    def run(batches):
        for b in text_slices(batches, "text"):
            f = model.value.features(b, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(f[:, i]) for i in range(f.shape[1]))], ["key", *FEATURES])
    return run


def score(docs: DataFrame, fitted, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    if fitted is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    model, w = fitted
    kind = docs.schema["doc_id"].dataType.simpleString()
    f = docs.mapInArrow(_feature_rows(model), f"key {kind}, whole double, passage double, peak double")
    z = F.lit(float(w[-1]))
    for name, weight in zip(FEATURES, w, strict=False):
        z = z + F.col(name) * float(weight)
    return f.select(F.col("key").alias("doc_id"), (1 / (1 + F.exp(-z))).alias("score"))


def without_toxic(docs: DataFrame, fitted, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with all their columns and without a shuffle."""
    if fitted is None:
        return docs
    model, w = fitted
    limit = np.log(threshold / (1 - threshold))

    def run(batches):
        for b in text_slices(batches, text):
            z = model.value.features(b, b.schema.get_field_index(text)) @ w[:-1] + w[-1]
            yield b.filter(pa.array(z < limit))
    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    fitted = fit(docs, labels, crc_split("doc_id", 4) != 2)
    return (score(docs, fitted).select("doc_id", (crc_split("doc_id", 4) == 2).alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))

"""Lexical retrieval packing: documents that share rare terms share a window.

Documents become token ids once, in a written table. The document frequency of
every token id over the whole corpus gives the BM25 weights. The corpus is cut
into shards of at most `SHARD_DOCS` documents and `SHARD_TOKENS` ids as the
table's partitions hold them, and every shard has an inverted index of its own,
so packing needs no shuffle. Whole windows of a long document are sequences by
themselves. The longest unplaced rest is the seed of a window; its terms of most
weight are looked up in the index, and the best unused neighbours that fit are
laid behind it. The best one that does not fit is cut where the window ends, and
its rest is the next seed. So every window but a shard's last is full.

Defined results: a null or empty text is its end id alone; every row is a document
of its own, also if rows or ids repeat; a text longer than a window is cut; ties
go to the earlier row of the shard; an empty table gives no pieces; other columns
play no part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import text_slices, written
from .tokens import Ids, default_path

WINDOW = 2048
END = 1
SHARD_DOCS = 2048             # at most 65,536
SHARD_TOKENS = 1 << 22
TERMS = 32            # of a seed, by weight, that are looked up
NEIGHBOURS = 64       # retrieved at once
K1, B = 1.2, 0.75


def tokenised(docs: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(doc_id, ids) of every row; ids as bytes of unsigned 16-bit numbers, the end id last."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        ids, end = Ids(path), np.array([END], "<u2").tobytes()
        for b in text_slices(batches, "text", 16 << 20):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x + end for x in ids.encode_many(b.column(1).to_pylist())], pa.binary())], ["doc_id", "ids"])
    return docs.mapInArrow(run, f"doc_id {kind.simpleString()}, ids binary")


def _frequencies(batches):
    """(token, documents that have it) of a partition."""
    n = np.zeros(1 << 16, np.int64)
    rows = 0
    total = 0
    for b in batches:
        for x in b.column(0).to_pylist():
            ids = np.frombuffer(x, "<u2")
            n[ids] += 1                 # an id that repeats in the index counts once
            rows += 1
            total += len(ids)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(n[at], [rows, total]))], ["token", "n"])


class Shard:
    """Inverted BM25 index of some documents, and their packing."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW):
        self.docs, self.window = docs, window
        size = np.array([len(d) for d in docs])
        owner = np.repeat(np.arange(len(docs), dtype=np.uint32), size)
        key, tf = np.unique((owner << np.uint32(16)) | np.concatenate(docs).astype(np.uint32), return_counts=True)
        doc, term = (key >> np.uint32(16)).astype(np.int64), (key & np.uint32(0xFFFF)).astype(np.int64)
        w = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / mean))
        # the terms of most weight of every document
        order = np.lexsort((term, -w, doc))
        place = np.arange(len(order)) - np.searchsorted(doc, np.arange(len(docs)))[doc[order]]
        top = order[place < TERMS]
        self.query, self.query_at = term[top], np.searchsorted(doc[top], np.arange(len(docs) + 1))
        by_term = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[by_term], w[by_term]
        self.at = np.searchsorted(term[by_term], np.arange((1 << 16) + 1))

    def neighbours(self, seed: int, free: np.ndarray) -> np.ndarray:
        """Free documents that share a term with the seed, best first."""
        q = self.query[self.query_at[seed]:self.query_at[seed + 1]]
        lo, hi = self.at[q], self.at[q + 1]
        rows = np.concatenate([np.arange(a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]) if len(q) else np.zeros(0, int)
        score = np.bincount(self.doc[rows], self.weight[rows], len(self.docs))
        score[~free] = 0
        n = min(NEIGHBOURS, len(score))
        best = np.argpartition(-score, n - 1)[:n]
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))]

    def pack(self) -> list[list[tuple[int, int, int]]]:
        """Sequences of pieces (document, start, length)."""
        w = self.window
        size = np.array([len(d) for d in self.docs])
        out = [[(i, k * w, w)] for i in np.flatnonzero(size >= w).tolist() for k in range(size[i] // w)]
        start, rest = size // w * w, size % w
        free = rest > 0
        longest = np.argsort(-rest, kind="stable").tolist()
        at, seed = 0, -1
        while True:
            if seed < 0:
                while at < len(longest) and not free[longest[at]]:
                    at += 1
                if at == len(longest):
                    return out
                seed = longest[at]
            free[seed] = False
            pieces, room = [(seed, int(start[seed]), int(rest[seed]))], w - int(rest[seed])
            owner, seed = seed, -1
            found = self.neighbours(owner, free).tolist() if room else []
            for i in found:
                if rest[i] <= room:
                    pieces.append((i, int(start[i]), int(rest[i])))
                    free[i] = False
                    room -= int(rest[i])
                    if not room:
                        break
            more = (i for i in [*found, *longest[at:]] if free[i])
            while room and (i := next(more, -1)) >= 0:
                take = min(room, int(rest[i]))
                pieces.append((i, int(start[i]), take))
                room -= take
                if take < rest[i]:
                    start[i] += take
                    rest[i] -= take
                    seed = i
                else:
                    free[i] = False
            out.append(pieces)


def _pack(stats, key_type: pa.DataType, window: int, shard_docs: int, shard_tokens: int):
    schema = pa.schema([("doc_id", key_type), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def packed(keys, docs, first):
        idf, mean = stats.value
        cols = [[] for _ in schema]
        sequences = Shard(docs, idf, mean, window).pack()
        for s, pieces in enumerate(sequences):
            at = 0
            for i, start, length in pieces:
                for c, v in zip(cols, (keys[i], start, length, len(docs[i]), first + s, at, docs[i][start:start + length].astype("<u4").tobytes()), strict=True):
                    c.append(v)
                at += length
        return len(sequences), pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def run(batches):
        first = TaskContext.get().partitionId() << 40
        keys, docs, held = [], [], 0
        for b in batches:
            for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(x, "<u2")
                if docs and (len(docs) >= shard_docs or held + len(ids) > shard_tokens):
                    n, out = packed(keys, docs, first)
                    yield out
                    first += n
                    keys, docs, held = [], [], 0
                keys.append(key), docs.append(ids)
                held += len(ids)
        if docs:
            yield packed(keys, docs, first)[1]
    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW,
         shard_docs: int = SHARD_DOCS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (bytes of
    unsigned 32-bit numbers)."""
    spark = docs.sparkSession
    ids = written(tokenised(docs, key, text, path or default_path()), "token-ids")
    n = np.zeros(1 << 16, np.int64)
    rows = total = 0
    for r in ids.select("ids").mapInArrow(_frequencies, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():   # one row for each token id
        if r.token >= 0:
            n[r.token] = r.n
        elif r.token == -1:
            rows = r.n
        else:
            total = r.n
    idf = np.log(1 + (rows - n + 0.5) / (n + 0.5))
    stats = spark.sparkContext.broadcast((idf, total / max(1, rows)))
    kind = ids.schema["doc_id"].dataType
    return ids.mapInArrow(_pack(stats, to_arrow_type(kind), window, shard_docs, shard_tokens),
                          f"doc_id {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def op1_packing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

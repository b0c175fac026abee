"""Shared helpers: tables cut from their lineage, distributed ranks, and word
hashes of whole Arrow batches."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import scratch_path, ship_package

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder that the cluster names in spark.checkpoint.dir."""
    ship_package(spark)
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """`df` written once to the shared folder and read back: its lineage ends
    there, so a lost executor costs no recomputation of what came before."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """`name` = position (from 1) of each row in the total order `order`. Rows are
    range-partitioned, ranked inside their partition, and shifted by the
    partition sizes; only one (partition, count) row each reaches a broadcast."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    parts = written(df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id()), "rank")
    sizes = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    # at most n rows, one for each range partition
    before = sizes.select("__p", (F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1))).alias("__b"))
    inside = F.row_number().over(W.partitionBy("__p").orderBy(*order))
    return (parts.withColumn("__r", inside).join(F.broadcast(before), "__p")
            .select(*cols, (F.col("__r") + F.coalesce("__b", F.lit(0))).cast("long").alias(name)))


# ---- word hashes of Arrow text columns --------------------------------------

SEGMENT = 2 << 20          # bytes hashed at once; bounds the work arrays
_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INV):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@functools.lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def is_word_byte(kind: str) -> np.ndarray:
    """Table of 256 flags. "space": words are `[^\\x20\\x09-\\x0D]+`; "alnum":
    words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of lower-cased text (every
    byte of a non-ASCII character is a word byte, so bytes decide)."""
    t = np.ones(256, bool)
    if kind == "space":
        t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    else:
        t[0x00:0x30] = t[0x3A:0x61] = t[0x7B:0x80] = False
    return t


def lower_table(lower: bool = True) -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    return t


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    col = col.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def word_hashes(data: np.ndarray, off: np.ndarray, kind: str = "space",
                lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its start byte, first word of every text + total) for
    texts that lie one after the other in `data`, cut at `off`. Equal words have
    equal 64-bit hashes wherever they stand."""
    word, low, value = is_word_byte(kind), lower_table(lower), _byte_values()
    hs, ss = [], []
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + SEGMENT)
        if end < n:                       # a segment ends where a text begins or behind a separator
            k = np.searchsorted(off, end, "right") - 1
            if off[k] > at:
                end = int(off[k])
            else:
                while end < n and end < off[k + 1] and word[low[data[end - 1]]]:
                    step = data[end - 1:min(n, end + 4096)]
                    hit = np.flatnonzero(~word[low[step]])
                    end = end - 1 + int(hit[0]) + 1 if len(hit) else end - 1 + len(step)
                    if not len(hit) and end >= n:
                        break
                end = min(end, int(off[k + 1]))
        b = low[data[at:end]]
        w = np.empty(len(b) + 2, bool)
        w[0] = w[-1] = False
        w[1:-1] = word[b]
        first = np.zeros(len(b) + 1, bool)
        o = off[np.searchsorted(off, at):np.searchsorted(off, end, "right")] - at
        first[o[(o >= 0) & (o <= len(b))]] = True
        s = np.flatnonzero(w[1:-1] & (~w[:-2] | first[:-1]))
        e = np.flatnonzero(w[1:-1] & (~w[2:] | first[1:])) + 1
        size = max(SEGMENT, 1 << (len(b)).bit_length())
        up, down = _powers(size + 1)
        pre = np.empty(len(b) + 1, np.uint64)
        pre[0] = 0
        np.cumsum(value[b] * up[:len(b)], out=pre[1:])
        hs.append(mix((pre[e] - pre[s]) * down[s]))
        ss.append(s + at)
        at = end
    h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    s = np.concatenate(ss) if ss else np.zeros(0, np.int64)
    return h, s, np.searchsorted(s, off)


def hash_word(word: str) -> int:
    """The hash that `word_hashes` gives to one (already lower-cased) word."""
    b = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(b, np.array([0, len(b)]), "space", False)[0][0])


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from every position on (the last k - 1 positions are not windows)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    m = len(h) - k + 1
    x = np.zeros(m, np.uint64)
    for j in range(k):
        x = mix(x * np.uint64(_BASE) + h[j:j + m])
    return x


def text_slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` bytes of text (or one row)."""
    for b in batches:
        col = b.column(b.schema.get_field_index(text))
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64) if len(col) else np.zeros(0, np.int64)
        at, acc = 0, 0
        for i, x in enumerate(size.tolist()):
            if i > at and acc + x > limit:
                yield b.slice(at, i - at)
                at, acc = i, 0
            acc += x
        if b.num_rows > at:
            yield b.slice(at, b.num_rows - at)


# ---- a bounded filter of row ids --------------------------------------------

BITS = 1 << 25        # bits of a broadcast id filter: 4 MB whatever the table's size


def id_bits(ids: DataFrame, key: str = "doc_id") -> np.ndarray:
    """Flags of id mod BITS, packed into bytes: a filter without false negatives. At
    most BITS / 32768 rows reach the driver."""
    pos = F.pmod(F.col(key), F.lit(BITS)) + 1
    rows = (ids.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(pos).alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(pos)).alias("m")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        out[(r.k - 1) * 4096:r.k * 4096] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def with_bit(b: pa.RecordBatch, bits: np.ndarray, key: int = 0) -> pa.RecordBatch:
    """The rows of `b` whose id may be in the filter; rows with a null id are not."""
    ids = b.column(key)
    at = np.asarray(pc.fill_null(ids, 0), np.int64) % BITS
    keep = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return b.filter(pa.array(keep & ~np.asarray(pc.is_null(ids))))


def crc_split(key: str, parts: int):
    """crc32 of the id as text, mod `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts

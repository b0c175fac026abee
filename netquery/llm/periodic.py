"""Periodic runs of words: maximal stretches that repeat with a smallest period.

Scale tiles: every document is looked at once for each octave of periods [s, 2s).
A run of such a period q is a stretch of at least s places x where word x equals
word x + q, so it holds a multiple of s (a boundary) and a block of s / 2 words at a
multiple of s / 2 that stands again q words later. A hash comparison of these blocks
finds the boundaries that a run can hold; these, with s words before and 3 s behind,
are exploded into tiles, which overlap where boundaries follow each other, so that
each tile can be solved in another task. A tile is solved without the others: the
Z-function of the words from a boundary on tells for all periods at once how far
places match to the right, the Z-function of the reversed words how far to the left,
both s places at most. Periods whose block is itself a repetition are left to their
divisor. The matching intervals are fragments of runs; they are shuffled by document
and period and stitched where they touch.

The octave of the smallest periods is [1, 16), with a boundary at every 6 words:
runs have 12 words at least, so fewer than 6 matching places are none.

Defined results: a null or blank text has no words and no runs; a null id is kept as
it is (and counts as the empty text where ids are hashed); repeated rows come back as
often as they are there; an empty table gives no rows; other columns play no part. Of
runs of equal length the one that starts first is the greatest, then the one of the smaller period."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import _powers, mix, text_slices, written

LEAST = 12              # words of the shortest run
SLICE = 1 << 20         # bytes of text whose documents are looked at together
TILE = 4096             # words of the boundaries of one tile, where a single boundary does not take more


def octaves(longest: int) -> Iterator[tuple[int, int, int]]:
    """(step between boundaries, smallest period, largest period + 1) up to half of `longest` words."""
    yield LEAST // 2, 1, 16
    s = 16
    while 2 * s <= longest:
        yield s, s, 2 * s
        s *= 2


def _block_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` codes from every position on."""
    up, down = _powers(1 << (len(codes) + 1).bit_length())
    pre = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64)) * up[:len(codes)], out=pre[1:])
    m = len(codes) - size + 1
    return (pre[size:] - pre[:m]) * down[:m]


def boundaries(codes: np.ndarray, off: np.ndarray, step: int, lo: int, hi: int) -> np.ndarray:
    """Places (in `codes`) of the boundaries that a run of a period in [lo, hi) can hold. `codes` are the words of
    documents, one after the other, cut at `off`; no code stands in two documents."""
    size = step // 2
    n = np.diff(off)
    blocks = np.maximum(0, (n - size - lo) // size + 1)       # blocks that stand `lo` words later as well
    blocks[n < size + lo] = 0
    if not blocks.sum():
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(n)), blocks)
    at = (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * size
    h = _block_hashes(codes, size)
    pad = np.concatenate([h, np.zeros(hi + size, np.uint64)])
    later = np.lib.stride_tricks.sliding_window_view(pad, hi - lo)
    place = off[doc] + at
    hit = np.zeros(len(at), bool)
    rows = max(1, (1 << 20) // (hi - lo))                     # bounds the compared windows
    for i in range(0, len(at), rows):
        p = place[i:i + rows]
        hit[i:i + rows] = (later[p + lo] == h[p][:, None]).any(1)
    b = (at[hit] + size) // step * step                       # the boundary that a run with this block holds
    d = doc[hit]
    inside = b + lo < n[d]
    return np.unique(off[d[inside]] + b[inside])


def tiles(codes: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(document, step, its first boundary, number of boundaries, codes) of all tiles that a run can touch. The codes
    begin `step` words before the first boundary, or where the document does."""
    alive = np.arange(len(off) - 1)
    for step, lo, hi in octaves(int(np.diff(off).max(initial=0))):
        keep = np.diff(off) >= max(LEAST, 2 * lo)
        if not keep.all():                                    # shorter documents have no run of this octave
            codes = codes[np.repeat(keep, np.diff(off))]
            alive, off = alive[keep], np.concatenate([[0], np.cumsum(np.diff(off)[keep])])
        if not len(alive):
            return
        b = boundaries(codes, off, step, lo, hi)
        if not len(b):
            continue
        d = np.searchsorted(off, b, "right") - 1
        rel = b - off[d]
        many = max(1, TILE // step)
        new = np.flatnonzero((np.diff(b) != step) | (np.diff(d) != 0) | (np.diff(rel // (step * many)) != 0)) + 1
        for i, j in zip(np.concatenate([[0], new]).tolist(), np.concatenate([new, [len(b)]]).tolist(), strict=True):
            start = max(int(off[d[i]]), int(b[i]) - step)
            end = min(int(off[d[i] + 1]), int(b[j - 1]) + hi - 1 + step)
            yield int(alive[d[i]]), step, int(rel[i]), j - i, codes[start:end]


def z_function(s: list[int]) -> list[int]:
    """For every i, how many items from i on equal those from 0 on."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _periods(step: int) -> tuple[int, int]:
    return (1, 16) if step < 16 else (step, 2 * step)


def solve(codes: list[int], step: int, boundary: int, count: int) -> Iterator[tuple[int, int, int]]:
    """(period, first, end) of the matching intervals around the `count` boundaries of one tile from `boundary` on,
    in words of the document; those of one period that touch inside the tile are one."""
    lo, hi = _periods(step)
    place = max(0, boundary - step)
    open_: dict[int, list[int]] = {}
    for b in range(boundary - place, boundary - place + count * step, step):
        ahead = codes[b:b + hi - 1 + step]
        z = z_function(ahead)
        start = max(0, b - step)
        end = min(len(codes), b + hi - 1)
        back = codes[start:b][::-1]
        y = z_function([*back, -1, *codes[start:end][::-1]])
        powers = np.zeros(hi, bool)                           # periods whose block repeats a shorter one
        for p in range(1, min(hi // 2 + 1, len(z))):
            if z[p] >= p and not powers[p]:
                powers[2 * p:min(hi, p + z[p] + 1):p] = True
        for q in range(lo, min(hi, len(ahead))):
            right = min(z[q], step)
            if not right or powers[q]:
                continue
            left = y[len(back) + 1 + end - b - q]
            if right < step and left < step and right + left < max(q, LEAST - q):
                continue
            i, j = place + b - left, place + b + right
            now = open_.get(q)
            if now is None:
                open_[q] = [i, j]
            elif i <= now[1]:
                now[1] = max(now[1], j)
            else:
                yield q, *now
                open_[q] = [i, j]
    for q, (i, j) in open_.items():
        yield q, i, j


def _plain(key: int | None, words: list[bytes]) -> list[bytes]:
    return words


def cycled(key: int | None, words: list[bytes]) -> list[bytes]:
    """The registered query's edit: in one document of ten (by crc32 of its id), the words from a place on repeat with a period."""
    h = zlib.crc32(b"" if key is None else str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_FOUND = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("words", pa.string()),
                    ("step", pa.int64()), ("boundary", pa.int64()), ("count", pa.int64()), ("codes", pa.list_(pa.int32()))])


def _explode(edit: Callable[[int | None, list[bytes]], list[bytes]]):
    """A row for each document (with its words where it has tiles, else with their digest) and a row for each of its tiles."""
    def run(batches):
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for b in text_slices(batches, "text", SLICE):
            docs, sizes, codes = [], [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = edit(key, (text or "").encode().split())         # bytes split at the six ASCII white spaces alone
                seen: dict[bytes, int] = {}
                begun = len(codes)
                codes.extend([begun + seen.setdefault(w, len(seen)) for w in words])
                docs.append((key, words)), sizes.append(len(words))
            off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            found = list(tiles(np.array(codes, np.int64), off))
            tiled = {t[0] for t in found}
            joined = [b" ".join(words) for _, words in docs]
            none = pa.nulls(len(docs), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(range(row, row + len(docs)), pa.int64()), b.column(0), pa.array(sizes, pa.int64()),
                pa.array([None if i in tiled else hashlib.sha256(w).hexdigest() for i, w in enumerate(joined)], pa.string()),
                pa.array([w.decode() if i in tiled else None for i, w in enumerate(joined)], pa.string()), none, none, none,
                pa.nulls(len(docs), _FOUND.field("codes").type)], schema=_FOUND)
            at = 0
            while at < len(found):                                       # batches of at most SLICE codes, or one tile
                end, held = at, 0
                while end < len(found) and (end == at or held + len(found[end][4]) <= SLICE):
                    held += len(found[end][4])
                    end += 1
                some, at = found[at:end], end
                none, words = pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.string())
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(t[4]) for t in some)]), pa.int32()),
                                                 pa.array(np.concatenate([t[4] - off[t[0]] for t in some]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array([row + t[0] for t in some], pa.int64()), none, none, words, words,
                                                  *[pa.array([t[k] for t in some], pa.int64()) for k in (1, 2, 3)], lists], schema=_FOUND)
            row += len(docs)
    return run, "row long, doc_id long, n_words long, sha string, words string, step long, boundary long, count long, codes array<int>"


def _fragments(batches):
    """(row, period, first, end) of the matching intervals of each tile (row, step, boundary, count, codes)."""
    for b in batches:
        out = []
        for i in range(b.num_rows):                                      # one tile's codes at a time
            row, step, boundary, count, codes = (c[i].as_py() for c in b.columns)
            out.extend((row, *f) for f in solve(codes, step, boundary, count))
            if len(out) > 50_000 or i + 1 == b.num_rows and out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["row", "period", "first", "end"])
                out = []


def stitched(fragments: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs: intervals of a document and period that touch are one."""
    line = W.partitionBy("row", "period").orderBy("first", "end")
    reach = F.max("end").over(line.rowsBetween(W.unboundedPreceding, -1))
    parts = fragments.withColumn("new", F.when(F.col("first") <= reach, 0).otherwise(1))
    parts = parts.withColumn("part", F.sum("new").over(line.rowsBetween(W.unboundedPreceding, 0)))
    whole = parts.groupBy("row", "period", "part").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    length = F.col("end") - F.col("first") + F.col("period")
    runs = whole.select("row", F.col("first").alias("start"), length.alias("length"), "period")
    return runs.where((F.col("length") >= LEAST) & (F.col("length") >= 2 * F.col("period")))


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                     ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run (start, length, period) holds after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    drop = np.cumsum(edge[:-1]) > 0
    return [w for w, d in zip(words, drop.tolist(), strict=True) if not d]


def _finish(batches):
    """The result rows of (doc_id, n_words, words, runs)."""
    for b in text_slices(batches, "words", SLICE):
        rows = []
        for key, n, text, runs in zip(*(c.to_pylist() for c in b.columns), strict=True):
            runs = sorted((r["start"], r["length"], r["period"]) for r in runs or [])
            runs.sort(key=lambda r: (r[0], r[2]))
            words = collapsed((text or "").encode().split(), runs)
            start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
            rows.append((key, n, len(runs), start, length, period, length and 1000 * length // period,
                         hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Callable[[int | None, list[bytes]], list[bytes]] = _plain) -> DataFrame:
    """One row per input row: doc_id, n_words, n_runs, the greatest run (start, length, period, exponent_milli),
    and digests of all runs and of the text without the repeats. `edit` may change a document's words first."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = written(docs.mapInArrow(*_explode(edit)), "tiles")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the tiles of one document are dealt to all tasks; neighbours stay together where they are small
    dealt = (found.where("step IS NOT NULL").select("row", "step", "boundary", "count", "codes")
             .repartition(n, "row", "step", F.floor(F.col("boundary") / (8 * F.greatest(F.col("step"), F.lit(TILE))))))
    runs = stitched(dealt.mapInArrow(_fragments, "row long, period long, first long, end long"))
    lists = runs.groupBy("row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))   # fewer than the document's words
    schema = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")
    tiled = found.where("words IS NOT NULL").select("row", "doc_id", "n_words", "words").join(lists, "row", "left")
    tiled = tiled.select("doc_id", "n_words", "words", "runs").mapInArrow(_finish, schema)
    none = F.lit(None).cast("long")
    plain = found.where("sha IS NOT NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_runs"), *[none.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"), F.col("sha").alias("collapsed_sha256"))
    return plain.unionByName(tiled)


def op12_periodic_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return periodic_runs(docs, edit=cycled)

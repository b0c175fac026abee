"""Exact Jaccard join of documents' word shingles as a metric-space join.

Jaccard distance is a metric, so a pivot p and a bound r on the distance of
linked documents leave only near regions to compare. Whole documents as first
pivots tell nothing (unrelated texts all lie at distance 1 from them), so the
first pivots are single shingles: a document lies nearest to the pivots {s} of
its own shingles, ties go to the first in one global order (frequent shingles
last), and as a linked document can lack at most n - ceil(t n) of n shingles,
replicating every document to its first n - ceil(t n) + 1 pivots covers the
boundary. Each region is cut again around the empty set, from which a document
lies as far as it has shingles: linked sizes differ by a factor of t at most, so a
ring of that width and the ring below it as window hold every pair. Regions of a
few documents are compared at once. In larger ones documents become pivots: every member is measured against them, joins the region
of the nearest (home) and, by the triangle inequality, all regions whose pivot is
at most 2 r farther (window), and regions are joined in the same way again.
Members that are already connected need no further comparison. Regions whose
members all lie within 2 r of all pivots cannot be cut; what components they still
hold after the last level is compared in pairs of bounded blocks.

Equal shingle sets form one class from the start, and only classes are compared.
Shingles are 64-bit hashes.

Defined results: null, empty and blank texts have no shingles, are linked with
nothing and are their own component; a text of fewer words than a shingle has one
(its whole sequence); a row with a null id counts for no one and gets a null
component; repeated rows are members of one class; other columns play no part."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import id_bits, mix, shingles, text_bytes, text_slices, with_bit, word_hashes, written
from .graph import components, spanning

LEAF = 32             # regions of up to so many classes are compared at once
PIVOTS = 4            # documents as pivots in a larger region
BINS = 256            # of a set's sketch
BLOCK_CLASSES, BLOCK_HASHES = 512, 200_000   # of a block of classes that is compared within one task
LEVELS = 1            # levels of document pivots
SLICE = 4 << 20       # bytes of text whose shingles a task holds at once
COUNTED = 2 << 20     # shingles that the survey counts together
HOT_ENTRIES = 1 << 18  # bound of the broadcast list of frequent shingles


def text_sets(b: pa.RecordBatch, k: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, sorted distinct shingle hashes) of each row of (doc_id, text)."""
    data, off = text_bytes(b.column(1))
    h, _, first = word_hashes(data, off)
    sh = shingles(h, k)
    for i, key in enumerate(b.column(0).to_pylist()):
        lo, hi = int(first[i]), int(first[i + 1])
        if hi - lo >= k:
            yield key, np.unique(sh[lo:hi - k + 1])
        elif hi > lo:
            x = np.uint64(hi - lo)
            for v in h[lo:hi]:
                x = mix(np.array([x], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + v)[0]
            yield key, np.array([x], np.uint64)
        else:
            yield key, sh[:0]


def signature(s: np.ndarray) -> np.uint64:
    """Of a set of hashes; equal sets have equal signatures."""
    parts = np.array([np.bitwise_xor.reduce(mix(s)), mix(s * np.uint64(3)).sum(), len(s)], np.uint64)
    return mix(parts.sum(keepdims=True))[0] if len(s) else np.uint64(0)


def _rows(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if not isinstance(cols[f.name], pa.Array) else cols[f.name]
                                       for f in schema], schema=schema)


def _survey(k: int, often: int):
    """Pass 1: a row (doc_id, n, c) for each document, and a row (shingle, hits) for
    each shingle that at least `often` different sets of about COUNTED shingles have."""
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("shingle", pa.int64()), ("hits", pa.int64())])

    def counted(sets):
        v, m = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        v, m = v[m >= often], m[m >= often]
        none = pa.nulls(len(v), pa.int64())
        return _rows(out, doc_id=none, n=none, c=none, shingle=v.view(np.int64), hits=m.astype(np.int64))

    def run(batches):
        sets, held = {}, 0
        for b in text_slices(batches, "text", SLICE):
            keys, ns, cs = [], [], []
            for key, s in text_sets(b, k):
                sig = signature(s)
                keys.append(key), ns.append(len(s)), cs.append(sig)
                if len(s) and sig not in sets:
                    sets[sig] = s.copy()
                    held += len(s)
            yield _rows(out, doc_id=keys, n=ns, c=np.array(cs, np.uint64).view(np.int64), shingle=pa.nulls(len(keys), pa.int64()),
                        hits=pa.nulls(len(keys), pa.int64()))
            if held > COUNTED:
                yield counted(sets)
                sets, held = {}, 0
        if sets:
            yield counted(sets)
    return run, "doc_id long, n long, c long, shingle long, hits long"


def prefix_of(s: np.ndarray, hot: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(percent n / 100) + 1 of n shingles: those not in `hot` by hash, then hot ones by rank."""
    m = len(s) - (percent * len(s) + 99) // 100 + 1
    if not len(hot):
        return s[:m]
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    is_hot = hot[at] == s
    rare = s[~is_hot][:m]
    if len(rare) == m:
        return rare
    often, r = s[is_hot], rank[at[is_hot]]
    return np.concatenate([rare, often[np.argsort(r, kind="stable")][:m - len(rare)]])


def _regions(k: int, percent: int, hot_b):
    """Pass 2: (anchor, c, n) for every pivot shingle of every different set of a slice."""
    out = pa.schema([("anchor", pa.int64()), ("c", pa.int64()), ("n", pa.int64())])

    def run(batches):
        hot, rank = hot_b.value
        for b in text_slices(batches, "text", SLICE):
            seen, anchors, cs, ns = set(), [], [], []
            for key, s in text_sets(b, k):
                if key is None or not len(s) or (sig := int(signature(s))) in seen:
                    continue
                seen.add(sig)
                p = prefix_of(s, hot, rank, percent)
                anchors.append(p), cs.append(np.full(len(p), sig, np.uint64)), ns.append(np.full(len(p), len(s), np.int64))
            if anchors:
                yield _rows(out, anchor=np.concatenate(anchors).view(np.int64), c=np.concatenate(cs).view(np.int64), n=np.concatenate(ns))
    return run, "anchor long, c long, n long"


def _wanted_sets(k: int, bits_b):
    """Pass 3: (c, s, g) of the documents whose bit is set: the set, and how many of its hashes fall in each of BINS bins."""
    out = pa.schema([("c", pa.int64()), ("s", pa.list_(pa.int64())), ("g", pa.list_(pa.int32()))])

    def run(batches):
        bits = bits_b.value
        for b in text_slices(batches, "text", SLICE):
            b = with_bit(b, bits)
            cs, sets = [], []
            for _, s in text_sets(b, k):
                if len(s):
                    cs.append(signature(s)), sets.append(s)
            if cs:
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32()),
                                                 pa.array(np.concatenate(sets).view(np.int64)))
                bins = np.concatenate([np.bincount((s % np.uint64(BINS)).astype(np.int64), minlength=BINS) for s in sets]).astype(np.int32)
                yield _rows(out, c=np.array(cs, np.uint64).view(np.int64), s=lists, g=pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BINS, pa.int32()), pa.array(bins)))
    return run, "c long, s array<long>, g array<int>"


def _beside(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """`pairs` with the values of `column` of both classes as x and y. The smaller set travels to the larger."""
    swap = F.col("na") > F.col("nb")
    pairs = pairs.withColumn("ca", F.when(swap, F.col("b")).otherwise(F.col("a"))).withColumn("cb", F.when(swap, F.col("a")).otherwise(F.col("b")))
    return (pairs.join(sets.select(F.col("c").alias("ca"), F.col(column).alias("x")), "ca")
            .join(sets.select(F.col("c").alias("cb"), F.col(column).alias("y")), "cb"))


def _measure(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(`pairs` with `most`, linked pairs: of those of one region as many as connect what all connect). Sets hashed into bins share at least as much
    as the sets do, and the Jaccard distance of such multisets is a metric too, never
    above that of the sets. So `most`, the overlap of the bins, rules pairs out and
    measures pivots; only what may still be linked has its sets compared."""
    most = F.aggregate(F.zip_with("x", "y", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    near = written(_beside(pairs, sets, "g").select("a", "b", "na", "nb", "region", most.cast("long").alias("most")), name)
    enough = lambda c: F.col(c) * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    both = F.size(F.array_intersect("x", "y")).cast("long").alias("both")
    links = _beside(near.where(enough("most")), sets, "s").select("a", "b", "na", "nb", "region", both).where(enough("both"))
    return near, written(spanning(links, "region"), name + "-links")


def _size_fits(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair once, smaller class first, with the first region that has it."""
    swap = F.col("a") > F.col("b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                        F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"), "region").groupBy("a", "b", "na", "nb").agg(F.min("region").alias("region"))


def _leaf_pairs(regions: DataFrame, percent: int, leaf: int) -> DataFrame:
    """All pairs, at least one at home, of the regions of at most `leaf` classes, each with the first region that has it."""
    m = regions.where(F.col("k") <= leaf).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("c", "n", "home"))).alias("m"))
    pair = F.flatten(F.transform(F.sequence(F.lit(0), F.size("m") - 2), lambda i: F.transform(
        F.slice(F.col("m"), i + 2, F.size("m")), lambda y: F.struct(F.col("m")[i].alias("x"), y.alias("y")))))
    fits = lambda p: (p["x"]["home"] | p["y"]["home"]) & (F.least(p["x"]["n"], p["y"]["n"]) * 100 >= F.greatest(p["x"]["n"], p["y"]["n"]) * percent)
    p = m.where(F.size("m") > 1).select("key", F.explode(F.filter(pair, fits)).alias("p"))
    p = p.select("key", F.col("p.x.c").alias("a"), F.col("p.y.c").alias("b"), F.col("p.x.n").alias("na"), F.col("p.y.n").alias("nb"))
    return p.groupBy("a", "b", "na", "nb").agg(F.min("key").alias("region"))


def _rings(regions: DataFrame, percent: int) -> DataFrame:
    """Every region cut into rings by size: members at home in their own ring, and as window in the next."""
    ring = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100)) + 1e-9)
    both = F.explode(F.array(F.struct(ring.alias("ring"), F.lit(True).alias("home")), F.struct((ring + 1).alias("ring"), F.lit(False).alias("home")))).alias("x")
    r = regions.select("key", "c", "n", both).select(F.xxhash64("key", "x.ring").alias("key"), "c", "n", "x.home")
    return _counted(r).where("homes > 0")


def most_frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the highest counts, at most `most`: the limit on the count comes from
    a table of rows by eighths of their count's logarithm, a few hundred rows."""
    step = F.floor(F.log2(F.col(count).cast("double")) * 8 + 1e-9)
    room, least = most, None
    for r in sorted(rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.step):
        room -= r.n
        if room < 0:
            break
        least = r.step
    return rows.where(step >= least) if least is not None else rows.where("false")


def _counted(regions: DataFrame) -> DataFrame:
    """With the size of the region (k) and its members at home; regions of one class go."""
    key = W.partitionBy("key")
    return regions.withColumn("k", F.count(F.lit(1)).over(key)).withColumn("homes", F.count(F.when(F.col("home"), 1)).over(key)).where("k > 1")


def _blocks(big: DataFrame) -> DataFrame:
    """(group, block, c, n, label): the classes of the regions left, each once. Regions
    that share classes form a group; its classes, ordered by component and size, are
    cut into blocks of at most BLOCK_CLASSES classes and about BLOCK_HASHES hashes."""
    first = big.groupBy("key").agg(F.min("c").alias("a"))
    group = components(big.join(first, "key").select("a", F.col("c").alias("b")))
    m = big.select("c", "n", "label").distinct().join(group.select(F.col("node").alias("c"), F.col("label").alias("group")), "c")
    each = F.col("n") + BLOCK_HASHES // BLOCK_CLASSES
    line = F.sum(each).over(W.partitionBy("group").orderBy("label", "n", "c").rowsBetween(W.unboundedPreceding, -1))
    return m.withColumn("block", F.floor(F.coalesce(line, F.lit(0)) / BLOCK_HASHES))


def _links_in(percent: int):
    """Rows (members x, members y, same) to links that connect what is not yet connected."""
    def columns(rows: pa.Array):
        f = rows.flatten()
        c, label = (f[i].to_numpy() for i in (0, 2))
        s = f[3]
        off, values = s.offsets.to_numpy() - s.offsets[0].as_py(), s.flatten().to_numpy()
        sets = [values[off[i]:off[i + 1]] for i in range(len(c))]
        return c, label, sets, np.stack([np.bincount((v.view(np.uint64) % np.uint64(BINS)).astype(np.int64), minlength=BINS) for v in sets]).astype(np.int32)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cx, lx, sx, gx = columns(batch.column(0).slice(i, 1).flatten())
                same = batch.column(2)[i].as_py()
                cy, ly, sy, gy = (cx, lx, sx, gx) if same else columns(batch.column(1).slice(i, 1).flatten())
                nx, ny = gx.sum(1), gy.sum(1)
                root = {int(v): int(v) for v in (*lx, *ly)}
                out = []

                def find(v):
                    while root[v] != v:
                        root[v] = root[root[v]]
                        v = root[v]
                    return v
                for j in range(len(cx)):
                    first = j + 1 if same else 0
                    both = ny[first:] + nx[j]
                    fits = (np.minimum(ny[first:], nx[j]) * 100 >= np.maximum(ny[first:], nx[j]) * percent) & (ly[first:] != lx[j])
                    at = np.flatnonzero(fits)
                    if len(at):
                        most = np.minimum(gy[first:][at], gx[j]).sum(1)
                        at = at[most * (100 + percent) >= percent * both[at]]
                    for k in (at + first).tolist():
                        a, b = find(int(lx[j])), find(int(ly[k]))
                        if a != b and len(np.intersect1d(sx[j], sy[k], assume_unique=True)) * (100 + percent) >= percent * (nx[j] + ny[k]):
                            root[max(a, b)] = min(a, b)
                            out.append((int(cx[j]), int(cy[k])))
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], ["a", "b"])
    return run


def _block_links(big: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components that are left in regions too dense to cut. Blocks
    meet in pairs; a pair of blocks inside one component, or of sizes too far apart,
    needs no meeting. A task holds two blocks and returns at most as many links as
    they have components."""
    m = written(_blocks(big), "blocks")
    some = m.groupBy("group", "block").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    x, y = (some.select("group", *[F.col(c).alias(c + t) for c in ("block", "l0", "l1", "n0", "n1")]) for t in "xy")
    meet = x.join(y, "group").where("blockx < blocky AND NOT (l0x = l1x AND l0y = l1y AND l0x = l0y)")
    meet = meet.where((F.col("n1x") * 100 >= F.col("n0y") * percent) & (F.col("n1y") * 100 >= F.col("n0x") * percent)).select("group", "blockx", "blocky")
    one = F.struct("c", "n", "label", "s")
    load = written(m.join(sets.select("c", "s"), "c").groupBy("group", "block").agg(F.collect_list(one).alias("m"), (F.min("label") < F.max("label")).alias("open")), "block-sets")
    # within a block nothing is joined: its content lies in the row
    same = load.where("open").select(F.col("m").alias("mx"), F.lit(None).cast(load.schema["m"].dataType).alias("my"), F.lit(True).alias("same"))
    rows = meet.join(load.select("group", F.col("block").alias("blockx"), F.col("m").alias("mx")), ["group", "blockx"])
    rows = rows.join(load.select("group", F.col("block").alias("blocky"), F.col("m").alias("my")), ["group", "blocky"])
    rows = same.unionByName(rows.select("mx", "my", F.lit(False).alias("same")))
    return written(rows.mapInArrow(_links_in(percent), "a long, b long"), "block-links")


def class_links(docs: DataFrame, k: int = 4, percent: int = 85, leaf: int = LEAF, pivots: int = PIVOTS, levels: int = LEVELS,
                often: int = 2, hot_least: int = 8) -> tuple[DataFrame, DataFrame]:
    """(documents as doc_id, n, c, links between classes as a, b): enough links that
    classes are connected exactly when they are by all links. `docs`: (doc_id, text)."""
    spark = docs.sparkSession
    run, schema = _survey(k, often)
    seen = written(docs.mapInArrow(run, schema), "shingle-survey")
    rows = seen.where(F.col("shingle").isNull()).select("doc_id", "n", "c")
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("doc_id"))
    # any list keeps the join exact; this one holds at most HOT_ENTRIES shingles
    often_seen = written(seen.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= hot_least), "frequent")
    hot = most_frequent(often_seen, "hits", HOT_ENTRIES).toPandas()
    v, hits = hot["shingle"].to_numpy(np.int64).view(np.uint64), hot["hits"].to_numpy(np.int64)
    by_hash = np.argsort(v)
    v, hits = v[by_hash], hits[by_hash]
    rank = np.empty(len(v), np.int64)
    rank[np.argsort(hits, kind="stable")] = np.arange(len(v))
    run, schema = _regions(k, percent, spark.sparkContext.broadcast((v, rank)))
    members = docs.mapInArrow(run, schema).withColumnsRenamed({"anchor": "key"}).withColumn("home", F.lit(True))
    shared = _counted(members.repartition("key").dropDuplicates(["key", "c"]))
    regions = written(_rings(written(shared, "shared-pivots"), percent), "regions")

    wanted = regions.select("c").distinct()
    bits = spark.sparkContext.broadcast(id_bits(classes.join(wanted, "c", "left_semi")))
    run, schema = _wanted_sets(k, bits)
    sets = written(docs.mapInArrow(run, schema), "sets")        # a set may come twice where ids agree mod BITS; its pairs do then, too

    _, links = _measure(_leaf_pairs(regions, percent, leaf), sets, percent, "leaf-pairs")
    big = regions.where(F.col("k") > leaf).select("key", "c", "n", "home")
    reach = 2 * (100 - percent) / 100 + 1e-9
    for level in range(levels):
        if not big.limit(1).count():
            return rows, links
        weight = big.join(_counted(big).groupBy("c").agg(F.sum("k").alias("w")), "c")
        order = W.partitionBy("key").orderBy(F.col("w").desc(), F.xxhash64("c", F.lit(level)))
        chosen = (weight.withColumn("r", F.row_number().over(order)).where(F.col("r") <= pivots)
                  .select("key", F.col("c").alias("p"), F.col("n").alias("np")))
        star = written(big.select("key", "c", "n").join(chosen, "key"), "star")
        pairs = _ordered(star.where("c <> p").select(F.col("c").alias("a"), F.col("p").alias("b"), F.col("n").alias("na"), F.col("np").alias("nb"), F.col("key").alias("region")))
        met, more = _measure(pairs, sets, percent, "pivot-pairs")
        links = links.unionByName(more)
        label = components(links)
        dist = met.groupBy("a", "b").agg(F.max(1 - F.col("most") / (F.col("na") + F.col("nb") - F.col("most"))).alias("d"))
        star = (star.withColumns({"a": F.least("c", "p"), "b": F.greatest("c", "p")}).join(dist, ["a", "b"], "left")
                .withColumn("d", F.when(F.col("c") == F.col("p"), 0.0).otherwise(F.col("d"))))
        star = (star.join(label.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
                .withColumn("near", F.min("d").over(W.partitionBy("key", "c"))).where(F.col("d") - F.col("near") <= reach))
        star = star.select(F.xxhash64("key", "p").alias("key"), "c", "n", "d", "label", (F.col("d") <= F.col("near")).alias("home"))
        size = star.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("k")).where("lo <> hi")
        star = written(star.join(size.select("key", "k"), "key"), "voronoi")
        links = links.unionByName(_measure(_leaf_pairs(star, percent, leaf), sets, percent, "leaf-pairs")[1])
        big = star.where(F.col("k") > leaf)
    if big.limit(1).count():
        big = big if "label" in big.columns else big.withColumn("label", F.col("c"))
        links = links.unionByName(_block_links(big, sets, percent))
    return rows, links


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85, **limits) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id of all documents reachable by links)."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, links = class_links(docs, k, percent, **limits)
    label = components(links)
    own = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("low"))
    named = own.join(label, own["c"] == label["node"], "left").withColumn("label", F.coalesce("label", "c"))
    named = named.join(named.groupBy("label").agg(F.min("low").alias("component_id")), "label").select("c", "component_id")
    # copies of one text share a class; classes of over 1 / 10,000 of all rows are joined by broadcast, at most 10,000 rows
    total = rows.count()
    large = rows.where("n > 0").groupBy("c").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") * 10_000 > F.lit(total)).drop("m")
    named = written(named.join(large.withColumn("large", F.lit(True)), "c", "left"), "class-components")
    some = rows.where("n > 0").join(F.broadcast(named.where("large").drop("large").withColumnRenamed("component_id", "id_l")), "c", "left")
    rest = named.where("large IS NULL").drop("large")
    hot = some.where("id_l IS NOT NULL").select("doc_id", "n", F.col("id_l").alias("component_id"))
    light = some.where("id_l IS NULL").drop("id_l").join(rest, "c", "left").select("doc_id", "n", "component_id")
    none = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return hot.unionByName(light).unionByName(none).select("doc_id", F.col("n").alias("n_shingles"),
                                                           F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op7_ngram_jaccard_join(spark, docs: DataFrame) -> DataFrame:
    return near_groups(docs)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the smallest id; rows with a
    null id and texts without words stay."""
    found = near_groups(docs, key, text, k, percent)
    drop = found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("__k")).distinct()
    return docs.join(written(drop, "near-duplicates"), F.col(key).cast("long") == F.col("__k"), "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (SELECT doc_id, CASE WHEN len(x) = 0 THEN [] WHEN len(x) < 4 THEN [array_to_string(x, ' ')]
        ELSE list_distinct([array_to_string(x[i:i+3], ' ') for i in generate_series(1, len(x) - 3)]) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * i >= 85 * (na + nb - i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN m USING (doc_id)
"""

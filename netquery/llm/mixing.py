"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of the mix are cut into equal blocks. Blocks go to sources, and inside
a source to its shards, by highest quotients votes / (2k - 1), so every source
and shard gets an integer quota. A shard lays its documents on one line in a
seeded order and takes its quota of blocks from the front, in as many full
rounds as the quota asks for.

Defined results: a null or blank text has size 0 and is never taken; a null
source is a source of its own, last in order; sources without words have target
0; an empty table gives an empty mix; rows that repeat are separate members of
their source, in order of id, size and text; other columns play no part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WHITE, global_rank, written

BLOCK = 1               # words of a block: larger ones round small sources away
SHARD_DOCS = 2048       # documents of a shard, on average
REPEATS = 3             # a source gives at most so many times its size
WEIGHTS = (5, 2, 1)     # of the sources in order, repeating
SEED = "mix-1"
CUTS = 1 << 18          # cut rows (about 100 bytes each) that are broadcast; more are joined by shard


def n_words(text: Column) -> Column:
    line = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "))
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """`sources` (source_size, weight) with `target`: the sum of all sizes shared by
    weight, where no target is above `repeats` times its source's size and what
    is over goes to the others by weight. Each round is one aggregate row."""
    big = lambda c: c.cast("decimal(18,0)")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    fixed, weights, capped = 0, sources.agg(F.sum("weight")).first()[0] or 1, 0
    while True:
        over = big(F.col("weight")) * big(F.lit(total - fixed)) > big(F.col("source_size") * repeats) * big(F.lit(weights))
        n, c, w = sources.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("source_size") * repeats)),
                              F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped:
            break
        fixed, weights, capped = c or 0, w or 1, n
    share = F.col("weight") * F.lit(float(total - fixed)) / F.lit(float(weights))
    return sources.withColumn("target", F.when(over, (F.col("source_size") * repeats).cast("double")).otherwise(share))


def _bounds(votes: Column, seats: Column, total: Column, n: Column) -> tuple[Column, Column]:
    """Seats that a member of `n` has for sure, and that it can have at most. With
    the divisor total / (seats -+ n / 2) the rounded shares sum to at most / at
    least the seats, so the true allocation lies between; one seat more on both
    sides covers rounding."""
    share = F.when(total > 0, votes / total).otherwise(0.0)
    low = F.greatest(F.lit(0), F.floor(share * (seats - n / 2) + 0.5) - 1)
    high = F.floor(share * (seats + n / 2) + 0.5) + 1
    return low.cast("long"), F.when(votes > 0, high).otherwise(0).cast("long")


def _candidates(df: DataFrame, votes: str) -> DataFrame:
    """The undecided seats of each member, with their quotients."""
    return (df.where("__high > __low").withColumn("__k", F.explode(F.sequence(F.col("__low") + 1, F.col("__high"))))
            .withColumn("__q", F.col(votes) / (2 * F.col("__k") - 1)))


def apportion(df: DataFrame, key: str, votes: str, seats: int, name: str = "quota") -> DataFrame:
    """`name`: seats of each row by Sainte-Lague over the whole table; ties go to the smaller `key`."""
    n, total = df.agg(F.count(F.when(F.col(votes) > 0, 1)), F.sum(votes)).first()
    low, high = _bounds(F.col(votes), F.lit(seats), F.lit(float(total or 0)), F.lit(n))
    df = df.withColumn("__low", low).withColumn("__high", high)
    left = seats - (df.agg(F.sum("__low")).first()[0] or 0)
    order = [F.col("__q").desc(), F.col(key), F.col("__k")]
    won = global_rank(_candidates(df, votes).select(key, "__k", "__q"), order).where(F.col("rank") <= left)
    won = won.groupBy(key).agg(F.count(F.lit(1)).alias("__won"))
    return (df.join(won, key, "left").withColumn(name, F.col("__low") + F.coalesce("__won", F.lit(0)))
            .drop("__low", "__high", "__won"))


def apportion_within(df: DataFrame, group: str, key: str, votes: str, seats: str, name: str = "quota") -> DataFrame:
    """The same inside every group, whose seats stand in the column `seats`."""
    g = W.partitionBy(group)
    low, high = _bounds(F.col(votes), F.col(seats), F.col("__total"), F.col("__n"))
    df = (df.withColumn("__total", F.sum(votes).over(g)).withColumn("__n", F.count(F.when(F.col(votes) > 0, 1)).over(g))
          .withColumn("__low", low).withColumn("__high", high).withColumn("__left", F.col(seats) - F.sum("__low").over(g)))
    place = F.row_number().over(W.partitionBy(group).orderBy(F.col("__q").desc(), key, "__k"))
    won = (_candidates(df, votes).withColumn("__place", place).where("__place <= __left")
           .groupBy(group, key).agg(F.count(F.lit(1)).alias("__won")))
    return (df.join(won, [group, key], "left").withColumn(name, F.col("__low") + F.coalesce("__won", F.lit(0)))
            .drop("__low", "__high", "__total", "__n", "__left", "__won"))


def _draw(key: Column, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))


def _shard(draw: Column, shards: Column) -> Column:
    return F.conv(F.substring(draw, 17, 8), 16, 10).cast("long") % shards


def _plan(docs: DataFrame, key: str, text: str, source: str, weights: tuple, block: int, repeats: int, shard_docs: int,
          seed: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources with quota and number of shards, rows with their place and the words
    before them in their shard, shards with the words they give)."""
    rows = written(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size")), "sizes")
    src = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("members"))
    src = global_rank(src, [F.col("source").asc_nulls_last()], "source_rank")
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    src = targets(written(src.withColumn("weight", cycle), "sources"), repeats)
    seats = -(-(src.agg(F.sum("source_size")).first()[0] or 0) // block)
    src = apportion(src, "source_rank", "target", seats).withColumnRenamed("quota", "source_quota")
    src = written(src.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("members") / shard_docs))), "source-quotas")

    s = src.withColumnRenamed("source", "__s")
    placed = (rows.join(s, F.col("source").eqNullSafe(F.col("__s"))).withColumn("draw", _draw(F.col("doc_id"), seed))
              .withColumn("shard", _shard(F.col("draw"), F.col("shards")))
              .select("doc_id", "size", "source_rank", "source_size", "target", "source_quota", "shard", "draw"))
    cells = placed.groupBy("source_rank", "shard").agg(F.sum("size").alias("cell_size"), F.first("source_quota").alias("source_quota"))
    cells = apportion_within(cells, "source_rank", "shard", "cell_size", "source_quota")
    taken = F.least(F.col("quota") * block, F.col("cell_size") * repeats)
    rounds = F.when(F.col("cell_size") > 0, F.floor(taken / F.col("cell_size"))).otherwise(0)
    cells = written(cells.select("source_rank", "shard", rounds.alias("rounds"), (taken - rounds * F.col("cell_size")).alias("rest")), "cells")
    line = W.partitionBy("source_rank", "shard").orderBy("draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return src, placed.withColumn("before", F.coalesce(F.sum("size").over(line), F.lit(0))), cells


def _part(size: Column, left: Column) -> Column:
    return F.greatest(F.lit(0), F.least(size, left))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS,
        block: int = BLOCK, repeats: int = REPEATS, shard_docs: int = SHARD_DOCS, seed: str = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken."""
    _, placed, cells = _plan(docs, key, text, source, weights, block, repeats, shard_docs, seed)
    taken = F.col("rounds") * F.col("size") + _part(F.col("size"), F.col("rest") - F.col("before"))
    return placed.join(cells, ["source_rank", "shard"]).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op10_mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return mix(docs)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", source: str = "source", weights: tuple = WEIGHTS,
          block: int = BLOCK, repeats: int = REPEATS, shard_docs: int = SHARD_DOCS, seed: str = SEED, cuts: int = CUTS) -> DataFrame:
    """The mix as documents with the columns of `docs`: a document that the mix
    takes t words of (size s) comes floor(t / s) times whole, and once with its
    first t mod s words where these are some; a column `chars` follows the text.

    The line of a shard is cut at one draw: rows before it come one round more
    than those behind it, so texts are not shuffled; only those of the draw
    itself (one document for each shard) are, to share what is left."""
    src, placed, cells = _plan(docs, key, text, source, weights, block, repeats, shard_docs, seed)
    draws = placed.groupBy("source_rank", "shard", "draw").agg(F.sum("size").alias("words"), F.min("before").alias("before"))
    left = F.col("rest") - F.col("before")
    cut = draws.join(cells, ["source_rank", "shard"]).where((left >= 0) & (left < F.col("words")))
    cut = cut.select("source_rank", "shard", "rounds", F.col("draw").alias("__cut"), left.alias("__left"))
    cut = cut.join(src.select("source_rank", F.col("source").alias("__source"), F.col("shards").alias("__shards")), "source_rank")
    cut = written(cut.select("__source", "__shards", F.col("shard").alias("__shard"), F.col("rounds").alias("__rounds"), "__cut", "__left"), "cuts")
    sources = written(src.select(F.col("source").alias("__s"), F.col("shards").alias("__n")), "shards")
    small = F.broadcast if cut.count() <= cuts else lambda x: x
    few = F.broadcast if sources.count() <= cuts else lambda x: x

    names = [f"__c{i}" for i in range(len(docs.columns))]       # columns of docs may have any name
    name = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names).withColumn("__draw", _draw(F.col(name[key]), seed))
    rows = rows.join(few(sources), F.col(name[source]).eqNullSafe(F.col("__s"))).withColumn("__at", _shard(F.col("__draw"), F.col("__n")))
    rows = rows.join(small(cut), F.col(name[source]).eqNullSafe(F.col("__source")) & (F.col("__at") == F.col("__shard")))
    t = F.col(name[text])
    whole = rows.where(F.col("__draw") != F.col("__cut")).withColumn("__size", n_words(t)).where("__size > 0")
    whole = whole.withColumn("__whole", F.col("__rounds") + F.when(F.col("__draw") < F.col("__cut"), 1).otherwise(0)).withColumn("__part", F.lit(0))
    at = rows.where(F.col("__draw") == F.col("__cut")).withColumn("__size", n_words(t)).where("__size > 0")
    line = W.partitionBy("__cut", "__shard", "__source").orderBy(name[key], "__size", t).rowsBetween(W.unboundedPreceding, -1)
    part = _part(F.col("__size"), F.col("__left") - F.coalesce(F.sum("__size").over(line), F.lit(0)))
    at = at.withColumn("__part", part).withColumn("__whole", F.col("__rounds") + F.floor(F.col("__part") / F.col("__size")))
    at = at.withColumn("__part", F.col("__part") % F.col("__size"))
    keep = [*names, F.col("__whole").cast("int").alias("__whole"), F.col("__part").cast("long").alias("__part")]
    rows = whole.select(*keep).unionByName(at.select(*keep))
    takes = F.concat(F.array_repeat(F.lit(0).cast("long"), F.col("__whole")), F.filter(F.array("__part"), lambda x: x > 0))
    rows = rows.withColumn("__take", F.explode(takes))
    words = F.split(F.btrim(F.regexp_replace(t, WHITE, " ")), " ")
    first = F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(1), F.col("__take")).cast("int")), " ")
    rows = rows.withColumn(name[text], F.when(F.col("__take") == 0, t).otherwise(first))
    if chars in name:
        n = F.col(name[chars])
        rows = rows.withColumn(name[chars], F.when(F.col("__take") == 0, n).otherwise(F.length(t)).cast(docs.schema[chars].dataType))
    return rows.select(*[F.col(name[c]).alias(c) for c in docs.columns])


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat('{SEED}|', coalesce(doc_id::VARCHAR, ''))) AS draw FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS members FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM s0),
s2 AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][((r - 1) % {len(WEIGHTS)} + 1)::INT] AS w, sum(source_size) OVER () AS total FROM s1),
s3 AS (SELECT *, row_number() OVER (ORDER BY {REPEATS}.0 * source_size / w, r) AS k FROM s2),
s4 AS (SELECT *, coalesce(sum({REPEATS} * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
              sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ww FROM s3),
lv AS (SELECT c, ww FROM s4 WHERE w * (total - c) <= {REPEATS} * source_size * ww ORDER BY k LIMIT 1),
s5 AS (SELECT s4.source, r, source_size, members, total,
              CASE WHEN w * (total - lv.c) > {REPEATS} * source_size * lv.ww THEN ({REPEATS} * source_size)::DOUBLE
                   ELSE (w * (total - lv.c))::DOUBLE / lv.ww::DOUBLE END AS target FROM s4, lv),
n AS (SELECT ceil(sum(source_size) / {BLOCK}.0)::BIGINT AS seats, count(*) AS m FROM s5),
q1 AS (SELECT r, target / (2 * k - 1) AS q, k FROM s5, n, unnest(generate_series(1, (target / greatest(total, 1) * seats)::BIGINT + m + 2)) AS u(k) WHERE target > 0),
q2 AS (SELECT r, row_number() OVER (ORDER BY q DESC, r, k) AS place FROM q1),
s6 AS (SELECT s5.*, (SELECT count(*) FROM q2, n WHERE q2.r = s5.r AND place <= seats) AS quota,
              greatest(1, ceil(members / {SHARD_DOCS}.0))::BIGINT AS shards FROM s5),
p AS (SELECT d.*, s6.r, source_size, target, quota, ('0x' || substr(draw, 17, 8))::BIGINT % shards AS shard
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source),
c0 AS (SELECT r, shard, sum(size)::BIGINT AS cell, any_value(quota) AS quota FROM p GROUP BY r, shard),
c1 AS (SELECT *, sum(cell) OVER (PARTITION BY r) AS whole, count(*) OVER (PARTITION BY r) AS m FROM c0),
c2 AS (SELECT r, shard, quota, cell / (2 * k - 1) AS q, k FROM c1, unnest(generate_series(1, (cell / greatest(whole, 1) * quota)::BIGINT + m + 2)) AS u(k) WHERE cell > 0),
c3 AS (SELECT r, shard, quota, row_number() OVER (PARTITION BY r ORDER BY q DESC, shard, k) AS place FROM c2),
c4 AS (SELECT r, shard, count(*) AS won FROM c3 WHERE place <= quota GROUP BY r, shard),
c5 AS (SELECT c0.r, c0.shard, cell, least(coalesce(won, 0) * {BLOCK}, {REPEATS} * cell) AS t FROM c0 LEFT JOIN c4 USING (r, shard)),
b AS (SELECT p.*, coalesce(sum(size) OVER (PARTITION BY r, shard ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT doc_id, size, source_size, target,
       (CASE WHEN cell > 0 THEN (t // cell) * size ELSE 0 END
        + greatest(0, least(size, CASE WHEN cell > 0 THEN t % cell ELSE 0 END - before)))::BIGINT AS taken
FROM b JOIN c5 USING (r, shard)
"""

"""Exact dedup on a persistent digest index.

The index is a Parquet table bucketed and sorted by digest: (digest, keep_id).
New rows are digested, their new digests are found by a sort-merge anti-join
against the index, and appended to it. The first batch that brings a digest
decides which row stays; inside a batch it is the smallest id.

Defined results: a null text counts as empty; empty texts equal each other; a
null id never stays before another id; an empty batch appends nothing; repeated
rows (same id and text) are members of one group, of which one row stays, the first in the
order of the digested table; other columns play no part."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, fresh_path, written

HEAVY = 10_000        # at most this many digests are joined by broadcast: those of over 1 / HEAVY of all rows


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """A digest index at `path` in shared storage with `buckets` buckets (fixed for its life)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + uuid.uuid4().hex
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> None:
        """Append the digests of (doc_id, digest) rows that the index lacks."""
        groups = digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        new = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (new.repartition(self.buckets, "digest").write.mode("append").format("parquet")
            .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), digest_of(F.col(text)).alias("digest"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = 2,
                index: DigestIndex | None = None, buckets: int | None = None) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept; of the rows with
    the id that stays, one is kept. The rows enter the index in `batches` batches by rising id. Groups of over 1 / HEAVY
    of all rows (at most HEAVY of them) meet their rows by broadcast, all others
    by a sort-merge join whose keys are then bounded."""
    spark, own = docs.sparkSession, index is None
    rows = written(digest_rows(docs, key, text).withColumn("n", F.monotonically_increasing_id()), "digests")        # n is fixed once written
    # one row: counts and the cuts between the batches
    total, cuts = rows.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", [i / batches for i in range(1, batches)] or [0.5])).first()
    buckets = buckets or max(8, min(4096, total // 500_000))
    index = index or DigestIndex(spark, fresh_path(spark, "digest-index"), buckets)
    part = F.lit(0)
    for c in (cuts or []) if batches > 1 else []:
        part = part + F.coalesce(F.col("doc_id") > c, F.lit(True)).cast("int")
    for i in range(batches):
        index.add(rows.where(part == i))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n"))["n"].alias("first"))
    groups = written(index.rows().hint("merge").join(sizes, "digest"), "digest-groups")
    heavy = F.col("group_size") * HEAVY > F.lit(total)
    few = F.broadcast(groups.where(heavy).withColumn("heavy", F.lit(True)))     # at most HEAVY rows
    marked = rows.join(few, "digest", "left")
    light = marked.where(F.col("heavy").isNull()).select("doc_id", "digest", "n").join(groups.where(~heavy), "digest")
    found = ["doc_id", "digest", "keep_id", "group_size", "n", "first"]
    full = marked.where(F.col("heavy")).select(*found).unionByName(light.select(*found))
    if own:
        spark.sql(f"DROP TABLE {index.name}")          # its name in the catalog; the files stay
    return full.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("first"))).drop("n", "first")


def op4_exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept",
                                    F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their own columns. Of rows that repeat
    the staying id with an equal text, one stays; only such rows, marked by their
    count, meet in a second shuffle."""
    kept = (exact_dedup(docs, key, text).where("doc_id <=> keep_id").groupBy("doc_id", "digest")
            .agg(F.count(F.lit(1)).alias("__n")).withColumnsRenamed({"doc_id": "__k", "digest": "__d"}))
    rows = docs.withColumn("__digest", digest_of(F.col(text)))
    rows = rows.join(written(kept, "kept"), F.col(key).cast("long").eqNullSafe(F.col("__k")) & (F.col("__digest") == F.col("__d")))
    once = rows.where("__n = 1").select(*docs.columns)
    more = rows.where("__n > 1").dropDuplicates(["__k", "__d"]).select(*docs.columns)
    return once.unionByName(more)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

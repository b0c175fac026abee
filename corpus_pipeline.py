"""From raw documents to packed training sequences, in five stages.

Every stage is one operator over all rows that the stage before has kept, written
as Parquet and read again. All but the last return the columns of the documents.
Null texts count as empty: they are never toxic, equal each other, have no near
duplicates, and the mix takes nothing of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquery.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from netquery.llm.common import table, written
from netquery.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: the models learn from all labelled documents; those of a score of 0.3 or more go."""
    ship_package(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts that differ in white space at most, the smallest doc_id stays."""
    ship_package(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of documents connected by similarities of 0.8 or more on five-word shingles, the smallest doc_id stays."""
    ship_package(spark)
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often, and with as many words, as their source's target asks for."""
    ship_package(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of token ids, each with its place in a sequence."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources", mix_sources), ("packing", pack_sequences)]

# The models of the first stage cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

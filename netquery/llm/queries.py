"""The thin registered queries: each reads its whole table through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, exact_dedup, html_extract, license_scan, mixing, ngram_join, packing, periodic, quality, spelling,
               token_counts, toxicity, url_filter)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": lambda spark, d: packing.op1_packing(spark, table(spark, d, "documents")),
    "op2_html_extract": lambda spark, d: html_extract.op2_html_extract(spark, table(spark, d, "pages")),
    "op3_toxicity": lambda spark, d: toxicity.op3_toxicity(spark, table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_exact_dedup": lambda spark, d: exact_dedup.op4_exact_dedup(spark, table(spark, d, "documents")),
    "op5_url_filter": lambda spark, d: url_filter.op5_url_filter(spark, table(spark, d, "pages")),
    "op6_quality": lambda spark, d: quality.op6_quality(spark, table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_ngram_jaccard_join": lambda spark, d: ngram_join.op7_ngram_jaccard_join(spark, table(spark, d, "documents")),
    "op8_nearest_neighbours": lambda spark, d: ann.op8_nearest_neighbours(spark, table(spark, d, "embeddings")),
    "op9_license_scan": lambda spark, d: license_scan.op9_license_scan(spark, table(spark, d, "documents")),
    "op10_mixing": lambda spark, d: mixing.op10_mixing(spark, table(spark, d, "documents")),
    "op11_spelling_variants": lambda spark, d: spelling.op11_spelling_variants(spark, table(spark, d, "documents")),
    "op12_periodic_runs": lambda spark, d: periodic.op12_periodic_runs(spark, table(spark, d, "documents")),
    "op13_token_counts": lambda spark, d: token_counts.op13_token_counts(spark, table(spark, d, "documents")),
}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op5_url_filter": url_filter.ORACLE,
    "op7_ngram_jaccard_join": ngram_join.ORACLE,
    "op9_license_scan": license_scan.ORACLE,
    "op10_mixing": mixing.ORACLE,
}

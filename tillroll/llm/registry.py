"""Queries of the corpus operators on the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tillroll.llm import (
    centroids,
    decontamination,
    fill_middle,
    html_text,
    mixing,
    quality,
    repeats,
    sharding,
    simhash,
    tokens,
    toxicity,
    url_filter,
    warc,
)
from tillroll.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@_query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"))


@_query
def op5_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op10_toxicity_severity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.severities(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


ORACLES["op8_source_mix"] = mixing.ORACLE


@_query
def op6_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards_of(table(spark, folder, "documents"))


@_query
def op3_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


ORACLES["op3_warc_round_trip"] = warc.ORACLE


@_query
def op9_benchmark_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.overlaps(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query
def op2_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages"))


@_query
def op7_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    # A cut inside a character leaves bytes that are no text: they show as U+FFFD.
    return repeats.without_repeats(table(spark, folder, "documents")).selectExpr(
        "* EXCEPT (kept)", "make_valid_utf8(CAST(kept AS string)) AS kept_text")


@_query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_middle(table(spark, folder, "documents"))


ORACLES["op11_fill_in_middle"] = fill_middle.ORACLE


@_query
def op12_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, folder, "pages"))


ORACLES["op12_url_verdicts"] = url_filter.ORACLE


@_query
def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, folder, "embeddings"))


ORACLES["op13_centroid_clusters"] = centroids.ORACLE


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

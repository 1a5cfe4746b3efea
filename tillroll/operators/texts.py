"""Bigram counts over product descriptions."""

from __future__ import annotations

from functools import cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.fixed_values import EXTRA_STOP_WORDS
from tillroll.functions.text import bigrams, drop_words, words
from tillroll.operators.frequent import most_frequent
from tillroll.operators.revenue import largest_first


@cache
def stop_words() -> tuple[str, ...]:
    """Spark's English list and the additions; needs a running session."""
    return (*StopWordsRemover.loadDefaultStopWords("english"), *EXTRA_STOP_WORDS)


def with_words(df: DataFrame, text: str = "Description") -> DataFrame:
    return df.withColumn("words", words(F.col(text)))


def with_clean_words(df: DataFrame) -> DataFrame:
    return df.withColumn("words_clean", drop_words(F.col("words"), stop_words()))


def with_bigrams(df: DataFrame) -> DataFrame:
    return df.withColumn("bigrams", bigrams(F.col("words_clean")))


def bigram_counts(df: DataFrame, text: str = "Description") -> DataFrame:
    """Occurrences of every bigram.

    Lines repeat a small set of descriptions, so equal texts are counted first
    and each text is taken apart once, weighted by its count.
    """
    texts = df.groupBy(text).agg(F.count(F.lit(1)).alias("lines"))
    taken_apart = with_bigrams(with_clean_words(with_words(texts, text)))
    # Outer, because for a plain explode the optimizer derives a filter "not
    # empty" and evaluates the whole text expression once more below the joins.
    return (
        taken_apart.select(F.explode_outer("bigrams").alias("bigram"), "lines")
        .where(F.col("bigram").isNotNull())
        .groupBy("bigram")
        .agg(F.sum("lines").alias("count"))
    )


def top_bigrams(df: DataFrame, text: str = "Description", top: int = 100) -> DataFrame:
    """The most frequent bigrams.  Texts are taken apart where they are read, and only
    each task's summary of the bigrams is moved."""
    lines = with_bigrams(with_clean_words(with_words(df.select(text), text)))
    found = most_frequent(
        lines.select(F.explode_outer("bigrams").alias("bigram")), ["bigram"], top, nulls=False)
    return largest_first(
        found.select(F.col("value").alias("bigram"), F.col("rows").alias("count")),
        "count", "bigram", top=top)


def distinct_descriptions(df: DataFrame, first: int = 10) -> DataFrame:
    from tillroll.operators.enrichment import normalised_description

    return (
        df.select(normalised_description().alias("Description_clean"))
        .distinct()
        .orderBy("Description_clean")
        .limit(first)
    )

"""Revenue of two versions of a table set side by side."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_revenue(versions: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (version label, Country) with the rounded revenue."""
    parts = [
        df.groupBy("Country")
        .agg(F.round(F.sum("OrderAmount"), 2).alias("total_revenue"))
        .select(F.lit(label).alias("version"), "Country", "total_revenue")
        for label, df in versions.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def revenue_by_country_delta(before: DataFrame, after: DataFrame, *,
                             label_before: str = "v0", label_after: str = "v1") -> DataFrame:
    """Revenue per country in both versions and the difference, lowest first.

    The versions are tagged and aggregated together: one exchange on Country.
    A country missing from one side has NULL there and a NULL difference.
    """
    if label_before == label_after:
        raise ValueError("the two versions need different labels")
    tagged = before.select(F.lit(False).alias("_after"), "Country", "OrderAmount").unionByName(
        after.select(F.lit(True).alias("_after"), "Country", "OrderAmount")
    )
    old, new = f"revenue_{label_before}", f"revenue_{label_after}"
    sides = tagged.groupBy("Country").agg(
        F.round(F.sum(F.when(~F.col("_after"), F.col("OrderAmount"))), 2).alias(old),
        F.round(F.sum(F.when(F.col("_after"), F.col("OrderAmount"))), 2).alias(new),
    )
    return sides.withColumn(
        "revenue_delta", F.round(F.col(f"`{new}`") - F.col(f"`{old}`"), 2)
    ).orderBy("revenue_delta", "Country")


def delta_summary(deltas: DataFrame) -> DataFrame:
    """Sums of the positive and of the negative differences; NULL counts 0."""
    delta = F.col("revenue_delta")
    return deltas.agg(
        F.round(F.sum(F.when(delta > 0, delta).otherwise(0)), 2).alias("total_positive_delta"),
        F.round(F.sum(F.when(delta < 0, delta).otherwise(0)), 2).alias("total_negative_delta"),
    )


def total_revenue_by_version(versions: Mapping[str, DataFrame]) -> DataFrame:
    """One row per version label; an empty version has a NULL total."""
    parts = [
        df.agg(F.round(F.sum("OrderAmount"), 2).alias("total_revenue")).select(
            F.lit(label).alias("version"), "total_revenue"
        )
        for label, df in versions.items()
    ]
    return reduce(DataFrame.unionByName, parts)

"""Revenue and count aggregates, rankings and shares.

Everything here is partial aggregation, one exchange on the grouping key and a
final aggregation; a hot key is folded on the map side before it travels.
Rankings always end in a unique key so ties have a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def revenue_by(df: DataFrame, *keys: str, total: str = "total_revenue",
               digits: int | None = None) -> DataFrame:
    amount = F.sum("OrderAmount")
    if digits is not None:
        amount = F.round(amount, digits)
    return df.groupBy(*keys).agg(amount.alias(total))


def largest_first(df: DataFrame, measure: str, *tie_breakers: str,
                  top: int | None = None) -> DataFrame:
    """Sorted by ``measure`` descending; with ``top`` a per-task top-k."""
    ordered = df.orderBy(F.col(measure).desc(), *[F.col(t) for t in tie_breakers])
    return ordered if top is None else ordered.limit(top)


def sales_by_country(gold: DataFrame) -> DataFrame:
    return revenue_by(gold, "Country")


def sales_by_product_category(gold: DataFrame) -> DataFrame:
    return revenue_by(gold, "product_category")


def sales_by_continent(gold: DataFrame) -> DataFrame:
    return revenue_by(gold, "Continent")


def sales_by_purchase_segment(gold: DataFrame) -> DataFrame:
    return revenue_by(gold, "Purchase_segment")


def sales_by_shopsize(gold: DataFrame) -> DataFrame:
    return revenue_by(gold, "Shopsize")


def mean_spend_by_segment(gold: DataFrame) -> DataFrame:
    return gold.groupBy("Purchase_segment").agg(F.avg("OrderAmount").alias("mean_spend"))


def sales_by_country_continent(gold: DataFrame) -> DataFrame:
    totals = revenue_by(gold, "Country", "Continent")
    return largest_first(totals, "total_revenue", "Country", "Continent")


def rounded_revenue_by_country(gold: DataFrame) -> DataFrame:
    return largest_first(revenue_by(gold, "Country", digits=2), "total_revenue", "Country")


def top_categories(gold: DataFrame, big_spender: Column, top: int | None = 10) -> DataFrame:
    """Categories by number of purchases among the rows ``big_spender`` marks."""
    counts = (
        gold.where(big_spender)
        .groupBy("product_category")
        .agg(F.count(F.lit(1)).alias("number_of_purchase"))
    )
    return largest_first(counts, "number_of_purchase", "product_category", top=top)


def rows_by(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return largest_first(counts, "count", key)


def top_customers(df: DataFrame, top: int = 10) -> DataFrame:
    spend = revenue_by(df, "CustomerID", total="TotalDepense", digits=2)
    return largest_first(spend, "TotalDepense", "CustomerID", top=top)


def top_items_by_quantity(df: DataFrame, top: int = 10) -> DataFrame:
    sold = df.groupBy("ItemCode").agg(F.sum("Quantity").alias("TotalQuantite"))
    return largest_first(sold, "TotalQuantite", "ItemCode", top=top)


def order_sizes(df: DataFrame) -> DataFrame:
    """Lines and pieces per invoice, largest first.

    The invoice number in the sort key spreads the few distinct line counts
    over all range partitions.
    """
    sizes = df.groupBy("InvoiceNo").agg(
        F.count(F.lit(1)).alias("NbItem"), F.sum("Quantity").alias("QuantiteTotale")
    )
    return largest_first(sizes, "NbItem", "InvoiceNo")


def monthly_revenue(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.year("InvoiceDate").alias("Year"), F.month("InvoiceDate").alias("Month"))
        .agg(F.sum("OrderAmount").alias("CA"))
        .orderBy("Year", "Month")
    )


def revenue_ranking(df: DataFrame, key: str = "Country", top: int | None = None) -> DataFrame:
    return largest_first(revenue_by(df, key, total="CA"), "CA", key, top=top)


def revenue_share(df: DataFrame, key: str, total: str, top: int | None = None) -> DataFrame:
    """Rounded revenue per ``key`` and its percentage of the grand total.

    The grand total is the sum of the already rounded parts.  It comes from a
    scalar subquery that reuses the exchange of the main aggregation, so the
    groups never meet in one task and the input is read once.
    """
    parts = revenue_by(df, key, total=total, digits=2)
    grand_total = parts.agg(F.sum(total).alias("grand_total")).scalar()
    shares = parts.withColumn("Part_CA_pct", F.round(F.col(total) / grand_total * 100, 2))
    return largest_first(shares, total, key, top=top)


def top_lines(df: DataFrame, top: int = 100) -> DataFrame:
    """The ``top`` lines by amount; at most ``top`` rows leave any task."""
    ties = [c for c in ("InvoiceNo", "ItemCode", "Quantity") if c in df.columns]
    return largest_first(df, "OrderAmount", *ties, top=top)


def cumulative_top_lines(df: DataFrame, top: int = 100) -> DataFrame:
    """Running amount and running percentage over the ``top`` largest lines.

    The two windows are unpartitioned on purpose: they see ``top`` rows.
    """
    lines = top_lines(df, top)
    ties = [F.col(c) for c in ("InvoiceNo", "ItemCode", "Quantity") if c in lines.columns]
    everything = Window.partitionBy()
    running = Window.orderBy(F.col("OrderAmount").desc(), *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return lines.withColumn("cum_amount", F.sum("OrderAmount").over(running)).withColumn(
        "cum_pct",
        F.round(F.col("cum_amount") / F.sum("OrderAmount").over(everything) * 100, 2),
    )


def total_of_top_lines(df: DataFrame, top: int = 100) -> DataFrame:
    return top_lines(df, top).agg(F.sum("OrderAmount").alias("total_CA"))


def total_revenue(df: DataFrame) -> DataFrame:
    return df.agg(F.round(F.sum("OrderAmount"), 2).alias("total_revenue"))


def nth_row(df: DataFrame, index: int) -> DataFrame:
    """Row number ``index`` (from 0) of an ordered frame, without collecting it."""
    return df.offset(index).limit(1)

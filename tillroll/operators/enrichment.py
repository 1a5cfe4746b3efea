"""Business columns on cleaned lines; every operator is map-only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions.casting import as_int
from tillroll.functions.labels import by_contained_text, by_exact_value, by_upper_bound
from tillroll.functions.predicates import not_cancelled, positive
from tillroll.functions.text import space_tokens


def amount_segment(amount: str = "OrderAmount") -> Column:
    return by_upper_bound(amount, fixed.AMOUNT_SEGMENTS, fixed.AMOUNT_SEGMENT_ELSE)


def customer_segment(customer: str = "CustomerID") -> Column:
    """``customer`` is the number, as SQL text."""
    return by_upper_bound(customer, fixed.CUSTOMER_SEGMENTS, fixed.CUSTOMER_SEGMENT_ELSE)


def high_spender(amount: str = "OrderAmount") -> Column:
    return F.col(amount) > fixed.HIGH_SPENDER_ABOVE


def shopsize_by_quantity(quantity: str = "Quantity") -> Column:
    return by_upper_bound(quantity, fixed.QUANTITY_SHOPSIZES, fixed.QUANTITY_SHOPSIZE_ELSE)


def shopsize_by_country(country: str = "Country") -> Column:
    return by_exact_value(country, fixed.COUNTRY_SHOPSIZES, fixed.COUNTRY_SHOPSIZE_ELSE)


def continent_by_name_part(country: str = "Country") -> Column:
    return by_contained_text(country, fixed.CONTINENT_NEEDLES, fixed.CONTINENT_ELSE)


def continent_by_country(country: str = "Country") -> Column:
    return by_exact_value(country, fixed.COUNTRY_CONTINENTS, fixed.COUNTRY_CONTINENT_ELSE)


def product_category(description: str = "desc_clean") -> Column:
    """``description`` is lower-case text: a column name or an expression."""
    return by_contained_text(description, fixed.CATEGORY_NEEDLES, fixed.CATEGORY_ELSE)


def normalised_description(description: str = "Description") -> Column:
    return F.expr(f"upper(trim({description}))")


def padded_code(code: str = "ItemCode") -> Column:
    """Five characters: shorter codes get zeros in front, longer ones are cut."""
    return F.lpad(F.col(code), fixed.CODE_LENGTH, "0")


def _pipeline_columns(df: DataFrame) -> dict[str, Callable[[], Column]]:
    return {
        "desc_clean": lambda: F.lower("Description"),
        "OrderAmount": lambda: F.expr("Quantity * UnitPrice"),
        "Purchase_segment": lambda: customer_segment(as_int(df, "CustomerID")),
        "Shopsize": shopsize_by_country,
        "Continent": continent_by_country,
        "product_category": lambda: product_category("lower(Description)"),
    }


def _notebook_columns(df: DataFrame) -> dict[str, Callable[[], Column]]:
    return {
        "Purchase_segment": amount_segment,
        "High_spender": high_spender,
        "Shopsize": shopsize_by_quantity,
        "Continent": continent_by_name_part,
    }


_RULES = {"pipeline": _pipeline_columns, "notebook": _notebook_columns}


def enrich_transactions(df: DataFrame, rules: str = "pipeline",
                        only: Sequence[str] | None = None) -> DataFrame:
    """Silver to gold (``pipeline``), or projected phase 2 to enriched phase 2.

    ``StockCode`` becomes ``ItemCode`` and the derived columns follow, all in
    one projection.  ``only`` names the derived columns wanted, so that a
    report on countries need not carry product descriptions.
    """
    if rules not in _RULES:
        raise ValueError(f"unknown rule set {rules!r}: use 'pipeline' or 'notebook'")
    derived = _RULES[rules](df)
    wanted = list(derived) if only is None else [n for n in derived if n in only]
    kept = [F.col(c).alias("ItemCode") if c == "StockCode" else c for c in df.columns]
    if rules == "notebook" and "Description" in df.columns:
        kept[df.columns.index("Description")] = normalised_description().alias("Description")
    return df.select(*kept, *[derived[n]().alias(n) for n in wanted])


def with_tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("tokens", space_tokens(F.col("Description")))


def categorised(df: DataFrame) -> DataFrame:
    """Adds ``desc_clean`` and ``product_category``."""
    return df.withColumn("desc_clean", F.lower(F.col("Description"))).withColumn(
        "product_category", product_category()
    )


def merge_ready(rest: DataFrame) -> DataFrame:
    """Lines left out of the sample, prepared as the source of the merge."""
    return (
        rest.withColumn("OrderAmount", F.col("Quantity") * F.col("UnitPrice"))
        .withColumn("ItemCode", padded_code())
        .where(positive("OrderAmount") & not_cancelled())
        .drop("tokens")
    )

"""Cleaning: raw invoice lines to typed, usable lines.

Two rule sets share the predicates and differ in order.  ``pipeline`` filters
the raw text and casts last, so an unreadable quantity survives as NULL for
the quality gate to catch.  ``notebook`` casts first, so unreadable values are
dropped with the missing ones.  Both are one projection over one filter: a
map-only stage with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.casting import as_double, as_int, as_timestamp
from tillroll.functions.fixed_values import PROJECTED_COLUMNS, REQUIRED_COLUMNS
from tillroll.functions.predicates import (
    article_code,
    not_cancelled,
    not_outlier,
    positive,
    present,
)


def typed(df: DataFrame) -> DataFrame:
    """Quantity int, UnitPrice double, InvoiceDate timestamp.

    Any of the three may be absent: only what is there gets cast.
    """
    casts = {"Quantity": as_int, "UnitPrice": as_double, "InvoiceDate": as_timestamp}
    return df.selectExpr(
        *[f"{casts[c](df, c)} AS {c}" if c in casts else f"`{c}`" for c in df.columns]
    )


def with_order_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("OrderAmount", F.col("Quantity") * F.col("UnitPrice"))


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.where(present(*REQUIRED_COLUMNS))


def drop_cancelled(df: DataFrame) -> DataFrame:
    return df.where(not_cancelled())


def drop_outlier(df: DataFrame) -> DataFrame:
    return df.where(not_outlier())


def keep_articles(df: DataFrame) -> DataFrame:
    return df.where(article_code())


def keep_positive(df: DataFrame, *names: str) -> DataFrame:
    return df.where(positive(*names))


def clean_transactions(df: DataFrame, rules: str = "pipeline") -> DataFrame:
    """Raw lines to silver (``pipeline``) or to phase 1 (``notebook``).

    The notebook form keeps cancelled, outlying and odd-coded lines: there
    they leave through table deletes, see ``plans.phases``.
    """
    if rules == "pipeline":
        usable = present(*REQUIRED_COLUMNS) & not_cancelled() & not_outlier() & article_code()
        return typed(df.where(usable))
    if rules == "notebook":
        return with_order_amount(drop_incomplete(typed(df)))
    raise ValueError(f"unknown rule set {rules!r}: use 'pipeline' or 'notebook'")


def project_sales(df: DataFrame) -> DataFrame:
    """Phase 1 to phase 2: fixed columns, positive price and quantity."""
    known = [c for c in PROJECTED_COLUMNS if c in df.columns]
    return df.where(positive("UnitPrice", "Quantity")).select(*known)


def rename_code(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("StockCode", "ItemCode")

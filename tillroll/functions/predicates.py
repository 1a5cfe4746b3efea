"""Row predicates shared by cleaning, deletes and merge preparation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.fixed_values import CODE_LENGTH, OUTLIER_INVOICE


def present(*names: str) -> Column:
    return F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names))


def not_cancelled(invoice: str = "InvoiceNo") -> Column:
    return F.expr(f"NOT startswith(lower({invoice}), 'c')")


def not_outlier(invoice: str = "InvoiceNo") -> Column:
    return F.expr(f"{invoice} <> '{OUTLIER_INVOICE}'")


def article_code(code: str = "StockCode") -> Column:
    """A NULL code is not an article code (the filter drops it)."""
    return F.expr(f"length({code}) = {CODE_LENGTH}")


def positive(*names: str) -> Column:
    return F.expr(" AND ".join(f"{n} > 0" for n in names))


def survives_delete(predicate: str) -> Column:
    """Rows a DELETE keeps: the predicate is false or NULL."""
    return F.expr(f"NOT coalesce(({predicate}), false)")

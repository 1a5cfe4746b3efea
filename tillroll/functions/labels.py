"""Label columns from ordered rule lists, each built as one SQL expression.

One expression text costs one call into the JVM; the same chain put together
from Column objects costs three per rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def first_true(branches: Iterable[tuple[str, str]], otherwise: str) -> Column:
    """CASE over (condition, label) in order; NULL conditions fall through."""
    whens = " ".join(f"WHEN {condition} THEN {quoted(label)}" for condition, label in branches)
    return F.expr(f"CASE {whens} ELSE {quoted(otherwise)} END")


def by_upper_bound(value: str, bounds, otherwise: str) -> Column:
    """``value``, here and below, is SQL text: a column name or an expression."""
    return first_true([(f"{value} < {bound}", label) for bound, label in bounds], otherwise)


def by_contained_text(value: str, needles, otherwise: str) -> Column:
    return first_true(
        [(f"contains({value}, {quoted(n)})", label) for n, label in needles], otherwise
    )


def by_exact_value(value: str, labels: Mapping[str, str], otherwise: str) -> Column:
    return first_true(
        [(f"{value} = {quoted(key)}", label) for key, label in labels.items()], otherwise
    )

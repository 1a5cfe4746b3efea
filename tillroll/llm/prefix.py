"""Prefix sums in the order of a random key, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import unused

# Rows that one window of the prefix sums has, about, and parts whose sums are added
# up together.
ROWS = 5_000
PARTS = 1_000


def random_key(doc_id: str | Column, text: str | Column) -> Column:
    """A hash of id and text as 32 hex digits: random, but the same in each run.

    Rows with the same key have the same id and text, so their order is open.
    """
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.col(text) if isinstance(text, str) else text
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.md5(text), F.lit(""))))


def with_prefix(df: DataFrame, groups: list[str], key: str, value: Column,
                name: str = "before", rows: int = ROWS) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before, by ``key`` within ``groups``.

    The key's range is cut into equal parts, so many that a part of the largest
    group has about ``rows`` rows.  Each part adds up its own rows, and the sums
    of the parts before it are added.  ``groups`` must not be null.  ``df`` is
    evaluated more than once and should be a stored table.
    """
    part, span, total, offset, own, lead = unused(
        df, "part", "span", "total", "offset", "own", "lead")
    parts = max(1, -(-df.count() // rows))
    cut = df.withColumn(part, F.expr(
        f"CAST(floor(CAST(conv(substring({key}, 1, 8), 16, 10) AS bigint) * {parts}D"
        f" / 4294967296D) AS bigint)"))

    def earlier(sums: DataFrame, within: list[str], order: str, name: str) -> DataFrame:
        before = Window.partitionBy(*within).orderBy(order).rowsBetween(
            Window.unboundedPreceding, -1)
        return sums.withColumn(name, F.coalesce(F.sum(total).over(before), F.lit(0)))

    # Sums of parts, and of spans of parts: no window has more than PARTS of either
    # until there are PARTS * PARTS parts.
    sums = cut.groupBy(*groups, part).agg(F.sum(value).alias(total)).withColumn(
        span, F.expr(f"{part} DIV {PARTS}"))
    spans = earlier(sums.groupBy(*groups, span).agg(F.sum(total).alias(total)), groups, span, lead)
    offsets = (earlier(sums, [*groups, span], part, offset)
               .join(spans.drop(total), [*groups, span])
               .select(*groups, part, (F.col(offset) + F.col(lead)).alias(offset)))
    inside = Window.partitionBy(*groups, part).orderBy(key).rowsBetween(
        Window.unboundedPreceding, -1)
    return (cut.withColumn(own, F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, [*groups, part])
            .withColumn(name, F.col(own) + F.col(offset)).drop(part, own, offset))

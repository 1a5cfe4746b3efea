"""Samples and the split of a table into sample and rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillroll.functions.workspace import stored
from tillroll.operators.membership import small_side

# Rows that one window of the running counts has, about.
_PART_ROWS = 100_000


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """``TABLESAMPLE (n ROWS)``: some n rows, whichever come first."""
    return df.limit(n)


def fraction(df: DataFrame, share: float = 0.1, columns: Sequence[str] | None = None) -> DataFrame:
    """About ``share`` of the rows: those whose content hash lies in that share of
    the hash range.  The same rows on every run; copies of a row stay together."""
    return df.where(row_hash(columns or df.columns) < _below(share))


def row_hash(columns: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def _below(share: float) -> str:
    """The hex text that a ``share`` of all hashes is smaller than."""
    return "g" if share >= 1 else f"{int(share * 2 ** 48):012x}"


def hash_sample(df: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows in the order of a hash of their content.

    Stands in for an unseeded random order: evenly spread, and the same rows
    on every run, so a retried task cannot change the sample.

    ``df`` is read twice and never copied: a count tells which share of the hash
    range holds a little more than n rows, and only rows of that share are written, copies
    folded into a count.  If the share holds too few (copies have one hash), twice the share
    is looked at.  Running counts over parts of the share tell how many of each are taken.
    """
    keys = list(columns or df.columns)
    order = ["_hash", *keys, *[c for c in df.columns if c not in keys]]
    hashed = df.withColumn("_hash", row_hash(keys))
    share = (n + 8 * n ** 0.5 + 64) / max(df.count(), 1)
    while True:
        few = hashed.where(F.col("_hash") < _below(share))
        folded = stored(few.groupBy(*hashed.columns).agg(F.count(F.lit(1)).alias("_copies")), "sample")
        held = folded.agg(F.count(F.lit(1)).alias("rows"), F.sum("_copies").alias("copies")).first()
        if share >= 1 or (held["copies"] or 0) >= n:
            break
        share *= 2
    chosen = _first_with_copies(folded, order, n, min(share, 1.0), held["rows"])
    return chosen.select(*df.columns)


def _first_with_copies(folded: DataFrame, order: Sequence[str], n: int, share: float,
                       rows: int) -> DataFrame:
    """The first ``n`` rows in ``order``, by running counts over parts of the hash range."""
    parts = max(1, -(-rows // _PART_ROWS))
    number = F.conv(F.substring("_hash", 1, 12), 16, 10).cast("double") / 2 ** 48
    cut = folded.withColumn("_part", F.floor(number / share * parts))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("_part").agg(F.sum("_copies").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    room = F.lit(n) - F.col("_offset") - F.coalesce(F.col("_inside"), F.lit(0))
    return (
        cut.withColumn("_inside", F.sum("_copies").over(inside))
        .join(offsets, "_part")
        .withColumn("_take", F.least(F.col("_copies"), room))
        .where(F.col("_take") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take"))))
    )


def rest_of(df: DataFrame, sample: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``sample`` on plain equality.

    As with any left anti join: every copy of a sampled row leaves, and a
    sampled row holding a NULL stays because NULL equals nothing.  A small sample
    goes to the rows of ``df``, which are then not moved.
    """
    return df.join(small_side(sample.select(*columns)), on=list(columns), how="left_anti")

"""The most frequent values without moving all values.

Counting every distinct value sends each of them over the network, although only a
few are wanted.  Here each task keeps a bounded summary: counters of values, and when there
are too many, the smallest are dropped and the largest dropped count is noted as the
error.  A value's true count is at most its reported count plus the errors of all tasks.

From the summaries come candidates, a second pass counts these exactly, and the result
is proven: if the last wanted count is above what any other value can have, no
other belongs to the result.  A column without that proof (its most
frequent values are hardly more frequent than others) is counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.workspace import shipped, stored

# Counters a task hands on for each column, and those it holds at most.
TRACKED = 2048
HELD = 1 << 16

_VALUE, _NULLS, _ERROR = 0, 1, 2
_SUMMARY = "column_name string, kind int, value string, n bigint"


class Counters:
    """Counts of the values of one column, at most ``held`` of them."""

    def __init__(self, held: int):
        self.held, self.parts, self.size, self.nulls, self.error = held, [], 0, 0, 0

    def add(self, column: pa.Array) -> None:
        self.nulls += column.null_count
        counted = pc.value_counts(column.drop_null())
        self.parts.append(pa.table([counted.field(0), counted.field(1)], names=["value", "n"]))
        self.size += len(counted)
        if self.size > 2 * self.held:
            self._keep(self.held)

    def _keep(self, most: int) -> pa.Table:
        """Folds the counters and drops the smallest beyond ``most``."""
        if not self.parts:
            return pa.table([pa.array([], pa.string()), pa.array([], pa.int64())], names=["value", "n"])
        folded = pa.concat_tables(self.parts).group_by("value").aggregate([("n", "sum")])
        folded = folded.rename_columns(["value", "n"])
        if len(folded) > most:
            folded = folded.sort_by([("n", "descending"), ("value", "ascending")])
            self.error += folded["n"][most].as_py()
            folded = folded.slice(0, most)
        self.parts, self.size = [folded], len(folded)
        return folded

    def rows(self, name: str, tracked: int) -> Iterator[pa.RecordBatch]:
        kept = self._keep(tracked)
        values = [*kept["value"].to_pylist(), None, None]
        numbers = [*kept["n"].to_pylist(), self.nulls, self.error]
        kinds = [_VALUE] * len(kept) + [_NULLS, _ERROR]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(values)), pa.array(kinds, pa.int32()),
             pa.array(values, pa.string()), pa.array(numbers, pa.int64())],
            names=["column_name", "kind", "value", "n"])


def summaries(df: DataFrame, tracked: int = TRACKED, held: int = HELD) -> DataFrame:
    """(column_name, kind, value, n) of the text columns of ``df``: sums over all tasks of the
    counters handed on, of the NULLs and of the errors."""
    names = df.columns
    shipped(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [Counters(max(held, tracked)) for _ in names]
        for batch in batches:
            for counter, column in zip(counters, batch.columns, strict=True):
                counter.add(column)
        for name, counter in zip(names, counters, strict=True):
            yield from counter.rows(name, tracked)

    return df.mapInArrow(run, _SUMMARY).groupBy("column_name", "kind", "value").agg(
        F.sum("n").alias("n"))


def _ranked(counts: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each column's (few) counts, with their rank."""
    order = Window.partitionBy("column_name").orderBy(F.col("rows").desc(), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def most_frequent(df: DataFrame, columns: Sequence[str], top: int, *, nulls: bool = True,
                  tracked: int = TRACKED, held: int = HELD) -> DataFrame:
    """(column_name, value, rows, rank): the ``top`` most frequent values of each column.

    Exact.  Values are given as text, ties go to the smaller text; NULL counts as a
    value where ``nulls`` is true, and comes first among ties.  ``df`` is read once, a second
    time for columns of whose values some were dropped, and counted in full for the columns
    that stay unproven.
    """
    tracked = max(tracked, 2 * top)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    found = stored(summaries(text, tracked, held), "summaries")
    # A column's counters in order: the candidates, and the largest count of the others.  A
    # bounded top-k for each column, so no task sorts all counters.
    order = [F.col("n").desc(), F.col("value")]
    chosen = stored(reduce(DataFrame.unionByName, [
        found.where((F.col("column_name") == c) & (F.col("kind") == _VALUE))
        .orderBy(*order).limit(tracked + 1)
        .withColumn("place", F.row_number().over(Window.orderBy(*order))) for c in columns]),
        "candidates")
    errors = {r["column_name"]: r["n"] for r in found.where(F.col("kind") == _ERROR).collect()}
    others = {r["column_name"]: r["n"]
              for r in chosen.where(F.col("place") == tracked + 1).collect()}
    chosen = chosen.where(F.col("place") <= tracked).select("column_name", "value", "n")

    none = found.where((F.col("kind") == _NULLS) & (F.col("n") > 0)).select(
        "column_name", F.lit(None).cast("string").alias("value"), F.col("n").alias("rows"))
    # Where no task dropped anything the sums are the counts.
    whole = [c for c in columns if not errors.get(c)]
    counts = chosen.where(F.col("column_name").isin(whole)).withColumnRenamed("n", "rows")
    dropped = [c for c in columns if errors.get(c)]
    if dropped:
        long = text.select(*dropped).unpivot([], dropped, "column_name", "value")
        # At most ``tracked`` candidates a column, however many rows there are.
        wanted = chosen.where(F.col("column_name").isin(dropped)).select("column_name", "value")
        again = stored(long.join(F.broadcast(wanted), ["column_name", "value"]).groupBy(
            "column_name", "value").agg(F.count(F.lit(1)).alias("rows")), "counted")
        counts = counts.unionByName(again)
    if nulls:
        counts = counts.unionByName(none)
    proven = set(whole)
    if dropped:
        least = {r["column_name"]: (r["n"], r["last"]) for r in _ranked(counts, top).groupBy(
            "column_name").agg(F.count(F.lit(1)).alias("n"), F.min("rows").alias("last")).collect()}
        for c in dropped:
            n, last = least.get(c, (0, 0))
            if n == top and last > others.get(c, 0) + errors[c]:
                proven.add(c)
    parts = [_ranked(counts.where(F.col("column_name").isin(sorted(proven))), top)]
    order = [F.col("rows").desc(), F.col("value")]
    # Counted in full, then a bounded top-k.
    for c in [c for c in columns if c not in proven]:
        full = text.select(c).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        full = full if nulls else full.where(F.col("value").isNotNull())
        parts.append(full.orderBy(*order).limit(top).select(
            F.lit(c).alias("column_name"), "value", "rows",
            F.row_number().over(Window.orderBy(*order)).alias("rank")))
    return reduce(DataFrame.unionByName, parts)

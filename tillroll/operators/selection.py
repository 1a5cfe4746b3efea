"""Exact quantiles by refining histograms.

A rank is sought in the range of all values.  The range is cut into ``BUCKETS``
parts, rows are counted by part, and the part that holds the rank is the next
range, until its least and greatest value are the same.  Any number of ranks in
any number of groups share each pass; a task hands on one row for each part that
it has rows in, so what crosses the exchange does not grow with the rows.  Nothing
is sorted and no value is approximated.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
# Groups and points whose open ranges go into one pass, at most.
_TOGETHER = 400


def quantiles(values: DataFrame, value: str, points: Mapping[str, float], *,
              weight: str | None = None, group: str | None = None,
              buckets: int = BUCKETS) -> dict[Any, dict[str, Any]]:
    """{group: {point: quantile}}: the first value whose share of the rows up to it is p.

    ``values`` is read once for each round (about three) and should be a stored
    table of this column alone.  NULL values are passed over; NaN comes last, as in
    Spark's order.  ``weight`` is a column of row counts.  Without ``group`` the only key is
    None; a group without values is left out.  Integers and decimals are compared
    as such, without a detour over doubles.
    """
    buckets = max(buckets, 4)
    rows = values.where(F.col(value).isNotNull()).select(
        (F.lit(None).cast("string") if group is None else F.col(group)).alias("_group"),
        _exact(values, value).alias("_value"),
        (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("_rows"))
    whole = rows.where(~_nan(rows)).groupBy("_group").agg(
        F.min("_value").alias("low"), F.max("_value").alias("high"), F.sum("_rows").alias("n"))
    nans = {r["_group"]: r["n"] for r in rows.where(_nan(rows)).groupBy("_group").agg(
        F.sum("_rows").alias("n")).collect()} if _is_float(rows) else {}
    plain = {r["_group"]: r for r in whole.collect()}
    found: dict[Any, dict[str, Any]] = {g: {} for g in {*plain, *nans}}
    # (group, point, least value, greatest value, rank within them)
    open_ = []
    for g in found:
        n = plain[g]["n"] if g in plain else 0
        for name, p in points.items():
            rank = max(1, math.ceil((n + nans.get(g, 0)) * p))
            if rank > n:
                found[g][name] = math.nan
            else:
                open_.append((g, name, plain[g]["low"], plain[g]["high"], rank))
    while open_:
        now, open_ = open_[:_TOGETHER], open_[_TOGETHER:]
        for g, name, low, high, rank in _refined(rows, [x for x in now if x[2] != x[3]], buckets):
            open_.append((g, name, low, high, rank))
        for g, name, low, high, _ in now:
            if low == high:
                found[g][name] = low
    kind = values.schema[value].dataType
    if not isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
        found = {g: {k: int(v) for k, v in at.items()} for g, at in found.items()}
    return found


def _exact(df: DataFrame, value: str):
    """The column in a type whose differences are exact enough to be ordered by."""
    kind = df.schema[value].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.col(value).cast("double")
    return F.col(value) if isinstance(kind, T.DecimalType) else F.col(value).cast("decimal(20,0)")


def _is_float(rows: DataFrame) -> bool:
    return isinstance(rows.schema["_value"].dataType, T.DoubleType)


def _nan(rows: DataFrame):
    return F.isnan("_value") if _is_float(rows) else F.lit(False)


def _refined(rows: DataFrame, ranges: list[tuple], buckets: int) -> list[tuple]:
    """The ranges' parts that hold their ranks, after one pass over ``rows``."""
    if not ranges:
        return []
    kind = rows.schema["_value"].dataType
    schema = T.StructType([
        T.StructField("_group", rows.schema["_group"].dataType), T.StructField("_at", T.IntegerType()),
        T.StructField("_low", kind), T.StructField("_high", kind)])
    # At most _TOGETHER rows.
    asked = rows.sparkSession.createDataFrame(
        [(g, i, low, high) for i, (g, _, low, high, _) in enumerate(ranges)], schema)
    # Halves, because the whole range may be more than the largest double.  The ends
    # have parts of their own, so each round parts at least one value from the rest.
    half = [f"({c} / 2)" if _is_float(rows) else c for c in ("_value", "_low", "_high")]
    most = 1.7976931348623157e308
    held = [f"least({most}D, greatest(-{most}D, {c}))" if _is_float(rows) else c for c in half]
    part = (f"CASE WHEN _value <= _low THEN 0 WHEN _value >= _high THEN {buckets - 1} "
            f"ELSE 1 + CAST(least({buckets - 3}D, floor(coalesce(try_divide("
            f"CAST({held[0]} - {held[1]} AS double), CAST({held[2]} - {held[1]} AS double)), 0D) "
            f"* {buckets - 2})) AS int) END")
    counted = (
        rows.where(~_nan(rows))
        .join(F.broadcast(asked), rows["_group"].eqNullSafe(asked["_group"]))
        .where("_value BETWEEN _low AND _high")
        .select("_at", F.expr(part).alias("_part"), "_value", "_rows")
        .groupBy("_at", "_part")
        .agg(F.sum("_rows").alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high"))
        .collect())
    by_range: dict[int, list] = {}
    for r in sorted(counted, key=lambda r: r["_part"]):
        by_range.setdefault(r["_at"], []).append(r)
    made = []
    for i, (g, name, _, _, rank) in enumerate(ranges):
        for r in by_range[i]:
            if rank <= r["n"]:
                made.append((g, name, r["low"], r["high"], rank))
                break
            rank -= r["n"]
    return made

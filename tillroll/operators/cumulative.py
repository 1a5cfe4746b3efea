"""Running sums over an ordering of the whole data set.

``sum(x) OVER (ORDER BY x DESC)`` has no partition key, so Spark moves every
row into one task.  Here the work is spread out, in the same way for any size:

1. fold rows with equal values into one row per distinct value (ties share
   their running sum, and a value that fills a third of the rows becomes one
   row before anything is shuffled);
2. cut the value range at approximate quantiles, so that a bucket has about
   ``BUCKET_ROWS`` values.  A bucket is a pure function of the value, so a
   recomputed task lands in the same bucket;
3. sum within each bucket, and add the totals of the buckets in front of it
   (one row per bucket).
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillroll.functions.workspace import stored
from tillroll.operators.revenue import largest_first, revenue_by

BUCKET_ROWS = 500_000


def prefix_sums(weights: DataFrame, value: str, weight: str, out: str, *,
                descending: bool = False,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` over all rows up to this value.

    ``weights`` holds one row per distinct ``value`` and must be cheap to read
    again (a stored table).  NULL values come last when descending, first when
    ascending, as in Spark's sort order.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    bucketed = _with_bucket(weights, value, max(2, -(-weights.count() // bucket_rows)))
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    bucket_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = Window.orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.sum(weight).alias("_bucket_total"))
        .select("_bucket", F.sum("_bucket_total").over(before).alias("_offset"))
    )
    inside = F.sum(weight).over(within)
    return (
        bucketed.withColumn("_inside", inside)
        .join(offsets, "_bucket")
        .withColumn(
            out,
            F.when(F.col("_inside").isNull(), F.col("_offset"))
            .when(F.col("_offset").isNull(), F.col("_inside"))
            .otherwise(F.col("_inside") + F.col("_offset")),
        )
        .select(*weights.columns, out)
    )


def _with_bucket(weights: DataFrame, value: str, buckets: int) -> DataFrame:
    """``_bucket`` numbers the value range; NULL is -1, NaN the last bucket."""
    numbers = weights.withColumn("_number", F.col(value).cast("double"))
    cuts = numbers.approxQuantile(
        "_number", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)
    )
    # Bucketizer wants at least three rising splits.
    inner = sorted(set(cuts)) or [0.0]
    splits = [-float("inf"), *[c for c in inner if abs(c) != float("inf")], float("inf")]
    if len(splits) < 3:
        splits = [-float("inf"), 0.0, float("inf")]
    marked = Bucketizer(
        splits=splits, inputCol="_number", outputCol="_place", handleInvalid="keep"
    ).transform(numbers)
    place = F.when(F.col("_number").isNull(), F.lit(-1)).otherwise(F.col("_place").cast("int"))
    return marked.withColumn("_bucket", place).drop("_number", "_place")


def running_total(totals: DataFrame, value: str, out: str = "cumulative_contribution", *,
                  bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``sum(value) OVER (ORDER BY value DESC)`` with the default RANGE frame."""
    table = stored(totals, "totals")
    per_value = stored(
        table.groupBy(value).agg(F.sum(value).alias("_weight")), "distinct-values"
    )
    sums = prefix_sums(
        per_value, value, "_weight", out, descending=True, bucket_rows=bucket_rows
    ).select(F.col(value).alias("_value"), out)
    # A value shared by very many rows makes one side of this join heavy; the
    # other side has one row per value, so adaptive skew handling can split it.
    return table.join(sums, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def contribution_by(gold: DataFrame, key: str, digits: int | None = None, *,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Keys by revenue with the running total, for any number of keys."""
    totals = revenue_by(gold, key, digits=digits)
    reached = running_total(totals, "total_revenue", bucket_rows=bucket_rows)
    return largest_first(reached, "total_revenue", key)


def contribution_by_country(gold: DataFrame, **options) -> DataFrame:
    return contribution_by(gold, "Country", **options)


def contribution_by_customer(gold: DataFrame, **options) -> DataFrame:
    return contribution_by(gold, "CustomerID", **options)

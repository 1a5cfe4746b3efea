"""Counts, summaries, exact quantiles, histograms and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.workspace import stored
from tillroll.operators.frequent import most_frequent
from tillroll.operators.selection import BUCKETS, quantiles


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def column_count(df: DataFrame) -> int:
    return len(df.columns)


def cancelled_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.lower("InvoiceNo").startswith("c")).alias("cancelled_rows"))


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (column, distinct value) with its row count.

    Values travel as text.  Map-side partial aggregation folds frequent values
    before the exchange, and each column's values spread over all tasks.
    """
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        as_text.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per column; NULL counts as a value."""
    return (
        column_values(df, columns)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )


_DESCRIBE = {
    "count": F.count,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per statistic, one double column per described column; one scan."""
    row = df.agg(
        *[
            f(c).cast("double").alias(f"{name}|{c}")
            for name, f in _DESCRIBE.items()
            for c in columns
        ]
    )
    statistics = [
        F.struct(
            F.lit(name).alias("summary"),
            *[F.col(f"{name}|{c}").alias(c) for c in columns],
        )
        for name in _DESCRIBE
    ]
    return row.select(F.inline(F.array(*statistics)))


QUARTILES = {"Q1": 0.25, "median": 0.5, "Q3": 0.75}


def approximate_summary(df: DataFrame, column: str = "OrderAmount",
                        accuracy: int = 10_000) -> DataFrame:
    """Min, max, mean and quartiles in one pass; quartiles within 1/accuracy."""
    return df.agg(
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.round(F.avg(column), 1).alias("avg"),
        *[
            F.round(F.percentile_approx(column, p, accuracy), 1).alias(name)
            for name, p in QUARTILES.items()
        ],
    )


def sketch_holds(df: DataFrame, summary: DataFrame, column: str = "OrderAmount",
                 accuracy: int = 10_000) -> DataFrame:
    """``summary`` of a sketch with a flag for each quartile instead of its value: whether
    its rank is off by no more than rows / accuracy (and the rounding to 0.1)."""
    one = summary.select(F.struct(*QUARTILES).alias("s")).scalar()
    ranks = df.where(F.col(column).isNotNull()).select(column, one.alias("s")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(column) < F.col(f"s.{q}") - 0.051).alias(f"low_{q}") for q in QUARTILES],
        *[F.count_if(F.col(column) <= F.col(f"s.{q}") + 0.051).alias(f"high_{q}")
          for q in QUARTILES],
    )
    slack = F.col("n") / accuracy + 1
    flags = [
        ((F.col(f"low_{q}") <= F.col("n") * p + slack)
         & (F.col(f"high_{q}") >= F.col("n") * p - slack)).alias(q)
        for q, p in QUARTILES.items()
    ]
    held = ranks.select(F.struct(*flags).alias("held")).scalar()
    return summary.drop(*QUARTILES).withColumn("held", held).select(
        *[c for c in summary.columns if c not in QUARTILES], "held.*")


def exact_summary(df: DataFrame, column: str = "OrderAmount", *,
                  buckets: int = BUCKETS) -> DataFrame:
    """Same columns with exact quartiles.

    The input is evaluated once, for this one column; the quartiles are
    found by refining histograms, so no pass sorts or moves the values.
    """
    values = stored(df.select(column), f"values-{column}")
    found = quantiles(values, column, QUARTILES, buckets=buckets).get(None, {})
    kind = values.schema[column].dataType
    return values.agg(
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.round(F.avg(column), 1).alias("avg"),
        *[F.round(F.lit(found.get(name)).cast(kind), 1).alias(name) for name in QUARTILES],
    )


def histogram(df: DataFrame, column: str = "OrderAmount", bins: int = 50) -> DataFrame:
    """Equal-width bins over the whole range, empty bins included.

    Each bin is closed below and open above; the last one is closed.  When all
    values are equal the range is widened by half a unit on each side.

    The input is evaluated once, for this one column.  First the extremes, then
    every row's bin, folded in each task: at most ``bins`` rows a task are moved.
    """
    values = stored(df.select(column).where(F.col(column).isNotNull()), f"values-{column}")
    ends = values.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    widen = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = ends.select(
        F.struct((F.col("lo") - widen).alias("lo"), (F.col("hi") + widen).alias("hi")).alias("e")
    )
    place = F.floor((F.col(column) - F.col("e.lo")) / (F.col("e.hi") - F.col("e.lo")) * bins)
    counts = (
        values.select(column, ends.scalar().alias("e"))
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    spark = df.sparkSession
    edges = spark.range(bins).select(
        F.col("id").alias("bin"), ends.scalar().alias("e")
    )
    step = (F.col("e.hi") - F.col("e.lo")) / bins
    return edges.join(counts, "bin", "left").select(
        F.col("bin"),
        (F.col("e.lo") + F.col("bin") * step).alias("bin_start"),
        F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column over the full table.

    Row, NULL and distinct counts, extremes, the most frequent value and, for
    numeric columns, mean, standard deviation and exact quartiles.  The input
    is scanned once, for the value counts; the rest comes from these.
    """
    names = list(columns or df.columns)
    values = stored(column_values(df, names), "profile-values")
    # Partial maximum per task before the exchange; ties go to the smaller text.
    per_column = values.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias(
            "null_rows"
        ),
        F.count("value").alias("distinct_values"),
        F.min(
            F.when(
                F.col("value").isNotNull(),
                F.struct((-F.col("rows")).alias("r"), F.col("value").alias("v")),
            )
        ).alias("top"),
    )
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name in names]
    result = per_column.select(
        "column_name", "rows", "null_rows", "distinct_values",
        F.col("top.v").alias("top_value"), (-F.col("top.r")).alias("top_rows"),
    )
    if not numeric:
        return result
    return result.join(_numeric_profile(values, df.schema, numeric), "column_name", "left")


def _numeric_profile(values: DataFrame, schema: T.StructType, numeric: Sequence[str]) -> DataFrame:
    """Moments and quartiles per numeric column, from the value counts alone."""
    numbers = values.where(F.col("column_name").isin(list(numeric)) & F.col("value").isNotNull())
    numbers = numbers.select("column_name", F.col("value").cast("double").alias("v"), "rows")
    means = numbers.groupBy("column_name").agg(
        F.sum("rows").alias("n"), (F.sum(F.col("v") * F.col("rows")) / F.sum("rows")).alias("mean"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    # Around the mean, so that large values do not cancel out.
    spread = numbers.join(means.select("column_name", "mean"), "column_name").groupBy(
        "column_name").agg(F.sum(F.pow(F.col("v") - F.col("mean"), 2) * F.col("rows")).alias("s"))
    moments = means.join(spread, "column_name").select(
        "column_name", "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("s") / (F.col("n") - 1))).alias("stddev"), "min", "max")
    typed = {}
    for c in numeric:
        typed.setdefault(schema[c].dataType, []).append(c)
    found = {}
    for kind, columns in typed.items():
        own = values.where(F.col("column_name").isin(columns)).withColumn(
            "v", F.col("value").cast(kind))
        found |= quantiles(own, "v", QUARTILES, weight="rows", group="column_name")
    quartiles = values.sparkSession.createDataFrame(
        [(c, *[float(at[q]) for q in QUARTILES]) for c, at in found.items()],
        "column_name string, " + ", ".join(f"{q} double" for q in QUARTILES))
    return moments.join(quartiles, "column_name")


def top_values(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """The most frequent values per column, exact, by bounded summaries of each task."""
    return most_frequent(df, columns, top)

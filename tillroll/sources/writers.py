"""Writing layers and laying tables out."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.partitions import encoded
from tillroll.functions.workspace import files_open

# Files a task holds open: a balanced piece has rows of few directories or buckets.
_OPEN = 16


def _balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with equal layout columns together, in pieces of even size.

    Without it every task opens a file in every directory it has rows for.
    The rebalance lets adaptive execution split a value that holds a third of
    the rows and join small ones, so file sizes follow the advisory size.
    """
    return df.hint("rebalance", *columns)


def write_layer(df: DataFrame, path: str, mode: str = "overwrite",
                partition_cols: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Save by path, optionally in directories per partition value.

    Partition text is encoded, so that ``read_layer`` gives back any text.
    """
    if partition_cols:
        with files_open(df.sparkSession, _OPEN):
            encoded(_balanced(df, partition_cols), partition_cols).write.format(fmt).mode(
                mode).partitionBy(*partition_cols).save(path)
    else:
        df.write.format(fmt).mode(mode).save(path)


def save_named(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
               path: str | None = None) -> DataFrame:
    """Save as a catalog table; with ``path`` the files live there."""
    df.write.format(fmt).mode(mode).options(**_location(path)).saveAsTable(name)
    return df.sparkSession.table(name)


def save_partitioned(df: DataFrame, name: str, columns: Sequence[str], fmt: str = "parquet",
                     path: str | None = None) -> DataFrame:
    """Catalog table partitioned by ``columns``; kept if it exists already."""
    with files_open(df.sparkSession, _OPEN):
        _balanced(df, columns).write.format(fmt).mode("ignore").partitionBy(*columns).options(
            **_location(path)
        ).saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(df: DataFrame, name: str, columns: Sequence[str], buckets: int = 8,
                  fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Catalog table hashed into ``buckets``; kept if it exists already.

    Grouping by all of these columns, and joining on them with a table of as many buckets, needs
    no exchange; ``bucket_rows`` reads a single bucket.
    """
    with files_open(df.sparkSession, _OPEN):
        _balanced(df, columns).write.format(fmt).mode("ignore").bucketBy(
            buckets, *columns
        ).options(**_location(path)).saveAsTable(name)
    return df.sparkSession.table(name)


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name})


def bucket_layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Bucket columns and number of buckets of a catalog table; none and 0 without buckets."""
    rows = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name)", args={"name": name})
    told = {r["col_name"]: r["data_type"] for r in rows.where(
        F.col("col_name").isin("Num Buckets", "Bucket Columns")).collect()}
    if "Num Buckets" not in told:
        return [], 0
    return re.findall(r"`((?:[^`]|``)+)`", told["Bucket Columns"]), int(told["Num Buckets"])


def bucket_rows(spark: SparkSession, name: str, **values) -> DataFrame:
    """The rows of a bucketed table with these values in all its bucket columns.

    Spark skips buckets only where there is a single bucket column.  Here the bucket of the
    values is computed as the writer computed it, and a filter on the file name, which is known
    before any file is opened, leaves the files of that bucket.  None finds NULL.
    """
    columns, buckets = bucket_layout(spark, name)
    if not columns or set(columns) != set(values):
        raise ValueError(f"{name} has the bucket columns {columns}, not {sorted(values)}")
    table = spark.table(name)
    typed = {c: F.lit(values[c]).cast(table.schema[c].dataType) for c in columns}
    number = spark.range(1).select(
        F.pmod(F.hash(*[typed[c] for c in columns]), F.lit(buckets))).first()[0]
    of_bucket = F.col("_metadata.file_name").rlike(f"_{number:05d}([.]|$)")
    same = [F.col(c).eqNullSafe(typed[c]) for c in columns]
    return table.where(of_bucket).where(reduce(lambda a, b: a & b, same))


def totals_in_pieces(table: DataFrame, columns: Sequence[str], *sums: Column) -> DataFrame:
    """``sums`` for each combination of the bucket columns, from files read in pieces.

    Grouped by the columns themselves a bucket is read by one task, however large it is.  Here the
    combination is one value, which the buckets are not laid out by: each task folds a piece of a
    file, and only its sums are moved.
    """
    of_pair = table.groupBy(F.struct(*columns).alias("_pair")).agg(*sums)
    return of_pair.select("_pair.*", *[c for c in of_pair.columns if c != "_pair"])


def bucket_contents(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per bucket and per combination of the bucket columns in it.

    The bucket number is the one Spark puts into each file's name.  Rows are counted by file
    first, so it is taken out of each name once.
    """
    bucket = F.regexp_extract(F.col("_file"), r"_(\d{5})\.", 1).cast("int")
    return (
        table.select(F.col("_metadata.file_name").alias("_file"), *columns)
        .groupBy("_file", *columns)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(bucket.alias("bucket"), *columns)
        .agg(F.sum("_rows").alias("rows"))
    )


def drop_named(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def register_views(**frames: DataFrame) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def _location(path: str | None) -> dict[str, str]:
    return {} if path is None else {"path": path}

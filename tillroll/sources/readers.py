"""Reading raw files and stored layers."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.functions.fixed_values import RAW_COLUMNS
from tillroll.functions.partitions import restored
from tillroll.tables import VersionedTable

# Formats that Spark lays out in directories by itself.
_FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Invoice lines with the fixed text schema: no pass to infer types."""
    return spark.read.csv(path, schema=RAW_SCHEMA, header=True)


load_raw_data = read_raw_csv


def read_inferred_csv(spark: SparkSession, path: str, sampling: float = 1.0) -> DataFrame:
    """Types inferred from the data, which costs one more pass.

    ``sampling`` below 1 looks at that share of the rows only.
    """
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling)


def register_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalog table over CSV files, kept if it is already there."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(
            name, path=path, source="csv", header="true", inferSchema="true"
        )
    return spark.table(name)


def read_layer(spark: SparkSession, path: str, fmt: str = "versioned",
               version: int | None = None) -> DataFrame:
    """A stored layer by path: a versioned table, or any Spark file format.

    Text in partition columns is restored as ``write_layer`` was given it.
    """
    if fmt == "versioned":
        return VersionedTable(spark, path).read(version)
    reader = spark.read.format(fmt)
    if version is not None:
        reader = reader.option("versionAsOf", version)
    layer = reader.load(path)
    return restored(layer, _directory_columns(layer, path)) if fmt in _FILE_FORMATS else layer


def _directory_columns(layer: DataFrame, path: str) -> list[str]:
    """Columns that are names of directories: told by the path of any one file."""
    row = layer.select("_metadata.file_path").limit(1).first()
    if row is None:
        return []
    inner = unquote(row[0]).split("/")[:-1]
    named = {part.split("=", 1)[0] for part in inner if "=" in part}
    return [c for c in layer.columns if c in named]


def read_named(spark: SparkSession, name: str, refresh: bool = False) -> DataFrame:
    """A catalog table; ``refresh`` forgets what is cached of it first."""
    if refresh:
        spark.catalog.refreshTable(name)
    return spark.table(name)


def clear_cache(spark: SparkSession) -> None:
    spark.catalog.clearCache()


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("DESCRIBE IDENTIFIER(:name)", args={"name": name})

"""Helpers that several corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.workspace import shipped

# Rows in one Arrow batch: with texts of some hundred KB a batch stays below
# a hundred MB or so in the Python worker.
BATCH_ROWS = 256
# Bytes of one text that are split into words at a time.
BLOCK_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Get ready for Python workers: the package is there, and an Arrow batch has
    few rows, since texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return shipped(spark)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def utf8(text: str | Column) -> Column:
    """The text's bytes; null counts as the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.encode(F.coalesce(column.cast("string"), F.lit("")), "UTF-8")


def word_blocks(data: bytes, block: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, a bounded block at a time.

    ``bytes.split`` without arguments splits at exactly these six bytes.
    """
    start = 0
    while len(data) - start > block:
        stop = _SPACE.search(data, start + block)
        if stop is None:
            break
        yield data[start:stop.start()].split()
        start = stop.start()
    yield data[start:].split()

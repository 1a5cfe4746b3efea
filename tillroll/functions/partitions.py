"""Partition values that survive being the name of a directory.

As a directory, empty text becomes NULL, and text that looks like a number or a date
is read back as one.  Text that is not plainly a word gets ``MARK`` in front when it is
written, and the mark is taken off where it is read.  Taking it off is an expression
over the partition column alone, so filters on the restored column still skip directories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "="
# Words that are read as numbers.
_NUMBER_WORDS = ("NaN", "Infinity")


def _texts(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def encoded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the text among these columns as it goes into directory names."""
    def mark(c: str):
        plain = F.col(c).rlike("^[A-Za-z]") & ~F.col(c).isin(*_NUMBER_WORDS)
        return F.when(F.col(c).isNull() | plain, F.col(c)).otherwise(F.concat(F.lit(MARK), F.col(c)))

    return df.withColumns({c: mark(c) for c in _texts(df, columns)}) if columns else df


def restored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the text of these partition columns as it was before ``encoded``."""
    def bare(c: str):
        return F.when(F.startswith(F.col(c), F.lit(MARK)), F.substr(F.col(c), F.lit(2))).otherwise(F.col(c))

    return df.withColumns({c: bare(c) for c in _texts(df, columns)}) if columns else df

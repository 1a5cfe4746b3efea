"""Casts that turn unreadable text into NULL while ANSI mode stays on.

The functions return SQL text for a column of ``df``, chosen by its type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.functions.fixed_values import DATE_FORMAT

# Digits with an optional fraction; a fraction is cut off, not rounded.
_PLAIN_NUMBER = r"^[+-]?(\\d+\\.?\\d*|\\.\\d+)$"


def as_int(df: DataFrame, name: str) -> str:
    """``name`` as int: '17850' and '17850.7' give 17850, 'abc' gives NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegerType):
        return name
    if not isinstance(kind, T.StringType):
        return f"try_cast({name} AS INT)"
    # The first branch settles nearly every row; only text that is not a bare
    # integer pays for the pattern.
    return (
        f"coalesce(try_cast({name} AS INT), CASE WHEN trim({name}) RLIKE '{_PLAIN_NUMBER}' "
        f"THEN try_cast(try_cast({name} AS DOUBLE) AS INT) END)"
    )


def as_double(df: DataFrame, name: str) -> str:
    if isinstance(df.schema[name].dataType, T.DoubleType):
        return name
    return f"try_cast({name} AS DOUBLE)"


def as_timestamp(df: DataFrame, name: str, fmt: str = DATE_FORMAT) -> str:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return name
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return f"CAST({name} AS TIMESTAMP)"
    return f"try_to_timestamp({name}, '{fmt}')"

"""A fixed-size filter of keys, so that a join moves only possible partners.

A row's keys are hashed to ``HASHES`` places of a bit array; a row whose places are
not all set has no partner for certain.  The array has the same size for any number of keys
(a filter that fills up lets more rows pass, it never loses one) and reaches the tasks
as the value of a scalar subquery: built, shared and tested on the JVM side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One MB; three places a key let one in thirty through at a million keys.
BITS = 1 << 23
HASHES = 3
_WORD = 64
# Bytes of a join's side, by the planner's estimate, that are sent to every task.
SMALL = 1 << 22


def estimated_bytes(df: DataFrame) -> int:
    """What the planner expects, from file sizes: no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(rows: DataFrame, limit: int = SMALL) -> DataFrame:
    """``rows``, sent whole to every task of a join where the planner expects at most ``limit``
    bytes of them, whatever the session's own limit is, so that the large side is not moved."""
    return F.broadcast(rows) if estimated_bytes(rows) <= limit else rows


def _present(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a NULL key; NaN is a value, equal to itself."""
    return rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _places(keys: Sequence[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *[F.col(k) for k in keys]), F.lit(bits))
            for i in range(HASHES)]


def key_bits(rows: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """One row with the bit array ``bits`` of the rows' keys; rows with a NULL key are
    left out.  Words are combined in each task before they are moved, and there are
    ``bits`` / 64 of them in all."""
    place = _present(rows, keys).select(
        F.explode(F.array(*_places(keys, bits))).alias("place"))
    words = place.groupBy(F.expr(f"place DIV {_WORD}").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST(place % {_WORD} AS int)))").alias("set"))
    every = rows.sparkSession.range(bits // _WORD).select(F.col("id").alias("word"))
    whole = every.join(words, "word", "left").agg(
        F.sort_array(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))))
        .alias("words"))
    return whole.select(F.col("words.set").alias("bits"))


def may_match(bits: DataFrame, keys: Sequence[str], size: int = BITS) -> Column:
    """False for rows whose keys are surely not among those of ``key_bits``."""
    words = bits.scalar()
    tests = [
        F.getbit(F.get(words, F.floor(place / _WORD).cast("int")),
                 F.pmod(place, F.lit(_WORD)).cast("int")) == 1
        for place in _places(keys, size)]
    return reduce(lambda a, b: a & b, tests)


def possible_partners(rows: DataFrame, source: DataFrame, keys: Sequence[str],
                      bits: int = BITS) -> DataFrame:
    """The rows that may equal a row of ``source`` in ``keys``, as a join would compare them.

    A NULL key equals nothing.  Where the two sides have unlike types a join casts first,
    so all rows without a NULL key stay.
    """
    present = _present(rows, keys)
    if any(rows.schema[k].dataType != source.schema[k].dataType for k in keys):
        return present
    return present.where(may_match(key_bits(source, keys, bits), keys, bits))

"""Token and n-gram columns from built-in array functions (no Python UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Java's \s stands for.
_BLANKS = " \t\n\x0b\f\r"


def space_tokens(text: Column) -> Column:
    """Lower-cased text split at every single space; empty tokens stay."""
    return F.split(F.lower(text), " ")


def words(text: Column) -> Column:
    """Lower-cased text split at every blank, trailing empty words dropped.

    Same result as ``pyspark.ml.feature.Tokenizer``: blanks in front or in a
    row give empty words, text of blanks alone gives no word at all.
    """
    lowered = F.lower(text)
    cut = F.rtrim(lowered, F.lit(_BLANKS))
    only_blanks = (cut == "") & (lowered != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(cut, r"\s"))


def drop_words(tokens: Column, unwanted: Iterable[str]) -> Column:
    """Tokens not in ``unwanted``, compared without regard to case."""
    lowered = sorted({w.lower() for w in unwanted})
    return F.filter(tokens, lambda t: ~F.lower(t).isin(lowered))


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens joined by one space; fewer than two give []."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda a, b: F.concat_ws(" ", a, b),
    )

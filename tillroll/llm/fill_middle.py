r"""Operator 11: fill-in-middle texts, cut by a Fenwick tree over text blocks.

A unit is a word with the white space before it, or the white space at a text's end.  So a
unit ends at each non-space byte before a space or the text's end, and at the end of a text
that ends in spaces; in UTF-8 no byte of a longer character looks like a space.

A text is taken in blocks of ``BLOCK`` bytes.  A Fenwick tree holds the ends of units and
the code points of each block; binary lifting descends to the block with a wanted end, and
only this block is looked at again to find the place.  The counts are made from ``STRIDE``
bytes at a time, so besides the text itself a task holds a few numbers for each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded, unused, utf8

SEED = 42
# Per cent of the texts that are transformed, and of these the ones with the suffix first.
TRANSFORMED = 50
SUFFIX_FIRST = 80
# The markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 4096
STRIDE = 256 * BLOCK

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Fenwick:
    """Sums of rows of counts: of the first rows, and the row where a count is reached."""

    def __init__(self, counts: np.ndarray):
        """``counts`` has a row for each block and a column for each kind of count."""
        self.n = len(counts)
        self.tree = np.zeros((self.n + 1, counts.shape[1]), dtype=np.int64)
        self.tree[1:] = counts
        step = 1
        while step < self.n:
            # Each node takes up the one that ends in the middle of its range.
            at = np.arange(2 * step, self.n + 1, 2 * step)
            self.tree[at] += self.tree[at - step]
            step *= 2

    def before(self, row: int) -> np.ndarray:
        """The sums of all rows before ``row``."""
        total = np.zeros(self.tree.shape[1], dtype=np.int64)
        while row:
            total += self.tree[row]
            row &= row - 1
        return total

    def find(self, wanted: int, kind: int = 0) -> tuple[int, int]:
        """The row that holds the ``wanted``-th of a kind, counted from 1, and how many of
        them lie before this row."""
        row, passed = 0, 0
        step = 1 << self.n.bit_length()
        while step := step >> 1:
            if row + step <= self.n and passed + self.tree[row + step, kind] < wanted:
                row += step
                passed += int(self.tree[row, kind])
        return row, passed


def _starts(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


class Units:
    """Places of the ends of units in one UTF-8 text."""

    def __init__(self, data: bytes, block: int = BLOCK, stride: int = STRIDE):
        self.data, self.block = np.frombuffer(data, dtype=np.uint8), block
        rows = []
        for low in range(0, len(data), stride):
            ends = self._ends(low, min(low + stride, len(data)))
            points = _starts(self.data[low:low + stride])
            at = np.arange(0, len(ends), block)
            rows.append(np.stack([np.add.reduceat(ends, at, dtype=np.int64),
                                  np.add.reduceat(points, at, dtype=np.int64)], axis=1))
        self.tree = Fenwick(np.concatenate(rows) if rows else np.zeros((0, 2), dtype=np.int64))
        self.n, self.points = (int(x) for x in self.tree.before(self.tree.n))

    def _ends(self, low: int, high: int) -> np.ndarray:
        """Whether a unit ends at each byte."""
        last = high == len(self.data)
        space = _SPACES[self.data[low:high + 1]]
        if not last:
            return ~space[:-1] & space[1:]
        ends = np.append(~space[:-1] & space[1:], True)
        return ends

    def cut(self, units: int) -> tuple[int, int]:
        """The byte and the code point after the first ``units`` units."""
        if units == 0:
            return 0, 0
        row, passed = self.tree.find(units)
        low = row * self.block
        ends = self._ends(low, min(low + self.block, len(self.data)))
        inside = int(np.flatnonzero(ends)[units - passed - 1]) + 1
        points = int(self.tree.before(row)[1]) + int(_starts(self.data[low:low + inside]).sum())
        return low + inside, points


def draws(doc_id: str, seed: int = SEED) -> list[int]:
    """The first four 8-digit groups of the hash of seed and id, as numbers."""
    digits = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digits[i:i + 8], 16) for i in range(0, 32, 8)]


def transformed(data: bytes, doc_id: str, seed: int = SEED, rate: int = TRANSFORMED,
                suffix_first: int = SUFFIX_FIRST, block: int = BLOCK) -> tuple:
    """(units, form, code points of prefix and middle, output) of one text."""
    units = Units(data, block, 256 * block)
    h1, h2, h3, h4 = draws(doc_id, seed)
    prefix, suffix, middle = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    if not data or prefix in data or suffix in data or middle in data or h3 % 100 >= rate:
        return units.n, "plain", None, None, data
    (a, points_a), (b, points_b) = (
        units.cut(k) for k in sorted((h1 % (units.n + 1), h2 % (units.n + 1))))
    if h4 % 100 < suffix_first:
        form, output = "spm", b"".join((suffix, data[b:], prefix, data[:a], middle, data[a:b]))
    else:
        form, output = "psm", b"".join((prefix, data[:a], suffix, data[b:], middle, data[a:b]))
    return units.n, form, points_a, points_b - points_a, output


def with_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
                rate: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``df`` with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Underscores are added to a name that ``df`` has already.  Cuts lie at ends of units, drawn
    by a hash of ``seed`` and id; a null id draws as the empty text.  A null or empty text is
    plain, has no units and an empty output; so is a text plain that holds a marker.
    Repeated rows and rows of equal id draw alike.  Texts are taken whole, at any length; an
    empty table stays empty.
    """
    bounded(df.sparkSession)
    key, data, *made = unused(df, "key", "data", "n", "form", "prefix_chars", "middle_chars",
                              "output")
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    schema = df.withColumns({
        name: F.lit(None).cast(kind)
        for name, kind in zip(made, ("bigint", "string", "bigint", "bigint", "string"), strict=True)
    }).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in (key, data))
            rest = [i for i, c in enumerate(batch.schema.names) if c not in (key, data)]
            # A long text goes on its own, so that few outputs are held together.
            sizes = np.cumsum([len(t.as_buffer()) for t in texts]) // STRIDE if len(texts) else []
            ends = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
            for low, high in pairwise(ends):
                rows = [transformed(t.as_py(), i.as_py(), seed, rate, suffix_first)
                        for i, t in zip(ids[low:high], texts[low:high], strict=True)]
                part = batch.slice(low, high - low)
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in rest] + [
                        pa.array(c, pa.binary()).cast(k) if k == pa.string() and name == made[4]
                        else pa.array(c, k)
                        for name, c, k in zip(made, columns, kinds, strict=True)],
                    names=[batch.schema.names[i] for i in rest] + made)

    return df.withColumns({
        key: F.coalesce(F.col(doc_id).cast("string"), F.lit("")), data: utf8(text),
    }).mapInArrow(run, schema)


def restored(output: str | Column, form: str | Column) -> Column:
    """The exact text of an output and its form.

    A transformed text holds no marker of its own, and markers cannot overlap, so each
    occurs once.
    """
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), 4)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
            .otherwise(output))


def fill_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its units, form, lengths of prefix and middle, and the hashes of the
    output and of the text restored from it.  Columns other than the two are not read."""
    rows = with_middle(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(restored("output", "form"), "UTF-8"), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''),
      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
k AS (
  SELECT *, len(units) AS n,
    CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS c1,
    CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS c2,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>')
        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[1:least(c1, c2)], '') AS pre,
    array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
    array_to_string(units[greatest(c1, c2) + 1:n], '') AS suf
  FROM k)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

"""Operator 7: removal of repeated 400-byte strings by a collection BWT.

A byte goes if a string of ``WIDTH`` bytes that covers it starts anywhere else
too, in the same document or another.

1. Deal.  The least hash of the ``CORE``-byte strings in a window of ``WIDTH``
   bytes depends on the window alone, so equal windows have the same key.
   Neighbouring windows with the same least string are kept together as a
   segment: the core with what lies left and right of it.  A key that occurs once holds no
   repeat.
2. Fold.  Equal segments of a key are counted and become one.  Their windows are
   all repeated if there are two or more.
3. Compare.  Unlike segments of a key are cut by their windows' distance from the core, so that
   the windows of a piece share ``INNER`` bytes, the piece's own key, and only pieces whose key
   is found again go on.  Of these the Burrows-Wheeler transform and the common
   prefixes of the collection are built column-wise: each round inserts one
   more symbol of every piece, from its end, by reading the last round's files
   in order and writing the next ones.  In the finished order equal windows are
   neighbours with a common prefix of the window's length.  All pieces of a key
   have the same inner bytes, so these are one symbol there, and a window
   is ``WIDTH - INNER + 1`` symbols.
4. Remove.  Repeated windows go back to all documents that hold them.

Keys with more than ``MOST`` pieces are not compared in one task; their
windows are dealt by the whole window, which is exact at any number.  Texts are read in parts of ``PART`` bytes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded, utf8

WIDTH = 400
CORE = 200
INNER = 350
PART = 1 << 17
# Pieces of one key that are compared in one task at most, and pieces that are
# compared together, about.
MOST = 4096
TOGETHER = 16_000

# Symbols that no UTF-8 text has.
_CORE_SYMBOL = 0xFF
_END = 0xFE
_MULTIPLIER = 0x9E3779B97F4A7C15


class Keys:
    """Least core hashes of the windows of a text part."""

    def __init__(self, width: int = WIDTH, core: int = CORE, part: int = PART):
        self.width, self.core, self.part = width, core, part
        size = part + width + 1
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        self.up, self.down = (np.multiply.accumulate(np.concatenate(
            [np.ones(1, np.uint64), np.full(size, m, np.uint64)])) for m in (_MULTIPLIER, inverse))

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash for each core, from sums of bytes times falling powers."""
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            (data.astype(np.uint64) + np.uint64(1)) * self.down[:len(data)], dtype=np.uint64)])
        h = (sums[self.core:] - sums[:-self.core]) * self.up[:len(data) - self.core + 1]
        for shift, factor in ((32, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        return h ^ (h >> np.uint64(32))

    def segments(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first window, number of windows, core's offset, key) of the segments, by part."""
        for start in range(0, len(data) - self.width + 1, self.part):
            part = np.frombuffer(data[start:start + self.part + self.width - 1], np.uint8)
            h = self._hashes(part)
            # The place in the low bits: of equal strings the first is the least.
            mask = np.uint64((1 << 20) - 1)
            ranked = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
            n, w = len(part) - self.width + 1, self.width - self.core + 1
            blocks = np.concatenate(
                [ranked, np.full(-len(ranked) % w, ~np.uint64(0))]).reshape(-1, w)
            after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
            before = np.minimum.accumulate(blocks, axis=1).ravel()
            least = (np.minimum(after[:n], before[w - 1:w - 1 + n]) & mask).astype(np.int64)
            cut = np.flatnonzero(np.diff(least)) + 1
            first = np.concatenate([[0], cut])
            count = np.diff(np.concatenate([first, [n]]))
            core = least[first]
            yield first + start, count, core - first, h[core].view(np.int64)


def _segments(texts: DataFrame) -> DataFrame:
    """(rid, first, windows, core_at, key, content) of the columns rid, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys()
        for batch in batches:
            for i, item in enumerate(batch.column("data")):
                data = item.as_py()
                for first, count, core, key in keys.segments(data):
                    content = np.frombuffer(b"".join(
                        xxhash.xxh3_64_digest(data[a:b]) for a, b in zip(
                            first.tolist(), (first + count + WIDTH - 1).tolist(), strict=True)),
                        dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("rid").take(pa.array(np.full(len(key), i))),
                         pa.array(first, pa.int64()), pa.array(count, pa.int32()),
                         pa.array(core, pa.int32()), pa.array(key), pa.array(content)],
                        names=["rid", "first", "windows", "core_at", "key", "content"])

    schema = "rid binary, first bigint, windows int, core_at int, key bigint, content bigint"
    return texts.mapInArrow(_merged(run), schema)


def _merged(run, rows: int = 20_000):
    """Joins the small batches of a ``mapInArrow`` function to larger ones."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in run(batches):
            held.append(batch)
            if sum(b.num_rows for b in held[-1:]) and len(held) >= 256 or batch.num_rows >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


class Transform:
    """Burrows-Wheeler transform and common prefixes of a collection, column-wise.

    Files hold, in suffix order, the symbol before each suffix and its common
    prefix with the suffix before it.  Round j reads them in order and writes
    the next ones, with the suffixes of length j of all strings that long put in.
    """

    def __init__(self, strings: list[bytes], folder: str):
        self.count = len(strings)
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        # Longest first: round j then concerns a leading part of the strings.
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.longest = int(self.sizes[0]) if self.count else 0
        columns = np.full((self.count, self.longest + 1), _END, dtype=np.uint8)
        for row, i in enumerate(self.order):
            columns[row, :len(strings[i])] = np.frombuffer(strings[i], np.uint8)[::-1]
        self.columns = np.ascontiguousarray(columns.T)
        total = int(sizes.sum()) + self.count
        self.files = [[np.memmap(f"{folder}/{name}{side}", kind, "w+", shape=total + 1)
                       for name, kind in (("symbols", np.uint8), ("prefixes", np.uint16))]
                      for side in "ab"]
        self.size = self.count
        self.files[0][0][:self.size] = self.columns[0]
        self.files[0][1][:self.size] = 0
        self.counts = np.bincount(self.columns[0], minlength=256)
        at = np.arange(self.count)
        for j in range(1, self.longest + 1):
            at = self._round(j, at[:int(np.searchsorted(-self.sizes, -j, side="right"))])
            self.files.reverse()

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        symbols, prefixes = self.files[0]
        return symbols[:self.size], prefixes[:self.size]

    def _round(self, j: int, at: np.ndarray) -> np.ndarray:
        """Puts in the suffixes of length j, whose tails stand at the places ``at``."""
        symbols, prefixes = self.read()
        put = self.columns[j - 1][:len(at)]
        # The places of equal symbols, in order, and where each symbol's begin.
        places = np.argsort(symbols, kind="stable")
        begins = np.concatenate([[0], np.cumsum(self.counts)])
        # Suffixes that begin with a symbol stand after the empty ones in the same order.
        by_symbol = np.lexsort((at, put))
        tails, put_sorted = at[by_symbol], put[by_symbol]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(put_sorted)) + 1, [len(at)]])
        index = np.empty(len(at), dtype=np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            low, high = begins[put_sorted[a]], begins[int(put_sorted[a]) + 1]
            index[a:b] = low + np.searchsorted(places[low:high], tails[a:b])
        # No end is put in, and ends sort between the symbols of texts and the core's.
        ends = int(self.counts[_END])
        new = self.count + index - np.where(put_sorted > _END, ends, 0)

        def common(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """One more than what the suffixes at low and high have in common."""
            pairs = np.stack([low + 1, high + 1], axis=1).ravel()
            return np.minimum.reduceat(self.files[0][1][:self.size + 1], pairs)[::2] + np.uint16(1)

        before, after = (np.zeros(len(at), dtype=np.uint16) for _ in range(2))
        k = index > begins[put_sorted]
        if k.any():
            before[k] = common(places[index[k] - 1], tails[k])
        k = index + 1 < begins[put_sorted.astype(np.int64) + 1]
        if k.any():
            after[k] = common(tails[k], places[index[k] + 1])
        size = self.size + len(at)
        old = np.ones(size, dtype=bool)
        old[new] = False
        next_symbols, next_prefixes = self.files[1]
        next_symbols[:size][old] = symbols
        next_prefixes[:size][old] = prefixes
        # An old suffix after a new one now has its prefix with the new one.
        follows = new + 1 < size
        follows[follows] = old[new[follows] + 1]
        next_prefixes[new[follows] + 1] = after[follows]
        next_prefixes[new] = before
        added = self.columns[j][:len(at)][by_symbol]
        next_symbols[new] = added
        self.counts += np.bincount(added, minlength=256)
        self.size = size
        now = np.empty(len(at), dtype=np.int64)
        now[by_symbol] = new
        return now

    def groups(self, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, strings, group) for each length from ``width`` on: suffixes with
        the same group number share their first ``width`` symbols."""
        symbols, prefixes = self.read()
        group = np.cumsum(prefixes < width)
        places = np.argsort(symbols, kind="stable")
        rank_of = np.empty(len(symbols), dtype=np.int64)
        rank_of[places] = np.arange(len(symbols))
        ends_at, n_ends = int(self.counts[:_END].sum()), int(self.counts[_END])
        at = np.arange(self.count)
        for j in range(1, self.longest + 1):
            at = at[:int(np.searchsorted(-self.sizes, -j, side="right"))]
            rank = rank_of[at]
            at = self.count + np.where(rank >= ends_at, rank - n_ends, rank)
            if j >= width:
                yield j, self.order[:len(at)], group[at]


def compare(keys: np.ndarray, strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each string of a batch of whole keys: which of its windows of ``width``
    symbols occur in another place of the batch, under the same key."""
    bucket = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
    length, owner, group = [], [], []
    with tempfile.TemporaryDirectory() as folder:
        for j, strings_of, groups in Transform(strings, folder).groups(width):
            length.append(np.full(len(groups), j))
            owner.append(strings_of)
            group.append(groups)
    marks = [np.zeros(len(s) - width + 1, dtype=bool) for s in strings]
    if not length:
        return marks
    length, owner, group = map(np.concatenate, (length, owner, group))
    _, same, count = np.unique(group * len(strings) + bucket[owner], return_inverse=True,
                               return_counts=True)
    twice = count[same] > 1
    for i, j in zip(owner[twice].tolist(), length[twice].tolist(), strict=True):
        marks[i][len(strings[i]) - j] = True
    return marks


def _spans(mark: np.ndarray) -> list[tuple[int, int]]:
    """Runs of marked windows as [low, high)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


_SPANS = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))


_PIECES = "key bigint, content bigint, low int, k bigint, g bigint, body binary"


def pieces(data: bytes, first: int, windows: int, core_at: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(first window, inner bytes, outer bytes) of a segment's pieces.

    The windows of a piece all hold the inner bytes, whose place is fixed
    relative to the core; in the outer bytes one symbol stands for them.
    """
    step = WIDTH - INNER
    core = first + core_at
    for band in range((core_at - windows + 1) // step, core_at // step + 1):
        low = core_at - min(core_at, band * step + step - 1)
        high = core_at - max(core_at - windows + 1, band * step)
        inner = core - band * step
        yield (low, data[inner:inner + INNER], data[first + low:inner] + bytes([_CORE_SYMBOL])
               + data[inner + INNER:first + high + WIDTH])


def _bodies(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pieces of the segments (rid, first, windows, core_at, key, content)."""
    asked = wanted.groupBy("rid").agg(F.collect_list(F.struct(
        "first", "windows", "core_at", "key", "content")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, asked in zip(batch.column("data"), batch.column("asked"), strict=True):
                data, rows = data.as_py(), asked.as_py()
                for at in range(0, len(rows), 1000):
                    made, inner = [], []
                    for r in rows[at:at + 1000]:
                        for low, core, body in pieces(data, r["first"], r["windows"], r["core_at"]):
                            made.append((r["key"], r["content"], low, body))
                            inner.append(xxhash.xxh3_128_digest(core))
                    hashes = np.frombuffer(b"".join(inner), dtype=np.int64).reshape(-1, 2)
                    key, content, low, body = zip(*made, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.int64()), pa.array(content, pa.int64()),
                         pa.array(low, pa.int32()), pa.array(hashes[:, 0].copy()),
                         pa.array(hashes[:, 1].copy()), pa.array(body, pa.binary())],
                        names=["key", "content", "low", "k", "g", "body"])

    return texts.join(asked, "rid").select("data", "asked").mapInArrow(_merged(run, 4000), _PIECES)


def _compared(bodies: DataFrame) -> DataFrame:
    """(key, content, spans) of pieces that are dealt and sorted by their own key k, g."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, bytes] = {}
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                names = list(held)
                marks = compare(np.array([n[:2] for n in names]), list(held.values()),
                                WIDTH - INNER + 1)
                spans = [[{"low": n[4] + a, "high": n[4] + b} for a, b in _spans(m)]
                         for n, m in zip(names, marks, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n[2] for n in names], pa.int64()),
                     pa.array([n[3] for n in names], pa.int64()), pa.array(spans, _SPANS)],
                    names=["key", "content", "spans"])
                held.clear()

        for batch in batches:
            for k, g, key, content, low, body in zip(*(batch.column(c).to_pylist() for c in (
                    "k", "g", "key", "content", "low", "body")), strict=True):
                if (k, g) != last and len(held) >= TOGETHER:
                    yield from flush()
                last = (k, g)
                held[k, g, key, content, low] = body
        yield from flush()

    return bodies.mapInArrow(
        run, "key bigint, content bigint, spans array<struct<low int, high int>>")


def _by_window(bodies: DataFrame) -> DataFrame:
    """Like ``_compared``, for keys of any number of pieces, by whole windows."""
    width = WIDTH - INNER + 1
    windows = stored(bodies.dropDuplicates(["k", "g", "key", "content", "low"]).selectExpr(
        "k", "g", "key", "content", "low",
        f"posexplode(transform(sequence(1, length(body) - {width - 1}), "
        f"i -> substring(body, i, {width}))) AS (at, outer)"), "windows")
    twice = windows.groupBy("k", "g", "outer").count().where("count > 1").drop("count")
    return windows.join(twice, ["k", "g", "outer"]).groupBy("key", "content").agg(
        F.collect_list(F.expr("struct(low + at AS low, low + at + 1 AS high)")).alias("spans"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(rid, spans) of the rows (rid, data): the bytes [low, high) to remove, unmerged.

    Rows of the same rid have the same text and count as several documents.
    """
    segments = stored(_segments(texts), "segments")
    keys = stored(segments.groupBy("key").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
        .where("n > 1").selectExpr("key", "low <> high AS mixed"), "keys")
    shared = stored(segments.join(keys, "key"), "shared")
    contents = stored(shared.groupBy("key", "content").agg(
        F.count("*").alias("n"), F.first("mixed").alias("mixed"),
        F.min(F.struct("rid", "first", "windows", "core_at")).alias("one")), "contents")
    whole = contents.where("n > 1").selectExpr(
        "key", "content", "array(struct(0 AS low, one.windows AS high)) AS spans")
    mixed = contents.where("mixed").selectExpr("key", "content", "one.*")
    bodies = stored(_bodies(texts, mixed), "pieces")
    counts = stored(bodies.groupBy("k", "g").count().where("count > 1"), "counts")
    few = bodies.join(counts.where(f"count <= {MOST}").select("k", "g"), ["k", "g"])
    found = _compared(few.repartition("k", "g").sortWithinPartitions("k", "g"))
    many = _by_window(bodies.join(counts.where(f"count > {MOST}").select("k", "g"), ["k", "g"]))
    # Contents that occur twice are marked as a whole already.
    found = found.unionByName(many).where("size(spans) > 0").join(
        whole.select("key", "content"), ["key", "content"], "left_anti")
    marks = stored(found.unionByName(whole), "marks")
    held = shared.select("rid", "first", "key", "content").join(marks, ["key", "content"])
    return held.selectExpr("rid", "first", "explode(spans) AS span").selectExpr(
        "rid", "first + span.low AS low", f"first + span.high + {WIDTH - 1} AS high"
    ).distinct().groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("low", "high"))).alias("spans"))


def merged_spans(spans: list[dict[str, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the sorted spans."""
    runs: list[tuple[int, int]] = []
    for span in spans:
        if runs and span["low"] <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], span["high"]))
        else:
            runs.append((span["low"], span["high"]))
    return runs


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, ``has_repeat`` (whether
    anything was removed) and ``kept``, the remaining bytes.

    A null text is empty.  Texts under 400 bytes lose nothing.  Repeated rows
    are documents of their own, so a row of 400 bytes or more that occurs twice
    goes as a whole.  Other columns are not read.
    """
    bounded(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("data"))
    rows = rows.withColumn("rid", F.unhex(F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"),
        F.lit(":").cast("binary"), F.col("data")))))
    spans = stored(repeated_spans(rows.select("rid", "data")), "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, found in zip(batch.column("data"), batch.column("spans"), strict=True):
                data = data.as_py()
                runs = merged_spans(found.as_py() or [])
                parts, at = [], 0
                for low, high in runs:
                    parts.append(data[at:low])
                    at = high
                kept = b"".join([*parts, data[at:]])
                out.append((len(data), len(data) - len(kept), len(runs),
                            hashlib.sha256(kept).hexdigest(), bool(runs), kept))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 pa.array(columns[3], pa.string()), pa.array(columns[4], pa.bool_()),
                 pa.array(columns[5], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "has_repeat",
                       "kept"])

    return rows.join(spans, "rid", "left").select("doc_id", "data", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
             "kept_sha256 string, has_repeat boolean, kept binary")

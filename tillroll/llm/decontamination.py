"""Operator 9: benchmark decontamination by spaced seeds.

Test items and training texts are read as lower-cased words without marks at their edges.  At
each place three fixed masks hash six of ten words and ignore the others, so a
seed still hits when ignored words were replaced: any two replaced words in a
passage of 13 leave a hit.  Items of at most ``SEGMENTED`` words are also cut into one
more segment than a fifth of their words, so one segment stays whole.  Each hit gives a place of the item in the text; along it
the best agreeing stretch, replaced words allowed, is taken.  It is an overlap if it has
``MIN_WORDS`` equal words and at most a fifth of its words differ; so is the
whole item if at most a fifth of its words differ.  Items under ``SHORTEST`` words are
overlaps where they stand whole and unchanged.

1. Items become a table of words and a table of seeds.  A bit array of fixed size over the
   seeds (a Bloom filter) is broadcast.
2. One scan reads each text once, whatever the number of items, and keeps the words and
   seeds of texts with a seed in the filter.  Equal texts are one from here on.
3. These seeds and the items' are joined in Spark; a pair of text and item with a common seed is
   checked word by word, with the words from the tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded, unused, utf8, word_blocks

SPAN = 10
# Fixed masks: the places of a window that are hashed.
MASKS = ((0, 1, 3, 7, 8, 9), (0, 2, 3, 6, 7, 9), (0, 1, 4, 5, 6, 9))
MIN_WORDS = 13
MIN_SHARE = 0.8
# Items of fewer words are searched as they are, without replaced words.
SHORTEST = 8
# Documents go for whole items of so many words or more; fewer are common phrases.
EVIDENCE = 5
# Beyond so many words, a fifth replaced leaves some 13 words with at most two replaced:
# three in each 13 would be more, 3 * (n // 13) > n // 5.
SEGMENTED = 90
# Bits of the filter (8 MB, at any number of items); a seed sets three.
FILTER_BITS = 1 << 26

_EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_"
_MEMO = 500_000
_PART = 1 << 20


class _Hashes(dict):
    """Hashes of words, made when first asked for; words of marks alone have 0."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_EDGES)
        found = self[word] = (xxhash.xxh64_intdigest(bare) | 1) if bare else 0
        return found


class Words:
    """Word hashes of texts, remembered for a bounded number of words."""

    def __init__(self) -> None:
        self.memo = _Hashes()

    def __call__(self, data: bytes) -> np.ndarray:
        """Hashes of the words; words of marks alone are passed over."""
        parts = []
        for words in word_blocks(data.decode().lower().encode()):
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            parts.append(np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words)))
        made = np.concatenate(parts)
        return made[made != 0]


# An odd factor for each place of a window.
_FACTORS = [np.uint64(int.from_bytes(hashlib.sha256(b"place %d" % i).digest()[:8], "little") | 1)
            for i in range(SPAN)]


def _products(words: np.ndarray, masks: list[tuple[int, ...]]) -> dict[int, np.ndarray]:
    """The words times the factor of each place that the masks look at."""
    return {place: words * _FACTORS[place] for place in {p for mask in masks for p in mask}}


def _seeds(products: dict[int, np.ndarray], mask: tuple[int, ...]) -> np.ndarray:
    n = len(products[0]) - mask[-1]
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    salt = int.from_bytes(hashlib.sha256(repr(mask).encode()).digest()[:8], "little")
    made = products[0][:n] + np.uint64(salt)
    for place in mask[1:]:
        made += products[place][place:place + n]
    for shift, factor in ((32, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
        made ^= made >> np.uint64(shift)
        made *= np.uint64(factor)
    made ^= made >> np.uint64(32)
    return made


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """One hash for each place where the mask fits."""
    return _seeds(_products(words, [mask]), mask)


def seeds_of(n_words: int) -> list[tuple[tuple[int, ...], list[int]]]:
    """The masks of an item and its places where each is looked up."""
    if n_words < SHORTEST:
        return [(tuple(range(n_words)), [0])] if n_words else []
    made = [(m, list(range(n_words - SPAN + 1))) for m in MASKS if n_words >= SPAN]
    if n_words <= SEGMENTED:
        parts = n_words // 5 + 1
        made.append((tuple(range(n_words // parts)), [i * n_words // parts for i in range(parts)]))
    return made


def item_seeds(words: np.ndarray) -> np.ndarray:
    """The different seeds of an item."""
    made = [seeds(words, mask)[at] for mask, at in seeds_of(len(words))]
    return np.unique(np.concatenate(made)) if made else np.empty(0, np.uint64)


def _shifts(size: int) -> tuple[int, ...]:
    """Where in a seed the numbers of its bits in a filter of this size stand."""
    bits = size.bit_length() - 1
    return (64 - bits, 64 - 2 * bits, 0)


class Filter:
    """The bit array, and a smaller one that most seeds are told apart by."""

    def __init__(self, held: np.ndarray):
        """``held`` are the words of the array."""
        self.held, self.size = held, 64 * len(held)
        # Whether any of sixteen neighbouring bits is set.
        self.near = held.view(np.uint16) != 0
        self.near_shift = np.uint64(64 - self.size.bit_length() + 1 + 4)

    def places(self, made: np.ndarray) -> np.ndarray:
        """Places of the seeds whose bits are all set."""
        at = np.flatnonzero(self.near[made >> self.near_shift])
        for shift in _shifts(self.size):
            bit = (made[at] >> np.uint64(shift)) & np.uint64(self.size - 1)
            at = at[(self.held[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)) > 0]
        return at


def candidates(texts: list[np.ndarray], masks: list[tuple[int, ...]],
               known: Filter) -> dict[int, np.ndarray]:
    """{text: its different seeds that the filter has}, for texts that have any.

    The texts' words are looked at in one row, a bounded part at a time.
    """
    words = np.concatenate([*texts, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    found: dict[int, list[np.ndarray]] = {}
    for start in range(0, len(words) if masks else 0, _PART):
        products = _products(words[start:start + _PART + SPAN - 1], masks)
        for mask in masks:
            made = _seeds(products, mask)
            at = known.places(made)
            first = owner[start + at]
            # Not over the end of a text.
            inside = first == owner[start + at + mask[-1]]
            at, first = at[inside], first[inside]
            for text in np.unique(first).tolist():
                found.setdefault(text, []).append(made[at[first == text]])
    return {text: np.unique(np.concatenate(parts)) for text, parts in sorted(found.items())}


def offsets(words: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Places of the item's first word in the text (or before it), by common seeds."""
    hit = np.zeros(len(words) + len(item), dtype=bool)
    for mask, at in seeds_of(len(item)):
        places: dict[int, list[int]] = {}
        for place, seed in zip(at, seeds(item, mask)[at].tolist(), strict=True):
            places.setdefault(seed, []).append(place)
        wanted = np.array(sorted(places), dtype=np.uint64)
        for start in range(0, len(words), _PART):
            made = seeds(words[start:start + _PART + mask[-1]], mask)
            found = np.flatnonzero(np.isin(made, wanted))
            for seed in np.unique(made[found]).tolist():
                here = start + found[made[found] == np.uint64(seed)]
                for place in places[seed]:
                    hit[here - place + len(item)] = True
    return np.flatnonzero(hit) - len(item)


def overlap(words: np.ndarray, item: np.ndarray) -> tuple[int, int, int] | None:
    """(equal words, words, start in the text) of the item's best verified overlap."""
    best = None
    for offset in offsets(words, item).tolist():
        low, high = max(0, -offset), min(len(item), len(words) - offset)
        same = item[low:high] == words[low + offset:high + offset]
        run = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
        end = int(np.argmax(run - np.minimum.accumulate(run)))
        start = int(np.argmin(run[:end + 1]))
        length, equal = end - start, int(same[start:end].sum())
        if same.sum() >= (MIN_SHARE if len(item) >= SHORTEST else 1) * len(item):
            start, length, equal = 0, len(same), int(same.sum())
        elif equal < MIN_WORDS or equal < MIN_SHARE * length:
            continue
        if best is None or equal > best[0]:
            best = (equal, length, low + offset + start)
    return best


def _words_of(data: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), dtype=np.uint64)


def _known(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_no, item_id, n, item_words): the items that have words, numbered."""
    rows = items.select(F.monotonically_increasing_id().alias("item_no"),
                        F.col(item_id).cast("bigint").alias("item_id"), utf8(text).alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Words()
        for batch in batches:
            made = [hashed(x.as_py()) for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_no"), batch.column("item_id"),
                 pa.array([len(m) for m in made], pa.int64()),
                 pa.array([m.tobytes() for m in made], pa.binary())],
                names=["item_no", "item_id", "n", "item_words"])

    # The numbers are fixed by writing them.
    return stored(rows.mapInArrow(
        run, "item_no bigint, item_id bigint, n bigint, item_words binary").where("n > 0"), "items")


def _seed_table(known: DataFrame) -> DataFrame:
    """(seed, item_no): the different seeds of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words in zip(batch.column("item_no"), batch.column("item_words"), strict=True):
                made = item_seeds(_words_of(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.view(np.int64)), pa.array(np.full(len(made), number.as_py()))],
                    names=["seed", "item_no"])

    return stored(known.select("item_no", "item_words").mapInArrow(
        run, "seed bigint, item_no bigint"), "seeds")


def _filter(found: DataFrame) -> np.ndarray:
    """The filter's words.  At most ``FILTER_BITS`` / 64 rows reach the driver."""
    places = [f"shiftrightunsigned(seed, {shift}) & {FILTER_BITS - 1}"
              for shift in _shifts(FILTER_BITS)]
    table = (found.selectExpr(f"explode(array({', '.join(places)})) AS place")
             .groupBy(F.expr("place DIV 64").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS int)))").alias("bits")).toArrow())
    held = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    held[np.array(table["word"], dtype=np.int64)] = np.array(table["bits"], dtype=np.int64).view(np.uint64)
    return held


def _node(text: str):
    return F.md5(utf8(text))


def verified(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
             item_text: str = "text") -> DataFrame:
    """(node, item_id, n, equal_words, words, first_word): overlaps of different texts (by the
    hash of the text) and items, n the item's words.  Written to the shared folder."""
    spark = bounded(docs.sparkSession)
    known = _known(items, item_id, item_text)
    found = _seed_table(known)
    # Longer items all have the same masks.
    lengths = known.selectExpr(f"CAST(least(n, {SEGMENTED + 1}) AS int) AS n").distinct().collect()
    masks = sorted({mask for r in lengths for mask, _ in seeds_of(r["n"])})
    held = spark.sparkContext.broadcast(_filter(found))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, known = Words(), Filter(held.value)
        for batch in batches:
            texts = [hashed(x.as_py()) for x in batch.column("data")]
            hits = candidates(texts, masks, known)
            kept, own = list(hits), [h.view(np.int64) for h in hits.values()]
            words = [texts[i].tobytes() for i in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(kept, pa.int64())),
                 pa.array(words, pa.binary()), pa.array(own, pa.list_(pa.int64()))],
                names=["node", "doc_words", "seeds"])

    hits = docs.select(_node(text).alias("node"), utf8(text).alias("data")).mapInArrow(
        scan, "node string, doc_words binary, seeds array<bigint>")
    # Written as they come, so that the scan is done once; then one row for each text.
    hits = stored(hits, "hits")
    hits = stored(hits.groupBy("node").agg(
        F.first("doc_words").alias("doc_words"), F.first("seeds").alias("seeds")), "hits")
    pairs = hits.select("node", F.explode("seeds").alias("seed")).join(found, "seed").select(
        "node", "item_no").distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, best = [], []
            for i, (a, b) in enumerate(zip(batch.column("doc_words"), batch.column("item_words"),
                                           strict=True)):
                made = overlap(_words_of(a), _words_of(b))
                if made:
                    kept.append(i)
                    best.append(made)
            part = batch.select(["node", "item_id", "n"]).take(pa.array(kept, pa.int64()))
            equal, words, first = zip(*best, strict=True) if best else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(equal, pa.int32()), pa.array(words, pa.int32()),
                 pa.array(first, pa.int64())],
                names=["node", "item_id", "n", "equal_words", "words", "first_word"])

    joined = pairs.join(known, "item_no").join(hits.select("node", "doc_words"), "node")
    return stored(joined.select("node", "item_id", "n", "doc_words", "item_words").mapInArrow(
        check, "node string, item_id bigint, n bigint, equal_words int, words int, "
               "first_word bigint"), "overlaps")


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
             item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row per document and item that overlap: ids, equal words, words of the
    overlap, its first word in the document, and the item's share that is there.

    Null and empty texts and items overlap with nothing, nor does anything with an empty
    benchmark; repeated documents and items give repeated rows; of equally good places the
    first is told; texts and items are taken whole at any length; other columns are not read.
    """
    found = verified(docs, items, text, item_id, item_text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), _node(text).alias("node"))
    return rows.join(found, "node").selectExpr(
        "doc_id", "item_id", "equal_words", "words", "first_word",
        "CAST(equal_words AS double) / n AS item_share")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  evidence: int = EVIDENCE) -> DataFrame:
    """The documents that overlap with no item of ``evidence`` words or more, with all their
    columns.  Null and empty texts stay."""
    found = verified(docs, items, text, item_id, item_text)
    (node,) = unused(docs, "node")
    leaked = found.where(f"n >= {int(evidence)}").select(F.col("node").alias(node)).distinct()
    return docs.withColumn(node, _node(text)).join(leaked, node, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])

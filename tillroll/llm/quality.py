"""Operator 5: quality rules and gradient-boosted trees over document statistics.

Base rules come first; documents that pass them are judged by boosted trees
over statistics of the text.  The trees are fitted to log loss by histograms,
with monotonic constraints: more repetition or more symbols never raise a
score.  All trees are flattened into numpy node arrays, so a batch of documents
walks down all of them at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded, utf8, word_blocks

MIN_WORDS = 50
# Rows that the trees are fitted on at most: those of smallest id hash.
FIT_ROWS = 20_000
THRESHOLD = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Feature -> sign of the effect it may have on the score; 0: free.
FEATURES = {
    "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": 0, "mark_share": 0, "digit_share": 0, "line_words": 0,
    "distinct_share": 0, "log_words": 0, "bang_share": -1,
}
_SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
_SPACES = np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8)
_MARKS = np.frombuffer(b"!?.,;:'\"()-", dtype=np.uint8)


def _word_ids(data: bytes) -> tuple[np.ndarray, int]:
    ids: dict[bytes, int] = {}
    parts = [np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
             for words in word_blocks(data)]
    return np.concatenate(parts), len(ids)


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words in three-word windows that are found twice or more."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * kinds + ids[1:]
    if kinds < 2_000_000:
        keys = pairs[:-1] * kinds + ids[2:]
    else:
        keys = np.unique(pairs, return_inverse=True)[1][:-1] * kinds + ids[2:]
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def statistics(data: bytes) -> tuple[list[int], list[float]]:
    """The five counts and the features of one text."""
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    ids, kinds = _word_ids(data)
    n_words = len(ids)
    points = int(seen.sum() - seen[0x80:0xC0].sum())
    word_chars = points - int(seen[_SPACES].sum())
    n_symbols = int(seen[_SYMBOLS].sum())
    lines: set[bytes] = set()
    n_lines = n_dup = start = 0
    while start <= len(data):
        stop = data.find(b"\n", start)
        stop = len(data) if stop < 0 else stop
        line = data[start:stop]
        start = stop + 1
        if line.strip():
            n_lines += 1
            if line in lines:
                n_dup += 1
            else:
                lines.add(line)
    n_repeat = repeated_words(ids, kinds)
    chars, words = max(word_chars, 1), max(n_words, 1)
    features = [
        word_chars / words, n_symbols / chars, n_dup / max(n_lines, 1), n_repeat / words,
        seen[0x41:0x5B].sum() / chars, seen[_MARKS].sum() / chars,
        seen[0x30:0x3A].sum() / chars, n_words / max(n_lines, 1), kinds / words,
        float(np.log1p(n_words)), seen[0x21] / words,
    ]
    return [n_words, word_chars, n_symbols, n_dup, n_repeat], [float(x) for x in features]


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the counts and ``features`` of each document; null counts as empty."""
    bounded(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(x.as_py()) for x in batch.column(1)]
            counts = [pa.array([m[0][i] for m in made], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([m[1] for m in made], pa.list_(pa.float64()))],
                names=["doc_id", *COUNTS, "features"])

    return docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("data")).mapInArrow(
        run, schema)


@dataclass
class Trees:
    """Boosted trees as node arrays; the children of a leaf are the leaf itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds: every row stands at a node of every tree, all step down together."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            down = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(down, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 3,
        rate: float = 0.2, bins: int = 64, least: int = 10, ridge: float = 1.0) -> Trees:
    """Trees for P(y = 1), by second-order boosting on quantile histograms.

    A split on a feature with sign s is taken only if s * (right - left) >= 0
    holds for the leaf values, and its halves are bounded by their middle, so
    the score is monotonic in that feature.
    """
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
            for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], 1)
    rate_one = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_one / (1 - rate_one)))
    score = np.full(n, base)
    nodes: list[list[float]] = []
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int,
             low: float, high: float) -> int:
        me = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value = float(np.clip(-total_g / (total_h + ridge), low, high))
        nodes.append([0, np.inf, me, me, rate * value])
        if level == depth or len(rows) < 2 * least:
            score[rows] += rate * value
            return me
        best = (1e-6, 0, 0, 0.0)
        for f in range(width):
            size = len(cuts[f]) + 1
            if size < 2:
                continue
            at = binned[rows, f]
            left_g = np.cumsum(np.bincount(at, g[rows], size))[:-1]
            left_h = np.cumsum(np.bincount(at, h[rows], size))[:-1]
            count = np.cumsum(np.bincount(at, minlength=size))[:-1]
            right_g, right_h = total_g - left_g, total_h - left_h
            wl = np.clip(-left_g / (left_h + ridge), low, high)
            wr = np.clip(-right_g / (right_h + ridge), low, high)

            def gain(w, gg, hh):
                return -(gg * w + 0.5 * (hh + ridge) * w * w)

            won = gain(wl, left_g, left_h) + gain(wr, right_g, right_h) - gain(
                value, total_g, total_h)
            fits = (count >= least) & (len(rows) - count >= least)
            fits &= (signs[f] * (wr - wl) >= 0)
            won = np.where(fits, won, -np.inf)
            k = int(np.argmax(won))
            if won[k] > best[0]:
                best = (float(won[k]), f, k, float((wl[k] + wr[k]) / 2))
        if best[0] <= 1e-6:
            score[rows] += rate * value
            return me
        _, f, k, middle = best
        go = binned[rows, f] <= k
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        lefts, rights = bounds.get(int(signs[f]), ((low, high), (low, high)))
        nodes[me][:2] = [f, float(cuts[f][k])]
        nodes[me][2] = grow(rows[go], g, h, level + 1, *lefts)
        nodes[me][3] = grow(rows[~go], g, h, level + 1, *rights)
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -8.0, 8.0))
    table = np.array(nodes)
    return Trees(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int),
                 table[:, 3].astype(int), table[:, 4], np.array(roots), depth, base)


def fit_on_labels(stats: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> Trees | None:
    """Trees from at most ``limit`` labelled documents, those of smallest id hash.

    Labels without id or grade are passed over; of several labels of a document
    the lowest counts.  None if not both grades are there.
    """
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    chosen = (known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(limit))
    rows = (stats.join(chosen, "doc_id").select("doc_id", "features", "quality")
            .dropDuplicates(["doc_id"]).orderBy("doc_id").collect())
    y = np.array([float(r.quality > 0) for r in rows])
    if len(set(y)) < 2:
        return None
    return fit(np.array([r.features for r in rows]), y, np.array(list(FEATURES.values())))


def judge(stats: DataFrame, model: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts with ``base_failed``, ``score`` (probability of good) and ``kept``."""
    fields = [f for f in stats.schema.fields if f.name != "features"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), dtype=float)
            if model is None or not len(x):
                score = np.ones(batch.num_rows)
            else:
                score = 1 / (1 + np.exp(-model.score(x)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in fields] + [pa.array(score)],
                names=[f.name for f in fields] + ["score"])

    scored = stats.mapInArrow(run, schema + ", score double")
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"
    return scored.withColumn("base_failed", F.expr(failed)).withColumn(
        "kept", F.expr(f"NOT base_failed AND score >= {threshold}"))


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Per document its counts, the base rules' result, score and verdict.

    Empty and null texts fail the base rules.  Without labels of both grades
    the base rules alone decide.  Repeated rows stay; other columns are not read.
    """
    stats = stored(text_statistics(docs, doc_id, text), "statistics")
    model = fit_on_labels(stats, labels)
    return judge(stats, model).select(
        "doc_id", *COUNTS, "base_failed", "kept", "score")

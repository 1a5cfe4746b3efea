"""Counts against a plain version, monotonic trees, and held-out accuracy."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from tillroll.llm import quality

SMALL = Path("/root/testdata/sf0.01")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(2)
    words = ["a", "bb", "ü", "x#", "C", "the", "\x1c", "\xa0"]
    made = [None, "", "\n\n", "one", "a b c a b c", "a a a a", "a\r\na\r\na", " x \n x\nx "]
    made += ["".join(w + rng.choice(" \n\t\x0b") for w in rng.choices(words, k=n))
             for n in (30, 60, 500)]
    made.append(" ".join(f"w{i}" for i in range(300_000)) + " w1 w2 w3")
    return made


def test_counts_and_base_rules(spark):
    rows = [(i, t, 1, 2) for i, t in enumerate(texts())] + [(1, "one", 3, 4), (None, "z", 5, 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, features int, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted((tuple(r)[:8] for r in quality.quality(frame, labels).collect()), key=repr)
    want = []
    for i, t, _, _ in rows:
        counts = plain(t)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append((i, *counts, failed, not failed))
    assert got == sorted(want, key=repr)
    assert quality.quality(frame.limit(0), labels).count() == 0


def test_many_word_kinds():
    ids = np.random.default_rng(1).integers(0, 50, 400)
    assert quality.repeated_words(ids, 50) == quality.repeated_words(ids, 3_000_000)


def test_trees_are_monotonic_and_fit():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1] + 0.1 * rng.standard_normal(3000)) < 0.8).astype(float)
    trees = quality.fit(x, y, np.array([-1, 0, 1]))
    assert ((trees.score(x) > 0) == (y > 0)).mean() > 0.9
    line = np.linspace(0, 1, 200)
    for fixed in rng.random((20, 3)):
        for feature, sign in ((0, -1), (2, 1)):
            rows = np.tile(fixed, (200, 1))
            rows[:, feature] = line
            assert (sign * np.diff(trees.score(rows)) >= -1e-12).all()


def test_scores_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(8)
    x = np.round(rng.random((400, 4)), 2)
    trees = quality.fit(x, (x[:, 0] * x[:, 1] > 0.3).astype(float), np.zeros(4), trees=15)
    rows = np.vstack([rng.random((300, 4)), x[:50], [[np.inf, -np.inf, 0, 1]]])
    want = []
    for row in rows:
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                smaller = row[trees.feature[node]] <= trees.threshold[node]
                node = trees.left[node] if smaller else trees.right[node]
            total += trees.value[node]
        want.append(total)
    assert np.allclose(trees.score(rows), want, atol=1e-12)


@pytest.mark.skipif(not SMALL.is_dir(), reason="test tables not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    fitted = labels.where("doc_id % 2 = 0")
    rows = quality.quality(docs, fitted).join(labels.where("doc_id % 2 = 1"), "doc_id").where(
        "NOT base_failed").collect()
    assert sum(r.kept == (r.quality > 0) for r in rows) > 0.95 * len(rows)

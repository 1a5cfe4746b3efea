"""Repeat removal against all windows, and the transform against sorted suffixes."""

import hashlib
import random
import tempfile
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import repeats

FIELDS = "doc_id long, text string, rid string, key int"


def plain(texts):
    seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - 399):
            if seen[text[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def check(spark, rows):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], FIELDS)
    got = sorted((tuple(r)[:5] for r in repeats.without_repeats(frame).collect()), key=repr)
    want = plain([(t or "").encode() for _, t in rows])
    assert got == sorted(((d, *w) for (d, _), w in zip(rows, want)), key=repr)
    return got


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefé ñ", k=rng.randrange(2, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    passage = prose(120)
    rows = [None, "", "short", "x" * 399, "x" * 400, "y" * 1500, "ab" * 900, passage,
            prose(3000) + passage[:401] + prose(20) + passage[-399:],
            passage[100:500], passage[100:499], passage[101:500] + "!"]
    exact = passage[:400]
    rows += [prose(30) + exact + prose(30) for _ in range(3)]
    rows += [prose(30) + exact[:399] + prose(30) for _ in range(3)]
    rows += [prose(40) + passage[k:k + 380] + prose(40) for k in range(0, 120, 7)]
    for _ in range(12):
        base = prose(rng.choice([150, 400])).split(" ")
        rows.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randrange(1, 4)):
                copy[rng.randrange(len(copy))] = "edited"
            rows.append(" ".join(copy))
    rows += [rows[20], rows[20], prose(200) * 2]
    return list(enumerate(rows)) + [(4, "x" * 400), (None, prose(90)), (None, None)]


def test_equals_all_windows(spark):
    got = check(spark, corpus())
    assert sum(r[2] > 0 for r in got) > 30


def test_small_parts_and_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MOST", 3)
    monkeypatch.setattr(repeats, "TOGETHER", 5)
    check(spark, corpus())


def test_part_edges(spark):
    keys = repeats.Keys(part=37)
    whole = repeats.Keys()
    text = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta"], k=300)).encode()

    def by_window(made):
        return {int(f) + i: int(k) for first, count, _, key in made
                for f, n, k in zip(first, count, key) for i in range(int(n))}

    assert by_window(keys.segments(text)) == by_window(whole.segments(text))
    assert sorted(by_window(whole.segments(text))) == list(range(len(text) - 399))


def test_no_texts(spark):
    check(spark, [])
    check(spark, [(1, None), (2, "")])


@pytest.mark.parametrize("seed", range(20))
def test_transform_equals_sorted_suffixes(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choices(b"ab\xff", k=rng.randrange(1, 14)))
               for _ in range(rng.randrange(1, 9))]
    with tempfile.TemporaryDirectory() as folder:
        made = repeats.Transform(strings, folder)
        symbols, prefixes = (x.tolist() for x in made.read())
        groups = [(j, o.tolist(), g.tolist()) for j, o, g in made.groups(3)]
        order = made.order.tolist()
    rank = {i: r for r, i in enumerate(order)}
    suffixes = sorted(((strings[i][len(strings[i]) - j:], rank[i], i, j)
                       for i in rank for j in range(len(strings[i]) + 1)),
                      key=lambda s: ([c + 1000 for c in s[0]] + [s[1]]))
    assert symbols == [strings[i][-j - 1] if j < len(strings[i]) else repeats._END
                       for _, _, i, j in suffixes]

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert prefixes == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
    place = {(i, j): k for k, (_, _, i, j) in enumerate(suffixes)}
    number = np.cumsum(np.array(prefixes) < 3)
    for j, owners, found in groups:
        assert found == [number[place[i, j]] for i in owners]

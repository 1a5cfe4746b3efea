"""Mixes against a plain water filling, and the prefix sums."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tillroll.llm import mixing, prefix

FIELDS = "doc_id long, text string, source string, size int, key string"


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    target = {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def docs(n, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])),
             rng.choice(["a", "a", "a", "a", "b", "ä", "Z", None, "", "q"])) for i in range(n)]
    rows += [(None, None, "a"), (None, None, None), (3, rows[3][1], rows[3][2]), (5, "x y", "zero"),
             (n + 1, None, "empty"), (n + 2, "word " * 90_000, "long")]
    return rows


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], FIELDS)


def test_mix_meets_targets(spark):
    rows = docs(400, 1)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    want = plain_targets(sizes)
    got = mixing.mix(frame_of(spark, rows)).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, size_of(t)) for d, t, _ in rows)
    taken, by_target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source_size, r.target] += r.taken
    for s, t in want.items():
        match = [k for k in taken if k[0] == sizes[s] and abs(k[1] - t) < 1e-6 * max(t, 1)]
        assert match, (s, t)
        by_target[s] = match[0]
    for (_, target), words in taken.items():
        n = sum(by_target[s][1] == target for s in want)
        assert n * (target - 1) < words <= n * target + 1e-6
    again = mixing.mix(frame_of(spark, rows[::-1])).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixed_rows(spark):
    rows = docs(300, 2)
    frame = frame_of(spark, rows)
    made = mixing.mixed(frame)
    assert made.columns == frame.columns
    got = Counter((r.doc_id, r.text, r.source) for r in made.collect())
    plan = mixing.mix(frame).collect()
    sizes = {(d, t): size_of(t) for d, t, _ in rows}
    words = Counter()
    for (d, t, s), n in got.items():
        words[s] += n * sizes[d, t]
    source = {(d, size_of(t)): s for d, t, s in rows}
    want = Counter()
    for r in plan:
        want[source[r.doc_id, r["size"]]] += r.taken
    largest = Counter()
    for d, t, s in rows:
        largest[s] = max(largest[s], size_of(t))
    for s in want:
        assert want[s] <= words[s] <= want[s] + largest[s]
    assert mixing.mix(frame.limit(0)).count() == 0 and mixing.mixed(frame.limit(0)).count() == 0


def test_prefix_sums(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix, "PARTS", 3)
    rng = random.Random(3)
    rows = [(rng.choice("aab"), hashlib.md5(str(i).encode()).hexdigest(), rng.randrange(9), "p")
            for i in range(700)]
    spark.createDataFrame(rows, "g string, key string, v long, part string").write.parquet(
        str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    for groups in (["g"], []):
        got = prefix.with_prefix(frame, groups, "key", F.col("v"), rows=50)
        assert set(got.columns) == {*frame.columns, "before"}
        sums = Counter()
        for r in sorted(got.collect(), key=lambda r: r.key):
            group = r.g if groups else ""
            assert r.before == sums[group]
            sums[group] += r.v

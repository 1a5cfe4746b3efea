"""Shards: sizes, slots, and copies that stay together."""

import random
import zlib
from collections import Counter, defaultdict

from tillroll.llm import sharding

FIELDS = "doc_id long, text string, shard string, uid int"


def rows_of(copies, alone):
    rng = random.Random(4)
    rows, i = [], 0
    for group, n in enumerate(copies):
        for _ in range(n):
            rows.append((i, f"text of group {group}", "s", 1))
            i += 1
    for _ in range(alone):
        rows.append((i, f"own text {i}", "s", 1))
        i += 1
    rng.shuffle(rows)
    return rows


def check(spark, rows):
    got = sharding.shards_of(spark.createDataFrame(rows, FIELDS)).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in rows)
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 8
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    shards = defaultdict(Counter)
    for r in got:
        shards[r.text_crc32][r.shard] += 1
    return shards, {zlib.crc32((t or "").encode()): t for _, t, _, _ in rows}


def test_groups_stay_together(spark):
    shards, _ = check(spark, rows_of([2, 3, 5, 8, 2, 2, 4, 6, 12, 20] * 2, 900))
    assert all(len(s) == 1 for s in shards.values())


def test_a_group_of_a_third_fills_few_shards(spark):
    shards, names = check(spark, rows_of([400, 2, 2, 3], 790))
    for key, s in shards.items():
        assert len(s) <= (4 if names[key] == "text of group 0" else 1)


def test_all_linked(spark):
    rows = rows_of([2] * 60 + [3] * 20, 0)
    shards, _ = check(spark, rows)
    assert sum(len(s) > 1 for s in shards.values()) <= 16


def test_odd_rows(spark):
    rows = [(None, None, "s", 1), (None, None, "s", 2), (1, "", "s", 3), (1, "", "s", 4),
            (1, "é", "s", 5), (2, "long " * 100_000, "s", 6)]
    check(spark, rows)
    check(spark, [])
    frame = spark.createDataFrame(rows, FIELDS)
    made = sharding.with_shard(frame)
    assert made.columns == [*frame.columns, "shard_", "slot"]
    assert Counter(r.uid for r in made.collect()) == Counter(r[3] for r in rows)
    assert len({(r.shard_, r.slot) for r in made.collect()}) == len(rows)
    assert sharding.with_shard(frame.limit(0)).count() == 0


def test_rounds_lower_the_cut(spark):
    rows = rows_of([400, 60, 40] + [2] * 60 + [3] * 20, 500)
    frame = spark.createDataFrame(rows, FIELDS)
    made = sharding.with_shard(frame)
    apart = sharding.cut(made, ["text"], "shard_").first()
    assert apart.linked == 680
    shards = defaultdict(Counter)
    for r in made.collect():
        shards[r.text][r.shard_] += 1
    assert apart.apart == sum(sum(s.values()) - max(s.values()) for s in shards.values())
    # Dealt by hash about seven eighths are apart; the group of 400 alone needs three shards.
    dealt = frame.selectExpr("text", "pmod(xxhash64(doc_id), 8) AS shard")
    assert sharding.cut(dealt, ["text"]).first().apart > 400
    assert apart.apart < 330
    assert tuple(sharding.cut(frame.limit(0).selectExpr("text", "0 AS shard"), ["text"]).first()) == (0, 0)


def test_a_hot_row_is_in_no_window_of_its_key(spark):
    """A third of the rows have one id and text: their texts never come to one task."""
    rows = [(7, "hot " * 50, "s", 1)] * 400 + rows_of([], 800)
    frame = spark.createDataFrame(rows, FIELDS).repartition(4)
    made = sharding.with_shard(frame)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan
    assert len({(r.shard_, r.slot) for r in made.collect()}) == 1200

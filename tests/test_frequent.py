"""The most frequent values against plain counts."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from tillroll.operators import frequent


def skewed(rows, distinct, seed=1):
    rng = random.Random(seed)
    return [f"v{min(distinct, int(rng.paretovariate(0.9)))}" for _ in range(rows)]


def plain(values, top, nulls=True):
    counts = Counter(v for v in values if nulls or v is not None)
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    return [(v, n, i + 1) for i, (v, n) in enumerate(order[:top])]


def of_column(df, name):
    return sorted(((r.value, r.rows, r.rank) for r in df.where(f"column_name = '{name}'").collect()),
                  key=lambda r: r[2])


@pytest.mark.parametrize("nulls", [True, False])
@pytest.mark.parametrize("tracked,held", [(2048, 1 << 16), (40, 60), (20, 20)])
def test_equals_plain_counts(spark, tracked, held, nulls):
    rng = random.Random(2)
    rows = [(v, i % 700, rng.choice([None, "x", "y"])) for i, v in enumerate(skewed(6000, 900))]
    frame = spark.createDataFrame(rows, "a string, b int, c string").repartition(5)
    got = frequent.most_frequent(frame, ["a", "b", "c"], 10, nulls=nulls, tracked=tracked, held=held)
    for at, name in enumerate("abc"):
        values = [None if r[at] is None else str(r[at]) for r in rows]
        assert of_column(got, name) == plain(values, 10, nulls)


def test_only_summaries_cross_the_exchange(spark):
    """Many distinct values, some frequent: a task hands on no more than its counters."""
    values = skewed(20_000, 50, 3) + [f"once{i}" for i in range(20_000)]
    random.Random(4).shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    made = frequent.summaries(frame, tracked=30, held=200)
    assert made.count() <= 4 * 30 + 2
    got = frequent.most_frequent(frame, ["v"], 5, tracked=30, held=200)
    assert of_column(got, "v") == plain(values, 5)
    # Proven from the candidates: no plan counts all values.
    assert "LocalLimit" not in got._jdf.queryExecution().toString()


def test_unproven_columns_are_counted_in_full(spark):
    values = [f"u{i % 3000}" for i in range(6001)]
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    got = frequent.most_frequent(frame, ["v"], 4, tracked=20, held=50)
    assert of_column(got, "v") == plain(values, 4)


def test_error_bounds_every_count():
    values = skewed(9000, 5000, 7)
    true = Counter(values)
    for tracked, held in [(10, 10), (50, 80), (500, 500)]:
        counter = frequent.Counters(held)
        for i in range(0, len(values), 111):
            counter.add(pa.array([*values[i:i + 111], None]))
        (batch,) = counter.rows("v", tracked)
        rows = batch.to_pylist()
        error = rows[-1]["n"]
        kept = {r["value"]: r["n"] for r in rows if r["kind"] == 0}
        assert len(kept) <= tracked and rows[-2]["n"] == len(range(0, len(values), 111))
        assert all(kept.get(v, 0) <= n <= kept.get(v, 0) + error for v, n in true.items())


def test_nothing(spark):
    frame = spark.createDataFrame([], "a string, b int")
    assert frequent.most_frequent(frame, ["a", "b"], 3).count() == 0
    frame = spark.createDataFrame([(None, 1)], "a string, b int")
    assert of_column(frequent.most_frequent(frame, ["a", "b"], 3), "a") == [(None, 1, 1)]

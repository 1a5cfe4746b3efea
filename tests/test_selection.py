"""Quantiles by refined histograms against sorted lists."""

import math
import random
from decimal import Decimal

import pytest

from tillroll.operators.selection import quantiles

POINTS = {"least": 0.0, "Q1": 0.25, "median": 0.5, "high": 0.9, "most": 1.0}


def plain(values):
    ordered = sorted(values, key=lambda v: (v != v, v))
    return {k: ordered[max(1, math.ceil(p * len(ordered))) - 1] for k, p in POINTS.items()}


def odd_values(kind):
    rng = random.Random(3)
    if kind == "double":
        return [rng.choice([0.0, 1.5, -1e308, 1e308, 1e-300, 3e-300, rng.random(), math.inf, -math.inf])
                for _ in range(900)]
    if kind == "bigint":
        # Neighbours that are the same as doubles, and the ends of the type.
        return [(1 << 62) + rng.randrange(9) for _ in range(500)] + [-(1 << 63), (1 << 63) - 1, 0]
    if kind == "decimal(38,10)":
        return [Decimal(rng.randrange(10**30)) / 10**10 for _ in range(300)]
    if kind == "float":
        return [0.5 * rng.randrange(40) for _ in range(200)]
    return [rng.randrange(-90, 90) for _ in range(400)]


@pytest.mark.parametrize("buckets", [4, 1024])
@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(38,10)", "int", "float"])
def test_equals_sorted_values(spark, kind, buckets):
    values = odd_values(kind)
    if buckets == 4:
        values = values[-60:]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], f"v {kind}")
    assert quantiles(frame, "v", POINTS, buckets=buckets) == {None: plain(values)}


def test_groups_and_weights(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), float(rng.randrange(70)), rng.randrange(1, 50))
            for _ in range(500)] + [("c", 4.0, 1), ("none", None, 3)]
    frame = spark.createDataFrame(rows, "g string, v double, n int")
    want = {g: plain([v for h, v, n in rows if h == g for _ in range(n)]) for g in ("a", "b", None, "c")}
    assert quantiles(frame, "v", POINTS, weight="n", group="g") == want


def test_nan_is_last(spark):
    frame = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, math.nan]], "v double")
    got = quantiles(frame, "v", {"median": 0.5, "most": 1.0})[None]
    assert got["median"] == 2.0 and math.isnan(got["most"])
    only = quantiles(frame.where("isnan(v)"), "v", {"median": 0.5})
    assert math.isnan(only[None]["median"])


def test_nothing(spark):
    assert quantiles(spark.createDataFrame([(None,)], "v double"), "v", POINTS) == {}

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillroll.operators import cumulative
from tillroll.operators.revenue import revenue_by


def totals(spark, values):
    return spark.createDataFrame(
        [(str(i), v) for i, v in enumerate(values)], "CustomerID string, total_revenue double"
    )


def plain(df):
    over = Window.orderBy(F.col("total_revenue").desc())
    return df.withColumn("cumulative_contribution", F.sum("total_revenue").over(over))


CASES = {
    "ties": [float(random.Random(5).randrange(40)) for _ in range(500)],
    "many": [float(i % 307) for i in range(3000)],
    "one value fills a third": [7.0] * 400 + [float(i) for i in range(800)],
    "all equal": [3.0] * 50,
    "nulls": [None, 1.0, 2.0, None, 2.0],
    "only nulls": [None, None],
    "negatives and zero": [-5.0, 0.0, -0.0, 5.0, 2.5, -2.5],
    "one row": [4.0],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("rows", [7, 1_000_000])
def test_running_total_equals_the_window(spark, case, rows):
    df = totals(spark, CASES[case])
    got = cumulative.running_total(df, "total_revenue", bucket_rows=rows)
    assert rows_of(got) == rows_of(plain(df))


def test_nan_sorts_first(spark):
    df = totals(spark, [1.0, float("nan"), 2.0])
    got = cumulative.running_total(df, "total_revenue", bucket_rows=10)
    assert [str(r[2]) for r in got.collect()] == ["nan"] * 3


@pytest.mark.parametrize("rows", [7, 1_000_000])
def test_prefix_sums_ascending(spark, rows):
    df = spark.createDataFrame([(float(i), i + 1) for i in range(200)], "v double, rows bigint")
    got = cumulative.prefix_sums(df, "v", "rows", "upto", bucket_rows=rows)
    assert rows_of(got) == sorted(
        ((float(i), i + 1, (i + 1) * (i + 2) // 2) for i in range(200)), key=repr
    )


def test_no_task_sees_all_rows(spark):
    df = totals(spark, CASES["many"])
    got = cumulative.running_total(df, "total_revenue", bucket_rows=10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The only single-task step is over one row per bucket.
    assert plan.count("Exchange SinglePartition") == 1
    assert "_bucket_total" in plan


def test_contribution_by_customer(spark):
    gold = spark.createDataFrame(
        [("a", 5.0), ("b", 1.0), ("a", 5.0), ("c", 10.0), (None, 2.0)],
        "CustomerID string, OrderAmount double",
    )
    rows = cumulative.contribution_by_customer(gold).collect()
    assert [tuple(r) for r in rows] == [
        ("a", 10.0, 20.0), ("c", 10.0, 20.0), (None, 2.0, 22.0), ("b", 1.0, 23.0)]


def test_contribution_by_country(spark):
    gold = spark.createDataFrame([("x", 1.0), ("y", 4.0)], "Country string, OrderAmount double")
    rows = cumulative.contribution_by_country(gold, digits=2).collect()
    assert [tuple(r) for r in rows] == [("y", 4.0, 4.0), ("x", 1.0, 5.0)]
    assert revenue_by(gold, "Country").count() == 2

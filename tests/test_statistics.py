import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tillroll.operators import statistics


def amounts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "OrderAmount double")


def test_distinct_counts_count_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 2), (None, 3)], "k string, n int")
    got = dict(map(tuple, statistics.distinct_counts(df, ("k", "n")).collect()))
    assert got == {"k": 2, "n": 3}


def test_quantiles_are_exact(spark):
    values = [float(v) for v in np.random.default_rng(3).integers(0, 90, 997)]
    row = statistics.exact_summary(amounts(spark, values + [None])).first()
    ordered = sorted(values)
    for name, p in statistics.QUARTILES.items():
        assert row[name] == ordered[int(np.ceil(p * len(values))) - 1]
    assert (row["min"], row["max"]) == (min(values), max(values))
    assert row["avg"] == round(sum(values) / len(values), 1)


def test_sketch_and_exact_summary_have_equal_columns(spark):
    df = amounts(spark, [1.0, 2.0, 3.0])
    exact, sketch = statistics.exact_summary(df), statistics.approximate_summary(df)
    assert exact.columns == sketch.columns
    assert rows_of(exact) == rows_of(sketch)


def test_summary_of_nothing(spark):
    row = statistics.exact_summary(amounts(spark, [None])).first()
    assert set(row.asDict().values()) == {None}


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 10.0],
        [0.0] * 7,
        np.random.default_rng(1).gamma(2.0, 10.0, 500).tolist(),
    ],
)
def test_histogram_equals_numpy(spark, values):
    counts, edges = np.histogram(values, bins=50)
    rows = statistics.histogram(amounts(spark, values)).orderBy("bin").collect()
    assert [r["rows"] for r in rows] == list(counts)
    assert np.allclose([r["bin_start"] for r in rows], edges[:-1])


def test_describe(spark):
    df = spark.createDataFrame([(1, 1.0), (3, None)], "Quantity int, UnitPrice double")
    got = {r["summary"]: (r["Quantity"], r["UnitPrice"])
           for r in statistics.describe_columns(df, ("Quantity", "UnitPrice")).collect()}
    assert got["count"] == (2.0, 1.0) and got["mean"] == (2.0, 1.0)
    assert got["min"] == (1.0, 1.0) and got["max"] == (3.0, 1.0)
    assert got["stddev"][0] == pytest.approx(2**0.5)


def test_profile(spark):
    df = spark.createDataFrame(
        [("x", 1), ("x", 2), ("y", 2), (None, 9)], "name string, number int"
    )
    rows = {r["column_name"]: r for r in statistics.profile(df).collect()}
    name, number = rows["name"], rows["number"]
    assert (name["rows"], name["null_rows"], name["distinct_values"]) == (4, 1, 2)
    assert (name["top_value"], name["top_rows"], name["mean"]) == ("x", 2, None)
    assert (number["top_value"], number["mean"], number["median"]) == ("2", 3.5, 2.0)
    assert (number["min"], number["max"]) == (1.0, 9.0)


def test_profile_of_text_only(spark):
    df = spark.createDataFrame([("x",)], "name string")
    assert statistics.profile(df).first()["top_value"] == "x"


def test_top_values(spark):
    df = spark.createDataFrame([(str(i % 30),) for i in range(300)], "name string")
    top = statistics.top_values(df, ("name",), top=3)
    assert [r["value"] for r in top.orderBy("rank").collect()] == ["0", "1", "10"]


def test_counts(spark):
    df = spark.createDataFrame([("C1",), ("c2",), ("3",), (None,)], "InvoiceNo string")
    assert statistics.cancelled_count(df).first()[0] == 2
    assert statistics.row_count(df).first()[0] == 4
    assert statistics.column_count(df) == 1


def test_sketch_holds_its_promise(spark):
    values = [float(v) for v in np.random.default_rng(4).integers(0, 5000, 4000)]
    df = amounts(spark, values)
    sketch = statistics.approximate_summary(df)
    assert statistics.sketch_holds(df, sketch).columns == sketch.columns
    assert statistics.sketch_holds(df, sketch).select("Q1", "median", "Q3").first() == (True,) * 3
    off = sketch.withColumn("median", F.col("median") + 400)
    assert statistics.sketch_holds(df, off).select("Q1", "median", "Q3").first() == (True, False, True)


def test_profile_scans_its_input_once(spark, tmp_path):
    rows = [("a", 1, 2.5), ("b", 3, None), ("a", 3, 1e9), (None, 8, 1e9 + 1)]
    spark.createDataFrame(rows, "k string, n int, x double").write.parquet(str(tmp_path / "t"))
    got = {r.column_name: r for r in statistics.profile(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert set(got) == {"k", "n", "x"} and got["k"].top_value == "a"
    assert got["n"].stddev == np.std([1, 3, 3, 8], ddof=1) and got["n"].mean == 3.75
    assert abs(got["x"].stddev - np.std([2.5, 1e9, 1e9 + 1], ddof=1)) < 1e-3


def test_top_values_beyond_a_thousand(spark):
    df = spark.range(3000).selectExpr("CAST(id % 1500 AS string) AS v")
    got = statistics.top_values(df, ["v"], top=1200).collect()
    assert len(got) == 1200 and {r["rows"] for r in got} == {2}
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 1201))

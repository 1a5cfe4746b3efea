"""Partition values that come back as they were, and reading by buckets."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tillroll.functions.workspace import fresh_path
from tillroll.sources import readers, writers
from tillroll.tables import VersionedTable

SCHEMA = "id int, Country string, n int"
ODD = ["", " ", "=", "==x", "007", "1e3", "2011-02-03", "NaN", "Infinity", "null", "France",
       "a/b", "a=b", "x%y", "é ü", "__HIVE_DEFAULT_PARTITION__", "United Kingdom", None]


def odd_rows(spark):
    return spark.createDataFrame([(i, c, i % 3) for i, c in enumerate(ODD * 2)], SCHEMA)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_any_text_is_a_partition_value(spark, fmt):
    path = fresh_path(spark, "layer")
    writers.write_layer(odd_rows(spark), path, partition_cols=("Country", "n"), fmt=fmt)
    layer = readers.read_layer(spark, path, fmt)
    assert sorted(layer.columns) == ["Country", "id", "n"]
    got = layer.select(F.col("id").cast("int"), "Country", F.col("n").cast("int"))
    assert rows_of(got) == rows_of(odd_rows(spark))


def test_filters_on_restored_values_skip_directories(spark):
    path = fresh_path(spark, "layer")
    writers.write_layer(odd_rows(spark), path, partition_cols=("Country",))
    for value in ("", "007", "France"):
        one = readers.read_layer(spark, path, "parquet").where(F.col("Country") == value)
        assert one.count() == 2
        assert "PartitionFilters: [" in plan_of(one) and "PartitionFilters: []" not in plan_of(one)
    none = readers.read_layer(spark, path, "parquet").where("Country IS NULL")
    assert none.count() == 2


def test_versions_keep_any_partition_value(spark):
    table = VersionedTable(spark, fresh_path(spark, "table"))
    table.overwrite(odd_rows(spark), partition_cols=("Country",))
    assert rows_of(table.read()) == rows_of(odd_rows(spark))
    table.delete_each(["Country = ''", "id < 4"])
    table.append(odd_rows(spark).where("Country = '' OR Country = '007'"))
    left = odd_rows(spark).where("Country IS NULL OR Country <> ''").where("id >= 4").union(
        odd_rows(spark).where("Country = '' OR Country = '007'"))
    assert rows_of(table.read()) == rows_of(left)
    one = table.read().where("Country = '007'")
    assert "PartitionFilters: [" in plan_of(one)


def sales(spark, n=600):
    rng = random.Random(1)
    rows = [(i, rng.choice(["France", "Spain", "EIRE", "", None, *["United Kingdom"] * 4]),
             rng.choice(["Small", "Large", None]), float(i % 7)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, Country string, Shopsize string, OrderAmount double")


@pytest.fixture(scope="module")
def bucketed(spark):
    name = "sales_in_buckets"
    writers.save_bucketed(sales(spark), name, ("Country", "Shopsize"), buckets=16,
                          path=fresh_path(spark, name))
    yield name
    writers.drop_named(spark, name)


def test_layout_is_told_by_the_catalog(spark, bucketed):
    assert writers.bucket_layout(spark, bucketed) == (["Country", "Shopsize"], 16)
    name = "sales_plain"
    writers.save_named(sales(spark), name, path=fresh_path(spark, name))
    assert writers.bucket_layout(spark, name) == ([], 0)
    with pytest.raises(ValueError, match="bucket columns"):
        writers.bucket_rows(spark, bucketed, Country="France")
    writers.drop_named(spark, name)


@pytest.mark.parametrize("country", ["France", "", None, "Nowhere"])
@pytest.mark.parametrize("size", ["Small", None])
def test_one_bucket_holds_the_rows(spark, bucketed, country, size):
    got = writers.bucket_rows(spark, bucketed, Country=country, Shopsize=size)
    want = sales(spark).where(F.col("Country").eqNullSafe(F.lit(country))
                              & F.col("Shopsize").eqNullSafe(F.lit(size)))
    assert rows_of(got) == rows_of(want)


def test_grouping_and_joining_by_buckets_moves_nothing(spark, bucketed):
    totals = spark.table(bucketed).groupBy("Country", "Shopsize").agg(
        F.sum("OrderAmount").alias("total"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shares = spark.table(bucketed).join(totals, ["Country", "Shopsize"])
        assert "Exchange" not in plan_of(totals) and "Exchange" not in plan_of(shares)
        plain = sales(spark).groupBy("Country", "Shopsize").agg(F.sum("OrderAmount").alias("total"))
        assert rows_of(totals) == rows_of(plain)
        assert rows_of(shares) == rows_of(sales(spark).join(plain, ["Country", "Shopsize"]).select(
            *shares.columns))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_totals_read_a_bucket_in_pieces(spark, fmt):
    name = f"sales_totals_{fmt}"
    path = fresh_path(spark, name)
    rows = sales(spark, 3000).withColumn("Country", F.coalesce(F.nullif("Country", F.lit("")), F.lit("x")))
    table = writers.save_bucketed(rows.coalesce(1), name, ("Country", "Shopsize"), buckets=1, fmt=fmt, path=path)
    sums = (F.count(F.lit(1)).alias("lines"), F.sum("OrderAmount").alias("total"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = writers.totals_in_pieces(table, ("Country", "Shopsize"), *sums)
        assert got.columns == ["Country", "Shopsize", "lines", "total"]
        assert "Bucketed: true" not in plan_of(got)
        assert rows_of(got) == rows_of(rows.groupBy("Country", "Shopsize").agg(*sums))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        writers.drop_named(spark, name)


def test_layouts_are_written_without_sorting(spark, monkeypatch, tmp_path):
    """Files open side by side while a layout is written; the session's setting comes back."""
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    saved = writers._balanced
    monkeypatch.setattr(writers, "_balanced", lambda *a: (seen.append(spark.conf.get(setting)), saved(*a))[1])
    before = spark.conf.get(setting)
    rows = sales(spark).where("Country <> ''")
    writers.save_partitioned(rows, "open_partitions", ("Country",), path=str(tmp_path / "p"))
    writers.save_bucketed(rows, "open_buckets", ("Country", "Shopsize"), path=str(tmp_path / "b"))
    assert seen == ["16", "16"] and spark.conf.get(setting) == before
    assert all(rows_of(spark.table(n).select(*rows.columns)) == rows_of(rows)
               for n in ("open_partitions", "open_buckets"))
    inside = writers.bucket_contents(spark.table("open_buckets"), ("Country", "Shopsize"))
    assert inside.agg(F.sum("rows")).first()[0] == rows.count()
    assert inside.count() == inside.select("Country", "Shopsize").distinct().count()
    writers.drop_named(spark, "open_partitions", "open_buckets")

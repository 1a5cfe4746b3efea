import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tillroll.operators import sampling


@pytest.fixture(scope="module")
def lines(spark):
    """9,000 rows, a third of them copies of one row."""
    base = spark.range(6000).select(
        F.concat(F.lit("inv"), F.col("id")).alias("InvoiceNo"), (F.col("id") % 7).alias("n")
    )
    copies = spark.range(3000).select(F.lit("inv17").alias("InvoiceNo"), F.lit(3).cast("long").alias("n"))
    return base.unionByName(copies).repartition(6)


@pytest.mark.parametrize("part_rows", [50, 10**6])
@pytest.mark.parametrize("n", [1, 40, 900, 4000, 20000])
def test_sample_is_the_plain_one(lines, n, part_rows, monkeypatch):
    monkeypatch.setattr(sampling, "_PART_ROWS", part_rows)
    order = [sampling.row_hash(lines.columns), *lines.columns]
    got = sampling.hash_sample(lines, n)
    assert got.columns == lines.columns
    assert rows_of(got) == rows_of(lines.orderBy(*order).limit(n))


def test_copies_inside_the_sample(spark):
    df = spark.createDataFrame([("same",)] * 50 + [("other",)], "v string")
    assert sampling.hash_sample(df, 20).count() == 20
    assert sampling.hash_sample(df.limit(0), 20).count() == 0


def test_sample_repeats(lines):
    assert rows_of(sampling.hash_sample(lines, 50)) == rows_of(sampling.hash_sample(lines, 50))


def test_fraction_and_first_rows(lines):
    few = sampling.fraction(lines.where("InvoiceNo <> 'inv17'"), 0.1)
    assert 450 < few.count() < 750 and rows_of(few) == rows_of(
        sampling.fraction(lines.where("InvoiceNo <> 'inv17'"), 0.1))
    assert sampling.fraction(lines, 1.0).count() == 9000 and sampling.fraction(lines, 0.0).count() == 0
    assert sampling.first_rows(lines, 5).count() == 5


REST = "a string, b int"


def test_rest_follows_plain_equality(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("y", None), ("z", 2)], REST)
    sample = spark.createDataFrame([("x", 1), ("y", None)], REST)
    # Both copies of x leave; y stays although it was sampled.
    assert rows_of(sampling.rest_of(df, sample, ["a", "b"])) == [("y", None), ("z", 2)]


def test_rest_of_a_small_sample_moves_no_rows(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 7 AS string) AS text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = sampling.rest_of(df, df.where("id < 10"), df.columns)
        plan = rest._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert rest.count() == 990
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

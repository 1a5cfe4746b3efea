"""Plans as tables, differences, and what scans have read."""

import pytest
from conftest import rows_of

from tillroll.functions.workspace import fresh_path
from tillroll.operators.revenue import rounded_revenue_by_country
from tillroll.plans import performance, plan_tree
from tillroll.sources import readers, writers


@pytest.fixture(scope="module")
def layouts(spark):
    rows = spark.range(4000).selectExpr(
        "CAST(id AS string) AS InvoiceNo",
        "element_at(array('France', 'Spain', 'Italy', 'EIRE'), CAST(1 + id % 4 AS int)) AS Country",
        "CAST(id % 50 AS double) AS OrderAmount")
    plain, split = fresh_path(spark, "plain"), fresh_path(spark, "split")
    writers.write_layer(rows.repartition(4), plain)
    writers.write_layer(rows, split, partition_cols=("Country",))
    writers.register_views(tree_plain=readers.read_layer(spark, plain, "parquet"),
                           tree_split=readers.read_layer(spark, split, "parquet"))


def test_tree_has_every_operator(spark, layouts):
    sql = ("SELECT Country, sum(OrderAmount) FROM tree_plain WHERE InvoiceNo > '5' "
           "AND OrderAmount > (SELECT avg(OrderAmount) FROM tree_split) GROUP BY Country")
    rows = {r.node: r for r in plan_tree.plan_table(spark, sql).collect()}
    names = [r.operator for r in rows.values()]
    assert names[0] == "AdaptiveSparkPlan" and names.count("HashAggregate") == 4
    assert sum(n.startswith("Scan parquet") for n in names) == 2 and "Exchange" in names
    roots = [r for r in rows.values() if r.parent is None]
    assert len(roots) == 1
    for r in rows.values():
        # Each parent is listed, one step up, or hosts the subquery.
        assert r.parent is None or r.depth == 0 or rows[r.parent].depth == r.depth - 1
    scan = next(r for r in rows.values() if "GreaterThan(InvoiceNo,5)" in r.details.get("PushedFilters", ""))
    assert "OrderAmount" in scan.details["ReadSchema"]


def test_difference(spark, layouts):
    plain = "SELECT sum(OrderAmount) FROM tree_plain WHERE Country = 'France'"
    split = "SELECT sum(OrderAmount) FROM tree_split WHERE Country = 'France'"
    rows = plan_tree.plan_difference(spark, plain, split).collect()
    kinds = {(r.kind, r.item): (r.plan_a, r.plan_b) for r in rows}
    assert kinds["column read", "Country:string"] == (1, 0)
    assert kinds["pushed filter", "EqualTo(Country,France)"] == (1, 0)
    assert any(kind == "partition filter" and "France" in item and n == (0, 1)
               for (kind, item), n in kinds.items())
    assert plan_tree.plan_difference(spark, plain, plain).count() == 0
    grouped = plan_tree.plan_difference(
        spark, "SELECT * FROM tree_plain", "SELECT DISTINCT Country FROM tree_plain")
    assert ("operator", "Exchange", 0, 1) in rows_of(grouped)


def test_scans_of_both_layouts(spark, layouts):
    whole = performance.benchmark_layouts(
        spark, non_partitioned_table="tree_plain", partitioned_table="tree_split", runs=1)
    one = performance.benchmark_layouts(
        spark, non_partitioned_table="tree_plain", partitioned_table="tree_split", runs=1,
        country="France")
    assert whole["partitioned"]["scan"]["partitions"] == 4
    assert one["partitioned"]["scan"]["partitions"] == 1
    assert one["partitioned"]["scan"]["files"] < whole["partitioned"]["scan"]["files"]
    assert one["partitioned"]["scan"]["rows"] == 1000
    assert 0 < one["partitioned"]["scan"]["bytes"] < whole["partitioned"]["scan"]["bytes"]
    assert one["non_partitioned"]["scan"]["files"] == whole["non_partitioned"]["scan"]["files"] == 4


def test_one_bucket_reads_fewer_files(spark):
    rows = spark.range(3000).selectExpr(
        "CAST(id % 40 AS string) AS Country", "CAST(id % 3 AS string) AS Shopsize",
        "CAST(id AS double) AS OrderAmount")
    writers.save_bucketed(rows, "tree_buckets", ("Country", "Shopsize"), path=fresh_path(spark, "b"))
    all_ = plan_tree.scanned(rounded_revenue_by_country(spark.table("tree_buckets")))
    one = plan_tree.scanned(rounded_revenue_by_country(
        writers.bucket_rows(spark, "tree_buckets", Country="7", Shopsize="1")))
    assert 0 < one["files"] < all_["files"] and one["rows"] < all_["rows"] / 2
    writers.drop_named(spark, "tree_buckets")

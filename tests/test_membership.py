"""Key filters: nothing is lost, little else passes, and merges move few rows."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tillroll.functions.workspace import fresh_path
from tillroll.operators.membership import key_bits, possible_partners
from tillroll.tables import VersionedTable

KEYS = ["a", "b"]


def target(spark, n=40_000):
    return spark.range(n).select(
        F.concat(F.lit("k"), F.col("id")).alias("a"), (F.col("id") % 100).alias("b"), "id")


def test_all_partners_and_few_others_pass(spark):
    rows = target(spark)
    source = rows.where("id % 100 = 7").select(*KEYS)
    passed = possible_partners(rows, source, KEYS)
    ids = {r.id for r in passed.collect()}
    assert set(range(7, 40_000, 100)) <= ids
    # One in a hundred are partners; the filter has room for a million keys.
    assert len(ids) < 0.0105 * 40_000


def test_full_filter_loses_nothing(spark):
    rows = target(spark, 3000)
    passed = possible_partners(rows, rows.where("id % 3 = 0").select(*KEYS), KEYS, bits=128)
    assert {i for i in range(0, 3000, 3)} <= {r.id for r in passed.collect()}


def test_size_does_not_depend_on_the_rows(spark):
    for n in (0, 10, 5000):
        row = key_bits(target(spark, n), KEYS, bits=4096).first()
        assert len(row.bits) == 64 and any(row.bits) == (n > 0)


def test_null_keys_and_unlike_types(spark):
    rows = spark.createDataFrame([("x", 1), (None, 1), ("y", None)], "a string, b int")
    assert rows_of(possible_partners(rows, rows, KEYS)) == [("x", 1)]
    other = spark.createDataFrame([("x", 1)], "a string, b bigint")
    assert rows_of(possible_partners(rows, other, KEYS)) == [("x", 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_plain_anti_join(spark, seed):
    rng = random.Random(seed)

    def some(n):
        return [(rng.choice(["p", "q", "", None]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]),
                 rng.randrange(9)) for _ in range(n)]

    schema = "a string, b double, v int"
    # On either side of the sizes between which the filter is used.
    held, new = (some(90), some(20)) if seed < 3 else (some(20), some(90))
    table = VersionedTable(spark, fresh_path(spark, "merged"))
    table.overwrite(spark.createDataFrame(held, schema))
    source = spark.createDataFrame(new, schema)
    want = rows_of(table.read()) + rows_of(source.join(table.read().select(*KEYS), KEYS, "left_anti").select("a", "b", "v"))
    table.merge_insert(source, KEYS)
    assert [repr(r) for r in rows_of(table.read())] == sorted(repr(r) for r in want)


def written_records(df):
    """Rows that each exchange of a finished plan has written."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_merge_moves_only_possible_partners(spark):
    """1 % merged into a table: its own side of the join moves about 1 % of its rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = target(spark)
        source = rows.where("id % 100 = 7")
        fresh = source.join(possible_partners(rows.select(*KEYS), source, KEYS), KEYS, "left_anti")
        assert fresh.collect() == []
        assert sorted(written_records(fresh))[-1] <= 0.0105 * 40_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

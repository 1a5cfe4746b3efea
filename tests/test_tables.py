import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.fixed_values import MERGE_KEYS, NOT_AN_ARTICLE_SQL
from tillroll.functions.workspace import fresh_path
from tillroll.tables import CheckViolation, VersionedTable

SCHEMA = "InvoiceNo string, ItemCode string, CustomerID string, OrderAmount double"


@pytest.fixture
def table(spark):
    return VersionedTable(spark, fresh_path(spark, "table"))


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_versions_stay_readable(spark, table):
    assert not table.exists()
    table.overwrite(frame(spark, ("1", "a", "x", 1.0), ("2", "b", "y", 2.0)))
    table.append(frame(spark, ("3", "c", "z", 3.0)))
    table.delete_where("OrderAmount < 2")
    table.overwrite(frame(spark, ("9", "i", "w", 9.0)))
    counts = [table.read(v).count() for v in range(4)]
    assert counts == [2, 3, 2, 1] and table.version() == 3
    with pytest.raises(ValueError, match="no version"):
        table.read(7)


def test_delete_keeps_rows_with_null(spark, table):
    df = frame(spark, ("1", "12345"), ("2", "123"), ("3", None), schema="InvoiceNo string, StockCode string")
    table.overwrite(df)
    assert table.delete_where(NOT_AN_ARTICLE_SQL) == 1
    assert rows_of(table.read()) == [("1", "12345"), ("3", None)]


def test_delete_does_not_reach_later_rows(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    table.delete_where("InvoiceNo = '1'")
    table.append(frame(spark, ("1", "b", "x", 5.0)))
    assert rows_of(table.read()) == [("1", "b", "x", 5.0)]


def test_deletes_in_a_row(spark, table):
    table.overwrite(frame(spark, *[(str(i), "a", "x", float(i)) for i in range(10)]))
    assert table.delete_each(["OrderAmount < 2", "OrderAmount < 4", "InvoiceNo = '77'",
                              "OrderAmount = 9"]) == [2, 2, 0, 1]
    kept = [[r[0] for r in rows_of(table.read(v))] for v in range(5)]
    assert kept == [list("0123456789"), list("23456789"), list("456789"), list("456789"),
                    list("45678")]
    assert table.delete_where("true") == 5 and table.read().count() == 0
    assert table.read().columns == ["InvoiceNo", "ItemCode", "CustomerID", "OrderAmount"]
    table.append(frame(spark, ("5", "b", "y", 1.0)))
    assert table.read().count() == 1


def test_a_version_never_changes(spark, table):
    rows = [(str(i), "now", "x", 1.0) for i in range(200)]
    table.overwrite(frame(spark, *rows, schema="random string, d string, select string, v double"))
    for predicate in ("rand() < 0.3", "unix_timestamp() % 2 = 0", "random = '7'", "`select` = 'q'"):
        deleted = table.delete_where(predicate)
        left = [rows_of(table.read()) for _ in range(3)]
        assert left[0] == left[1] == left[2]
        assert len(left[0]) == table.read(table.version() - 1).count() - deleted
    table.delete_where("d = 'now'")
    assert table.read().count() == 0


def test_layout_is_kept(spark, table):
    schema = "InvoiceNo string, Country string, CustomerID string, ItemCode string"
    table.overwrite(frame(spark, ("1", "France", "x", "a"), ("2", "Spain", "y", "b"), schema=schema),
                    partition_cols=("Country",))
    table.append(frame(spark, ("3", "France", "z", "c"), ("4", None, "z", "d"), schema=schema))
    table.merge_insert(frame(spark, ("5", "Spain", "w", "e"), schema=schema), MERGE_KEYS)
    table.delete_where("InvoiceNo = '2'")
    table.overwrite(table.read().unionByName(frame(spark, ("6", "Italy", "v", "f"), schema=schema)))
    for version, rows in enumerate((2, 4, 5, 4, 5)):
        got = table.read(version)
        assert got.columns == ["InvoiceNo", "Country", "CustomerID", "ItemCode"]
        assert got.count() == rows
        plan = got.where("Country = 'France'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert rows_of(table.read().where("Country = 'France'")) == [
        ("1", "France", "x", "a"), ("3", "France", "z", "c")]


def test_checks_together(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    with pytest.raises(CheckViolation) as caught:
        table.add_checks({"positive": "OrderAmount > 0", "large": "OrderAmount > 5"})
    assert caught.value.broken == {"large": 1} and table.version() == 0
    table.add_checks({"positive": "OrderAmount > 0", "known": "CustomerID IS NOT NULL"})
    assert table.version() == 2 and set(table.checks()) == {"positive", "known"}


def test_merge_keys(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0), ("2", "b", None, 2.0)))
    source = frame(
        spark,
        ("1", "a", "x", 7.0),   # known: left alone
        ("2", "b", None, 2.0),  # NULL key: never equal, inserted
        ("3", "c", "z", 3.0),   # new, twice: both inserted
        ("3", "c", "z", 3.0),
    )
    assert table.merge_insert(source, MERGE_KEYS) == 3
    assert rows_of(table.read()) == sorted(
        [("1", "a", "x", 1.0), ("2", "b", None, 2.0), ("2", "b", None, 2.0),
         ("3", "c", "z", 3.0), ("3", "c", "z", 3.0)], key=repr)
    assert table.history().first()["operation"] == "MERGE"


def test_merge_source_may_lack_and_add_columns(spark, table):
    table.overwrite(
        frame(spark, ("1", "a", "x", "Bags"), schema="InvoiceNo string, ItemCode string, CustomerID string, category string")
    )
    source = frame(spark, ("2", "b", "y", 5), schema="InvoiceNo string, ItemCode string, CustomerID string, pieces int")
    table.merge_insert(source, MERGE_KEYS)
    assert table.read().columns == ["InvoiceNo", "ItemCode", "CustomerID", "category", "pieces"]
    assert rows_of(table.read()) == [("1", "a", "x", "Bags", None), ("2", "b", "y", None, 5)]
    table.delete_where("pieces = 5")
    assert rows_of(table.read()) == [("1", "a", "x", "Bags", None)]


def test_check_is_enforced_now_and_later(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    table.add_check("positive", "OrderAmount > 0")
    assert table.version() == 1 and table.checks() == {"positive": "OrderAmount > 0"}
    with pytest.raises(CheckViolation) as caught:
        table.append(frame(spark, ("2", "b", "y", 0.0), ("3", "c", "z", 1.0)))
    assert caught.value.broken == {"positive": 1}
    with pytest.raises(CheckViolation):  # NULL is not true
        table.append(frame(spark, ("2", "b", "y", None)))
    with pytest.raises(CheckViolation):  # a missing column is NULL
        table.append(frame(spark, ("2",), schema="InvoiceNo string"))
    with pytest.raises(CheckViolation):
        table.overwrite(frame(spark, ("2", "b", "y", -1.0)))
    assert table.version() == 1 and table.read().count() == 1
    table.append(frame(spark, ("2", "b", "y", 2.0)))
    assert table.read().count() == 2


def test_check_refused_when_rows_break_it(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", -1.0)))
    with pytest.raises(CheckViolation):
        table.add_check("positive", "OrderAmount > 0")
    assert table.version() == 0 and table.checks() == {}


def test_same_check_twice(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    table.add_check("positive", "OrderAmount > 0")
    with pytest.raises(ValueError, match="already"):
        table.add_check("positive", "OrderAmount > 1")


def test_history_is_newest_first(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0), ("2", "b", "y", 2.0)))
    table.delete_where("OrderAmount = 1")
    table.add_check("c", "OrderAmount > 0")
    rows = table.history().collect()
    assert [r["version"] for r in rows] == [2, 1, 0]
    assert [r["operation"] for r in rows] == ["ADD CONSTRAINT", "DELETE", "WRITE"]
    assert rows[1]["operationMetrics"] == {"numDeletedRows": 1}
    assert rows[1]["operationParameters"] == {"predicate": "OrderAmount = 1"}
    assert rows[2]["operationMetrics"] == {"numOutputRows": 2}
    assert rows[0]["timestamp"] >= rows[2]["timestamp"]


def test_overwrite_may_read_the_table_itself(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    table.overwrite(table.read().withColumn("OrderAmount", F.col("OrderAmount") + 1))
    assert rows_of(table.read()) == [("1", "a", "x", 2.0)]


def test_arrays_and_empty_frames(spark, table):
    df = spark.createDataFrame([("1", ["a", "b"])], "InvoiceNo string, tokens array<string>")
    table.overwrite(df.limit(0))
    assert table.read().count() == 0
    table.append(df)
    assert table.read().first()["tokens"] == ["a", "b"]


def test_view(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    table.append(frame(spark, ("2", "b", "y", 2.0)))
    table.create_view("first_version", 0)
    assert spark.sql("SELECT count(*) FROM first_version").first()[0] == 1


def test_read_prunes_columns_and_pushes_filters(spark, table):
    table.overwrite(frame(spark, ("1", "a", "x", 1.0)))
    table.append(frame(spark, ("2", "b", "y", 2.0)))
    df = table.read().where("InvoiceNo = '1'").select("OrderAmount")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # parts alike share one scan
    assert "EqualTo(InvoiceNo,1)" in plan
    assert "ItemCode" not in plan.split("ReadSchema:")[1]


KEY = st.sampled_from(["1", "2", None])
ROW = st.tuples(KEY, KEY, st.sampled_from(["x", None]), st.sampled_from([0.5, 1.0, None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.lists(ROW, max_size=6), source=st.lists(ROW, max_size=6))
def test_delete_and_merge_follow_the_model(spark, target, source):
    table = VersionedTable(spark, fresh_path(spark, "model"))
    table.overwrite(frame(spark, *target))
    table.delete_where("OrderAmount < 1")
    kept = [r for r in target if not (r[3] is not None and r[3] < 1)]
    assert rows_of(table.read()) == sorted(kept, key=repr)

    known = {r[:3] for r in kept if None not in r[:3]}
    table.merge_insert(frame(spark, *source), MERGE_KEYS)
    added = [r for r in source if r[:3] not in known]
    assert rows_of(table.read()) == sorted(kept + added, key=repr)


def test_delete_sorts_no_rows(spark, table, monkeypatch):
    """Marked rows go to files open side by side; the session's setting comes back."""
    from pyspark.sql import DataFrameWriter

    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    saved = DataFrameWriter.parquet
    table.overwrite(frame(spark, *[(str(i), "a", "x", float(i)) for i in range(10)]))
    before = spark.conf.get(setting)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (
        seen.append(spark.conf.get(setting)), saved(self, path))[1])
    assert table.delete_each(["OrderAmount < 2", "OrderAmount < 4"]) == [2, 2]
    assert seen == ["2"] and spark.conf.get(setting) == before
    assert [table.read(v).count() for v in range(3)] == [10, 8, 6]

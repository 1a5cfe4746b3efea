import datetime

import pytest
from conftest import line
from pyspark.sql import types as T

from tillroll.functions.casting import as_int
from tillroll.operators.cleaning import clean_transactions, project_sales
from tillroll.operators.quality import run_checks


def invoices(df):
    return sorted(r["InvoiceNo"] for r in df.collect())


def test_unusable_lines_are_dropped(raw):
    lines = raw(
        line("600001"),
        line("c600002"),
        line("C600003"),
        line("541431"),
        line("600005", code="20001AB9"),
        line("600006", customer=None),
        line("600007", price=None),
        line("600008", quantity=None),
        line(None),
        line("600010", code=None),
    )
    cleaned = clean_transactions(lines)
    assert invoices(cleaned) == ["600001"]
    row = cleaned.first()
    assert (row["StockCode"], row["Quantity"], row["UnitPrice"]) == ("20001", 4, 1.25)
    assert row["InvoiceDate"] == datetime.datetime(2011, 2, 3, 10, 15)
    assert run_checks(cleaned, raise_on_failure=False)["passed"]


def test_types_and_column_order(raw):
    cleaned = clean_transactions(raw(line()))
    kinds = {f.name: f.dataType for f in cleaned.schema}
    assert list(kinds) == [
        "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
        "CustomerID", "Country",
    ]
    assert isinstance(kinds["Quantity"], T.IntegerType)
    assert isinstance(kinds["UnitPrice"], T.DoubleType)
    assert isinstance(kinds["InvoiceDate"], T.TimestampType)


def test_numbers_instead_of_text_are_accepted(spark):
    lines = spark.createDataFrame(
        [("600001", "20001", "LAMP", 6, "01/12/2010 08:26:00", 2.55, "17850", "France")],
        "InvoiceNo string, StockCode string, Description string, Quantity bigint, "
        "InvoiceDate string, UnitPrice double, CustomerID string, Country string",
    )
    row = clean_transactions(lines).first()
    assert (row["Quantity"], row["UnitPrice"]) == (6, 2.55)


def test_rule_sets_differ_on_unreadable_quantity(raw):
    lines = raw(line("600001", quantity="many"), line("600002"))
    kept = clean_transactions(lines)
    assert invoices(kept) == ["600001", "600002"]
    report = run_checks(kept, raise_on_failure=False)
    assert {c["name"] for c in report["constraints"] if not c["passed"]} == {"quantity_not_null"}
    assert invoices(clean_transactions(lines, "notebook")) == ["600002"]


def test_notebook_rules_keep_cancellations_and_odd_codes(raw):
    lines = raw(line("C600001"), line("541431"), line("600003", code="POST"), line("600004", code=None))
    phase1 = clean_transactions(lines, "notebook")
    assert phase1.count() == 4
    assert phase1.columns[-1] == "OrderAmount"
    assert phase1.first()["OrderAmount"] == 5.0


def test_unreadable_date_is_null_not_an_error(raw):
    cleaned = clean_transactions(raw(line(date="2011-02-03"), line(date="31/02/2011 00:00:00")))
    assert [r["InvoiceDate"] for r in cleaned.collect()] == [None, None]


def test_projection_wants_positive_price_and_quantity(raw):
    lines = raw(line("1", quantity="0"), line("2", quantity="-3"), line("3", price="0"), line("4"))
    assert invoices(project_sales(clean_transactions(lines, "notebook"))) == ["4"]


def test_unknown_rule_set(raw):
    with pytest.raises(ValueError, match="rule set"):
        clean_transactions(raw(line()), "other")


@pytest.mark.parametrize(
    "text, number",
    [
        ("17850", 17850), (" 42 ", 42), ("-7", -7), ("17850.0", 17850), ("17850.7", 17850),
        ("-2.9", -2), ("abc", None), ("", None), ("NaN", None), ("9000000000000", None),
        ("6d", None), ("1e3", None), (None, None),
    ],
)
def test_text_to_int(spark, text, number):
    df = spark.createDataFrame([(text,)], "n string")
    assert df.selectExpr(f"{as_int(df, 'n')} AS n").first()["n"] == number


def test_cleaning_is_one_map_only_stage(raw):
    plan = clean_transactions(raw(line()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_filter_reaches_the_parquet_scan(spark, raw, tmp_path):
    raw(line()).write.parquet(str(tmp_path / "raw"))
    cleaned = clean_transactions(spark.read.parquet(str(tmp_path / "raw")))
    plan = cleaned.select("InvoiceNo")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(CustomerID)" in plan
    assert "Not(EqualTo(InvoiceNo,541431))" in plan
    assert "Country" not in plan.split("ReadSchema:")[1]

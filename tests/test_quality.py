import pytest
from conftest import line

from tillroll.functions.fixed_values import CLEANING_RULES, ENRICHED_RULES
from tillroll.operators.cleaning import clean_transactions
from tillroll.operators.quality import DataQualityError, run_checks, violations


def test_clean_lines_pass(raw):
    cleaned = clean_transactions(raw(line(code="85123A"), line("600002")))
    report = run_checks(cleaned, raise_on_failure=False)
    assert report["passed"] and report["scope"] == "cleaning" and report["row_count"] == 1
    assert [c["name"] for c in report["constraints"]] == list(CLEANING_RULES)
    assert all(c["violations"] == 0 for c in report["constraints"])


def test_cancelled_line_raises(raw):
    with pytest.raises(DataQualityError) as caught:
        run_checks(raw(line("C600001", code="85123A")))
    report = caught.value.report
    failed = {c["name"] for c in report["constraints"] if not c["passed"]}
    assert not report["passed"]
    assert failed == {"invoice_not_cancelled", "stock_code_length_5"}
    assert "invoice_not_cancelled" in str(caught.value)


def test_null_predicate_is_no_violation(spark):
    df = spark.createDataFrame([(None, None)], "OrderAmount double, ItemCode string")
    assert run_checks(df, scope="enriched")["passed"]


def test_empty_frame_passes(raw):
    report = run_checks(raw(line()).limit(0))
    assert report["passed"] and report["row_count"] == 0


def test_counts_per_rule(spark):
    df = spark.createDataFrame([(0.0, "12345"), (-1.0, "1234"), (2.0, "12345")],
                               "OrderAmount double, ItemCode string")
    got = {r["name"]: (r["violations"], r["passed"]) for r in violations(df, ENRICHED_RULES).collect()}
    assert got == {"order_amount_positive": (2, False), "item_code_length_5": (1, False)}


def test_unknown_scope(raw):
    with pytest.raises(ValueError, match="scope"):
        run_checks(raw(line()), scope="elsewhere")


def test_all_rules_in_one_scan(raw, spark, tmp_path):
    raw(line()).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = violations(df, CLEANING_RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1

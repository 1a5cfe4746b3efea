"""Quality rules: all rules of a scope are counted in one pass."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.fixed_values import CLEANING_RULES, ENRICHED_RULES

SCOPES: dict[str, Mapping[str, str]] = {
    "cleaning": CLEANING_RULES,
    "enriched": ENRICHED_RULES,
}


class DataQualityError(Exception):
    """At least one rule is violated; ``report`` holds the counts."""

    def __init__(self, report: dict[str, Any]):
        self.report = report
        broken = ", ".join(c["name"] for c in report["constraints"] if not c["passed"])
        super().__init__(f"data quality rules violated: {broken}")


def rules_for(scope: str) -> Mapping[str, str]:
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}: use one of {', '.join(SCOPES)}")
    return SCOPES[scope]


def violation_counters(rules: Mapping[str, str]) -> list[Column]:
    """Aggregates counting violating rows; a NULL predicate is no violation."""
    return [F.count_if(F.expr(predicate)).alias(name) for name, predicate in rules.items()]


def violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: name, violations, passed."""
    counted = df.agg(*violation_counters(rules))
    per_rule = [
        F.struct(F.lit(name).alias("name"), F.col(name).alias("violations")) for name in rules
    ]
    return counted.select(F.inline(F.array(*per_rule))).withColumn(
        "passed", F.col("violations") == 0
    )


def as_report(scope: str, rules: Mapping[str, str], counts: Mapping[str, int]) -> dict[str, Any]:
    """``counts`` maps 'row_count' and every rule name to a number."""
    constraints = [
        {"name": name, "violations": counts[name], "passed": counts[name] == 0}
        for name in rules
    ]
    return {
        "scope": scope,
        "row_count": counts["row_count"],
        "constraints": constraints,
        "passed": all(c["passed"] for c in constraints),
    }


def run_checks(df: DataFrame, *, scope: str = "cleaning",
               raise_on_failure: bool = True) -> dict[str, Any]:
    """Count every rule of ``scope`` in a single job and report."""
    rules = rules_for(scope)
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"), *violation_counters(rules)
    ).first().asDict()
    report = as_report(scope, rules, counts)
    if raise_on_failure and not report["passed"]:
        raise DataQualityError(report)
    return report

"""Bronze, silver and gold from one raw file.

Each layer is read once: CSV to bronze, bronze to silver, silver to gold.
Quality rules are counted while a layer is being written; the version is
published only if all of them hold, so no layer is scanned just to check it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import quality
from tillroll.operators.cleaning import clean_transactions
from tillroll.operators.enrichment import enrich_transactions
from tillroll.plans.performance import benchmark_layouts
from tillroll.plans.reports import (
    get_sales_by_continent,
    get_sales_by_country,
    get_sales_by_product_category,
    get_sales_by_purchase_segment,
)
from tillroll.sources.readers import read_layer, read_raw_csv
from tillroll.sources.writers import register_views, write_layer
from tillroll.tables import VersionedTable

log = logging.getLogger(__name__)


def publish_checked(table: VersionedTable, df: DataFrame, scope: str,
                    partition_cols: Sequence[str] | None = None) -> dict:
    """Write, count the rules of ``scope`` on the way, publish only if they hold."""
    rules = quality.rules_for(scope)
    reports = []

    def accept(counts):
        reports.append(quality.as_report(scope, rules, counts))
        if not reports[0]["passed"]:
            raise quality.DataQualityError(reports[0])

    table.overwrite(df, gate=quality.violation_counters(rules), accept=accept,
                    partition_cols=partition_cols)
    return reports[0]


def build_layers(spark: SparkSession, raw: str | DataFrame, out: str, *,
                 to_gold: Callable[[DataFrame], DataFrame] | None = None,
                 gold_partition_cols: Sequence[str] | None = None) -> dict[str, dict]:
    """Build the three layers under ``out``; returns the two quality reports.

    ``to_gold`` is applied to silver before it is enriched, for instance to
    keep positive prices only; ``gold_partition_cols`` lay gold out in directories.

    A failed rule raises ``DataQualityError`` before its layer appears; the
    layers before it stay.
    """
    bronze, silver, gold = (
        VersionedTable(spark, f"{out.rstrip('/')}/{layer}")
        for layer in ("bronze", "silver", "gold")
    )
    lines = read_raw_csv(spark, raw) if isinstance(raw, str) else raw
    counts = bronze.overwrite(lines)
    log.info("bronze: %s rows", counts["row_count"])
    cleaned = publish_checked(silver, clean_transactions(bronze.read()), "cleaning")
    log.info("silver: %s rows", cleaned["row_count"])
    usable = silver.read() if to_gold is None else to_gold(silver.read())
    enriched = publish_checked(gold, enrich_transactions(usable), "enriched", gold_partition_cols)
    log.info("gold: %s rows", enriched["row_count"])
    return {"silver": cleaned, "gold": enriched}


def run_analytics(spark: SparkSession, gold_path: str, fmt: str = "versioned",
                  benchmark: bool = True) -> dict:
    """The four revenue reports and, if wanted, the layout benchmark."""
    results = {
        "sales_by_country": get_sales_by_country(spark, gold_path, fmt),
        "sales_by_product_category": get_sales_by_product_category(spark, gold_path, fmt),
        "sales_by_continent": get_sales_by_continent(spark, gold_path, fmt),
        "sales_by_purchase_segment": get_sales_by_purchase_segment(spark, gold_path, fmt),
    }
    if benchmark:
        results["partition_benchmark"] = partition_benchmark(spark, gold_path, fmt)
    return results


def partition_benchmark(spark: SparkSession, gold_path: str, fmt: str = "versioned") -> dict:
    """Rewrite gold by country and continent next to it; time both layouts."""
    gold = read_layer(spark, gold_path, fmt)
    sibling = sibling_of(gold_path, "gold_partitioned_benchmark")
    files = "parquet" if fmt == "versioned" else fmt
    write_layer(gold, sibling, partition_cols=("Country", "Continent"), fmt=files)
    register_views(
        phase4=gold,
        sales_per_country_continent=read_layer(spark, sibling, files),
    )
    return benchmark_layouts(spark)


def sibling_of(path: str, name: str) -> str:
    """The path of ``name`` in the folder that holds ``path``."""
    parent, slash, own = path.rstrip("/").rpartition("/")
    if not own or slash and (not parent or parent.endswith("/") or parent.endswith(":")):
        raise ValueError(f"{path!r} lies in no folder of its own: its sibling would be at the root")
    return f"{parent}{slash}{name}"


def run_pipeline(spark: SparkSession, raw: str, out: str, analytics: bool = False) -> int:
    """0 when every layer was published, 1 otherwise; errors go to the log."""
    try:
        build_layers(spark, raw, out)
        if analytics:
            results = run_analytics(spark, f"{out.rstrip('/')}/gold")
            for name, result in results.items():
                if isinstance(result, DataFrame):
                    log.info("%s", name)
                    result.show(20, truncate=False)
                else:
                    log.info("%s: %s", name, result)
        return 0
    except Exception:
        log.exception("pipeline failed")
        return 1

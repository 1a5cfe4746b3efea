"""The notebook flow as versioned tables: phase 1 to phase 4 and the merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions import fixed_values as fixed
from tillroll.operators.cleaning import clean_transactions, project_sales
from tillroll.operators.enrichment import (
    categorised,
    enrich_transactions,
    merge_ready,
    with_tokens,
)
from tillroll.operators.sampling import hash_sample, rest_of
from tillroll.tables import VersionedTable


@dataclass
class Phases:
    """The tables by their names in the flow."""

    spark: SparkSession
    warehouse: str

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.warehouse.rstrip('/')}/{name}")


def purge(table: VersionedTable) -> VersionedTable:
    """Three deletes, three versions: cancellations, the outlier, non-articles."""
    table.delete_each((fixed.CANCELLED_SQL, fixed.OUTLIER_SQL, fixed.NOT_AN_ARTICLE_SQL))
    return table


def build_phase1(phases: Phases, raw: DataFrame) -> VersionedTable:
    """Version 0 holds all complete lines, versions 1 to 3 the deletes."""
    table = phases.table("phase1")
    table.overwrite(clean_transactions(raw, "notebook"))
    return purge(table)


def enriched_phase2(phase1: DataFrame) -> DataFrame:
    return enrich_transactions(project_sales(phase1), "notebook")


def split_phase2(phase2: DataFrame, sample_rows: int = fixed.SAMPLE_ROWS,
                 sample_keys=None) -> DataFrame:
    """The sampled lines with tokens; the rest is taken against the stored copy."""
    return hash_sample(with_tokens(phase2), sample_rows, sample_keys or phase2.columns)


def build_phases(phases: Phases, raw: DataFrame, *, sample_rows: int = fixed.SAMPLE_ROWS,
                 sample_keys=None) -> Phases:
    """All tables of the flow.

    Every step reads the table the step before published, so the sample that
    is merged against is the one that was stored, and a lost executor re-reads
    files instead of recomputing the flow.
    """
    phase1 = build_phase1(phases, raw)
    phases.table("phase2").overwrite(project_sales(phase1.read()))
    phase2 = enrich_transactions(phases.table("phase2").read(), "notebook")

    phase3 = phases.table("phase3")
    phase3.overwrite(categorised(split_phase2(phase2, sample_rows, sample_keys)))
    phase3.add_checks(fixed.TABLE_CHECKS)

    phase4 = phases.table("phase4")
    phase4.overwrite(phase3.read().drop("tokens"))

    rest = rest_of(with_tokens(phase2), phase3.read(), phase2.columns)
    source = phases.table("df_rest_phase5")
    source.overwrite(merge_ready(rest))
    phase4.merge_insert(source.read(), fixed.MERGE_KEYS)
    return phases

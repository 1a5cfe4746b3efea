"""A training corpus from ``documents``: five stages, each written and read again.

Toxic documents go, one document of each near-duplicate group stays, documents
that hold benchmark passages go, sources are mixed to their target weights, and the
mix is dealt to shards of equal size.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.workspace import noted, remove, stored
from tillroll.llm import decontamination, mixing, sharding, simhash, toxicity
from tillroll.llm.common import table


_left: list[str] = []


def _stage(function):
    """A stage removes the intermediate folders of the one before, whose result is written.

    What ``docs`` reads itself stays, so a result that is not written loses nothing.
    """

    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = "\n".join(docs.inputFiles())
        gone = [name for name in _left if name.rpartition("/")[2] not in read]
        remove(spark, gone)
        _left[:] = [name for name in _left if name not in gone]
        with noted() as made:
            result = function(spark, docs, sf_dir)
        _left.extend(made)
        return result

    return stage


@_stage
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted severity is not rejected (operator 10).

    Null and empty texts and repeated rows are judged like any other and stay where they are
    clean; without labels nothing is rejected.  An empty table stays empty, in each stage.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group (operator 1).

    Groups are the components of fingerprints of three-word shingles within two bits, those
    of null and empty texts included.  Of repeated rows one stays; null ids come last.
    """
    return simhash.one_of_each(docs)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item (operator 9).

    Null and empty texts overlap with nothing and stay, as do all without a benchmark;
    repeated rows are judged alike.
    """
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them (operator 8).

    Null is a source.  Null and empty texts have no words and come with the documents around
    them in the hash order; repeated rows count each; equal hashes are in open order.
    """
    return mixing.mixed(docs)


@_stage
def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot (operator 6).

    Equal texts, null texts too, are drawn together; repeated rows get a slot each.
    """
    return sharding.with_shard(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("sharding", shards),
]

# The toxicity model and the fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

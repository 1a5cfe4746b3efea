"""Operator 8: mixing sources to target weights.

Each document gets a hash-random key.  Within a source the documents are ordered by it, prefix
sums of their sizes are computed over all tasks, and the mix takes whole epochs
of the source plus the documents whose words lie before the rest of the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import unused
from tillroll.llm.prefix import random_key, with_prefix

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def words(text: str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; a null text has none."""
    return F.coalesce(
        F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to rows (no_source, source, source_size), one for each source.

    Weights repeat over the sources by code point, null last.  The targets share
    ``SHARE`` of all words; none is above ``MOST`` times its source.  That is
    a common level times the weight, or the source's limit if that is lower;
    the level lies after the sources with the smallest limits for their
    weight.  These few rows, one a source, are put in order in one task.
    """
    weight = f"element_at(array({', '.join(map(str, WEIGHTS))}), CAST(1 + (n - 1) % {len(WEIGHTS)} AS int))"
    rows = (
        sizes.selectExpr("*", "row_number() OVER (ORDER BY no_source, source) AS n")
        .selectExpr("no_source", "source", "source_size", f"{weight} AS weight",
                    f"{MOST} * source_size AS most", "sum(source_size) OVER () AS all_size")
        .selectExpr("*", "CAST(most AS double) / weight AS level")
        .selectExpr("*",
                    "sum(most) OVER (ORDER BY level) - sum(most) OVER (PARTITION BY level) AS full",
                    "sum(weight) OVER (ORDER BY level DESC) AS open")
        .selectExpr("*", f"({SHARE}D * all_size - full) / open AS reached")
    )
    # The least level that a source's limit is not below ends the filling.
    rows = rows.selectExpr("*", "min(CASE WHEN level >= reached THEN struct(level, reached) END) "
                                "OVER () AS stop")
    return rows.selectExpr("no_source", "source", "source_size",
                           "least(CAST(most AS double), stop.reached * weight) AS target")


def _plan(rows: DataFrame) -> DataFrame:
    """Adds source_size, target, ``full`` epochs and ``rest``: words of the last epoch
    for the document at its place, to stored rows (no_source, source, size, key)."""
    sizes = rows.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes).selectExpr(
        "*", "CAST(floor(target) AS bigint) AS budget").selectExpr(
        "*", "CASE WHEN source_size > 0 THEN budget DIV source_size ELSE 0 END AS full")
    goals = goals.withColumn("rest", F.expr("budget - full * source_size"))
    placed = with_prefix(rows, ["no_source", "source"], "key", F.col("size"))
    return placed.join(goals, ["no_source", "source"])


def _columns(doc_id: str, text: str, source: str) -> list[Column]:
    return [F.col(doc_id).alias("doc_id"), words(text).alias("size"),
            F.col(source).isNull().alias("no_source"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
            random_key(doc_id, text).alias("key")]


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """Per document its size, its source's size and target, and the words taken.

    The document on the budget's edge gives just the words that are missing, so
    a source's taken words are its target without the fraction.  Null texts
    have size 0; the null source is a source.  Repeated rows count each.
    """
    rows = stored(docs.select(*_columns(doc_id, text, source)), "sizes")
    return _plan(rows).selectExpr(
        "doc_id", "size", "source_size", "target",
        "full * size + greatest(0L, least(size, rest - before)) AS taken")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it.

    Texts stay whole, so the document on the edge is taken once more as a
    whole.  Rows are numbered while they are written, so each is found again by its
    number, and rows of one id and text never come together.  Null and odd rows as in ``mix``;
    an empty table stays empty.
    """
    uid, plan, copies = unused(docs, "uid", "plan", "copies")
    held = stored(docs.withColumns({
        uid: F.monotonically_increasing_id(),
        plan: F.struct(*_columns(doc_id, text, source)[1:])}), "numbered")
    rows = held.select(F.col(uid).alias("doc_id"), f"{plan}.*")
    chosen = _plan(rows).selectExpr(
        f"doc_id AS {uid}", f"CAST(full + IF(before < rest, 1, 0) AS int) AS {copies}").where(
        f"{copies} > 0")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (held.join(chosen, uid)
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies))
            .select(*columns))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, text IS NULL AS none,
    CASE WHEN text IS NULL THEN 0
      ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, 2 * source_size AS most, CAST(2 * source_size AS DOUBLE) / weight AS level,
    (SELECT sum(source_size) FROM s) AS all_size FROM s),
f AS (
  SELECT *, (1.5::DOUBLE * all_size
        - (sum(most) OVER (ORDER BY level) - sum(most) OVER (PARTITION BY level)))
      / sum(weight) OVER (ORDER BY level DESC) AS reached
  FROM l),
g AS (
  SELECT source, source_size, least(CAST(most AS DOUBLE), weight * (
      SELECT arg_min(reached, level) FROM f WHERE level >= reached)) AS target FROM f),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM p
"""

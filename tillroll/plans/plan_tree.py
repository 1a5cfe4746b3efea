"""Query plans as data: their operators, what reaches the scans, and differences."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_LINE = re.compile(r"^(?P<front>[ :|]*)(?:[+:]- )?(?:\* )?(?P<name>[^()]+?(?: \S+)*?) \((?P<node>\d+)\)$")
_DETAIL = re.compile(r"^\((?P<node>\d+)\) (?P<name>.+?)(?: \[codegen id : \d+\])?$")
_HOST = re.compile(r"^Subquery:\d+ Hosting operator id = (?P<node>\d+)")
# What EXPLAIN tells of a node, and the name it is compared by.
_COMPARED = {
    "PushedFilters": "pushed filter",
    "PartitionFilters": "partition filter",
    "ReadSchema": "column read",
    "SelectedBucketsCount": "buckets",
}


@dataclass
class Node:
    """One operator of a physical plan."""

    number: int
    operator: str
    parent: int | None
    depth: int
    details: dict[str, str] = field(default_factory=dict)


def plan_nodes(spark: SparkSession, sql: str) -> list[Node]:
    """The operators of a query's physical plan, from the root down, subqueries last.

    A node that is reached twice (a reused exchange's source) is listed once.
    """
    return parsed(spark.sql(f"EXPLAIN FORMATTED {sql}").first()[0])


def parsed(text: str) -> list[Node]:
    nodes: dict[int, Node] = {}
    above: list[tuple[int, int]] = []
    host = current = None
    for line in text.splitlines():
        if m := _HOST.match(line):
            host, above, current = int(m["node"]), [], None
        elif (m := _DETAIL.match(line)) and int(m["node"]) in nodes:
            current = nodes[int(m["node"])]
        elif m := _LINE.match(line):
            depth, number = len(m["front"]) // 3 + ("- " in line[:len(m["front"]) + 3]), int(m["node"])
            above = [a for a in above if a[0] < depth]
            parent = above[-1][1] if above else host
            nodes.setdefault(number, Node(number, m["name"].strip(), parent, depth))
            above.append((depth, number))
        elif current is not None and ": " in line:
            key, value = line.split(": ", 1)
            current.details[re.sub(r" \[\d+\]$", "", key)] = value
    return list(nodes.values())


def plan_table(spark: SparkSession, sql: str) -> DataFrame:
    """A row for each operator: number, parent, depth, name and what is told of it."""
    rows = [(n.number, n.parent, n.depth, n.operator, n.details) for n in plan_nodes(spark, sql)]
    return spark.createDataFrame(
        rows, "node int, parent int, depth int, operator string, details map<string,string>")


def _listed(value: str) -> list[str]:
    """The parts of ``[a, b(c, d)]`` or of ``struct<a:int,b:string>``."""
    inner = value.strip()
    inner = inner[inner.index("<") + 1:-1] if inner.startswith("struct<") else inner.strip("[]")
    parts, depth, part = [], 0, ""
    for c in inner:
        depth += (c in "([<") - (c in ")]>")
        if c == "," and not depth:
            parts.append(part.strip())
            part = ""
        else:
            part += c
    # Numbers of attributes differ from one analysis to the next.
    return [re.sub(r"#\d+L?", "", p) for p in [*parts, part.strip()] if p]


def _facts(nodes: list[Node]) -> Iterator[tuple[str, str]]:
    for node in nodes:
        yield "operator", node.operator
        for key, name in _COMPARED.items():
            if key in node.details:
                value = node.details[key]
                for part in [value] if name == "buckets" else _listed(value):
                    yield name, part


def plan_difference(spark: SparkSession, sql_a: str, sql_b: str) -> DataFrame:
    """What two plans do a different number of times: (kind, item, plan_a, plan_b).

    Kinds are operators (exchanges, joins, scans and so on), filters pushed to the
    scans, filters on partitions, columns read and buckets.  No row: the plans are
    alike in all of these.
    """
    a, b = (Counter(_facts(plan_nodes(spark, sql))) for sql in (sql_a, sql_b))
    rows = [(kind, item, a[kind, item], b[kind, item])
            for kind, item in sorted({*a, *b}) if a[kind, item] != b[kind, item]]
    return spark.createDataFrame(rows, "kind string, item string, plan_a int, plan_b int")


# Metrics of file scans.
_SCANNED = {"files": "numFiles", "bytes": "filesSize", "partitions": "numPartitions",
            "rows": "numOutputRows"}


def scanned(df: DataFrame) -> dict[str, int]:
    """Files, bytes, partitions and rows that a query's scans have read.

    Runs ``df`` and brings its rows to the driver, so it is for reports and other small
    results; the figures are the executed plan's own.
    """
    df.collect()
    total = dict.fromkeys(_SCANNED, 0)
    for node in _executed(df._jdf.queryExecution().executedPlan()):
        metrics = node.metrics()
        if not metrics.contains("numFiles"):
            continue
        for name, key in _SCANNED.items():
            if metrics.contains(key):
                total[name] += int(metrics.apply(key).value())
    return total


def _executed(node) -> Iterator:
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _executed(node.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from _executed(node.plan())
        return
    if kind == "ReusedExchangeExec":
        return
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _executed(children.apply(i))

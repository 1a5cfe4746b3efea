"""Invoice lines from an order star schema.

Maps ``lineitem``, ``orders``, ``customer``, ``nation`` and ``part`` to the raw
text schema of invoice lines, with cancellations, odd codes, missing customers
and quantities and zero prices in it.

All five tables are joined, whatever columns are wanted: a line without its
order, customer, nation or part is no invoice line, so the rows do not depend
on the columns.  Unused columns are still pruned from the scans.  Orders meet
customers first, so the wide line table crosses one exchange on the order key;
it does so as the few numbers the text is made of, and becomes text after the
join.  What a part alone decides is made into text once for each part, before the join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.fixed_values import DATE_FORMAT, RAW_COLUMNS
from tillroll.functions.labels import quoted

# Country name per nation key, and product words renamed.
COUNTRIES = (
    "United Kingdom", "France", "Germany", "EIRE", "Spain", "Netherlands", "Belgium",
    "Switzerland", "Portugal", "Australia", "Norway", "Italy", "Channel Islands",
    "Finland", "Cyprus", "Sweden", "Austria", "Denmark", "Japan", "Poland", "USA",
    "Israel", "Unspecified", "Brazil", "RSA",
)
PRODUCT_WORDS = (
    ("ring", "heart"), ("gear", "clock"), ("plate", "cake"), ("bolt", "bag"),
    ("widget", "retrospot"),
)


def _renamed(name: str) -> str:
    for word, new in PRODUCT_WORDS:
        name = f"replace({name}, {quoted(word)}, {quoted(new)})"
    return name


# Raw column -> SQL text over the star-schema columns.
_TEXT = {
    "InvoiceNo": "IF(l_returnflag = 'R' AND l_linenumber = 1, 'C', '') "
    "|| CAST(l_orderkey + 536365 AS STRING)",
    "StockCode": "StockCode",
    "Description": "Description",
    "Quantity": "IF(l_linenumber = 7 AND l_quantity = 1, NULL, "
    "CAST(CAST(l_quantity AS INT) AS STRING))",
    "InvoiceDate": f"date_format(o_orderdate, '{DATE_FORMAT}')",
    "UnitPrice": "UnitPrice",
    "CustomerID": "IF(o_custkey % 13 = 0, NULL, CAST((o_custkey * 7919) % 30000 AS STRING))",
    "Country": f"get(array({', '.join(map(quoted, COUNTRIES))}), n_nationkey)",
}

# The same over the columns of ``part``.
_PART_TEXT = {
    "StockCode": "lpad(CAST(p_partkey AS STRING), 5, '0') || IF(p_partkey % 97 = 0, 'A', '')",
    "Description": f"' ' || upper({_renamed('p_name')}) || ' '",
    "UnitPrice": "CAST(IF(p_partkey % 211 = 5, 0D, "
    "CAST(45 + p_partkey % 251 AS DOUBLE) / 100D) AS STRING)",
}

# Known types: no pass over file footers to find them.
_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int",
    "part": "p_partkey bigint, p_name string",
}


def retail_lines(spark: SparkSession, folder: str,
                 columns: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    """The wanted raw columns, in raw order, all text."""
    wanted = [c for c in RAW_COLUMNS if c in set(columns)]

    def table(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    def keyed(frame: DataFrame, key: str, name: str) -> DataFrame:
        return frame.withColumnRenamed(key, name)

    homes = keyed(table("customer"), "c_nationkey", "n_nationkey").join(
        table("nation"), "n_nationkey")
    orders = table("orders").join(keyed(homes, "c_custkey", "o_custkey"), "o_custkey")
    parts = table("part").selectExpr(
        "p_partkey AS l_partkey", *[f"{_PART_TEXT[c]} AS {c}" for c in wanted if c in _PART_TEXT])
    lines = (
        table("lineitem")
        .join(keyed(orders, "o_orderkey", "l_orderkey"), "l_orderkey")
        .join(parts, "l_partkey")
    )
    return lines.selectExpr(*[f"{_TEXT[c]} AS {c}" for c in wanted])

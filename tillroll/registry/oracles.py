"""The same queries as SQL for a second engine, built from shared WITH parts."""

from __future__ import annotations

from tillroll.registry import expected

# Stated here a second time so that the check does not lean on the engine under
# test.  Fixed values: Spark's English stop words.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd "
    "you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't "
    "won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's "
    "let's ought that's there's what's when's where's who's why's would"
).split()


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(branches: list[tuple[str, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {condition} THEN {_text(label)}" for condition, label in branches)
    return f"CASE {whens} ELSE {_text(otherwise)} END"


_COUNTRY = "CASE c_nationkey {} END".format(
    " ".join(f"WHEN {i} THEN {_text(c)}" for i, c in enumerate(expected.COUNTRIES))
)
_CONTINENT = _case(
    [(f"contains(Country, {_text(n)})", label) for n, label in expected.CONTINENTS],
    expected.CONTINENT_ELSE,
)
_CATEGORY = _case(
    [(f"contains(desc_clean, {_text(n)})", label) for n, label in expected.CATEGORIES],
    expected.CATEGORY_ELSE,
)
_STOP = ", ".join(_text(w) for w in (*ENGLISH_STOP_WORDS, *expected.EXTRA_STOP_WORDS))
_SAMPLE_HASH = (
    "md5(concat_ws('|', InvoiceNo, ItemCode, Description, CAST(Quantity AS VARCHAR), "
    "CustomerID, Country))"
)
_SAMPLE_ORDER = (
    f"{_SAMPLE_HASH}, InvoiceNo, ItemCode, Description, Quantity, CustomerID, Country, "
    "InvoiceDate, UnitPrice"
)
_PHASE2_COLUMNS = (
    "CustomerID", "InvoiceNo", "ItemCode", "Description", "Quantity", "InvoiceDate",
    "UnitPrice", "Country", "OrderAmount", "Purchase_segment", "High_spender", "Shopsize",
    "Continent",
)

# name -> (parts it reads, SELECT)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "retail": ((), f"""
        SELECT
          CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'C' ELSE '' END
            || CAST(o_orderkey + 536365 AS VARCHAR) AS InvoiceNo,
          lpad(CAST(l_partkey AS VARCHAR), 5, '0')
            || CASE WHEN l_partkey % 97 = 0 THEN 'A' ELSE '' END AS StockCode,
          ' ' || upper(replace(replace(replace(replace(replace(p_name,
            'ring', 'heart'), 'gear', 'clock'), 'plate', 'cake'),
            'bolt', 'bag'), 'widget', 'retrospot')) || ' ' AS Description,
          CAST(CAST(CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN NULL
            ELSE l_quantity END AS INTEGER) AS VARCHAR) AS Quantity,
          strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS InvoiceDate,
          CAST(CASE WHEN l_partkey % 211 = 5 THEN 0.0E0
            ELSE CAST(45 + l_partkey % 251 AS DOUBLE) / 100.0E0 END AS VARCHAR) AS UnitPrice,
          CASE WHEN o_custkey % 13 = 0 THEN NULL
            ELSE CAST((o_custkey * 7919) % 30000 AS VARCHAR) END AS CustomerID,
          {_COUNTRY} AS Country
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey"""),
    "typed": (("retail",), """
        SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS INTEGER) AS Quantity,
               strptime(InvoiceDate, '%d/%m/%Y %H:%M:%S') AS InvoiceDate,
               CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country
        FROM retail"""),
    "silver": (("typed",), """
        SELECT * FROM typed
        WHERE CustomerID IS NOT NULL AND UnitPrice IS NOT NULL AND Quantity IS NOT NULL
          AND InvoiceNo IS NOT NULL AND lower(InvoiceNo) NOT LIKE 'c%'
          AND InvoiceNo <> '541431' AND length(StockCode) = 5"""),
    "gold": (("silver",), f"""
        SELECT *, {_CATEGORY} AS product_category FROM (
          SELECT InvoiceNo, StockCode AS ItemCode, Description, Quantity, InvoiceDate,
                 UnitPrice, CustomerID, Country, lower(Description) AS desc_clean,
                 Quantity * UnitPrice AS OrderAmount,
                 CASE WHEN CAST(CustomerID AS INTEGER) < 10000 THEN 'High_spender'
                      WHEN CAST(CustomerID AS INTEGER) < 20000 THEN 'Medium_spender'
                      ELSE 'Low_spender' END AS Purchase_segment,
                 CASE Country WHEN 'United Kingdom' THEN 'Large' WHEN 'France' THEN 'Medium'
                      ELSE 'Small' END AS Shopsize,
                 CASE WHEN Country IN ('United Kingdom', 'France') THEN 'Europe'
                      ELSE 'Other' END AS Continent
          FROM silver)"""),
    "phase1": (("typed",), """
        SELECT *, Quantity * UnitPrice AS OrderAmount FROM typed
        WHERE CustomerID IS NOT NULL AND UnitPrice IS NOT NULL AND Quantity IS NOT NULL
          AND InvoiceNo IS NOT NULL"""),
    "phase1_v1": (("phase1",),
        "SELECT * FROM phase1 WHERE NOT coalesce(lower(InvoiceNo) LIKE 'c%', false)"),
    "phase1_v2": (("phase1_v1",),
        "SELECT * FROM phase1_v1 WHERE NOT coalesce(InvoiceNo = '541431', false)"),
    "phase1_v3": (("phase1_v2",),
        "SELECT * FROM phase1_v2 WHERE NOT coalesce(length(StockCode) <> 5, false)"),
    "phase2": (("phase1_v3",), f"""
        SELECT CustomerID, InvoiceNo, StockCode AS ItemCode,
               upper(trim(Description)) AS Description, Quantity, InvoiceDate, UnitPrice,
               Country, OrderAmount,
               CASE WHEN OrderAmount < 5 THEN 'Low' WHEN OrderAmount < 20 THEN 'Medium'
                    ELSE 'High' END AS Purchase_segment,
               OrderAmount > 100 AS High_spender,
               CASE WHEN Quantity < 3 THEN 'Small' WHEN Quantity < 12 THEN 'Medium'
                    WHEN Quantity < 50 THEN 'Big' ELSE 'Very_Big' END AS Shopsize,
               {_CONTINENT} AS Continent
        FROM phase1_v3 WHERE UnitPrice > 0 AND Quantity > 0"""),
    "categorised": (("phase2",), f"""
        SELECT *, {_CATEGORY} AS product_category
        FROM (SELECT *, lower(Description) AS desc_clean FROM phase2)"""),
    "phase3": (("categorised",), f"""
        SELECT * FROM categorised ORDER BY {_SAMPLE_ORDER} LIMIT {expected.SAMPLE_ROWS}"""),
    "rest": (("phase2", "phase3"), """
        SELECT * FROM phase2 p WHERE NOT EXISTS (SELECT 1 FROM phase3 s WHERE {})""".format(
        " AND ".join(f"s.{c} = p.{c}" for c in _PHASE2_COLUMNS))),
    "source": (("rest",), """
        SELECT * REPLACE (lpad(ItemCode, 5, '0') AS ItemCode, Quantity * UnitPrice AS OrderAmount)
        FROM rest WHERE Quantity * UnitPrice > 0 AND lower(InvoiceNo) NOT LIKE 'c%'"""),
    "merged": (("source", "phase3"), """
        SELECT * FROM source s WHERE NOT EXISTS (
          SELECT 1 FROM phase3 t WHERE t.InvoiceNo = s.InvoiceNo
            AND t.ItemCode = s.ItemCode AND t.CustomerID = s.CustomerID)"""),
    "phase4": (("phase3", "merged"),
        "SELECT * FROM phase3 UNION ALL BY NAME SELECT * FROM merged"),
    "top100": (("phase2",), """
        SELECT * FROM phase2 ORDER BY OrderAmount DESC, InvoiceNo, ItemCode, Quantity LIMIT 100"""),
    "running100": (("top100",), """
        SELECT *, sum(OrderAmount) OVER (ORDER BY OrderAmount DESC, InvoiceNo, ItemCode, Quantity
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_amount,
               sum(OrderAmount) OVER () AS whole
        FROM top100"""),
    "by_country": (("phase2",), """
        SELECT Country, round(sum(OrderAmount), 2) AS CA FROM phase2 GROUP BY Country"""),
    "months": (("phase2",), """
        SELECT CAST(year(InvoiceDate) AS INTEGER) AS Year,
               CAST(month(InvoiceDate) AS INTEGER) AS Month, round(sum(OrderAmount), 2) AS CA
        FROM phase2 GROUP BY 1, 2"""),
    "worded": (("phase2",), f"""
        SELECT Description,
               list_filter(string_split_regex(lower(Description), '\\s'),
                           lambda x: x NOT IN ({_STOP})) AS w
        FROM phase2"""),
    "paired": (("worded",), """
        SELECT Description, list_transform(range(1, greatest(len(w), 1)),
                 lambda i: w[i] || ' ' || w[i + 1]) AS b
        FROM worded"""),
    "raw_paired": (("retail",), f"""
        SELECT list_transform(range(1, greatest(len(w), 1)),
                 lambda i: w[i] || ' ' || w[i + 1]) AS b
        FROM (SELECT list_filter(string_split_regex(rtrim(lower(Description)), '\\s'),
                                 lambda x: x NOT IN ({_STOP})) AS w FROM retail)"""),
    "delta": (("phase1", "phase4"), """
        SELECT coalesce(a.Country, b.Country) AS Country, a.r AS revenue_v0, b.r AS revenue_v1,
               round(b.r - a.r, 2) AS revenue_delta
        FROM (SELECT Country, round(sum(OrderAmount), 2) AS r FROM phase1 GROUP BY Country) a
        FULL JOIN (SELECT Country, round(sum(OrderAmount), 2) AS r FROM phase4 GROUP BY Country) b
          ON a.Country IS NOT DISTINCT FROM b.Country"""),
}


def with_parts(select: str, *parts: str) -> str:
    """``select`` behind a WITH clause of everything ``parts`` lean on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in PARTS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        visit(part)
    clauses = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in ordered)
    return f"WITH {clauses}\n{select}"


def _revenue(key: str, table: str, name: str = "total_revenue") -> str:
    return f"SELECT {key}, round(sum(OrderAmount), 2) AS {name} FROM {table} GROUP BY {key}"


def _rules(rules, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(n)} AS name, count(*) FILTER (WHERE {p}) AS violations, "
        f"count(*) FILTER (WHERE {p}) = 0 AS passed FROM {table}"
        for n, p in rules.items()
    )


def _share(key: str, total: str) -> str:
    return (
        f"SELECT {key}, {total}, round({total} / sum({total}) OVER () * 100, 2) AS Part_CA_pct "
        f"FROM ({_revenue(key, 'phase2', total)})"
    )


def _cumulative(key: str) -> str:
    return (
        f"SELECT {key}, total_revenue, round(sum(total_revenue) OVER (ORDER BY total_revenue "
        f"DESC), 2) AS cumulative_contribution FROM ({_revenue(key, 'gold')})"
    )


def _distinct(columns, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(c)} AS column_name, count(*) AS distinct_values "
        f"FROM (SELECT DISTINCT {c} FROM {table})"
        for c in columns
    )


def _check(name: str) -> str:
    predicate = expected.TABLE_CHECKS[name]
    return (
        f"SELECT {_text(name)} AS check_name, count(*) AS rows, "
        f"count(*) FILTER (WHERE NOT coalesce({predicate}, false)) AS broken_rows FROM phase3"
    )


# Columns of phase 1, and whether they are numbers.
_PHASE1_COLUMNS = {
    "InvoiceNo": False, "StockCode": False, "Description": False, "Quantity": True,
    "InvoiceDate": False, "UnitPrice": True, "CustomerID": False, "Country": False,
    "OrderAmount": True,
}
_PROFILED = (
    "(SELECT * REPLACE (CAST(round(OrderAmount, 2) AS DECIMAL(18, 2)) AS OrderAmount) FROM phase1)"
)


def _profile_row(column: str, numeric: bool) -> str:
    top = (
        f"(SELECT {{}} FROM (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM {_PROFILED} "
        f"WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1))"
    )
    if numeric:
        numbers = (
            f"round(avg(CAST({column} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({column} AS DOUBLE)), 6) AS stddev, "
            f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, "
            f"CAST(quantile_disc({column}, 0.25) AS DOUBLE) AS Q1, "
            f"CAST(quantile_disc({column}, 0.5) AS DOUBLE) AS median, "
            f"CAST(quantile_disc({column}, 0.75) AS DOUBLE) AS Q3"
        )
    else:
        numbers = ", ".join(
            f"CAST(NULL AS DOUBLE) AS {n}"
            for n in ("mean", "stddev", "min", "max", "Q1", "median", "Q3")
        )
    return (
        f"SELECT {_text(column)} AS column_name, count(*) AS rows, "
        f"count(*) - count({column}) AS null_rows, count(DISTINCT {column}) AS distinct_values, "
        f"{top.format('v')} AS top_value, {top.format('n')} AS top_rows, {numbers} FROM {_PROFILED}"
    )


def _top_values(column: str) -> str:
    return (
        f"SELECT * FROM (SELECT {_text(column)} AS column_name, CAST({column} AS VARCHAR) AS value, "
        f"count(*) AS rows, CAST(row_number() OVER (ORDER BY count(*) DESC, "
        f"CAST({column} AS VARCHAR) NULLS FIRST) AS INTEGER) AS rank FROM {_PROFILED} GROUP BY {column}) "
        f"WHERE rank <= 10"
    )


_DESCRIBED = {
    "count": "count({})", "mean": "avg({})", "stddev": "stddev_samp({})",
    "min": "min({})", "max": "max({})",
}


def _described(columns, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(name)} AS summary, "
        + ", ".join(f"round(CAST({f.format(c)} AS DOUBLE), 6) AS {c}" for c in columns)
        + f" FROM {table}"
        for name, f in _DESCRIBED.items()
    )


_SUMMARY = with_parts("""
    SELECT min(OrderAmount) AS min, max(OrderAmount) AS max, round(avg(OrderAmount), 1) AS avg,
           round(quantile_disc(OrderAmount, 0.25), 1) AS Q1,
           round(quantile_disc(OrderAmount, 0.5), 1) AS median,
           round(quantile_disc(OrderAmount, 0.75), 1) AS Q3
    FROM phase2""", "phase2")

_HISTORY = with_parts("""
    SELECT 'phase1' AS table_name, CAST(0 AS BIGINT) AS version, 'WRITE' AS operation,
           (SELECT count(*) FROM phase1) AS rows
    UNION ALL SELECT 'phase1', 1, 'DELETE',
           (SELECT count(*) FROM phase1) - (SELECT count(*) FROM phase1_v1)
    UNION ALL SELECT 'phase1', 2, 'DELETE',
           (SELECT count(*) FROM phase1_v1) - (SELECT count(*) FROM phase1_v2)
    UNION ALL SELECT 'phase1', 3, 'DELETE',
           (SELECT count(*) FROM phase1_v2) - (SELECT count(*) FROM phase1_v3)
    UNION ALL SELECT 'phase4', 0, 'WRITE', (SELECT count(*) FROM phase3)
    UNION ALL SELECT 'phase4', 1, 'MERGE', (SELECT count(*) FROM merged)""",
    "phase1_v3", "phase3", "merged")

_HISTOGRAM = with_parts("""
    SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_start, count(v) AS rows
    FROM (SELECT unnest(range(50)) AS bin, lo, hi
          FROM (SELECT min(OrderAmount) AS lo, max(OrderAmount) AS hi FROM phase2))
    LEFT JOIN (SELECT OrderAmount AS v, least(CAST(floor((OrderAmount - lo) / (hi - lo) * 50)
                 AS BIGINT), 49) AS b
               FROM phase2, (SELECT min(OrderAmount) AS lo, max(OrderAmount) AS hi FROM phase2))
      ON b = bin
    GROUP BY bin, lo, hi""", "phase2")

_ROUNDED = "SELECT * REPLACE (round(OrderAmount, 2) AS OrderAmount) FROM {}"
_LINE = "InvoiceNo, StockCode, CustomerID, Quantity, UnitPrice"
_RAW_LINE = "InvoiceNo, StockCode, Quantity, UnitPrice, CustomerID"
_BY_SEGMENT = _revenue("Purchase_segment", "gold")
_CATEGORY_COUNTS = (
    "SELECT product_category, count(*) AS count FROM {} GROUP BY product_category"
)

ORACLES: dict[str, str] = {
    "s01_typed_csv": with_parts("SELECT * FROM retail", "retail"),
    "s02_load_raw_data": with_parts("SELECT * FROM retail", "retail"),
    "s03_inferred_csv": with_parts("""
        SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS INTEGER) AS Quantity,
               InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
               CAST(CustomerID AS INTEGER) AS CustomerID, Country FROM retail""", "retail"),
    "s04_csv_catalog_table": with_parts("""
        SELECT Country, count(*) AS lines, CAST(sum(CAST(Quantity AS INTEGER)) AS BIGINT) AS pieces
        FROM retail GROUP BY Country""", "retail"),
    "s05_layer_by_path": with_parts(
        "SELECT Country, count(*) AS count FROM silver GROUP BY Country", "silver"),
    "s06_table_by_name": with_parts(_revenue("Country", "phase2"), "phase2"),
    "s07_version_read": with_parts(_ROUNDED.format("phase1"), "phase1"),
    "s08_first_rows": with_parts("""
        SELECT least(count(*), 5) AS row_count FROM retail
        UNION ALL SELECT least(count(*), 5000) FROM retail""", "retail"),
    "s09_fraction_sample": with_parts(f"""
        SELECT InvoiceNo, round(OrderAmount, 2) AS OrderAmount FROM phase2
        WHERE {_SAMPLE_HASH} < '199999999999'""", "phase2"),
    "k01_write_layer_partitioned": with_parts(_BY_SEGMENT, "gold"),
    "k01_any_partition_text": with_parts("""
        SELECT * REPLACE (CASE WHEN UnitPrice = '0.0' THEN '' ELSE Quantity END AS Quantity)
        FROM retail""", "retail"),
    "k02_named_table_overwrite": with_parts(_ROUNDED.format("phase1"), "phase1"),
    "k03_partitioned_by_country_continent": with_parts(_revenue("Country", "phase4"), "phase4"),
    "k04_partitioned_by_continent_category": with_parts(
        _CATEGORY_COUNTS.format("phase4"), "phase4"),
    "k05_bucketed_by_country_shopsize": with_parts("""
        SELECT Country, Shopsize, count(*) AS lines, round(sum(OrderAmount), 2) AS total_revenue
        FROM phase4 GROUP BY Country, Shopsize""", "phase4"),
    "k05_line_share_in_its_bucket": with_parts("""
        SELECT InvoiceNo, ItemCode, CustomerID, Country, Shopsize, round(OrderAmount
                 / sum(OrderAmount) OVER (PARTITION BY Country, Shopsize), 9) AS share
        FROM phase4""", "phase4"),
    "k05_rows_of_one_bucket": with_parts("""
        SELECT InvoiceNo, ItemCode, CustomerID, round(OrderAmount, 2) AS OrderAmount
        FROM phase4 WHERE Country = 'France' AND Shopsize = 'Big'""", "phase4"),
    "k06_partitioned_copy_one_country": with_parts(
        _revenue("Country", "(SELECT * FROM gold WHERE Country = 'France')"), "gold"),
    "k06_partitioned_copy_all_countries": with_parts(_revenue("Country", "gold"), "gold"),
    "k07_list_partitions": with_parts("""
        SELECT DISTINCT 'Country=' || Country || '/Continent=' || Continent AS partition
        FROM phase4""", "phase4"),
    "k08_bucket_contents": with_parts("""
        SELECT Country, Shopsize, CAST(1 AS BIGINT) AS buckets, count(*) AS rows
        FROM phase4 GROUP BY Country, Shopsize""", "phase4"),
    "k10_temp_view": with_parts(
        "SELECT Country, count(*) AS lines FROM phase2 GROUP BY Country", "phase2"),
    "t01_delete_cancelled": with_parts(_ROUNDED.format("phase1_v1"), "phase1_v1"),
    "t02_delete_outlier": with_parts(_ROUNDED.format("phase1_v2"), "phase1_v2"),
    "t03_delete_non_articles": with_parts(_ROUNDED.format("phase1_v3"), "phase1_v3"),
    "t03_delete_rewritten": with_parts(_ROUNDED.format("phase1_v3"), "phase1_v3"),
    "t04_merge_insert": with_parts("SELECT * FROM phase4", "phase4"),
    "t05_check_purchase_positive": with_parts(_check("purchase_positive"), "phase3"),
    "t06_check_not_cancelled": with_parts(_check("invoice_not_cancelled"), "phase3"),
    "t07_check_itemcode_length": with_parts(_check("itemcode_length_check"), "phase3"),
    "t08_history": _HISTORY,
    "f01_complete_lines": with_parts(f"""
        SELECT {_RAW_LINE} FROM retail
        WHERE CustomerID IS NOT NULL AND UnitPrice IS NOT NULL AND Quantity IS NOT NULL
          AND InvoiceNo IS NOT NULL""", "retail"),
    "f02_not_cancelled": with_parts("""
        SELECT InvoiceNo, StockCode FROM retail WHERE lower(InvoiceNo) NOT LIKE 'c%'""", "retail"),
    "f03_not_outlier": with_parts(
        "SELECT InvoiceNo, StockCode FROM retail WHERE InvoiceNo <> '541431'", "retail"),
    "f04_article_codes": with_parts(
        "SELECT InvoiceNo, StockCode FROM retail WHERE length(StockCode) = 5", "retail"),
    "f05_clean_transactions": with_parts("SELECT * FROM silver", "silver"),
    "f05_clean_transactions_notebook": with_parts("SELECT * FROM phase1", "phase1"),
    "f06_positive_price_quantity": with_parts(
        f"SELECT {_LINE} FROM phase1_v3 WHERE UnitPrice > 0 AND Quantity > 0", "phase1_v3"),
    "f07_positive_amount": with_parts(
        "SELECT InvoiceNo, ItemCode, OrderAmount FROM gold WHERE OrderAmount > 0", "gold"),
    "f08_customers_of_france": with_parts(
        "SELECT CustomerID FROM phase2 WHERE Country = 'France'", "phase2"),
    "f09_high_spender_lines": with_parts(
        "SELECT InvoiceNo, ItemCode, OrderAmount FROM phase2 WHERE High_spender", "phase2"),
    "f09_high_spender_segment": with_parts("""
        SELECT InvoiceNo, ItemCode, CustomerID FROM gold
        WHERE Purchase_segment = 'High_spender'""", "gold"),
    "f10_cancelled_rows": with_parts("""
        SELECT count(*) FILTER (WHERE lower(InvoiceNo) LIKE 'c%') AS cancelled_rows,
               'before' AS state FROM phase1
        UNION ALL
        SELECT count(*) FILTER (WHERE lower(InvoiceNo) LIKE 'c%'), 'after'
        FROM phase1_v1""", "phase1_v1"),
    "f11_projected_sales": with_parts("""
        SELECT CustomerID, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
               Country, OrderAmount
        FROM phase1_v3 WHERE UnitPrice > 0 AND Quantity > 0""", "phase1_v3"),
    "f12_renamed_code": with_parts(
        "SELECT InvoiceNo, StockCode AS ItemCode FROM silver", "silver"),
    "f13_dropped_tokens": with_parts(
        "SELECT InvoiceNo, ItemCode, Description FROM phase2", "phase2"),
    "f14_casts": with_parts(
        "SELECT InvoiceNo, Quantity, InvoiceDate, UnitPrice FROM typed", "typed"),
    "f15_order_amount": with_parts("""
        SELECT InvoiceNo, Quantity, UnitPrice, round(Quantity * UnitPrice, 2) AS OrderAmount
        FROM typed""", "typed"),
    "e01_amount_segment": with_parts(
        "SELECT InvoiceNo, ItemCode, Purchase_segment FROM phase2", "phase2"),
    "e02_customer_segment": with_parts(
        "SELECT InvoiceNo, CustomerID, Purchase_segment FROM gold", "gold"),
    "e03_high_spender_flag": with_parts(
        "SELECT InvoiceNo, ItemCode, High_spender FROM phase2", "phase2"),
    "e04_shopsize_by_quantity": with_parts(
        "SELECT InvoiceNo, Quantity, Shopsize FROM phase2", "phase2"),
    "e05_shopsize_by_country": with_parts("SELECT InvoiceNo, Country, Shopsize FROM gold", "gold"),
    "e06_continent_by_name_part": with_parts(
        "SELECT InvoiceNo, Country, Continent FROM phase2", "phase2"),
    "e07_continent_by_country": with_parts(
        "SELECT InvoiceNo, Country, Continent FROM gold", "gold"),
    "e08_product_category": with_parts(
        "SELECT InvoiceNo, desc_clean, product_category FROM gold", "gold"),
    "e09_lowered_description": with_parts("SELECT ItemCode, desc_clean FROM gold", "gold"),
    "e10_normalised_description": with_parts("SELECT ItemCode, Description FROM phase2", "phase2"),
    "e11_padded_code": with_parts(
        "SELECT InvoiceNo, lpad(StockCode, 5, '0') AS ItemCode FROM retail", "retail"),
    "e12_enrich_transactions": with_parts(
        "SELECT * REPLACE (round(OrderAmount, 2) AS OrderAmount) FROM gold", "gold"),
    "e12_enrich_notebook": with_parts(
        "SELECT * REPLACE (round(OrderAmount, 2) AS OrderAmount) FROM phase2", "phase2"),
    "a01_sales_by_country": with_parts(_revenue("Country", "gold"), "gold"),
    "a02_sales_by_product_category": with_parts(_revenue("product_category", "gold"), "gold"),
    "a03_sales_by_continent": with_parts(_revenue("Continent", "gold"), "gold"),
    "a04_sales_by_purchase_segment": with_parts(_BY_SEGMENT, "gold"),
    "a05_sales_by_shopsize": with_parts(_revenue("Shopsize", "gold"), "gold"),
    "a06_mean_spend_by_segment": with_parts("""
        SELECT Purchase_segment, round(avg(OrderAmount), 6) AS mean_spend
        FROM gold GROUP BY Purchase_segment""", "gold"),
    "a06_mean_spend_by_amount_segment": with_parts("""
        SELECT Purchase_segment, round(avg(OrderAmount), 6) AS mean_spend
        FROM phase2 GROUP BY Purchase_segment""", "phase2"),
    "a07_top_categories_big_customers": with_parts("""
        SELECT product_category, count(*) AS number_of_purchase FROM gold
        WHERE Purchase_segment = 'High_spender' GROUP BY product_category
        ORDER BY number_of_purchase DESC, product_category LIMIT 10""", "gold"),
    "a08_categories_high_spender": with_parts("""
        SELECT product_category, count(*) AS number_of_purchase FROM categorised
        WHERE High_spender GROUP BY product_category""", "categorised"),
    "a09_sales_by_country_continent": with_parts(_revenue("Country, Continent", "gold"), "gold"),
    "a10_rounded_revenue_by_country": with_parts(_revenue("Country", "gold"), "gold"),
    "a11_rows_by_country": with_parts(
        "SELECT Country, count(*) AS count FROM phase1_v3 GROUP BY Country", "phase1_v3"),
    "a12_distinct_counts": with_parts(
        _distinct(("CustomerID", "StockCode", "Description", "Country"), "phase1_v3"),
        "phase1_v3"),
    "a12_distinct_counts_raw": with_parts(
        _distinct(("CustomerID", "Quantity", "InvoiceNo"), "retail"), "retail"),
    "a13_row_count": with_parts("SELECT count(*) AS row_count FROM phase1_v3", "phase1_v3"),
    "a14_column_count": with_parts(
        "SELECT count(*) AS row_count, 9 AS column_count FROM phase1_v3", "phase1_v3"),
    "a15_describe": with_parts(_described(("Quantity", "UnitPrice"), "phase1_v3"), "phase1_v3"),
    "a16_order_amount_summary": _SUMMARY,
    "a16_order_amount_summary_distributed": _SUMMARY,
    "a16_order_amount_summary_sketch": with_parts("""
        SELECT min(OrderAmount) AS min, max(OrderAmount) AS max, round(avg(OrderAmount), 1) AS avg,
               true AS Q1, true AS median, true AS Q3
        FROM phase2""", "phase2"),
    "a17_top_customers": with_parts(
        _revenue("CustomerID", "phase2", "TotalDepense")
        + " ORDER BY TotalDepense DESC, CustomerID LIMIT 10", "phase2"),
    "a18_top_items_by_quantity": with_parts("""
        SELECT ItemCode, CAST(sum(Quantity) AS BIGINT) AS TotalQuantite FROM phase2
        GROUP BY ItemCode ORDER BY TotalQuantite DESC, ItemCode LIMIT 10""", "phase2"),
    "a19_order_sizes": with_parts("""
        SELECT InvoiceNo, count(*) AS NbItem, CAST(sum(Quantity) AS BIGINT) AS QuantiteTotale
        FROM phase2 GROUP BY InvoiceNo""", "phase2"),
    "a20_monthly_revenue": with_parts("SELECT * FROM months", "months"),
    "a21_top_countries": with_parts(
        "SELECT * FROM by_country ORDER BY CA DESC, Country LIMIT 10", "by_country"),
    "a22_rows_by_category": with_parts(_CATEGORY_COUNTS.format("categorised"), "categorised"),
    "a23_distinct_categories": with_parts(
        "SELECT DISTINCT product_category FROM categorised", "categorised"),
    "a24_distinct_descriptions": with_parts("""
        SELECT DISTINCT upper(trim(Description)) AS Description_clean FROM phase2
        ORDER BY 1 LIMIT 10""", "phase2"),
    "a25_total_of_top_lines": with_parts(
        "SELECT round(sum(OrderAmount), 2) AS total_CA FROM top100", "top100"),
    "a26_total_revenue": with_parts(
        "SELECT round(sum(OrderAmount), 2) AS total_revenue FROM phase1", "phase1"),
    "a29_top_bigrams": with_parts("""
        SELECT bigram, count(*) AS count FROM (SELECT unnest(b) AS bigram FROM paired)
        GROUP BY bigram ORDER BY count DESC, bigram LIMIT 100""", "paired"),
    "w01_share_by_country": with_parts(_share("Country", "ChiffreAffaires"), "phase2"),
    "w02_share_by_item": with_parts(
        _share("ItemCode", "CA_Produit") + " ORDER BY CA_Produit DESC, ItemCode LIMIT 10",
        "phase2"),
    "w02_share_by_item_all": with_parts(_share("ItemCode", "CA_Produit"), "phase2"),
    "w03_running_amount": with_parts("""
        SELECT InvoiceNo, CustomerID, round(OrderAmount, 2) AS OrderAmount,
               round(cum_amount, 2) AS cum_amount FROM running100""", "running100"),
    "w04_running_percent": with_parts("""
        SELECT InvoiceNo, CustomerID, round(OrderAmount, 2) AS OrderAmount,
               round(cum_amount, 2) AS cum_amount, round(cum_amount / whole * 100, 2) AS cum_pct
        FROM running100 ORDER BY running100.cum_amount, InvoiceNo, ItemCode LIMIT 32""", "running100"),
    "w05_cumulative_by_country": with_parts(_cumulative("Country"), "gold"),
    "w06_cumulative_by_customer": with_parts(_cumulative("CustomerID"), "gold"),
    "w06_cumulative_by_customer_distributed": with_parts(_cumulative("CustomerID"), "gold"),
    "j01_rest_of_sample": with_parts(
        "SELECT * REPLACE (round(OrderAmount, 2) AS OrderAmount) FROM rest", "rest"),
    "l02_top_lines": with_parts("""
        SELECT InvoiceNo, ItemCode, Quantity, round(OrderAmount, 2) AS OrderAmount
        FROM top100""", "top100"),
    "l04_sample_5000": with_parts("""
        SELECT InvoiceNo, ItemCode, Description, Quantity, CustomerID, Country
        FROM phase3""", "phase3"),
    "l04_sample_by_threshold": with_parts(f"""
        SELECT InvoiceNo, ItemCode, Description, Quantity, CustomerID, Country
        FROM phase2 ORDER BY {_SAMPLE_ORDER} LIMIT 500""", "phase2"),
    "l05_second_category": with_parts(
        _CATEGORY_COUNTS.format("categorised")
        + " ORDER BY count DESC, product_category LIMIT 1 OFFSET 1", "categorised"),
    "x01_space_tokens": with_parts("""
        SELECT array_to_string(string_split(lower(Description), ' '), '|') AS tokens,
               count(*) AS lines FROM retail GROUP BY 1""", "retail"),
    "x02_words": with_parts("""
        SELECT array_to_string(string_split_regex(rtrim(lower(Description)), '\\s'), '|') AS words,
               count(*) AS lines FROM retail GROUP BY 1""", "retail"),
    "x03_clean_words": with_parts("""
        SELECT array_to_string(w, '|') AS words_clean, count(*) AS lines
        FROM worded GROUP BY 1""", "worded"),
    "x04_bigrams": with_parts("""
        SELECT array_to_string(b, '|') AS bigrams, count(*) AS lines
        FROM paired GROUP BY 1""", "paired"),
    "x05_bigram_counts": with_parts("""
        SELECT bigram, count(*) AS count FROM (SELECT unnest(b) AS bigram FROM raw_paired)
        GROUP BY bigram""", "raw_paired"),
    "q02_cleaning_rules": with_parts(_rules(expected.CLEANING_RULES, "retail"), "retail"),
    "q02_cleaning_rules_silver": with_parts(_rules(expected.CLEANING_RULES, "silver"), "silver"),
    "q03_enriched_rules": with_parts(_rules(expected.ENRICHED_RULES, "gold"), "gold"),
    "q04_check_report": with_parts("""
        SELECT 'enriched' AS scope, count(*) AS row_count, name, max(violations) AS violations,
               max(bad) = 0 AS passed
        FROM gold, (SELECT *, sum(violations) OVER () AS bad FROM ({}))
        GROUP BY name""".format(_rules(expected.ENRICHED_RULES, "gold")), "gold"),
    "q06_profile": with_parts(
        " UNION ALL ".join(_profile_row(c, numeric) for c, numeric in _PHASE1_COLUMNS.items()),
        "phase1"),
    "q06_top_values": with_parts(
        " UNION ALL ".join(_top_values(c) for c in _PHASE1_COLUMNS), "phase1"),
    "u01_labelled_revenue": with_parts("""
        SELECT 'v0' AS version, Country, round(sum(OrderAmount), 2) AS total_revenue
        FROM phase1 GROUP BY Country
        UNION ALL
        SELECT 'v1', Country, round(sum(OrderAmount), 2) FROM phase4 GROUP BY Country""",
        "phase1", "phase4"),
    "v01_revenue_delta_by_country": with_parts("SELECT * FROM delta", "delta"),
    "v02_total_revenue_by_version": with_parts("""
        SELECT 'phase1_v0' AS version, round(sum(OrderAmount), 2) AS total_revenue FROM phase1
        UNION ALL SELECT 'phase4_v1', round(sum(OrderAmount), 2) FROM phase4""",
        "phase1", "phase4"),
    "v03_delta_summary": with_parts("""
        SELECT round(coalesce(sum(revenue_delta) FILTER (WHERE revenue_delta > 0), 0), 2)
                 AS total_positive_delta,
               round(coalesce(sum(revenue_delta) FILTER (WHERE revenue_delta < 0), 0), 2)
                 AS total_negative_delta
        FROM delta""", "delta"),
    "p01_amount_histogram": _HISTOGRAM,
    "p02_country_bars": with_parts("""
        SELECT CAST(row_number() OVER (ORDER BY CA DESC, Country) AS INTEGER) AS bar, Country,
               round(CA / max(CA) OVER (), 6) AS length
        FROM by_country ORDER BY bar LIMIT 10""", "by_country"),
    "p03_monthly_line": with_parts(
        "SELECT concat_ws('-', CAST(Year AS VARCHAR), CAST(Month AS VARCHAR)) AS Date, CA "
        "FROM months", "months"),
    "o01_report_on_stored_gold": with_parts(
        " UNION ALL ".join(
            f"SELECT {key} AS label, round(sum(OrderAmount), 2) AS total_revenue "
            f"FROM gold GROUP BY {key}"
            for key in ("Country", "product_category", "Continent", "Purchase_segment")
        ), "gold"),
    "o03_layer_counts": with_parts("""
        SELECT 'bronze' AS layer, count(*) AS row_count FROM retail
        UNION ALL SELECT 'silver', count(*) FROM silver
        UNION ALL SELECT 'gold', count(*) FROM silver WHERE UnitPrice > 0 AND Quantity > 0""",
        "retail", "silver"),    "o03_layer_rows": with_parts(" UNION ALL ".join(
        f"SELECT '{layer}' AS layer, InvoiceNo, StockCode AS code, Description, "
        f"CAST(Quantity AS INTEGER) AS Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice, "
        f"CustomerID, Country, {amount} AS OrderAmount FROM {rows}"
        for layer, rows, amount in (
            ("bronze", "retail", "CAST(NULL AS DOUBLE)"), ("silver", "silver", "CAST(NULL AS DOUBLE)"),
            ("gold", "silver WHERE UnitPrice > 0 AND Quantity > 0",
             "round(Quantity * UnitPrice, 2)"))), "retail", "silver"),
}

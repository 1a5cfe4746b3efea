"""Queries by inventory key: ``query(spark, folder) -> DataFrame``.

Money columns are rounded here, because two engines add doubles in different
orders; the operators themselves return raw doubles where the reports do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions.workspace import fresh_path, stored
from tillroll.operators import (
    cleaning,
    comparison,
    cumulative,
    enrichment,
    quality,
    revenue,
    sampling,
    statistics,
    texts,
)
from tillroll.plans import phases as flow
from tillroll.plans import medallion, reports
from tillroll.sources import readers, writers
from tillroll.sources.star import retail_lines
from tillroll.tables import VersionedTable, check_counters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Columns the cleaning filters look at; the rest is read only when wanted.
_FILTERED = ("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID")
# What the sample is ordered by: text that both engines write alike.
SAMPLE_KEYS = ("InvoiceNo", "ItemCode", "Description", "Quantity", "CustomerID", "Country")


def query(key: str):
    def register(function: Query) -> Query:
        QUERIES[key] = function
        return function

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def silver(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return cleaning.clean_transactions(retail_lines(spark, folder, (*_FILTERED, *more)))


def gold(spark: SparkSession, folder: str, more: tuple[str, ...], *derived: str) -> DataFrame:
    return enrichment.enrich_transactions(silver(spark, folder, *more), only=derived)


def phase1(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """Complete lines before any delete."""
    return cleaning.clean_transactions(
        retail_lines(spark, folder, (*_FILTERED, *more)), "notebook"
    )


def purged(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """Phase 1 after its three deletes (a NULL code would stay)."""
    from tillroll.functions.predicates import survives_delete

    lines = phase1(spark, folder, *more)
    for predicate in (fixed.CANCELLED_SQL, fixed.OUTLIER_SQL, fixed.NOT_AN_ARTICLE_SQL):
        lines = lines.where(survives_delete(predicate))
    return lines


def phase2(spark: SparkSession, folder: str, more: tuple[str, ...] = (), *derived: str) -> DataFrame:
    lines = cleaning.project_sales(purged(spark, folder, *more))
    return enrichment.enrich_transactions(lines, "notebook", only=derived)


_STAR = ("lineitem", "orders", "customer", "nation", "part")
_built: dict[tuple, flow.Phases] = {}
_gold_paths: dict[tuple, str] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Session, folder, and the files in it with size and time: what is built from
    them is built again when they change."""
    files = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for name in _STAR:
        path = files(f"{folder}/{name}.parquet")
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while listed.hasNext():
            file = listed.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return (spark.sparkContext.applicationId, folder, hash(tuple(sorted(found))))


def built_phases(spark: SparkSession, folder: str) -> flow.Phases:
    """The stored tables of the notebook flow, built once for a state of the tables."""
    key = _state(spark, folder)
    if key not in _built:
        tables = flow.Phases(spark, fresh_path(spark, "phases"))
        _built[key] = flow.build_phases(
            tables, retail_lines(spark, folder), sample_keys=SAMPLE_KEYS
        )
    return _built[key]


def gold_path(spark: SparkSession, folder: str) -> str:
    """A stored gold layer, written once for a state of the tables."""
    key = _state(spark, folder)
    if key not in _gold_paths:
        path = fresh_path(spark, "gold")
        lines = cleaning.clean_transactions(retail_lines(spark, folder))
        VersionedTable(spark, path).overwrite(enrichment.enrich_transactions(lines))
        _gold_paths[key] = path
    return _gold_paths[key]


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


# -- sources ---------------------------------------------------------------


def _csv_copy(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "lines-csv")
    retail_lines(spark, folder).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


@query("s01_typed_csv")
def _(spark, folder):
    return readers.read_raw_csv(spark, _csv_copy(spark, folder))


@query("s02_load_raw_data")
def _(spark, folder):
    return readers.load_raw_data(spark, _csv_copy(spark, folder))


@query("s03_inferred_csv")
def _(spark, folder):
    return readers.read_inferred_csv(spark, _csv_copy(spark, folder))


@query("s04_csv_catalog_table")
def _(spark, folder):
    table = readers.register_csv(spark, _name("df_or"), _csv_copy(spark, folder))
    return table.groupBy("Country").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("pieces")
    )


@query("s05_layer_by_path")
def _(spark, folder):
    path = fresh_path(spark, "silver")
    writers.write_layer(silver(spark, folder, "Country"), path)
    return revenue.rows_by(readers.read_layer(spark, path, "parquet"), "Country")


@query("s06_table_by_name")
def _(spark, folder):
    name = _name("phase2")
    writers.save_named(phase2(spark, folder, ("Country",)), name, path=fresh_path(spark, name))
    table = readers.read_named(spark, name, refresh=True)
    return rounded(revenue.revenue_by(table, "Country"), "total_revenue")


@query("s07_version_read")
def _(spark, folder):
    table = built_phases(spark, folder).table("phase1")
    return rounded(table.read(0), "OrderAmount")


@query("s08_first_rows")
def _(spark, folder):
    lines = retail_lines(spark, folder, ("InvoiceNo",))
    few = statistics.row_count(sampling.first_rows(lines, 5))
    many = statistics.row_count(sampling.first_rows(lines, 5000))
    return few.unionByName(many)


@query("s09_fraction_sample")
def _(spark, folder):
    sample = sampling.fraction(_enriched(spark, folder), 0.1, SAMPLE_KEYS)
    return rounded(sample.select("InvoiceNo", "OrderAmount"), "OrderAmount")


# -- sinks and layout --------------------------------------------------------


@query("k01_write_layer_partitioned")
def _(spark, folder):
    path = fresh_path(spark, "gold-by-segment")
    lines = gold(spark, folder, (), "OrderAmount", "Purchase_segment")
    writers.write_layer(lines, path, partition_cols=("Purchase_segment",))
    layer = readers.read_layer(spark, path, "parquet")
    return rounded(revenue.sales_by_purchase_segment(layer), "total_revenue")


@query("k01_any_partition_text")
def _(spark, folder):
    # Partition text that looks like a number, that is empty, and none.
    path = fresh_path(spark, "lines-by-quantity")
    lines = retail_lines(spark, folder).withColumn(
        "Quantity", F.when(F.col("UnitPrice") == "0.0", "").otherwise(F.col("Quantity")))
    writers.write_layer(lines, path, partition_cols=("Quantity",))
    return readers.read_layer(spark, path, "parquet").select(*lines.columns)


@query("k02_named_table_overwrite")
def _(spark, folder):
    name = _name("phase1")
    path = fresh_path(spark, name)
    lines = phase1(spark, folder, "Description", "InvoiceDate", "Country")
    writers.save_named(lines.limit(1), name, path=path)
    return rounded(writers.save_named(lines, name, path=path), "OrderAmount")


def _phase4(spark, folder) -> DataFrame:
    return built_phases(spark, folder).table("phase4").read()


@query("k03_partitioned_by_country_continent")
def _(spark, folder):
    name = _name("sales_per_country_continent")
    table = writers.save_partitioned(
        _phase4(spark, folder), name, ("Country", "Continent"), fmt="csv",
        path=fresh_path(spark, name),
    )
    return revenue.rounded_revenue_by_country(table)


@query("k04_partitioned_by_continent_category")
def _(spark, folder):
    name = _name("product_category_per_continent")
    table = writers.save_partitioned(
        _phase4(spark, folder), name, ("Continent", "product_category"), fmt="csv",
        path=fresh_path(spark, name),
    )
    return revenue.rows_by(table, "product_category")


@query("k05_bucketed_by_country_shopsize")
def _(spark, folder):
    name = _name("sales_clus_country_shopsize")
    table = writers.save_bucketed(
        _phase4(spark, folder), name, ("Country", "Shopsize"), fmt="csv",
        path=fresh_path(spark, name),
    )
    return writers.totals_in_pieces(
        table, ("Country", "Shopsize"),
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("OrderAmount"), 2).alias("total_revenue"),
    )


def _bucketed(spark, folder) -> str:
    name = _name("sales_clus_country_shopsize")
    writers.save_bucketed(
        _phase4(spark, folder), name, ("Country", "Shopsize"), path=fresh_path(spark, name))
    return name


@query("k05_line_share_in_its_bucket")
def _(spark, folder):
    # Grouped by the bucket columns: no exchange.  The labels are few, so their totals go to the
    # rows, which are neither sorted nor read by whole buckets.
    table = spark.table(_bucketed(spark, folder))
    totals = table.groupBy("Country", "Shopsize").agg(F.sum("OrderAmount").alias("total"))
    return table.join(F.broadcast(totals), ["Country", "Shopsize"]).select(
        "InvoiceNo", "ItemCode", "CustomerID", "Country", "Shopsize",
        F.round(F.col("OrderAmount") / F.col("total"), 9).alias("share"))


@query("k05_rows_of_one_bucket")
def _(spark, folder):
    rows = writers.bucket_rows(
        spark, _bucketed(spark, folder), Country="France", Shopsize="Big")
    return rounded(rows.select("InvoiceNo", "ItemCode", "CustomerID", "OrderAmount"), "OrderAmount")


@query("k06_partitioned_copy_one_country")
def _(spark, folder):
    path = fresh_path(spark, "gold-partitioned")
    source = readers.read_layer(spark, gold_path(spark, folder))
    writers.write_layer(source, path, partition_cols=("Country", "Continent"))
    copy = readers.read_layer(spark, path, "parquet")
    return revenue.rounded_revenue_by_country(copy.where(F.col("Country") == "France"))


@query("k06_partitioned_copy_all_countries")
def _(spark, folder):
    copy = VersionedTable(spark, fresh_path(spark, "gold-partitioned"))
    source = readers.read_layer(spark, gold_path(spark, folder))
    copy.overwrite(source, partition_cols=("Country", "Continent"))
    return revenue.rounded_revenue_by_country(copy.read())


@query("k07_list_partitions")
def _(spark, folder):
    name = _name("sales_per_country_continent")
    writers.save_partitioned(
        _phase4(spark, folder), name, ("Country", "Continent"), path=fresh_path(spark, name)
    )
    return writers.list_partitions(spark, name)


@query("k08_bucket_contents")
def _(spark, folder):
    name = _name("sales_clus_country_shopsize")
    table = writers.save_bucketed(
        _phase4(spark, folder), name, ("Country", "Shopsize"), path=fresh_path(spark, name)
    )
    inside = writers.bucket_contents(table, ("Country", "Shopsize"))
    # The same pair always lands in the same bucket.
    return inside.groupBy("Country", "Shopsize").agg(
        F.count("bucket").alias("buckets"), F.sum("rows").alias("rows")
    )


@query("k10_temp_view")
def _(spark, folder):
    name = _name("phase4")
    writers.register_views(**{name: phase2(spark, folder, ("Country",))})
    return spark.table(name).groupBy("Country").agg(F.count(F.lit(1)).alias("lines"))


# -- versioned tables --------------------------------------------------------

_LINE = ("InvoiceNo", "StockCode", "CustomerID", "Quantity", "UnitPrice")


@query("t01_delete_cancelled")
def _(spark, folder):
    return rounded(built_phases(spark, folder).table("phase1").read(1), "OrderAmount")


@query("t02_delete_outlier")
def _(spark, folder):
    return rounded(built_phases(spark, folder).table("phase1").read(2), "OrderAmount")


@query("t03_delete_non_articles")
def _(spark, folder):
    return rounded(built_phases(spark, folder).table("phase1").read(3), "OrderAmount")


@query("t03_delete_rewritten")
def _(spark, folder):
    table = VersionedTable(spark, fresh_path(spark, "phase1"))
    table.overwrite(phase1(spark, folder, "Description", "InvoiceDate", "Country"))
    table.delete_where(fixed.CANCELLED_SQL)
    table.delete_where(fixed.OUTLIER_SQL)
    table.delete_where(fixed.NOT_AN_ARTICLE_SQL)
    return rounded(table.read(), "OrderAmount")


@query("t04_merge_insert")
def _(spark, folder):
    return built_phases(spark, folder).table("phase4").read(1)


def _check_result(spark, folder, name):
    table = built_phases(spark, folder).table("phase3")
    checked = table.read().agg(
        F.count(F.lit(1)).alias("rows"),
        *[c.alias("broken_rows") for c in check_counters({name: table.checks()[name]})],
    )
    return checked.select(F.lit(name).alias("check_name"), "rows", "broken_rows")


@query("t05_check_purchase_positive")
def _(spark, folder):
    return _check_result(spark, folder, "purchase_positive")


@query("t06_check_not_cancelled")
def _(spark, folder):
    return _check_result(spark, folder, "invoice_not_cancelled")


@query("t07_check_itemcode_length")
def _(spark, folder):
    return _check_result(spark, folder, "itemcode_length_check")


@query("t08_history")
def _(spark, folder):
    tables = built_phases(spark, folder)
    metrics = F.col("operationMetrics")
    parts = [
        tables.table(name)
        .history()
        .select(
            F.lit(name).alias("table_name"),
            "version",
            "operation",
            F.coalesce(metrics["numDeletedRows"], metrics["numOutputRows"]).alias("rows"),
        )
        for name in ("phase1", "phase4")
    ]
    return parts[0].unionByName(parts[1])


# -- filters and projections ---------------------------------------------------


@query("f01_complete_lines")
def _(spark, folder):
    return cleaning.drop_incomplete(retail_lines(spark, folder, _FILTERED))


@query("f02_not_cancelled")
def _(spark, folder):
    return cleaning.drop_cancelled(retail_lines(spark, folder, ("InvoiceNo", "StockCode")))


@query("f03_not_outlier")
def _(spark, folder):
    return cleaning.drop_outlier(retail_lines(spark, folder, ("InvoiceNo", "StockCode")))


@query("f04_article_codes")
def _(spark, folder):
    return cleaning.keep_articles(retail_lines(spark, folder, ("InvoiceNo", "StockCode")))


@query("f05_clean_transactions")
def _(spark, folder):
    return cleaning.clean_transactions(retail_lines(spark, folder))


@query("f05_clean_transactions_notebook")
def _(spark, folder):
    return cleaning.clean_transactions(retail_lines(spark, folder), "notebook")


@query("f06_positive_price_quantity")
def _(spark, folder):
    return cleaning.keep_positive(purged(spark, folder), "UnitPrice", "Quantity").select(*_LINE)


@query("f07_positive_amount")
def _(spark, folder):
    lines = gold(spark, folder, (), "OrderAmount")
    return cleaning.keep_positive(lines, "OrderAmount").select(
        "InvoiceNo", "ItemCode", "OrderAmount"
    )


@query("f08_customers_of_france")
def _(spark, folder):
    lines = phase2(spark, folder, ("Country",))
    return lines.where(F.col("Country") == "France").select("CustomerID")


@query("f09_high_spender_lines")
def _(spark, folder):
    lines = phase2(spark, folder, (), "High_spender")
    return lines.where("High_spender").select("InvoiceNo", "ItemCode", "OrderAmount")


@query("f09_high_spender_segment")
def _(spark, folder):
    lines = gold(spark, folder, (), "OrderAmount", "Purchase_segment")
    return lines.where(F.col("Purchase_segment") == "High_spender").select(
        "InvoiceNo", "ItemCode", "CustomerID"
    )


@query("f10_cancelled_rows")
def _(spark, folder):
    before = statistics.cancelled_count(phase1(spark, folder))
    after = statistics.cancelled_count(cleaning.drop_cancelled(phase1(spark, folder)))
    return before.withColumn("state", F.lit("before")).unionByName(
        after.withColumn("state", F.lit("after"))
    )


@query("f11_projected_sales")
def _(spark, folder):
    return cleaning.project_sales(purged(spark, folder, "Description", "InvoiceDate", "Country"))


@query("f12_renamed_code")
def _(spark, folder):
    return cleaning.rename_code(silver(spark, folder)).select("InvoiceNo", "ItemCode")


@query("f13_dropped_tokens")
def _(spark, folder):
    lines = enrichment.with_tokens(phase2(spark, folder, ("Description",)))
    return lines.drop("tokens").select("InvoiceNo", "ItemCode", "Description")


@query("f14_casts")
def _(spark, folder):
    return cleaning.typed(
        retail_lines(spark, folder, ("InvoiceNo", "Quantity", "UnitPrice", "InvoiceDate"))
    )


@query("f15_order_amount")
def _(spark, folder):
    lines = cleaning.typed(retail_lines(spark, folder, ("InvoiceNo", "Quantity", "UnitPrice")))
    return rounded(cleaning.with_order_amount(lines), "OrderAmount")


# -- enrichment ----------------------------------------------------------------


@query("e01_amount_segment")
def _(spark, folder):
    return phase2(spark, folder, (), "Purchase_segment").select(
        "InvoiceNo", "ItemCode", "Purchase_segment"
    )


@query("e02_customer_segment")
def _(spark, folder):
    return gold(spark, folder, (), "Purchase_segment").select(
        "InvoiceNo", "CustomerID", "Purchase_segment"
    )


@query("e03_high_spender_flag")
def _(spark, folder):
    return phase2(spark, folder, (), "High_spender").select("InvoiceNo", "ItemCode", "High_spender")


@query("e04_shopsize_by_quantity")
def _(spark, folder):
    return phase2(spark, folder, (), "Shopsize").select("InvoiceNo", "Quantity", "Shopsize")


@query("e05_shopsize_by_country")
def _(spark, folder):
    return gold(spark, folder, ("Country",), "Shopsize").select("InvoiceNo", "Country", "Shopsize")


@query("e06_continent_by_name_part")
def _(spark, folder):
    return phase2(spark, folder, ("Country",), "Continent").select(
        "InvoiceNo", "Country", "Continent"
    )


@query("e07_continent_by_country")
def _(spark, folder):
    return gold(spark, folder, ("Country",), "Continent").select(
        "InvoiceNo", "Country", "Continent"
    )


@query("e08_product_category")
def _(spark, folder):
    return gold(spark, folder, ("Description",), "desc_clean", "product_category").select(
        "InvoiceNo", "desc_clean", "product_category"
    )


@query("e09_lowered_description")
def _(spark, folder):
    return gold(spark, folder, ("Description",), "desc_clean").select("ItemCode", "desc_clean")


@query("e10_normalised_description")
def _(spark, folder):
    return phase2(spark, folder, ("Description",)).select("ItemCode", "Description")


@query("e11_padded_code")
def _(spark, folder):
    lines = cleaning.rename_code(retail_lines(spark, folder, ("InvoiceNo", "StockCode")))
    return lines.select("InvoiceNo", enrichment.padded_code().alias("ItemCode"))


@query("e12_enrich_transactions")
def _(spark, folder):
    lines = cleaning.clean_transactions(retail_lines(spark, folder))
    return rounded(enrichment.enrich_transactions(lines), "OrderAmount")


@query("e12_enrich_notebook")
def _(spark, folder):
    lines = cleaning.project_sales(purged(spark, folder, "Description", "InvoiceDate", "Country"))
    return rounded(enrichment.enrich_transactions(lines, "notebook"), "OrderAmount")


# -- aggregates ------------------------------------------------------------------


@query("a01_sales_by_country")
def _(spark, folder):
    lines = gold(spark, folder, ("Country",), "OrderAmount")
    return rounded(revenue.sales_by_country(lines), "total_revenue")


@query("a02_sales_by_product_category")
def _(spark, folder):
    lines = gold(spark, folder, ("Description",), "OrderAmount", "product_category")
    return rounded(revenue.sales_by_product_category(lines), "total_revenue")


@query("a03_sales_by_continent")
def _(spark, folder):
    lines = gold(spark, folder, ("Country",), "OrderAmount", "Continent")
    return rounded(revenue.sales_by_continent(lines), "total_revenue")


@query("a04_sales_by_purchase_segment")
def _(spark, folder):
    lines = gold(spark, folder, (), "OrderAmount", "Purchase_segment")
    return rounded(revenue.sales_by_purchase_segment(lines), "total_revenue")


@query("a05_sales_by_shopsize")
def _(spark, folder):
    lines = gold(spark, folder, ("Country",), "OrderAmount", "Shopsize")
    return rounded(revenue.sales_by_shopsize(lines), "total_revenue")


@query("a06_mean_spend_by_segment")
def _(spark, folder):
    lines = gold(spark, folder, (), "OrderAmount", "Purchase_segment")
    return rounded(revenue.mean_spend_by_segment(lines), "mean_spend", digits=6)


@query("a06_mean_spend_by_amount_segment")
def _(spark, folder):
    lines = phase2(spark, folder, (), "Purchase_segment")
    return rounded(revenue.mean_spend_by_segment(lines), "mean_spend", digits=6)


@query("a07_top_categories_big_customers")
def _(spark, folder):
    lines = gold(spark, folder, ("Description",), "Purchase_segment", "product_category")
    return revenue.top_categories(lines, F.col("Purchase_segment") == "High_spender")


@query("a08_categories_high_spender")
def _(spark, folder):
    lines = enrichment.categorised(phase2(spark, folder, ("Description",), "High_spender"))
    return revenue.top_categories(lines, F.col("High_spender"), top=None)


@query("a09_sales_by_country_continent")
def _(spark, folder):
    lines = gold(spark, folder, ("Country",), "OrderAmount", "Continent")
    return rounded(revenue.sales_by_country_continent(lines), "total_revenue")


@query("a10_rounded_revenue_by_country")
def _(spark, folder):
    return revenue.rounded_revenue_by_country(gold(spark, folder, ("Country",), "OrderAmount"))


@query("a11_rows_by_country")
def _(spark, folder):
    return revenue.rows_by(purged(spark, folder, "Country"), "Country")


@query("a12_distinct_counts")
def _(spark, folder):
    lines = purged(spark, folder, "Description", "Country")
    return statistics.distinct_counts(lines, ("CustomerID", "StockCode", "Description", "Country"))


@query("a12_distinct_counts_raw")
def _(spark, folder):
    lines = retail_lines(spark, folder, ("CustomerID", "Quantity", "InvoiceNo"))
    return statistics.distinct_counts(lines, ("CustomerID", "Quantity", "InvoiceNo"))


@query("a13_row_count")
def _(spark, folder):
    return statistics.row_count(purged(spark, folder))


@query("a14_column_count")
def _(spark, folder):
    lines = purged(spark, folder, "Description", "InvoiceDate", "Country")
    return statistics.row_count(lines).withColumn(
        "column_count", F.lit(statistics.column_count(lines))
    )


@query("a15_describe")
def _(spark, folder):
    table = statistics.describe_columns(purged(spark, folder), ("Quantity", "UnitPrice"))
    return rounded(table, "Quantity", "UnitPrice", digits=6)


@query("a16_order_amount_summary")
def _(spark, folder):
    return statistics.exact_summary(phase2(spark, folder))


@query("a16_order_amount_summary_distributed")
def _(spark, folder):
    return statistics.exact_summary(phase2(spark, folder), buckets=4)


@query("a16_order_amount_summary_sketch")
def _(spark, folder):
    # The sketch's quartiles may be off by some ranks; whether they are within
    # the error they promise is told by counting.
    lines = stored(phase2(spark, folder).select("OrderAmount"), "amounts")
    sketch = statistics.approximate_summary(lines)
    return statistics.sketch_holds(lines, sketch)


@query("a17_top_customers")
def _(spark, folder):
    return revenue.top_customers(phase2(spark, folder))


@query("a18_top_items_by_quantity")
def _(spark, folder):
    return revenue.top_items_by_quantity(phase2(spark, folder))


@query("a19_order_sizes")
def _(spark, folder):
    return revenue.order_sizes(phase2(spark, folder))


@query("a20_monthly_revenue")
def _(spark, folder):
    return rounded(revenue.monthly_revenue(phase2(spark, folder, ("InvoiceDate",))), "CA")


@query("a21_top_countries")
def _(spark, folder):
    return rounded(revenue.revenue_ranking(phase2(spark, folder, ("Country",)), top=10), "CA")


@query("a22_rows_by_category")
def _(spark, folder):
    lines = enrichment.categorised(phase2(spark, folder, ("Description",)))
    return revenue.rows_by(lines, "product_category")


@query("a23_distinct_categories")
def _(spark, folder):
    lines = enrichment.categorised(phase2(spark, folder, ("Description",)))
    return lines.select("product_category").distinct()


@query("a24_distinct_descriptions")
def _(spark, folder):
    return texts.distinct_descriptions(phase2(spark, folder, ("Description",)))


@query("a25_total_of_top_lines")
def _(spark, folder):
    return rounded(revenue.total_of_top_lines(phase2(spark, folder)), "total_CA")


@query("a26_total_revenue")
def _(spark, folder):
    return revenue.total_revenue(phase1(spark, folder))


@query("a29_top_bigrams")
def _(spark, folder):
    return texts.top_bigrams(phase2(spark, folder, ("Description",)))


# -- shares and running sums -------------------------------------------------------


@query("w01_share_by_country")
def _(spark, folder):
    return revenue.revenue_share(phase2(spark, folder, ("Country",)), "Country", "ChiffreAffaires")


@query("w02_share_by_item")
def _(spark, folder):
    return revenue.revenue_share(phase2(spark, folder), "ItemCode", "CA_Produit", top=10)


@query("w02_share_by_item_all")
def _(spark, folder):
    return revenue.revenue_share(phase2(spark, folder), "ItemCode", "CA_Produit")


_RUNNING = ("InvoiceNo", "CustomerID", "OrderAmount", "cum_amount")


@query("w03_running_amount")
def _(spark, folder):
    lines = revenue.cumulative_top_lines(phase2(spark, folder))
    return rounded(lines.select(*_RUNNING), "OrderAmount", "cum_amount")


@query("w04_running_percent")
def _(spark, folder):
    lines = revenue.cumulative_top_lines(phase2(spark, folder))
    first = lines.orderBy("cum_amount", "InvoiceNo", "ItemCode").limit(32)
    return rounded(first.select(*_RUNNING, "cum_pct"), "OrderAmount", "cum_amount")


def _contribution(lines: DataFrame, operator, **options) -> DataFrame:
    # Rounded before the running sum, so that ties are ties in both engines.
    return rounded(operator(lines, digits=2, **options), "cumulative_contribution")


@query("w05_cumulative_by_country")
def _(spark, folder):
    lines = gold(spark, folder, ("Country",), "OrderAmount")
    return _contribution(lines, cumulative.contribution_by_country)


@query("w06_cumulative_by_customer")
def _(spark, folder):
    lines = gold(spark, folder, (), "OrderAmount")
    return _contribution(lines, cumulative.contribution_by_customer)


@query("w06_cumulative_by_customer_distributed")
def _(spark, folder):
    lines = gold(spark, folder, (), "OrderAmount")
    return _contribution(lines, cumulative.contribution_by_customer, bucket_rows=20)


# -- split, sample, top-k ------------------------------------------------------------


def _enriched(spark, folder):
    return phase2(
        spark, folder, ("Description", "InvoiceDate", "Country"),
        "Purchase_segment", "High_spender", "Shopsize", "Continent",
    )


@query("j01_rest_of_sample")
def _(spark, folder):
    lines = _enriched(spark, folder)
    sample = built_phases(spark, folder).table("phase3").read()
    return rounded(sampling.rest_of(lines, sample, lines.columns), "OrderAmount")


@query("l02_top_lines")
def _(spark, folder):
    return rounded(
        revenue.top_lines(phase2(spark, folder)).select(
            "InvoiceNo", "ItemCode", "Quantity", "OrderAmount"
        ),
        "OrderAmount",
    )


@query("l04_sample_5000")
def _(spark, folder):
    lines = _enriched(spark, folder)
    sample = sampling.hash_sample(lines, fixed.SAMPLE_ROWS, SAMPLE_KEYS)
    return sample.select(*SAMPLE_KEYS)


@query("l04_sample_by_threshold")
def _(spark, folder):
    lines = _enriched(spark, folder)
    sample = sampling.hash_sample(lines, 500, SAMPLE_KEYS)
    return sample.select(*SAMPLE_KEYS)


@query("l05_second_category")
def _(spark, folder):
    lines = enrichment.categorised(phase2(spark, folder, ("Description",)))
    return revenue.nth_row(revenue.rows_by(lines, "product_category"), 1)


# -- text ------------------------------------------------------------------------------


def _described(spark, folder):
    return phase2(spark, folder, ("Description",))


def _token_counts(df: DataFrame, tokens: str) -> DataFrame:
    return df.groupBy(F.array_join(tokens, "|").alias(tokens)).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query("x01_space_tokens")
def _(spark, folder):
    # On the raw descriptions: their outer blanks give empty tokens.
    lines = retail_lines(spark, folder, ("InvoiceNo", "Description"))
    return _token_counts(enrichment.with_tokens(lines), "tokens")


@query("x02_words")
def _(spark, folder):
    lines = retail_lines(spark, folder, ("InvoiceNo", "Description"))
    return _token_counts(texts.with_words(lines), "words")


@query("x03_clean_words")
def _(spark, folder):
    return _token_counts(
        texts.with_clean_words(texts.with_words(_described(spark, folder))), "words_clean"
    )


@query("x04_bigrams")
def _(spark, folder):
    lines = texts.with_clean_words(texts.with_words(_described(spark, folder)))
    return _token_counts(texts.with_bigrams(lines), "bigrams")


@query("x05_bigram_counts")
def _(spark, folder):
    return texts.bigram_counts(retail_lines(spark, folder, ("Description",)))


# -- quality -----------------------------------------------------------------------------


@query("q02_cleaning_rules")
def _(spark, folder):
    return quality.violations(retail_lines(spark, folder, _FILTERED), fixed.CLEANING_RULES)


@query("q02_cleaning_rules_silver")
def _(spark, folder):
    return quality.violations(silver(spark, folder), fixed.CLEANING_RULES)


@query("q03_enriched_rules")
def _(spark, folder):
    return quality.violations(gold(spark, folder, (), "OrderAmount"), fixed.ENRICHED_RULES)


@query("q04_check_report")
def _(spark, folder):
    report = quality.run_checks(
        gold(spark, folder, (), "OrderAmount"), scope="enriched", raise_on_failure=False
    )
    rows = [
        (report["scope"], report["row_count"], c["name"], c["violations"], report["passed"])
        for c in report["constraints"]
    ]
    return spark.createDataFrame(
        rows, "scope string, row_count bigint, name string, violations bigint, passed boolean"
    )


def _phase1_all(spark, folder):
    # Amounts as both engines write them: rounded, as decimal text.
    lines = phase1(spark, folder, "Description", "InvoiceDate", "Country")
    return lines.withColumn("OrderAmount", F.col("OrderAmount").cast("decimal(18,2)"))


@query("q06_profile")
def _(spark, folder):
    return rounded(statistics.profile(_phase1_all(spark, folder)), "mean", "stddev", "min", "max",
                   "Q1", "median", "Q3", digits=6)


@query("q06_top_values")
def _(spark, folder):
    lines = _phase1_all(spark, folder)
    return statistics.top_values(lines, lines.columns)


# -- version comparison ---------------------------------------------------------------------


def _versions(spark, folder) -> tuple[DataFrame, DataFrame]:
    tables = built_phases(spark, folder)
    return tables.table("phase1").read(0), tables.table("phase4").read(1)


@query("u01_labelled_revenue")
def _(spark, folder):
    before, after = _versions(spark, folder)
    return comparison.labelled_revenue({"v0": before, "v1": after})


@query("v01_revenue_delta_by_country")
def _(spark, folder):
    return comparison.revenue_by_country_delta(*_versions(spark, folder))


@query("v02_total_revenue_by_version")
def _(spark, folder):
    before, after = _versions(spark, folder)
    return comparison.total_revenue_by_version({"phase1_v0": before, "phase4_v1": after})


@query("v03_delta_summary")
def _(spark, folder):
    return comparison.delta_summary(
        comparison.revenue_by_country_delta(*_versions(spark, folder))
    )


# -- chart data -------------------------------------------------------------------------------


@query("p01_amount_histogram")
def _(spark, folder):
    return rounded(statistics.histogram(phase2(spark, folder)), "bin_start", digits=6)


@query("p02_country_bars")
def _(spark, folder):
    bars = revenue.revenue_ranking(phase2(spark, folder, ("Country",)), top=10)
    # Bars from the top down, each with its length against the longest.
    place = Window.orderBy(F.col("CA").desc(), F.col("Country"))
    longest = F.max("CA").over(Window.partitionBy())
    return bars.select(F.row_number().over(place).alias("bar"), "Country",
                       F.round(F.col("CA") / longest, 6).alias("length"))


@query("p03_monthly_line")
def _(spark, folder):
    months = revenue.monthly_revenue(phase2(spark, folder, ("InvoiceDate",)))
    label = F.concat_ws("-", F.col("Year").cast("string"), F.col("Month").cast("string"))
    return rounded(months.select(label.alias("Date"), "CA"), "CA")


# -- reports on a stored layer ------------------------------------------------------------------


@query("o01_report_on_stored_gold")
def _(spark, folder):
    path = gold_path(spark, folder)
    frames = [
        report(spark, path).select(F.col(key).alias("label"), "total_revenue")
        for report, key in (
            (reports.get_sales_by_country, "Country"),
            (reports.get_sales_by_product_category, "product_category"),
            (reports.get_sales_by_continent, "Continent"),
            (reports.get_sales_by_purchase_segment, "Purchase_segment"),
        )
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return rounded(whole, "total_revenue")


@query("o03_layer_counts")
def _(spark, folder):
    out = fresh_path(spark, "layers")
    medallion.build_layers(
        spark, retail_lines(spark, folder), out,
        to_gold=lambda silver: cleaning.keep_positive(silver, "UnitPrice", "Quantity"))
    layers = [
        statistics.row_count(readers.read_layer(spark, f"{out}/{name}")).withColumn(
            "layer", F.lit(name))
        for name in ("bronze", "silver", "gold")
    ]
    return reduce(DataFrame.unionByName, layers)


@query("o03_layer_rows")
def _(spark, folder):
    out = fresh_path(spark, "layers")
    medallion.build_layers(
        spark, retail_lines(spark, folder), out,
        to_gold=lambda silver: cleaning.keep_positive(silver, "UnitPrice", "Quantity"))

    def layer(name: str) -> DataFrame:
        rows = readers.read_layer(spark, f"{out}/{name}")
        code = "ItemCode" if name == "gold" else "StockCode"
        amount = F.round("OrderAmount", 2) if name == "gold" else F.lit(None).cast("double")
        return rows.select(
            F.lit(name).alias("layer"), "InvoiceNo", F.col(code).alias("code"), "Description",
            F.col("Quantity").cast("int").alias("Quantity"),
            F.col("UnitPrice").cast("double").alias("UnitPrice"), "CustomerID", "Country",
            amount.alias("OrderAmount"))

    return reduce(DataFrame.unionByName, [layer(name) for name in ("bronze", "silver", "gold")])

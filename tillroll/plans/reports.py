"""Reports on a stored gold layer: ``report(spark, path, fmt)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import cumulative, revenue
from tillroll.sources.readers import read_layer


def _on_gold(operator: Callable[[DataFrame], DataFrame]):
    def report(spark: SparkSession, path: str, fmt: str = "versioned") -> DataFrame:
        return operator(read_layer(spark, path, fmt))

    return report


get_sales_by_country = _on_gold(revenue.sales_by_country)
get_sales_by_product_category = _on_gold(revenue.sales_by_product_category)
get_sales_by_continent = _on_gold(revenue.sales_by_continent)
get_sales_by_purchase_segment = _on_gold(revenue.sales_by_purchase_segment)
get_sales_by_shopsize = _on_gold(revenue.sales_by_shopsize)
get_mean_spend_by_segment = _on_gold(revenue.mean_spend_by_segment)
get_top_category_for_big_customer = _on_gold(
    lambda gold: revenue.top_categories(gold, F.col("Purchase_segment") == "High_spender")
)
get_sales_by_country_continent = _on_gold(revenue.sales_by_country_continent)
get_cumulative_contribution_by_country = _on_gold(cumulative.contribution_by_country)
get_cumulative_contribution_by_customer_id = _on_gold(cumulative.contribution_by_customer)

import pytest
from conftest import line
from pyspark.sql import functions as F

from tillroll.operators import enrichment
from tillroll.operators.cleaning import clean_transactions, project_sales


def labels(spark, kind, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_amount_segments(spark):
    got = labels(spark, "double", [0.0, 4.99, 5.0, 19.99, 20.0, None],
                 enrichment.amount_segment("v"))
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High"]


def test_customer_segments(spark):
    got = labels(spark, "int", [9999, 10000, 19999, 20000, None],
                 enrichment.customer_segment("v"))
    assert got == ["High_spender", "Medium_spender", "Medium_spender", "Low_spender", "Low_spender"]


def test_shopsizes(spark):
    assert labels(spark, "int", [2, 3, 11, 12, 49, 50, None],
                  enrichment.shopsize_by_quantity("v")) == [
        "Small", "Medium", "Medium", "Big", "Big", "Very_Big", "Very_Big"]
    assert labels(spark, "string", ["United Kingdom", "France", "Spain", None],
                  enrichment.shopsize_by_country("v")) == ["Large", "Medium", "Small", "Small"]


def test_continents(spark):
    assert labels(spark, "string",
                  ["Australia", "RSA", "Israel", "Japan", "Brazil", "USA", "Belgium",
                   "Unspecified", None, "The Netherlands", "france"],
                  enrichment.continent_by_name_part("v")) == [
        "Europa", "Europa", "Eurasia", "Asia", "Southamerica", "Northamerica", "Other",
        "Other", "Other", "Europa", "Other"]
    assert labels(spark, "string", ["France", "Spain", None],
                  enrichment.continent_by_country("v")) == ["Europe", "Other", "Other"]


def test_first_category_wins(spark):
    got = labels(spark, "string",
                 ["clock bag", "heart bag", "heart of retrospot", "retrospot cake", "cake tin",
                  "BAG", None],
                 enrichment.product_category("v"))
    assert got == ["Clocks", "Bags", "Hearts object", "Retrospots", "Cakes", "Others", "Others"]


def test_codes_and_descriptions(spark):
    assert labels(spark, "string", ["12", "123456", None], enrichment.padded_code("v")) == [
        "00012", "12345", None]
    assert labels(spark, "string", ["  red  Box "], enrichment.normalised_description("v")) == [
        "RED  BOX"]


def test_high_spender(spark):
    assert labels(spark, "double", [100.0, 100.01, None], enrichment.high_spender("v")) == [
        False, True, None]


def test_gold_columns(raw):
    gold = enrichment.enrich_transactions(
        clean_transactions(raw(line(text="Red Clock", customer="17850.0")))
    )
    assert gold.columns == [
        "InvoiceNo", "ItemCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
        "CustomerID", "Country", "desc_clean", "OrderAmount", "Purchase_segment", "Shopsize",
        "Continent", "product_category",
    ]
    row = gold.first()
    assert row["desc_clean"] == "red clock" and row["product_category"] == "Clocks"
    assert row["OrderAmount"] == 5.0 and row["Purchase_segment"] == "Medium_spender"
    assert row["Shopsize"] == "Medium" and row["Continent"] == "Europe"


def test_wanted_columns_only(raw):
    silver = clean_transactions(raw(line())).drop("Description")
    assert enrichment.enrich_transactions(silver, only=("OrderAmount",)).columns[-1] == "OrderAmount"


def test_notebook_columns_and_merge_source(raw):
    phase2 = enrichment.enrich_transactions(
        project_sales(clean_transactions(raw(line(text=" red bag ", code="77")), "notebook")),
        "notebook",
    )
    assert phase2.columns[-4:] == ["Purchase_segment", "High_spender", "Shopsize", "Continent"]
    tokens = enrichment.with_tokens(phase2)
    assert tokens.first()["tokens"] == ["red", "bag"]
    source = enrichment.merge_ready(tokens)
    assert "tokens" not in source.columns and source.first()["ItemCode"] == "00077"


def test_unknown_rule_set(raw):
    with pytest.raises(ValueError, match="rule set"):
        enrichment.enrich_transactions(raw(line()), "other")

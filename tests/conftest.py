import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW = (
    "InvoiceNo string, StockCode string, Description string, Quantity string, "
    "InvoiceDate string, UnitPrice string, CustomerID string, Country string"
)


def line(invoice="600001", code="20001", text="TIN LAMP", quantity="4",
         date="03/02/2011 10:15:00", price="1.25", customer="15000", country="France"):
    return (invoice, code, text, quantity, date, price, customer, country)


@pytest.fixture
def raw(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), RAW)

    return make


def rows_of(df):
    """Rows as sorted tuples, for comparing bags of rows."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

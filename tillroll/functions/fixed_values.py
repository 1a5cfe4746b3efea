"""Values that results depend on, stated as plain text.

Fixed values: column names, thresholds, labels, country and category needles,
rule names and rule predicates.  Order matters wherever a tuple is a
first-match list.
"""

# Raw invoice lines: every column is read as text.
RAW_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)
DATE_FORMAT = "dd/MM/yyyy HH:mm:ss"

REQUIRED_COLUMNS = ("CustomerID", "UnitPrice", "Quantity", "InvoiceNo")
OUTLIER_INVOICE = "541431"
CODE_LENGTH = 5

# Delete predicates and table checks, as SQL text.
CANCELLED_SQL = "lower(InvoiceNo) LIKE 'c%'"
OUTLIER_SQL = "InvoiceNo = '541431'"
NOT_AN_ARTICLE_SQL = "length(StockCode) <> 5"

TABLE_CHECKS = {
    "purchase_positive": "OrderAmount > 0",
    "invoice_not_cancelled": "lower(InvoiceNo) NOT LIKE 'c%'",
    "itemcode_length_check": "length(ItemCode) = 5",
}

# Quality rules: name and the predicate that marks a violating row.
CLEANING_RULES = {
    "customer_id_not_null": "CustomerID IS NULL",
    "unit_price_not_null": "UnitPrice IS NULL",
    "quantity_not_null": "Quantity IS NULL",
    "invoice_no_not_null": "InvoiceNo IS NULL",
    "invoice_not_cancelled": "lower(InvoiceNo) LIKE 'c%'",
    "invoice_not_541431": "InvoiceNo = '541431'",
    "stock_code_length_5": "length(StockCode) <> 5",
}
ENRICHED_RULES = {
    "order_amount_positive": "OrderAmount <= 0",
    "item_code_length_5": "length(ItemCode) <> 5",
}

# Upper bound (exclusive) -> label; the last label takes everything else.
AMOUNT_SEGMENTS = ((5, "Low"), (20, "Medium"))
AMOUNT_SEGMENT_ELSE = "High"
CUSTOMER_SEGMENTS = ((10000, "High_spender"), (20000, "Medium_spender"))
CUSTOMER_SEGMENT_ELSE = "Low_spender"
QUANTITY_SHOPSIZES = ((3, "Small"), (12, "Medium"), (50, "Big"))
QUANTITY_SHOPSIZE_ELSE = "Very_Big"
HIGH_SPENDER_ABOVE = 100

# Exact country name -> label (pipeline rules).
COUNTRY_SHOPSIZES = {"United Kingdom": "Large", "France": "Medium"}
COUNTRY_SHOPSIZE_ELSE = "Small"
COUNTRY_CONTINENTS = {"United Kingdom": "Europe", "France": "Europe"}
COUNTRY_CONTINENT_ELSE = "Other"

# Contained text -> label, first match wins (notebook rules).
CONTINENT_NEEDLES = (
    ("Australia", "Europa"),
    ("EIRE", "Europa"),
    ("Iceland", "Europa"),
    ("United Arab Emirates", "Eurasia"),
    ("Israel", "Eurasia"),
    ("Channel Islands", "Europa"),
    ("Cyprus", "Europa"),
    ("Sweden", "Europa"),
    ("RSA", "Europa"),
    ("Denmark", "Europa"),
    ("Bahrain", "Asia"),
    ("United Kingdom", "Europa"),
    ("Switzerland", "Europa"),
    ("Lithuania", "Europa"),
    ("Czech Republic", "Europa"),
    ("Norway", "Europa"),
    ("Austria", "Europa"),
    ("European Community", "Europa"),
    ("Netherlands", "Europa"),
    ("Spain", "Europa"),
    ("Italy", "Europa"),
    ("Japan", "Asia"),
    ("Finland", "Europa"),
    ("Saudi Arabia", "Eurasia"),
    ("Brazil", "Southamerica"),
    ("France", "Europa"),
    ("Germany", "Europa"),
    ("Poland", "Europa"),
    ("USA", "Northamerica"),
    ("Malta", "Europa"),
    ("Portugal", "Europa"),
    ("Greece", "Europa"),
    ("Singapore", "Asia"),
    ("Lebanon", "Eurasia"),
    ("Canada", "Northamerica"),
)
CONTINENT_ELSE = "Other"

CATEGORY_NEEDLES = (
    ("clock", "Clocks"),
    ("bag", "Bags"),
    ("heart", "Hearts object"),
    ("retrospot", "Retrospots"),
    ("cake", "Cakes"),
)
CATEGORY_ELSE = "Others"

# Stop words added to the English defaults.  The first two can never equal a
# whitespace-free token; they are kept because they are part of the list.
EXTRA_STOP_WORDS = (
    " ", "of ", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12",
)

# Columns of the projection that follows cleaning in the notebook rules.
PROJECTED_COLUMNS = (
    "CustomerID",
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "Country",
    "OrderAmount",
)
MERGE_KEYS = ("InvoiceNo", "ItemCode", "CustomerID")
SAMPLE_ROWS = 5000

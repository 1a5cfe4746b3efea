"""What the SQL counterparts expect, stated apart from the engine they check.

Fixed values: country names by nation key, name parts and their labels in order
of precedence, stop words, rule and check predicates, the sample's size.
"""

COUNTRIES = (
    "United Kingdom", "France", "Germany", "EIRE", "Spain", "Netherlands", "Belgium",
    "Switzerland", "Portugal", "Australia", "Norway", "Italy", "Channel Islands", "Finland",
    "Cyprus", "Sweden", "Austria", "Denmark", "Japan", "Poland", "USA", "Israel", "Unspecified",
    "Brazil", "RSA",
)

CONTINENTS = (
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

CATEGORIES = (
    ("clock", "Clocks"),
    ("bag", "Bags"),
    ("heart", "Hearts object"),
    ("retrospot", "Retrospots"),
    ("cake", "Cakes"),
)
CATEGORY_ELSE = "Others"

EXTRA_STOP_WORDS = (
    " ", "of ", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12",
)

TABLE_CHECKS = {
    "purchase_positive": "OrderAmount > 0",
    "invoice_not_cancelled": "lower(InvoiceNo) NOT LIKE 'c%'",
    "itemcode_length_check": "length(ItemCode) = 5",
}

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

SAMPLE_ROWS = 5000

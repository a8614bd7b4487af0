"""Small raw frames with hand-computed results."""

from tillroll.operators.cleaning import to_fact, transform_retail

RAW_SCHEMA = (
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity BIGINT, "
    "InvoiceDate STRING, UnitPrice DOUBLE, CustomerID DOUBLE, Country STRING"
)
TEXT_SCHEMA = RAW_SCHEMA.replace("BIGINT", "STRING").replace("DOUBLE", "STRING")

UK = "United Kingdom"

EDGE_CASES = [
    ("536365", "85123A", "WHITE HEART", 6, "2010-12-01 08:26:00", 2.55, 17850.0, "United Kingdom "),
    ("C536379", "D", "Discount", -1, "2010-12-01 09:41:00", 27.50, 17850.0, UK),
    ("536380", " 22423 ", None, 10, "2010-12-01 10:00:00", 1.25, None, "France"),
    ("536381", "71053", "LANTERN", 2, "2010-12-01 11:00:00", 3.39, 13047.0, UK),
    ("536381", "71053", "LANTERN", 2, "2010-12-01 11:00:00", 3.39, 13047.0, UK),
    ("536382", "B", "Adjust bad debt", -1, "2010-12-01 12:00:00", -11062.06, None, UK),
    ("536383", "35004B", "SET", 0, "2010-12-01 13:00:00", 0.0, 14500.0, "EIRE"),
]

LOADED = [
    ("536365", "85123A", "WHITE HEART", 6, "2010-12-01 08:26:00", 2.50, 17850.0, UK),
    ("C536366", "85123A", "WHITE HEART", -2, "2010-12-01 09:00:00", 2.50, 17850.0, UK),
    ("536367", "71053", "LANTERN", 4, "2010-12-01 10:00:00", 3.00, None, "France"),
    ("536367", "71053", "LANTERN", 4, "2010-12-01 10:00:00", 3.00, None, "France"),
    ("A563186", "B", "Adjust bad debt", 1, "2010-12-01 11:00:00", -100.00, None, UK),
]

NINE_LINES = [
    ("536365", "PROD_A", "Product A", 10, "2011-01-05 10:00:00", 5.0, 1001.0, UK),
    ("536366", "PROD_B", "Product B", 5, "2011-01-15 11:00:00", 10.0, 1002.0, "France"),
    ("C536367", "PROD_A", "Product A", -2, "2011-01-20 12:00:00", 5.0, 1001.0, UK),
    ("536368", "PROD_A", "Product A", 20, "2011-02-01 10:00:00", 5.0, 1001.0, UK),
    ("536369", "PROD_C", None, 15, "2011-02-15 14:00:00", 2.0, None, "Germany"),
    ("536370", "PROD_B", "Product B", 4, "2011-03-01 09:00:00", 10.0, 1003.0, UK),
    ("536370", "PROD_B", "Product B", 4, "2011-03-01 09:00:00", 10.0, 1003.0, UK),
    ("A563186", "B", "Adjust bad debt", 1, "2011-03-05 12:00:00", -50.0, None, UK),
    ("536371", "PROD_A", "Product A", 8, "2011-03-10 15:00:00", 5.0, 1002.0, "France"),
]


def raw_frame(spark, rows, schema=RAW_SCHEMA):
    return spark.createDataFrame(rows, schema)


def line(invoice="1", stock="S", description="thing", quantity=1, date="2011-01-01 00:00:00", price=1.0,
         customer=None, country=UK):
    return (invoice, stock, description, quantity, date, price, customer, country)


def fact_frame(spark, rows, schema=RAW_SCHEMA):
    return to_fact(transform_retail(raw_frame(spark, rows, schema)))


def dicts(frame):
    return [row.asDict() for row in frame.collect()]


def only(frame):
    rows = dicts(frame)
    assert len(rows) == 1
    return rows[0]

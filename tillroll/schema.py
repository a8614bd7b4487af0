"""Column names, types and fixed values of the raw lines and the fact table."""

from pyspark.sql import types as T

# Names and labels that users' queries and reports refer to.
RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

FLAG_COLUMNS = [
    "is_duplicate",
    "is_cancelled",
    "is_negative_quantity",
    "is_zero_quantity",
    "is_negative_price",
    "is_zero_price",
    "is_missing_customer",
    "is_missing_description",
    "is_normal_sale",
]

MISSING_DESCRIPTION = "UNSPECIFIED"

FEE_CODES = ["POST", "D", "M", "BANK CHARGES", "PADS", "DOT", "CRUK"]

CATEGORIES = [
    "DUPLICATE",
    "CANCELLED_INVOICE",
    "NEGATIVE_PRICE_ADJUSTMENT",
    "ZERO_PRICE_ITEM",
    "NEGATIVE_QUANTITY_OTHER",
    "ZERO_QUANTITY",
    "NORMAL_SALE",
]
OTHER_CATEGORY = "OTHER"

# A price fits into a long, as whole millionths.
PRICE_TYPE = T.DecimalType(18, 6)
REVENUE_TYPE = T.DecimalType(30, 6)

RAW_TO_FACT = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
    "LineRevenue": "line_revenue",
}

FACT_SCHEMA = T.StructType(
    [
        T.StructField("line_id", T.StringType()),
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("unit_price", PRICE_TYPE),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("line_revenue", REVENUE_TYPE),
        *[T.StructField(flag, T.IntegerType()) for flag in FLAG_COLUMNS],
        T.StructField("transaction_category", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("sales_month", T.StringType()),
    ]
)

# Why a line is kept out of the fact, and the line as it was read.
REJECT_COLUMNS = ["reasons", "raw_line"]

# Columns that a published fact may not leave null.
REQUIRED_FACT_COLUMNS = [
    "invoice_no",
    "stock_code",
    "quantity",
    "invoice_date",
    "unit_price",
    "country",
    "line_revenue",
    *FLAG_COLUMNS,
    "transaction_category",
]

"""Cleaning and classification of raw retail lines; no row is ever dropped."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.errors import MissingColumnsError
from tillroll.functions import parsing
from tillroll.operators.duplicates import content_hash, detect_duplicates
from tillroll.schema import (
    CATEGORIES,
    FLAG_COLUMNS,
    MISSING_DESCRIPTION,
    OTHER_CATEGORY,
    PRICE_TYPE,
    RAW_COLUMNS,
    RAW_TO_FACT,
    REJECT_COLUMNS,
    REVENUE_TYPE,
)


def standardize_columns(raw: DataFrame) -> DataFrame:
    """Strip header names and keep the eight business columns, by name."""
    named = raw.toDF(*[name.strip() for name in raw.columns])
    missing = [name for name in RAW_COLUMNS if name not in named.columns]
    if missing:
        raise MissingColumnsError(f"Missing required columns in dataset: {missing}")
    return named.select(*RAW_COLUMNS)


def clean_text_fields(lines: DataFrame) -> DataFrame:
    """Strip the text columns; flag and name missing descriptions.

    A null description becomes UNSPECIFIED, one of white space becomes empty;
    both are flagged.
    """
    names = ["InvoiceNo", "StockCode", "Country", "Description"]
    stripped = lines.withColumns({name: parsing.strip(F.col(name)) for name in names})
    description = F.col("Description")
    return stripped.withColumns(
        {
            "Description": F.coalesce(description, F.lit(MISSING_DESCRIPTION)),
            "is_missing_description": description.isNull() | (description == ""),
        }
    )


def convert_data_types(lines: DataFrame) -> DataFrame:
    """Type the columns: unreadable quantity and price become 0, dates and customers null.

    A quantity or price that is a number but beyond its type becomes null, so
    that a load refuses it instead of publishing it as 0.
    """

    return _typed(parsing.with_values(lines), lines.columns)


def _typed(read: DataFrame, names: list[str]) -> DataFrame:
    """The named columns, those in READERS as the values that were read."""
    zeros = {"Quantity": F.lit(0).cast("bigint"), "UnitPrice": F.lit(0).cast(PRICE_TYPE)}

    def value(name):
        found = F.col(f"value_{name}")
        if name not in zeros:
            return found
        return F.when(F.coalesce(F.col(f"state_{name}") != parsing.BEYOND, F.lit(True)), F.coalesce(found, zeros[name]))

    columns = {name: value(name) if name in parsing.READERS else F.col(name) for name in names}
    if any(isinstance(read.schema[name].dataType, T.StringType) for name in parsing.READERS):
        # Conditions on the result stay above a generator: none is put on the text, to be read for it once more.
        return read.select(F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))
    return read.select(*[column.alias(name) for name, column in columns.items()])


def _rejected(read: DataFrame) -> Column:
    """Why a line cannot be published: column:reason, joined by commas; null if it can.

    Reasons are missing, for fields that a line must have, unreadable and beyond
    (its type).
    """
    states = {name: F.col(f"state_{name}") for name in ("Quantity", "InvoiceDate", "UnitPrice")}
    product = F.try_multiply("value_Quantity", "value_UnitPrice").try_cast(REVENUE_TYPE)
    held = F.col("value_Quantity").isNotNull() & F.col("value_UnitPrice").isNotNull()
    rules = {
        **{f"{name}:missing": F.col(name).isNull() for name in ("InvoiceNo", "StockCode", "Country")},
        "Quantity:beyond": states["Quantity"] == parsing.BEYOND,
        "InvoiceDate:missing": F.col("value_InvoiceDate").isNull() & states["InvoiceDate"].isNull(),
        "InvoiceDate:unreadable": states["InvoiceDate"].isNotNull(),
        "UnitPrice:beyond": states["UnitPrice"] == parsing.BEYOND,
        "LineRevenue:beyond": held & product.isNull(),
    }
    return F.nullif(F.concat_ws(",", *[F.when(rule, code) for code, rule in rules.items()]), F.lit(""))


def set_rejects_apart(lines: DataFrame) -> DataFrame:
    """clean_text_fields and convert_data_types in one, with ``reasons`` and ``raw_line`` for lines that can't be published.

    Both are null for all others. ``raw_line`` is the line as it was read, as JSON.
    """
    raw = F.struct(*[F.col(name).cast("string").alias(name) for name in RAW_COLUMNS])
    cleaned = clean_text_fields(lines.withColumn("raw_line", raw))
    read = parsing.with_values(cleaned).withColumn("reasons", _rejected(cleaned))
    # JSON is written for these few lines only.
    text = F.to_json("raw_line", {"ignoreNullFields": "false"})
    read = read.withColumn("raw_line", F.when(F.col("reasons").isNotNull(), text))
    return _typed(read, [*cleaned.columns, "reasons"])


def calculate_line_revenue(lines: DataFrame) -> DataFrame:
    """LineRevenue = Quantity * UnitPrice, rounded half up to four places; null where the product is beyond its type."""
    product = F.try_multiply("Quantity", "UnitPrice").try_cast(REVENUE_TYPE)
    return lines.withColumn("LineRevenue", F.round(product, 4).try_cast(REVENUE_TYPE))


def classify_transactions(lines: DataFrame) -> DataFrame:
    """Add the audit flags and the category, the first rule that holds."""
    if "is_duplicate" not in lines.columns:
        lines = lines.withColumn("is_duplicate", F.lit(False))
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    cancelled = F.coalesce(F.col("InvoiceNo").startswith("C"), F.lit(False))
    duplicate = F.col("is_duplicate")
    sale = (quantity > 0) & (price > 0) & ~cancelled & ~duplicate
    rules = [duplicate, cancelled, price < 0, price == 0, quantity < 0, quantity == 0, sale]
    first, *rest = zip(rules, CATEGORIES)
    category = reduce(lambda chain, rule: chain.when(rule[0], rule[1]), rest, F.when(*first))
    return lines.withColumns(
        {
            "is_cancelled": cancelled,
            "is_negative_quantity": quantity < 0,
            "is_zero_quantity": quantity == 0,
            "is_negative_price": price < 0,
            "is_zero_price": price == 0,
            "is_missing_customer": F.col("CustomerID").isNull(),
            "is_normal_sale": sale,
            "transaction_category": category.otherwise(OTHER_CATEGORY),
        }
    )


def transform_retail(
    raw: DataFrame,
    spread: Callable[[DataFrame], DataFrame] | None = None,
    earlier: DataFrame | None = None,
    quarantine: bool = False,
    by_time: bool = False,
) -> DataFrame:
    """Clean, type, mark and classify raw lines: one shuffle, row count kept; spread, earlier and by_time as in detect_duplicates.

    With ``quarantine`` lines that cannot be published have ``reasons`` and ``raw_line``.
    """
    lines = standardize_columns(raw)
    typed = set_rejects_apart(lines) if quarantine else convert_data_types(clean_text_fields(lines))
    marked = detect_duplicates(typed, spread=spread, earlier=earlier, by_time=by_time)
    return classify_transactions(calculate_line_revenue(marked))


def to_fact(transformed: DataFrame, batch: int = 0) -> DataFrame:
    """Map transformed lines to the fact schema, flags as 0/1.

    ``line_id`` is a 128-bit hash of the line's content, the load batch and the
    copy's number, so it is unique in the table and the same on every rerun.
    Flags that are absent become 0 and an absent category UNKNOWN.
    """
    present = set(transformed.columns)
    occurrence = F.col("occurrence") if "occurrence" in present else F.lit(1)
    category = F.col("transaction_category") if "transaction_category" in present else F.lit("UNKNOWN")
    return transformed.select(
        F.concat_ws("-", content_hash(), F.lit(batch), occurrence).alias("line_id"),
        *[F.col(raw).alias(name) for raw, name in RAW_TO_FACT.items()],
        *[(F.col(flag).cast("int") if flag in present else F.lit(0)).alias(flag) for flag in FLAG_COLUMNS],
        category.alias("transaction_category"),
        F.current_timestamp().alias("loaded_at"),
        F.date_format("InvoiceDate", "yyyy-MM").alias("sales_month"),
        *[F.col(name) for name in REJECT_COLUMNS if name in present],
    )

"""The money and unit measures that every report shares.

Which rows count towards a measure is stated as an SQL condition on the fact.
"""

from pyspark.sql import Column, functions as F

ALL_ROWS = "true"
KEPT = "is_duplicate = 0"
DUPLICATE = "is_duplicate = 1"
NORMAL_SALE = "is_normal_sale = 1"
CANCELLED = "is_cancelled = 1"
CANCELLED_KEPT = "is_cancelled = 1 AND is_duplicate = 0"
BAD_DEBT = "is_negative_price = 1 AND is_duplicate = 0"
OTHER_NEGATIVE_QUANTITY = "is_negative_quantity = 1 AND is_cancelled = 0 AND is_duplicate = 0"
ZERO_PRICE_KEPT = "is_zero_price = 1 AND is_negative_quantity = 0 AND is_duplicate = 0"
GUEST_SALE = "is_normal_sale = 1 AND customer_id IS NULL"


def units(rows: str) -> Column:
    """Quantity of the given rows, 0 elsewhere."""
    return F.expr(f"CASE WHEN {rows} THEN quantity ELSE 0 END")


def revenue(rows: str) -> Column:
    """Line revenue of the given rows, 0 elsewhere."""
    return F.expr(f"CASE WHEN {rows} THEN line_revenue ELSE 0 END")


def lines(rows: str) -> Column:
    """1 for the given rows, 0 elsewhere."""
    return F.expr(f"CASE WHEN {rows} THEN 1 ELSE 0 END")


def as_money(amount: Column) -> Column:
    """Round an exact amount to pence, then publish it as DOUBLE."""
    return F.round(amount, 2).cast("double")


def or_zero(amount: Column) -> Column:
    """0 instead of the null that a sum over no rows gives."""
    return F.coalesce(amount, F.lit(0).cast("bigint"))


def to_hundredths(value: Column) -> Column:
    """Round a DOUBLE to two decimals, half away from zero, the same in every engine."""
    half_up = F.floor(F.abs(value) * 100 + 0.5)
    return F.when(value < 0, -half_up).otherwise(half_up) / 100


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE, null when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))

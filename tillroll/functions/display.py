"""Text forms of report values: currency, counts and percentages."""

from pyspark.sql import Column, functions as F


def currency(amount: Column) -> Column:
    """Pounds with thousands commas and two decimals; null shows as zero."""
    text = F.format_number(F.abs(amount), 2)
    return F.when(amount.isNull(), "£0.00").when(amount < 0, F.concat(F.lit("-£"), text)).otherwise(
        F.concat(F.lit("£"), text)
    )


def number(value: Column) -> Column:
    """Whole number with thousands commas, half rounded to even; null shows as 0."""
    return F.when(value.isNull(), "0").otherwise(F.format_number(F.rint(value.cast("double")).cast("bigint"), 0))


def percent(value: Column) -> Column:
    """Signed percentage with one decimal; null and zero show as 0.0%."""
    digits = F.call_function("format_number", F.abs(value), F.lit("0.0"))
    sign = F.when(value < 0, "-").otherwise("+")
    return F.when(value.isNull() | (value == 0), "0.0%").otherwise(F.concat(sign, digits, F.lit("%")))

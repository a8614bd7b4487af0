"""Group-by with exact distinct counts of invoices and customers.

``count_distinct`` of several conditions multiplies every fact row before the
shuffle. Here lines are first added up per invoice, combined on the map side,
so one third of all rows under one key shrinks before it moves, and a busy key
is spread over its invoices; the second step counts invoices.
"""

from pyspark.sql import Column, DataFrame, functions as F


def _per_group(sums: dict[str, Column], orders: dict[str, str]) -> list[Column]:
    return [F.sum(value).alias(name) for name, value in sums.items()] + [
        F.bool_or(F.expr(rows)).alias(name) for name, rows in orders.items()
    ]


def invoice_totals(
    fact: DataFrame, keys: list[str], sums: dict[str, Column], orders: dict[str, str]
) -> DataFrame:
    """One row per key and invoice: the sums, and whether any line met each condition in ``orders``."""
    return fact.groupBy(*keys, "invoice_no").agg(*_per_group(sums, orders))


def rollup(
    fact: DataFrame, keys: list[str], sums: dict[str, Column], orders: dict[str, str]
) -> DataFrame:
    """One row per key: each of ``sums`` added up, and for each condition in
    ``orders`` the number of distinct invoices with a line that meets it."""
    named = F.col("invoice_no").isNotNull()
    return (
        invoice_totals(fact, keys, sums, orders)
        .groupBy(*keys)
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            *[F.count_if(F.col(name) & named).alias(name) for name in orders],
        )
    )


def rollup_with_customers(
    fact: DataFrame, keys: list[str], sums: dict[str, Column], orders: dict[str, str]
) -> DataFrame:
    """As ``rollup``, plus ``identified_customers``, the distinct customers.

    An invoice row and a customer row are made of each invoice-customer pair,
    so both distinct counts come out of the same two small shuffles.
    """
    pairs = fact.groupBy(*keys, "invoice_no", "customer_id").agg(*_per_group(sums, orders))
    invoice = F.struct(F.lit(True).alias("is_invoice"), F.col("invoice_no").alias("id"))
    customer = F.struct(F.lit(False).alias("is_invoice"), F.col("customer_id").cast("string").alias("id"))
    entities = F.when(F.col("customer_id").isNull(), F.array(invoice)).otherwise(F.array(invoice, customer))
    is_invoice, known = F.col("is_invoice"), F.col("id").isNotNull()
    return (
        pairs.select(*keys, *sums, *orders, F.inline(entities))
        .groupBy(*keys, "is_invoice", "id")
        .agg(
            *[F.sum(F.when(is_invoice, F.col(name))).alias(name) for name in sums],
            *[F.bool_or(name).alias(name) for name in orders],
        )
        .groupBy(*keys)
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            *[F.count_if(F.col(name) & is_invoice & known).alias(name) for name in orders],
            F.count_if(~is_invoice).alias("identified_customers"),
        )
    )

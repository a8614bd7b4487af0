"""Returns, cancellations and accounting adjustments."""

from pyspark.sql import DataFrame, functions as F

from tillroll.operators.measures import (
    BAD_DEBT,
    CANCELLED_KEPT,
    OTHER_NEGATIVE_QUANTITY,
    ZERO_PRICE_KEPT,
    as_money,
    lines,
    or_zero,
)

# Report labels, with the rows each of them covers.
ANOMALIES = [
    (
        "Cancelled Invoices (Starts with C)",
        CANCELLED_KEPT,
        "Definitive order cancellation or return initiated by customer",
    ),
    (
        "Other Negative Quantity (Non-Cancelled)",
        OTHER_NEGATIVE_QUANTITY,
        "Inventory write-offs, damaged stock, or manual corrections (UnitPrice = 0)",
    ),
    (
        "Negative Price Adjustments (Bad Debt)",
        BAD_DEBT,
        "Accounting ledger adjustment (e.g. Adjust bad debt) rather than item sale",
    ),
    (
        "Zero Price Promotional / Gift Items",
        ZERO_PRICE_KEPT,
        "Free samples, gifts, or zero-priced line items",
    ),
]


def returns_and_cancellations(fact: DataFrame) -> DataFrame:
    """Four rows, one per anomaly, from one scan; a line may count in several.

    An anomaly without rows has null impacts, as a sum over nothing has.
    """
    per_invoice, overall = [], []
    for i, (_, rows, _) in enumerate(ANOMALIES):
        per_invoice += [
            F.sum(lines(rows)).alias(f"n{i}"),
            F.sum(F.when(F.expr(rows), F.col("quantity"))).alias(f"units{i}"),
            F.sum(F.when(F.expr(rows), F.col("line_revenue"))).alias(f"revenue{i}"),
        ]
        overall += [
            or_zero(F.sum(f"n{i}")).alias(f"n{i}"),
            F.count_if((F.col(f"n{i}") > 0) & F.col("invoice_no").isNotNull()).alias(f"invoices{i}"),
            F.sum(f"units{i}").alias(f"units{i}"),
            as_money(F.sum(f"revenue{i}")).alias(f"revenue{i}"),
        ]
    any_anomaly = " OR ".join(f"({rows})" for _, rows, _ in ANOMALIES)
    totals = fact.where(any_anomaly).groupBy("invoice_no").agg(*per_invoice).agg(*overall)
    rows = [
        F.struct(
            F.lit(label).alias("anomaly_category"),
            F.col(f"n{i}").alias("record_count"),
            F.col(f"invoices{i}").alias("distinct_invoices"),
            F.col(f"units{i}").alias("net_units_impact"),
            F.col(f"revenue{i}").alias("net_revenue_impact"),
            F.lit(behavior).alias("observed_behavior"),
        )
        for i, (label, _, behavior) in enumerate(ANOMALIES)
    ]
    return totals.select(F.inline(F.array(*rows)))

"""Financial reconciliation and audits of the fact, each from a single scan."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.operators.measures import (
    ALL_ROWS,
    BAD_DEBT,
    CANCELLED,
    CANCELLED_KEPT,
    DUPLICATE,
    KEPT,
    NORMAL_SALE,
    OTHER_NEGATIVE_QUANTITY,
    ratio,
    revenue,
    to_hundredths,
)
from tillroll.schema import FLAG_COLUMNS


def _amounts(**rows: str) -> list[Column]:
    """Sums of revenue rounded to pence, still exact; 0 over no rows."""
    zero = F.lit(0).cast("decimal(28,2)")
    return [F.coalesce(F.round(F.sum(revenue(r)), 2), zero).alias(name) for name, r in rows.items()]


def _published(frame: DataFrame, names: list[str]) -> DataFrame:
    return frame.withColumns({name: F.col(name).cast("double") for name in names})


def _reconciled(totals: DataFrame, parts: list[str], whole: str, component_sum: str, difference: str) -> DataFrame:
    """Add the sum of the parts and its distance from the whole.

    The parts may overlap: a line of negative price and negative quantity is in
    two of them, and shows up as a difference.
    """
    with_sum = totals.withColumn(component_sum, reduce(add, [F.col(part) for part in parts]))
    return with_sum.withColumn(difference, F.round(F.abs(F.col(component_sum) - F.col(whole)), 4))


def financial_reconciliation(fact: DataFrame) -> DataFrame:
    """One row: the four components, their sum, net revenue and the discrepancy."""
    totals = fact.agg(
        *_amounts(
            gross_normal_sales=NORMAL_SALE,
            cancellations_non_dup=CANCELLED_KEPT,
            bad_debt_adjustments=BAD_DEBT,
            other_neg_qty=OTHER_NEGATIVE_QUANTITY,
            duplicate_revenue_excluded=DUPLICATE,
            net_revenue_non_duplicate=KEPT,
            total_table_revenue=ALL_ROWS,
        )
    )
    parts = ["gross_normal_sales", "cancellations_non_dup", "bad_debt_adjustments", "other_neg_qty"]
    result = _reconciled(totals, parts, "net_revenue_non_duplicate", "component_sum", "discrepancy")
    return _published(result, result.columns)


def load_audit(fact: DataFrame, *more: Column) -> DataFrame:
    """One row of row, null and flag counts with the financial check.

    ``more`` aggregates are added in front of the amounts, in the same scan.
    """
    counts = {
        "missing_customers": "customer_id IS NULL",
        "missing_descriptions": "is_missing_description = 1",
        "duplicates": DUPLICATE,
        "cancellations": CANCELLED,
        "normal_sales": NORMAL_SALE,
        "neg_quantities": "is_negative_quantity = 1",
        "zero_prices": "is_zero_price = 1",
        "neg_prices": "is_negative_price = 1",
    }
    amounts = _amounts(
        gross_normal_sales=NORMAL_SALE,
        cancelled_returns_non_dup=CANCELLED_KEPT,
        bad_debt_adjustments=BAD_DEBT,
        other_neg_qty_adjustments=OTHER_NEGATIVE_QUANTITY,
        duplicate_revenue_excluded=DUPLICATE,
        net_revenue_non_duplicate=KEPT,
        total_table_revenue=ALL_ROWS,
    )
    totals = fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.expr(rows)).alias(name) for name, rows in counts.items()],
        *more,
        *amounts,
    )
    parts = [
        "gross_normal_sales",
        "cancelled_returns_non_dup",
        "bad_debt_adjustments",
        "other_neg_qty_adjustments",
    ]
    result = _reconciled(totals, parts, "net_revenue_non_duplicate", "component_sum", "discrepancy")
    return _published(result, result.columns[1 + len(counts) + len(more) :])


def audit_financials(fact: DataFrame) -> DataFrame:
    """One row of audit amounts; cancellations with and without duplicates."""
    totals = fact.agg(
        *_amounts(
            gross_normal_sales=NORMAL_SALE,
            cancelled_returns_offset_non_dup=CANCELLED_KEPT,
            cancelled_returns_offset_all=CANCELLED,
            bad_debt_accounting_adjustments=BAD_DEBT,
            other_negative_quantity_adjustments=OTHER_NEGATIVE_QUANTITY,
            duplicate_revenue_excluded=DUPLICATE,
            net_revenue_non_duplicate=KEPT,
        )
    )
    parts = [
        "gross_normal_sales",
        "cancelled_returns_offset_non_dup",
        "bad_debt_accounting_adjustments",
        "other_negative_quantity_adjustments",
    ]
    result = _reconciled(
        totals, parts, "net_revenue_non_duplicate", "component_reconciled_sum", "reconciliation_difference"
    )
    return _published(result, result.columns)


def category_breakdown(fact: DataFrame) -> DataFrame:
    """Rows per category, most frequent first, with their share in percent."""
    counts = fact.groupBy("transaction_category").agg(F.count(F.lit(1)).alias("n"))
    # One row per category reaches this window, never the fact.
    share = ratio(F.col("n"), F.sum("n").over(Window.partitionBy())) * 100
    return counts.withColumn("pct", to_hundredths(share)).orderBy(F.desc("n"), "transaction_category")


def audit_flags(fact: DataFrame) -> DataFrame:
    """Rows per flag, in fixed order of definition, with their share in percent."""
    totals = fact.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(flag) == 1).alias(flag) for flag in FLAG_COLUMNS]
    )
    share = F.coalesce(to_hundredths(ratio(F.col("count"), F.col("rows")) * 100), F.lit(0.0))
    pairs = [F.struct(F.lit(flag).alias("flag"), F.col(flag).alias("count")) for flag in FLAG_COLUMNS]
    return totals.select("rows", F.inline(F.array(*pairs))).select("flag", "count", share.alias("percentage"))


def missing_values(frame: DataFrame) -> DataFrame:
    """Null count of every column of ``frame``."""
    totals = frame.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in frame.columns])
    pairs = [F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").alias("null_count")) for name in frame.columns]
    return totals.select(F.inline(F.array(*pairs)))

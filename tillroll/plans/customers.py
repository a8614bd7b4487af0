"""Identified customers: lifetime value, segments and spend."""

from pyspark.sql import DataFrame, functions as F

from tillroll.operators.measures import (
    CANCELLED,
    CANCELLED_KEPT,
    KEPT,
    NORMAL_SALE,
    as_money,
    ratio,
    revenue,
    to_hundredths,
    units,
)
from tillroll.operators.quantiles import exact_quantiles
from tillroll.operators.rollup import invoice_totals, rollup


def customer_totals(fact: DataFrame) -> DataFrame:
    """One row per identified customer; guest checkouts are left out first.

    The country is part of the first grouping, so that step keeps to hash
    aggregation over numbers; the text maximum is taken over invoice rows.
    """
    sums = {
        "units_purchased": units(NORMAL_SALE),
        "gross": revenue(NORMAL_SALE),
        "returns": revenue(CANCELLED_KEPT),
        "net": revenue(KEPT),
    }
    orders = {"completed": NORMAL_SALE, "cancelled": CANCELLED}
    add_up = [F.sum(name).alias(name) for name in sums]
    highest = F.max("country").alias("country")
    named = F.col("invoice_no").isNotNull()
    return (
        invoice_totals(fact.where(F.col("customer_id").isNotNull()), ["customer_id", "country"], sums, orders)
        .groupBy("customer_id", "invoice_no")
        .agg(*add_up, highest, *[F.bool_or(name).alias(name) for name in orders])
        .groupBy("customer_id")
        .agg(
            *add_up,
            highest,
            F.count_if(F.col("completed") & named).alias("completed_orders"),
            F.count_if(F.col("cancelled") & named).alias("cancellation_orders"),
        )
    )


def customer_analysis(fact: DataFrame, limit: int = 50) -> DataFrame:
    """The customers with the highest net lifetime spend and their segment."""
    segment = F.when(F.col("completed_orders") > 1, "REPEAT").otherwise("ONE_TIME")
    return (
        customer_totals(fact)
        .select(
            "customer_id",
            F.col("country").alias("primary_country"),
            "completed_orders",
            "cancellation_orders",
            "units_purchased",
            as_money(F.col("gross")).alias("gross_spend"),
            as_money(F.col("returns")).alias("returns_refunded"),
            as_money(F.col("net")).alias("net_lifetime_spend"),
            segment.alias("customer_type"),
        )
        .orderBy(F.desc("net_lifetime_spend"), "customer_id")
        .limit(limit)
    )


def _spend(fact: DataFrame) -> DataFrame:
    totals = rollup(
        fact.where(F.col("customer_id").isNotNull()),
        ["customer_id"],
        sums={"net": revenue(KEPT)},
        orders={"order_count": NORMAL_SALE},
    )
    return totals.select("customer_id", "order_count", F.round("net", 2).alias("net_spend"))


def customer_summary(fact: DataFrame) -> DataFrame:
    """One row: customers, repeat and one-time buyers, mean spend, repeat rate.

    One-time buyers have exactly one completed order; customers with none are
    counted in the total only.
    """
    totals = _spend(fact).agg(
        F.count("customer_id").alias("total_identified_customers"),
        F.count_if(F.col("order_count") > 1).alias("repeat_customers"),
        F.count_if(F.col("order_count") == 1).alias("one_time_customers"),
        F.sum("net_spend").alias("spend"),
    )
    customers = F.col("total_identified_customers")
    return totals.select(
        "total_identified_customers",
        "repeat_customers",
        "one_time_customers",
        to_hundredths(ratio(F.col("spend"), customers)).alias("avg_spend_per_customer"),
        F.coalesce(to_hundredths(ratio(F.col("repeat_customers"), customers) * 100), F.lit(0.0)).alias(
            "repeat_customer_rate_pct"
        ),
    )


def customer_median_spend(fact: DataFrame) -> DataFrame:
    """The median of net spend over identified customers, exact despite the column's name."""
    pence = (F.col("net_spend") * 100).cast("bigint")
    spend = _spend(fact).select(F.lit("net_spend").alias("name"), pence.alias("value"))
    # The empty aggregate gives a null row when there are no customers.
    return exact_quantiles(spend, [0.5]).agg(to_hundredths(F.max("quantile") / 100).alias("approx_median_spend"))

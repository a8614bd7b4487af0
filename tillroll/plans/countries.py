"""Sales by country."""

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.operators.measures import (
    CANCELLED_KEPT,
    GUEST_SALE,
    KEPT,
    NORMAL_SALE,
    as_money,
    ratio,
    revenue,
    to_hundredths,
    units,
)
from tillroll.operators.rollup import rollup_with_customers


def country_analysis(fact: DataFrame, limit: int | None = None) -> DataFrame:
    """Countries by net revenue, best first, with their share of all net revenue."""
    totals = rollup_with_customers(
        fact,
        ["country"],
        sums={
            "units_sold": units(NORMAL_SALE),
            "gross": revenue(NORMAL_SALE),
            "cancellations": revenue(CANCELLED_KEPT),
            "net": revenue(KEPT),
        },
        orders={
            "sales_orders": NORMAL_SALE,
            "guest_orders": GUEST_SALE,
        },
    )
    # One row per country reaches this window, never the fact.
    all_net = F.sum("net").over(Window.partitionBy())
    countries = totals.select(
        "country",
        "sales_orders",
        "identified_customers",
        "guest_orders",
        "units_sold",
        as_money(F.col("gross")).alias("gross_revenue"),
        as_money(F.col("cancellations")).alias("cancellations_offset"),
        as_money(F.col("net")).alias("net_revenue"),
        to_hundredths(ratio(F.col("net"), all_net) * 100).alias("pct_of_global_net_revenue"),
    ).orderBy(F.desc("net_revenue"), "country")
    return countries if limit is None else countries.limit(limit)


def market_share(fact: DataFrame, top: int = 6) -> DataFrame:
    """Net revenue of the ``top`` countries."""
    return country_analysis(fact, limit=top).select("country", "net_revenue")

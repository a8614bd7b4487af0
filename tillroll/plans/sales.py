"""Sales KPIs and trends: overview, months, days, filtered KPIs, filter options."""

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.operators.filters import NO_FILTER, ReportFilter
from tillroll.operators.measures import (
    ALL_ROWS,
    BAD_DEBT,
    CANCELLED,
    CANCELLED_KEPT,
    DUPLICATE,
    KEPT,
    NORMAL_SALE,
    as_money,
    lines,
    or_zero,
    ratio,
    revenue,
    to_hundredths,
    units,
)
from tillroll.operators.rollup import rollup, rollup_with_customers

# The bounds offered when the fact holds no dates.
DEFAULT_MIN_DATE = "2010-12-01"
DEFAULT_MAX_DATE = "2011-12-09"


def sales_overview(fact: DataFrame) -> DataFrame:
    """One row of platform-wide counts, units, revenue and order values."""
    totals = rollup(
        fact,
        [],
        sums={
            "total_transaction_lines": F.lit(1),
            "non_duplicate_lines": lines(KEPT),
            "duplicate_lines": lines(DUPLICATE),
            "units_sold": units(NORMAL_SALE),
            "units_returned": units(CANCELLED_KEPT),
            "gross": revenue(NORMAL_SALE),
            "cancellations": revenue(CANCELLED_KEPT),
            "bad_debt": revenue(BAD_DEBT),
            "net": revenue(KEPT),
        },
        orders={
            "total_distinct_invoices": ALL_ROWS,
            "sales_invoices": NORMAL_SALE,
            "cancellation_invoices": CANCELLED,
            "kept_invoices": KEPT,
        },
    )
    return totals.select(
        or_zero(F.col("total_transaction_lines")).alias("total_transaction_lines"),
        "non_duplicate_lines",
        "duplicate_lines",
        "total_distinct_invoices",
        "sales_invoices",
        "cancellation_invoices",
        "units_sold",
        "units_returned",
        as_money(F.col("gross")).alias("gross_sales_revenue"),
        as_money(F.col("cancellations")).alias("cancellations_revenue_offset"),
        as_money(F.col("bad_debt")).alias("bad_debt_adjustments"),
        as_money(F.col("net")).alias("net_revenue"),
        to_hundredths(ratio(F.col("gross"), F.col("sales_invoices"))).alias("gross_aov_per_sales_order"),
        to_hundredths(ratio(F.col("net"), F.col("kept_invoices"))).alias("net_aov_per_distinct_order"),
    )


def _trend(fact: DataFrame, period: str, *more_units: str) -> DataFrame:
    all_units = {"units_sold": units(NORMAL_SALE), "units_returned": units(CANCELLED_KEPT)}
    shown = {name: all_units[name] for name in ["units_sold", *more_units]}
    totals = rollup(
        fact,
        [period],
        sums={
            **shown,
            "gross": revenue(NORMAL_SALE),
            "returns": revenue(CANCELLED_KEPT),
            "net": revenue(KEPT),
        },
        orders={"order_count": NORMAL_SALE},
    )
    return totals.select(
        period,
        "order_count",
        *shown,
        as_money(F.col("gross")).alias("gross_revenue"),
        as_money(F.col("returns")).alias("returns_offset"),
        as_money(F.col("net")).alias("net_revenue"),
    )


def monthly_sales(fact: DataFrame, where: ReportFilter = NO_FILTER) -> DataFrame:
    """Months in order, with growth over the previous month that has rows."""
    months = _trend(fact.where(where.predicate()), "sales_month")
    # One row per calendar month reaches this window, never the fact.
    previous = F.lag("net_revenue").over(Window.orderBy("sales_month"))
    growth = F.try_divide(F.col("net_revenue") - F.col("prev_month_net_revenue"), F.col("prev_month_net_revenue"))
    return (
        months.withColumn("prev_month_net_revenue", previous)
        .withColumn("mom_growth_percent", to_hundredths(growth * 100))
        .orderBy("sales_month")
    )


def daily_sales(fact: DataFrame, where: ReportFilter = NO_FILTER) -> DataFrame:
    """Days in order, with orders, units and revenue."""
    dated = fact.where(where.predicate()).withColumn("sales_date", F.to_date("invoice_date"))
    days = _trend(dated, "sales_date", "units_returned")
    return days.withColumn("sales_date", F.date_format("sales_date", "yyyy-MM-dd")).orderBy("sales_date")


def daily_moving_average(fact: DataFrame, where: ReportFilter = NO_FILTER) -> DataFrame:
    """Daily sales with the mean net revenue of the last seven days that have rows."""
    # One row per calendar day reaches this window.
    last_seven = Window.orderBy("sales_date").rowsBetween(-6, 0)
    net = F.col("net_revenue").cast("decimal(28,2)")
    mean = ratio(F.sum(net).over(last_seven), F.count(net).over(last_seven))
    return daily_sales(fact, where).withColumn("net_revenue_7d_ma", to_hundredths(mean)).orderBy("sales_date")


def first_and_last_days(fact: DataFrame, days: int = 5, where: ReportFilter = NO_FILTER) -> DataFrame:
    """The first and the last ``days`` of the daily series, marked in ``part``."""
    daily = daily_sales(fact, where)
    first = daily.orderBy("sales_date").limit(days).withColumn("part", F.lit("FIRST"))
    last = daily.orderBy(F.desc("sales_date")).limit(days).withColumn("part", F.lit("LAST"))
    return first.unionByName(last).orderBy("part", "sales_date")


def filtered_kpis(fact: DataFrame, where: ReportFilter = NO_FILTER) -> DataFrame:
    """One row of KPIs under a filter; zeros when nothing matches."""
    totals = rollup_with_customers(
        fact.where(where.predicate()),
        [],
        sums={
            "total_rows": F.lit(1),
            "non_duplicate_lines": lines(KEPT),
            "units_sold": units(NORMAL_SALE),
            "units_returned": units(CANCELLED_KEPT),
            "gross": revenue(NORMAL_SALE),
            "cancellations": revenue(CANCELLED_KEPT),
            "bad_debt": revenue(BAD_DEBT),
            "net": revenue(KEPT),
        },
        orders={
            "total_invoices": ALL_ROWS,
            "sales_invoices": NORMAL_SALE,
            "cancel_invoices": CANCELLED,
        },
    )

    def money(name):
        return F.coalesce(as_money(F.col(name)), F.lit(0.0))

    return totals.select(
        or_zero(F.col("total_rows")).alias("total_rows"),
        or_zero(F.col("non_duplicate_lines")).alias("non_duplicate_lines"),
        "total_invoices",
        "sales_invoices",
        "cancel_invoices",
        or_zero(F.col("units_sold")).alias("units_sold"),
        or_zero(F.col("units_returned")).alias("units_returned"),
        money("gross").alias("gross_sales_revenue"),
        money("cancellations").alias("cancellations_offset"),
        money("bad_debt").alias("bad_debt_adjustments"),
        money("net").alias("net_revenue"),
        "identified_customers",
        # The order value is taken from the rounded gross, as shown next to it.
        F.coalesce(to_hundredths(ratio(money("gross"), F.col("sales_invoices"))), F.lit(0.0)).alias("gross_aov"),
    )


def net_units(kpis: DataFrame) -> DataFrame:
    """Units sold and returned with their balance; returned units are negative."""
    return kpis.select(
        "units_sold", "units_returned", (F.col("units_sold") + F.col("units_returned")).alias("net_units")
    )


def date_bounds(fact: DataFrame) -> DataFrame:
    """First and last day in the fact, or the default range when it is empty."""
    return fact.agg(F.min("invoice_date").alias("first"), F.max("invoice_date").alias("last")).select(
        F.coalesce(F.date_format("first", "yyyy-MM-dd"), F.lit(DEFAULT_MIN_DATE)).alias("min_date"),
        F.coalesce(F.date_format("last", "yyyy-MM-dd"), F.lit(DEFAULT_MAX_DATE)).alias("max_date"),
    )


def country_options(fact: DataFrame) -> DataFrame:
    """The countries in the fact, in order."""
    return fact.where(F.col("country").isNotNull()).select("country").distinct().orderBy("country")

"""Product names and rankings."""

from pyspark.sql import DataFrame, functions as F

from tillroll.operators.filters import NO_FILTER, ReportFilter
from tillroll.operators.measures import CANCELLED_KEPT, KEPT, NORMAL_SALE, as_money, revenue, units
from tillroll.schema import FEE_CODES, MISSING_DESCRIPTION

# The ranking orders users may ask for.
ORDERINGS = {"revenue": "gross_revenue", "quantity": "gross_units_sold"}

# Lines that can lend a product its name.
NAMED_SALE = f"{NORMAL_SALE} AND description NOT IN ('{MISSING_DESCRIPTION}', '')"


def canonical_names(fact: DataFrame) -> DataFrame:
    """For each stock code the description most often sold under.

    Ties go to the description that sorts first.
    """
    counts = fact.where(NAMED_SALE).groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("n"))
    most_sold = F.min_by("description", F.struct(-F.col("n"), F.col("description")))
    return counts.groupBy("stock_code").agg(most_sold.alias("description"))


def _ranking(fact: DataFrame, order_by: str, limit: int) -> DataFrame:
    """Totals of the best products; sums alone, so map tasks shrink every product to a row."""
    totals = fact.groupBy("stock_code").agg(
        F.sum(units(NORMAL_SALE)).alias("gross_units_sold"),
        F.sum(units(CANCELLED_KEPT)).alias("units_returned"),
        F.sum(units(KEPT)).alias("net_units_sold"),
        as_money(F.sum(revenue(NORMAL_SALE))).alias("gross_revenue"),
        as_money(F.sum(revenue(KEPT))).alias("net_revenue"),
    )
    return totals.orderBy(F.desc(ORDERINGS[order_by]), "stock_code").limit(limit)


def top_products(
    fact: DataFrame, order_by: str = "revenue", limit: int = 10, where: ReportFilter = NO_FILTER
) -> DataFrame:
    """The ``limit`` best products by gross revenue or units; fee codes left out.

    Filters choose the lines that are ranked; names come from all sales. Ties
    go to the stock code that sorts first. An invoice rarely repeats a product,
    so counting its invoices shrinks nothing: that is done, together with the
    names, for the lines of ranked products only. Both readings of the fact leave
    out the same lines, so that what derives it, if it is not published yet, runs
    once; the join alone would ask one of them for codes that are not null.
    """
    if order_by not in ORDERINGS:
        raise ValueError(f"Products cannot be ranked by {order_by!r}; choose one of {sorted(ORDERINGS)}.")
    fact = fact.where(F.col("stock_code").isNotNull() & ~F.col("stock_code").isin(FEE_CODES))
    ranked = _ranking(fact.where(where.predicate()), order_by, limit)
    product = ranked.columns
    ordered = F.when(F.expr(NORMAL_SALE) & where.predicate(), F.col("invoice_no"))
    name = F.when(F.expr(NAMED_SALE), F.col("description"))
    entities = F.array(
        F.struct(F.lit(True).alias("is_order"), ordered.alias("id")),
        F.struct(F.lit(False).alias("is_order"), name.alias("id")),
    )
    lines = fact.join(ranked, "stock_code")
    is_order, known = F.col("is_order"), F.col("id").isNotNull()
    most_sold = F.min_by("id", F.when(~is_order & known, F.struct(-F.col("n"), F.col("id"))))
    return (
        lines.select(*product, F.inline(entities))
        .groupBy(*product, "is_order", "id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*product)
        .agg(
            F.coalesce(most_sold, F.lit(MISSING_DESCRIPTION)).alias("product_name"),
            F.count_if(is_order & known).alias("order_count"),
        )
        .select("stock_code", "product_name", *product[1:], "order_count")
        .orderBy(F.desc(ORDERINGS[order_by]), "stock_code")
    )

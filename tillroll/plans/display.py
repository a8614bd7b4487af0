"""Reports as people read them: formatted values under display headings."""

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.display import currency, number, percent

# Heading and format of every displayed column, by report.
_PLAIN = None
MONTHLY_DISPLAY = {
    "sales_month": ("Month", _PLAIN),
    "order_count": ("Orders", _PLAIN),
    "net_revenue": ("Net Revenue", currency),
    "mom_growth_percent": ("MoM Growth", percent),
}
PRODUCT_DISPLAY = {
    "stock_code": ("Stock Code", _PLAIN),
    "product_name": ("Product Name", _PLAIN),
    "gross_units_sold": ("Units Sold", number),
    "units_returned": ("Units Returned", number),
    "net_units_sold": ("Net Units", number),
    "gross_revenue": ("Gross Revenue", currency),
    "net_revenue": ("Net Revenue", currency),
    "order_count": ("Orders", _PLAIN),
}
COUNTRY_DISPLAY = {
    "country": ("Country", _PLAIN),
    "sales_orders": ("Sales Orders", number),
    "identified_customers": ("Identified Customers", number),
    "guest_orders": ("Guest Orders", number),
    "units_sold": ("Units Sold", _PLAIN),
    "gross_revenue": ("Gross Revenue", currency),
    "cancellations_offset": ("Returns Offset", currency),
    "net_revenue": ("Net Revenue", currency),
    "pct_of_global_net_revenue": ("% Global Revenue", _PLAIN),
}
CUSTOMER_DISPLAY = {
    "customer_id": ("Customer ID", _PLAIN),
    "primary_country": ("Country", _PLAIN),
    "completed_orders": ("Completed Orders", _PLAIN),
    "cancellation_orders": ("Cancellations", _PLAIN),
    "units_purchased": ("Units Purchased", _PLAIN),
    "gross_spend": ("Gross Spend", currency),
    "returns_refunded": ("Refunds", currency),
    "net_lifetime_spend": ("Net Lifetime Spend", currency),
    "customer_type": ("Segment", _PLAIN),
}
ANOMALY_DISPLAY = {
    "anomaly_category": ("Anomaly Category", _PLAIN),
    "record_count": ("Records", number),
    "distinct_invoices": ("Invoices", number),
    "net_units_impact": ("Net Units Impact", number),
    "net_revenue_impact": ("Net Revenue Impact", currency),
    "observed_behavior": ("Empirical Observation", _PLAIN),
}


def displayed(report: DataFrame, layout: dict) -> DataFrame:
    """The layout's columns of a report, formatted and renamed."""
    return report.select(
        *[(form(F.col(name)) if form else F.col(name)).alias(heading) for name, (heading, form) in layout.items()]
    )


def ascending(report: DataFrame, measure: str) -> DataFrame:
    """A ranking turned round, smallest first, as bar charts draw it."""
    return report.orderBy(measure)

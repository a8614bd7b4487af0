"""The business report as a set of frames, to look at or to write out."""

from pyspark.sql import DataFrame

from tillroll.plans.anomalies import returns_and_cancellations
from tillroll.plans.countries import country_analysis
from tillroll.plans.customers import customer_analysis, customer_summary
from tillroll.plans.products import top_products
from tillroll.plans.reconciliation import financial_reconciliation
from tillroll.plans.sales import first_and_last_days, monthly_sales, sales_overview


def business_report(fact: DataFrame) -> dict[str, DataFrame]:
    """Every report that makes up the business report, whole, by name and still lazy."""
    return {
        "overview": sales_overview(fact),
        "reconciliation": financial_reconciliation(fact),
        "monthly": monthly_sales(fact),
        "products_by_revenue": top_products(fact, "revenue", 10),
        "products_by_quantity": top_products(fact, "quantity", 10),
        "countries": country_analysis(fact, 10),
        "customer_summary": customer_summary(fact),
        "customers": customer_analysis(fact, 10),
        "anomalies": returns_and_cancellations(fact),
        "first_and_last_days": first_and_last_days(fact, 5),
    }


def write_business_report(fact: DataFrame, path: str) -> None:
    """Write each section as Parquet under ``path``, replacing an earlier report."""
    for name, section in business_report(fact).items():
        section.write.mode("overwrite").parquet(f"{path}/{name}")

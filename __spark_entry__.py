
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duckdb_checks import CHECKS  # noqa: E402
from tillroll.operators.cleaning import (  # noqa: E402
    clean_text_fields,
    convert_data_types,
    standardize_columns,
    to_fact,
    transform_retail,
)
from tillroll.operators.distinct import distinct_counts  # noqa: E402
from tillroll.operators.filters import ReportFilter  # noqa: E402
from tillroll.plans import (  # noqa: E402
    anomalies,
    countries,
    customers,
    display,
    products,
    profile,
    publish,
    reconciliation,
    sales,
    validation,
)
from tillroll.plans.etl import run_etl  # noqa: E402
from tillroll.schema import FLAG_COLUMNS, RAW_TO_FACT  # noqa: E402
from tillroll.sources.orders import order_dates, retail_lines, text_lines  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from tillroll.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tillroll.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

AUDITED = [*RAW_TO_FACT.values(), *FLAG_COLUMNS, "transaction_category"]

YEAR = {"start_date": "1996-03-15", "end_date": "1997-02-10"}
COUNTRY_YEAR = ReportFilter(**YEAR, country="NATION_3")
SEARCH_YEAR = ReportFilter(**YEAR, search_query=" LD_g%r ")
PRODUCT_FILTER = ReportFilter(**YEAR, country="NATION_3", search_query="bolt")
FUTURE = ReportFilter(start_date="2030-01-01")


def _on_raw(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(retail_lines(spark, folder))


def _on_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_raw(lambda raw: report(to_fact(transform_retail(raw))))


def _shown(report: Callable[[DataFrame], DataFrame], layout: dict) -> Query:
    return _on_fact(lambda fact: display.displayed(report(fact), layout))


def _with_text_dates(frame: DataFrame, date: str, price: str) -> DataFrame:
    return frame.withColumns(
        {date: F.date_format(date, "yyyy-MM-dd HH:mm:ss"), price: F.col(price).cast("double")}
    )


def _clean_transactions(fact: DataFrame) -> DataFrame:
    published = _with_text_dates(fact.drop("loaded_at"), "invoice_date", "unit_price")
    return published.withColumn("line_revenue", F.col("line_revenue").cast("double"))


def _sample(raw: DataFrame) -> DataFrame:
    return _with_text_dates(profile.profile_sample(raw), "InvoiceDate", "UnitPrice")


def _revenue_mismatches(raw: DataFrame) -> DataFrame:
    wrong = validation.revenue_mismatches(transform_retail(raw))
    return wrong.agg(F.count(F.lit(1)).alias("mismatches"))


def _with_wrong_revenue(transformed: DataFrame) -> DataFrame:
    """Revenue is one too high wherever seven divides the quantity."""
    off = F.when(F.col("Quantity") % 7 == 0, 1).otherwise(0)
    return transformed.withColumn("LineRevenue", F.col("LineRevenue") + off)


def _untidy_revenue_mismatches(raw: DataFrame) -> DataFrame:
    wrong = validation.revenue_mismatches(_with_wrong_revenue(transform_retail(raw)))
    return wrong.agg(F.count(F.lit(1)).alias("mismatches"))


def _untidy_lines(text: DataFrame) -> DataFrame:
    """Every untidy line, cleaned and typed, under the names of the fact."""
    typed = convert_data_types(clean_text_fields(standardize_columns(text)))
    names = {raw: name for raw, name in RAW_TO_FACT.items() if raw in typed.columns}
    lines = _with_text_dates(typed.withColumnsRenamed(names), "invoice_date", "unit_price")
    return lines.withColumn("is_missing_description", F.col("is_missing_description").cast("int"))


def _validation_summary(text: DataFrame) -> DataFrame:
    return validation.validation_summary(standardize_columns(text), _with_wrong_revenue(transform_retail(text)))


def _row_counts(raw: DataFrame) -> DataFrame:
    return validation.row_counts(standardize_columns(raw), transform_retail(raw))


def _on_text(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(text_lines(spark, folder))


def _in_work_folder(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """The few rows that work finds with a new folder of its own, which is then removed.

    The folder lies in spark.checkpoint.dir or, where that is unset, in the
    warehouse: every executor reaches either.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tillroll-{uuid.uuid4().hex}")
    try:
        found = work(path.toString())
        return spark.createDataFrame(found.collect(), found.schema)
    finally:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _publish_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Load the fact table, then read the published version back, one row for each month."""

    def work(table: str) -> DataFrame:
        publish.load_transformed(transform_retail(retail_lines(spark, folder), by_time=True), table, by_time=True)
        invoices = publish.read_fact(spark, table).groupBy("sales_month", "invoice_no")
        totals = invoices.agg(F.count(F.lit(1)).alias("lines"), F.sum("line_revenue").alias("revenue"))
        return totals.groupBy("sales_month").agg(
            F.sum("lines").alias("lines"),
            F.count("invoice_no").alias("invoices"),
            F.sum("revenue").cast("double").alias("revenue"),
        )

    return _in_work_folder(spark, work)


def _append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Load the fact table, append the same lines again, read both back, one row for each month."""

    def work(base: str) -> DataFrame:
        raw, dates, table = _derived_once(spark, folder, base), order_dates(spark, folder), f"{base}/fact"
        for full_refresh in (True, False):
            publish.load_transformed(
                lambda earlier: transform_retail(raw, earlier=earlier, by_time=True), table, full_refresh, dates=dates, by_time=True
            )
        fact = publish.read_fact(spark, table)
        totals = fact.groupBy("sales_month").agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("line_revenue").cast("double").alias("revenue"),
        )
        ids = distinct_counts(fact, "sales_month", "line_id", f"{base}/repeated").withColumnRenamed("sales_month", "month")
        return totals.join(ids, F.col("sales_month").eqNullSafe(F.col("month"))).select("sales_month", "lines", F.col("distinct").alias("line_ids"), "revenue")

    return _in_work_folder(spark, work)


def _derived_once(spark: SparkSession, folder: str, base: str) -> DataFrame:
    """The raw lines, written to be loaded twice: to join the tables again would move far more than is written."""
    retail_lines(spark, folder).write.option("compression", "zstd").parquet(f"{base}/raw")
    return spark.read.parquet(f"{base}/raw")


def _append_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Load the raw lines, append them again, and count what both loads together are: the second adds but duplicates."""

    def work(base: str) -> DataFrame:
        raw, dates, table = _derived_once(spark, folder, base), order_dates(spark, folder), f"{base}/fact"
        for full_refresh in (True, False):
            # Lines have few copies here, so that little is lost by moving them uncombined.
            publish.load_raw(raw, table, full_refresh, dates=dates, by_time=True)
        kinds = publish.read_fact(spark, table).groupBy("sales_month", "transaction_category")
        return kinds.agg(F.count(F.lit(1)).alias("lines"), F.sum("line_revenue").cast("double").alias("revenue"))

    return _in_work_folder(spark, work)


def _search_published(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales of the products that a search finds in the published table's dictionary of products."""

    def work(table: str) -> DataFrame:
        publish.load_raw(retail_lines(spark, folder), table)
        return sales.daily_sales(publish.search_fact(spark, table, SEARCH_YEAR))

    return _in_work_folder(spark, work)


def _quarantine_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Load the untidy lines and set apart what can't be published: lines by fate, published or why not, and revenue."""

    def work(table: str) -> DataFrame:
        text = text_lines(spark, folder)
        publish.load_raw(text, table, expected_rows=text.count(), quarantine_limit=2**62)
        good = publish.read_fact(spark, table).select(F.lit("published").alias("fate"), "line_revenue")
        apart = publish.quarantined(spark, table).select(F.array_join("reasons", ",").alias("fate"), F.lit(None).alias("line_revenue"))
        fates = good.unionByName(apart).groupBy("fate")
        return fates.agg(F.count(F.lit(1)).alias("lines"), F.sum("line_revenue").cast("double").alias("revenue"))

    return _in_work_folder(spark, work)


def _written_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the load job writes about itself, read back: parts of its report and the size in its profile."""

    def work(base: str) -> DataFrame:
        retail_lines(spark, folder).write.option("compression", "zstd").parquet(f"{base}/raw")
        run_etl(spark, f"{base}/raw", f"{base}/fact", profile_path=f"{base}/profile", report_path=f"{base}/report")
        report = spark.read.parquet(f"{base}/report")
        wanted = F.col("name").isin("total_rows", "duplicates", "normal_sales", "status") | F.concat_ws(".", "section", "name").isin("run.raw_rows", "steps.profile")
        size = spark.read.parquet(f"{base}/profile/size").select(F.lit("profile").alias("section"), F.lit("rows").alias("name"), F.col("rows").cast("string").alias("value"))
        return report.where(wanted).unionByName(size)

    return _in_work_folder(spark, work)


def _user_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A user's SQL over the published fact, one row for each country."""

    def work(table: str) -> DataFrame:
        # Lines have one copy at most here, so that little is lost by moving them uncombined.
        publish.load_transformed(transform_retail(retail_lines(spark, folder), by_time=True), table, by_time=True)
        text = """SELECT country, COUNT(*) AS sales FROM retail_transactions
                  WHERE is_normal_sale = ? AND quantity > ? GROUP BY country"""
        return publish.execute_query(spark, table, text, [1, 10])

    return _in_work_folder(spark, work)


def _load_job(spark: SparkSession, folder: str) -> DataFrame:
    """Write the raw lines as CSV, with line breaks and quotes inside fields, run the whole job on them, audit the fact."""

    def work(base: str) -> DataFrame:
        raw_path, table = f"{base}/raw.csv", f"{base}/fact"
        raw = retail_lines(spark, folder)
        longer = F.concat("Description", F.lit('\nsaid "again", twice'))
        raw = raw.withColumn("Description", F.when(F.col("InvoiceNo").startswith("C") & (F.trim("Description") != ""), longer).otherwise(F.col("Description")))
        kept_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        raw.write.options(header=True, escape='"', quoteAll=True, compression="gzip", **kept_blanks).csv(raw_path)
        run_etl(spark, raw_path, table, multi_line=True)
        return reconciliation.load_audit(publish.read_fact(spark, table))

    return _in_work_folder(spark, work)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly sales with growth over the cleaned lines of the smallest test set."""
    return queries()["monthly_sales"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every report and check; each takes the session and the folder of the tables."""
    return retail_queries() | (llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})


def retail_queries() -> dict[str, Query]:
    """The queries that need no more than the library itself."""
    return {
        "clean_transactions": _on_fact(_clean_transactions),
        "category_breakdown": _on_fact(reconciliation.category_breakdown),
        "sales_overview": _on_fact(sales.sales_overview),
        "monthly_sales": _on_fact(sales.monthly_sales),
        "monthly_sales_filtered": _on_fact(lambda fact: sales.monthly_sales(fact, COUNTRY_YEAR)),
        "daily_sales": _on_fact(sales.daily_sales),
        "daily_sales_filtered": _on_fact(lambda fact: sales.daily_sales(fact, SEARCH_YEAR)),
        "daily_moving_average": _on_fact(sales.daily_moving_average),
        "daily_first_last": _on_fact(sales.first_and_last_days),
        "canonical_names": _on_fact(products.canonical_names),
        "top_products_revenue": _on_fact(products.top_products),
        "top_products_quantity": _on_fact(lambda fact: products.top_products(fact, order_by="quantity")),
        "top_products_filtered": _on_fact(
            lambda fact: products.top_products(fact, limit=25, where=PRODUCT_FILTER)
        ),
        "country_analysis": _on_fact(countries.country_analysis),
        "market_share_top6": _on_fact(countries.market_share),
        "market_share_top10": _on_fact(
            lambda fact: display.ascending(countries.market_share(fact, top=10), "net_revenue")
        ),
        "customer_analysis": _on_fact(customers.customer_analysis),
        "customer_summary": _on_fact(customers.customer_summary),
        "customer_median_spend": _on_fact(customers.customer_median_spend),
        "returns_and_cancellations": _on_fact(anomalies.returns_and_cancellations),
        "financial_reconciliation": _on_fact(reconciliation.financial_reconciliation),
        "filtered_kpis": _on_fact(lambda fact: sales.filtered_kpis(fact, COUNTRY_YEAR)),
        "filtered_kpis_empty": _on_fact(lambda fact: sales.filtered_kpis(fact, FUTURE)),
        "net_units": _on_fact(lambda fact: sales.net_units(sales.filtered_kpis(fact))),
        "filter_date_bounds": _on_fact(sales.date_bounds),
        "filter_countries": _on_fact(sales.country_options),
        "load_audit": _on_fact(reconciliation.load_audit),
        "audit_flags": _on_fact(reconciliation.audit_flags),
        "audit_financials": _on_fact(reconciliation.audit_financials),
        "missing_values": _on_fact(lambda fact: reconciliation.missing_values(fact.select(*AUDITED))),
        "profile_size": _on_raw(profile.profile_size),
        "profile_columns": _on_raw(profile.profile_columns),
        "profile_sample": _on_raw(_sample),
        "profile_duplicates": _on_raw(profile.profile_duplicates),
        "profile_temporal": _on_raw(profile.profile_temporal),
        "profile_numeric": _on_raw(profile.profile_numeric),
        "profile_anomalies": _on_raw(profile.profile_anomalies),
        "parse_failures": _on_raw(profile.parse_failures),
        "revenue_mismatches": _on_raw(_revenue_mismatches),
        "row_count_reconciliation": _on_raw(_row_counts),
        "not_null_violations": _on_fact(validation.not_null_violations),
        "monthly_display": _shown(sales.monthly_sales, display.MONTHLY_DISPLAY),
        "products_display": _shown(products.top_products, display.PRODUCT_DISPLAY),
        "countries_display": _shown(
            lambda fact: countries.country_analysis(fact, limit=15), display.COUNTRY_DISPLAY
        ),
        "customers_display": _shown(
            lambda fact: customers.customer_analysis(fact, limit=20), display.CUSTOMER_DISPLAY
        ),
        "anomalies_display": _shown(anomalies.returns_and_cancellations, display.ANOMALY_DISPLAY),
        "untidy_lines": _on_text(_untidy_lines),
        "untidy_parse_failures": _on_text(profile.parse_failures),
        "untidy_not_null_violations": _on_text(
            lambda text: validation.not_null_violations(to_fact(transform_retail(text)))
        ),
        "untidy_revenue_mismatches": _on_raw(_untidy_revenue_mismatches),
        "validation_summary": _on_text(_validation_summary),
        "append_roundtrip": _append_roundtrip,
        "append_duplicates": _append_duplicates,
        "search_published": _search_published,
        "quarantine_roundtrip": _quarantine_roundtrip,
        "written_report": _written_report,
        "user_sql": _user_sql,
        "publish_roundtrip": _publish_roundtrip,
        "load_job": _load_job,
    }


def oracle_sql() -> dict[str, str]:
    """For every query the SQL that must give the same rows in DuckDB."""
    return CHECKS | (llm.SQL if llm else {})

import pytest
from samples import NINE_LINES, dicts, fact_frame, line, only

from tillroll.operators.filters import ReportFilter
from tillroll.plans import anomalies, countries, customers, products, reconciliation, reports, sales
from tillroll.plans.display import ascending


@pytest.fixture(scope="module")
def fact(spark):
    return fact_frame(spark, NINE_LINES).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return fact_frame(spark, [])


def test_overview(fact):
    assert only(sales.sales_overview(fact)) == {
        "total_transaction_lines": 9,
        "non_duplicate_lines": 8,
        "duplicate_lines": 1,
        "total_distinct_invoices": 8,
        "sales_invoices": 6,
        "cancellation_invoices": 1,
        "units_sold": 62,
        "units_returned": -2,
        "gross_sales_revenue": 310.0,
        "cancellations_revenue_offset": -10.0,
        "bad_debt_adjustments": -50.0,
        "net_revenue": 250.0,
        "gross_aov_per_sales_order": 51.67,
        "net_aov_per_distinct_order": 31.25,
    }


def test_overview_of_nothing(empty):
    row = only(sales.sales_overview(empty))
    assert row["total_transaction_lines"] == row["sales_invoices"] == 0
    assert row["net_revenue"] is None and row["gross_aov_per_sales_order"] is None


def test_months(fact):
    rows = dicts(sales.monthly_sales(fact))
    found = [(r["sales_month"], r["order_count"], r["net_revenue"], r["mom_growth_percent"]) for r in rows]
    assert found == [("2011-01", 2, 90.0, None), ("2011-02", 2, 130.0, 44.44), ("2011-03", 2, 30.0, -76.92)]
    assert [r["prev_month_net_revenue"] for r in rows] == [None, 90.0, 130.0]


def test_growth_skips_months_without_rows(fact):
    rows = dicts(sales.monthly_sales(fact, ReportFilter(country="France")))
    assert [(r["sales_month"], r["prev_month_net_revenue"]) for r in rows] == [("2011-01", None), ("2011-03", 50.0)]


def test_growth_after_zero_is_null(spark):
    fact = fact_frame(spark, [line("1", price=0.0), line("2", date="2011-02-03 00:00:00")])
    assert [r["mom_growth_percent"] for r in dicts(sales.monthly_sales(fact))] == [None, None]


def test_days_and_their_filter(fact):
    january = dicts(sales.daily_sales(fact, ReportFilter("2011-01-01", "2011-01-31")))
    assert [r["sales_date"] for r in january] == ["2011-01-05", "2011-01-15", "2011-01-20"]
    assert january[2]["units_returned"] == -2 and january[2]["returns_offset"] == -10.0
    assert dicts(sales.daily_sales(fact, ReportFilter("2025-01-01", "2025-01-31"))) == []


def test_last_day_of_a_range_is_included(spark):
    fact = fact_frame(spark, [line(date="2011-01-31 23:59:59"), line(date="2011-02-01 00:00:00")])
    assert len(dicts(sales.daily_sales(fact, ReportFilter(end_date="2011-01-31")))) == 1


def test_moving_average_is_over_seven_rows(spark):
    days = [1, 2, 3, 5, 6, 8, 9, 20]
    fact = fact_frame(spark, [line(str(d), date=f"2011-01-{d:02d} 09:00:00", price=float(d)) for d in days])
    found = [r["net_revenue_7d_ma"] for r in dicts(sales.daily_moving_average(fact))]
    expected = [round(sum(days[max(0, i - 6) : i + 1]) / len(days[max(0, i - 6) : i + 1]), 2) for i in range(8)]
    assert found == expected


def test_first_and_last_days(fact):
    rows = dicts(sales.first_and_last_days(fact, 2))
    assert [(r["part"], r["sales_date"]) for r in rows] == [
        ("FIRST", "2011-01-05"), ("FIRST", "2011-01-15"), ("LAST", "2011-03-05"), ("LAST", "2011-03-10"),
    ]


def test_sums_agree_across_grains(fact):
    net = only(sales.sales_overview(fact))["net_revenue"]
    assert sum(r["net_revenue"] for r in dicts(sales.monthly_sales(fact))) == net
    assert sum(r["net_revenue"] for r in dicts(sales.daily_sales(fact))) == net
    assert sum(r["net_revenue"] for r in dicts(countries.country_analysis(fact))) == net


def test_products(fact):
    rows = [tuple(r.values()) for r in dicts(products.top_products(fact))]
    assert rows == [
        ("PROD_A", "Product A", 38, -2, 36, 190.0, 180.0, 3),
        ("PROD_B", "Product B", 9, 0, 9, 90.0, 90.0, 2),
        ("PROD_C", "UNSPECIFIED", 15, 0, 15, 30.0, 30.0, 1),
        ("B", "UNSPECIFIED", 0, 0, 1, 0.0, -50.0, 0),
    ]


def test_products_by_quantity_and_limit(fact):
    rows = dicts(products.top_products(fact, order_by="quantity", limit=2))
    assert [r["stock_code"] for r in rows] == ["PROD_A", "PROD_C"]


def test_long_rankings_begin_as_short_ones(fact):
    short = dicts(products.top_products(fact, limit=2))
    assert dicts(products.top_products(fact, limit=20_000))[:2] == short


def test_unknown_product_order(fact):
    with pytest.raises(ValueError, match="cannot be ranked by"):
        products.top_products(fact, order_by="invalid_col")


def test_fee_codes_are_not_ranked(spark):
    fact = fact_frame(spark, [line(stock=code) for code in ["POST", "D", "M", "BANK CHARGES", "PADS", "DOT", "CRUK", "m"]])
    assert [r["stock_code"] for r in dicts(products.top_products(fact))] == ["m"]


def test_names_come_from_all_sales_whatever_the_filter(spark):
    rows = [line(str(i), description="usual", country="A") for i in range(3)]
    rows += [line("9", description="rare", country="B"), line("C8", description="note"), line("10", description="note", price=0.0)]
    fact = fact_frame(spark, rows)
    found = dicts(products.top_products(fact, where=ReportFilter(country="B")))
    assert [(r["product_name"], r["order_count"], r["gross_units_sold"]) for r in found] == [("usual", 1, 1)]


def test_name_ties_go_to_the_first_in_order(spark):
    rows = [line("1", description="b"), line("2", description="a"), line("3", description=None), line("4", description=" ")]
    fact = fact_frame(spark, rows)
    assert dicts(products.canonical_names(fact)) == [{"stock_code": "S", "description": "a"}]
    assert only(products.top_products(fact))["product_name"] == "a"


def test_countries(fact):
    rows = [tuple(r.values()) for r in dicts(countries.country_analysis(fact))]
    assert rows == [
        ("United Kingdom", 3, 2, 0, 34, 190.0, -10.0, 130.0, 52.0),
        ("France", 2, 1, 0, 13, 90.0, 0.0, 90.0, 36.0),
        ("Germany", 1, 0, 1, 15, 30.0, 0.0, 30.0, 12.0),
    ]
    assert len(dicts(countries.country_analysis(fact, limit=2))) == 2
    assert dicts(countries.market_share(fact, top=1)) == [{"country": "United Kingdom", "net_revenue": 130.0}]


def test_customers(fact):
    rows = dicts(customers.customer_analysis(fact))
    found = [(r["customer_id"], r["completed_orders"], r["cancellation_orders"], r["net_lifetime_spend"]) for r in rows]
    assert found == [(1001, 2, 1, 140.0), (1002, 2, 0, 90.0), (1003, 1, 0, 40.0)]
    assert [r["customer_type"] for r in rows] == ["REPEAT", "REPEAT", "ONE_TIME"]
    assert only(customers.customer_summary(fact)) == {
        "total_identified_customers": 3,
        "repeat_customers": 2,
        "one_time_customers": 1,
        "avg_spend_per_customer": 90.0,
        "repeat_customer_rate_pct": 66.67,
    }
    assert only(customers.customer_median_spend(fact)) == {"approx_median_spend": 90.0}


def test_customers_of_nothing(empty):
    row = only(customers.customer_summary(empty))
    assert row["total_identified_customers"] == 0 and row["repeat_customer_rate_pct"] == 0.0
    assert row["avg_spend_per_customer"] is None
    assert only(customers.customer_median_spend(empty)) == {"approx_median_spend": None}


def test_customer_without_orders_is_one_time_but_not_counted_so(spark):
    fact = fact_frame(spark, [line("C1", quantity=-1, customer=7.0), line("2", customer=8.0)])
    assert {r["customer_id"]: r["customer_type"] for r in dicts(customers.customer_analysis(fact))} == {
        7: "ONE_TIME", 8: "ONE_TIME",
    }
    summary = only(customers.customer_summary(fact))
    assert (summary["total_identified_customers"], summary["one_time_customers"]) == (2, 1)


def test_an_invoice_in_two_countries_counts_once_per_customer(spark):
    rows = [line("1", stock="x", customer=7.0, country="A"), line("1", stock="y", customer=7.0, country="B")]
    row = only(customers.customer_analysis(fact_frame(spark, rows)))
    assert (row["completed_orders"], row["primary_country"]) == (1, "B")


def test_cancelled_counts_include_duplicates_but_amounts_do_not(spark):
    rows = [line("C1", quantity=-1, customer=7.0)] * 2
    fact = fact_frame(spark, rows)
    row = only(customers.customer_analysis(fact))
    assert (row["cancellation_orders"], row["returns_refunded"]) == (1, -1.0)
    audit = only(reconciliation.audit_financials(fact))
    assert audit["cancelled_returns_offset_non_dup"] == -1.0 and audit["cancelled_returns_offset_all"] == -2.0


def test_anomalies(fact):
    rows = [tuple(r.values())[1:5] for r in dicts(anomalies.returns_and_cancellations(fact))]
    assert rows == [(1, 1, -2, -10.0), (0, 0, None, None), (1, 1, 1, -50.0), (0, 0, None, None)]


def test_anomalies_of_nothing(empty):
    rows = [tuple(r.values())[1:5] for r in dicts(anomalies.returns_and_cancellations(empty))]
    assert rows == [(0, 0, None, None)] * 4


def test_reconciliation(fact):
    assert only(reconciliation.financial_reconciliation(fact)) == {
        "gross_normal_sales": 310.0,
        "cancellations_non_dup": -10.0,
        "bad_debt_adjustments": -50.0,
        "other_neg_qty": 0.0,
        "duplicate_revenue_excluded": 40.0,
        "net_revenue_non_duplicate": 250.0,
        "total_table_revenue": 290.0,
        "component_sum": 250.0,
        "discrepancy": 0.0,
    }


def test_overlapping_components_show_as_a_discrepancy(spark):
    fact = fact_frame(spark, [line("1"), line("2", quantity=-2, price=-5.0)])
    row = only(reconciliation.financial_reconciliation(fact))
    assert (row["bad_debt_adjustments"], row["other_neg_qty"]) == (10.0, 10.0)
    assert (row["component_sum"], row["net_revenue_non_duplicate"], row["discrepancy"]) == (21.0, 11.0, 10.0)


def test_reconciliation_of_nothing(empty):
    assert set(only(reconciliation.financial_reconciliation(empty)).values()) == {0.0}


def test_load_audit(fact):
    row = only(reconciliation.load_audit(fact))
    assert {name: row[name] for name in list(row)[:9]} == {
        "total_rows": 9, "missing_customers": 2, "missing_descriptions": 1, "duplicates": 1, "cancellations": 1,
        "normal_sales": 6, "neg_quantities": 1, "zero_prices": 0, "neg_prices": 1,
    }
    assert row["discrepancy"] == 0.0


def test_categories_and_flags(fact, empty):
    categories = [(r["transaction_category"], r["n"], r["pct"]) for r in dicts(reconciliation.category_breakdown(fact))]
    assert categories == [
        ("NORMAL_SALE", 6, 66.67), ("CANCELLED_INVOICE", 1, 11.11), ("DUPLICATE", 1, 11.11),
        ("NEGATIVE_PRICE_ADJUSTMENT", 1, 11.11),
    ]
    flags = {r["flag"]: (r["count"], r["percentage"]) for r in dicts(reconciliation.audit_flags(fact))}
    assert flags["is_normal_sale"] == (6, 66.67) and flags["is_zero_price"] == (0, 0.0) and len(flags) == 9
    assert {(r["count"], r["percentage"]) for r in dicts(reconciliation.audit_flags(empty))} == {(0, 0.0)}


def test_kpis(fact):
    row = only(sales.filtered_kpis(fact, ReportFilter(country="France")))
    assert (row["sales_invoices"], row["identified_customers"], row["gross_sales_revenue"]) == (2, 1, 90.0)
    assert row["gross_aov"] == 45.0
    everything = only(sales.filtered_kpis(fact, ReportFilter(country="All", search_query="  ")))
    assert everything["net_revenue"] == 250.0 and everything["total_invoices"] == 8


def test_kpis_without_matches_are_zero(fact):
    row = only(sales.filtered_kpis(fact, ReportFilter(start_date="2030-01-01")))
    assert set(row.values()) == {0}
    assert only(sales.net_units(sales.filtered_kpis(fact)))["net_units"] == 60


def test_kpis_agree_with_reconciliation(fact):
    kpis, balance = only(sales.filtered_kpis(fact)), only(reconciliation.financial_reconciliation(fact))
    assert kpis["net_revenue"] == balance["net_revenue_non_duplicate"] == balance["component_sum"]


def test_filter_options(fact, empty):
    assert only(sales.date_bounds(fact)) == {"min_date": "2011-01-05", "max_date": "2011-03-10"}
    assert only(sales.date_bounds(empty)) == {"min_date": "2010-12-01", "max_date": "2011-12-09"}
    assert [r["country"] for r in dicts(sales.country_options(fact))] == ["France", "Germany", "United Kingdom"]


def test_business_report_is_written_by_section(spark, fact, tmp_path):
    for _ in range(2):
        reports.write_business_report(fact, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == set(reports.business_report(fact))
    assert spark.read.parquet(str(tmp_path / "overview")).first().net_revenue == 250.0


def test_rankings_can_be_turned_round(fact):
    rows = dicts(ascending(countries.market_share(fact), "net_revenue"))
    assert [r["country"] for r in rows] == ["Germany", "France", "United Kingdom"]

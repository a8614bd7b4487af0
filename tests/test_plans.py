"""The shape of the physical plans: what reaches the scan, what is shuffled."""

import re

import pytest
from samples import NINE_LINES, raw_frame

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.operators.cleaning import transform_retail
from tillroll.plans import anomalies, countries, customers, products, publish, reconciliation, sales
from tillroll.schema import RAW_COLUMNS, RAW_TO_FACT

FOLDER = "/root/testdata/sf0.001"
EAGER = ("publish_roundtrip", "append_roundtrip", "append_duplicates", "search_published", "quarantine_roundtrip", "written_report", "user_sql", "load_job")
LAZY = [name for name in entry.retail_queries() if name not in EAGER]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    table = str(tmp_path_factory.mktemp("plans") / "fact")
    publish.load_transformed(transform_retail(raw_frame(spark, NINE_LINES)), table)
    return publish.read_fact(spark, table)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    for operator in ["Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate", "Expand"]:
        assert operator not in plan, operator


@pytest.mark.parametrize(
    "report, exchanges",
    [
        (sales.sales_overview, 2),
        (sales.filtered_kpis, 3),
        (anomalies.returns_and_cancellations, 2),
        (customers.customer_analysis, 3),
        (customers.customer_summary, 3),
        (reconciliation.financial_reconciliation, 1),
        (reconciliation.load_audit, 1),
        (reconciliation.audit_flags, 1),
    ],
)
def test_one_scan_and_few_shuffles(fact, report, exchanges):
    plan = plan_of(report(fact))
    assert plan.count("FileScan") == 1
    assert len(re.findall(r"(?<!Reused)Exchange ", plan)) == exchanges


@pytest.mark.parametrize(
    "report", [sales.sales_overview, sales.monthly_sales, sales.daily_sales, sales.filtered_kpis, countries.country_analysis]
)
def test_sums_are_combined_before_the_shuffle_without_sorting_text(fact, report):
    plan = plan_of(report(fact))
    assert "partial_sum" in plan and "SortAggregate" not in plan


def test_reports_read_their_columns_only(fact):
    schema = plan_of(reconciliation.category_breakdown(fact)).split("ReadSchema: ")[1]
    assert schema.startswith("struct<transaction_category:string>")


def test_ranked_products_are_joined_to_the_lines_by_broadcast(fact):
    plan = plan_of(products.top_products(fact))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("FileScan") == 2


@pytest.mark.parametrize("name", ["products_display", "top_products_quantity", "top_products_revenue"])
def test_lines_are_derived_once_for_ranking_and_names(spark, name):
    frame = entry.retail_queries()[name](spark, FOLDER)
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \S*\[l_orderkey", final)) == 1 and "ReusedExchange" in final


def test_cleaning_shuffles_once(spark):
    frame = transform_retail(raw_frame(spark, NINE_LINES))
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    assert len(re.findall(r"(?<!Reused)Exchange ", final)) == 1
    assert "Window" not in final


def test_inline_filters_reach_the_source(spark):
    plan = plan_of(entry.queries()["filtered_kpis"](spark, FOLDER)).split("== Initial Plan ==")[0]
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if "o_orderdate" in p]
    assert pushed and all("GreaterThanOrEqual(o_orderdate" in p for p in pushed)


def test_guests_are_left_out_before_customers_are_grouped(fact):
    assert "IsNotNull(customer_id)" in plan_of(customers.customer_analysis(fact))


def test_quantiles_count_their_values_once(spark):
    frame = entry.retail_queries()["profile_numeric"](spark, "/root/testdata/sf0.001")
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \S*\[l_orderkey", final)
    assert len(scans) <= 2 and final.count("ReusedExchange") >= 2


@pytest.mark.parametrize("name", ["untidy_lines", "untidy_not_null_violations", "validation_summary"])
def test_what_reads_text_is_compiled(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().debug().codegenToSeq()
        # The JVM only interprets methods of more bytes.
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_texts_are_shuffled_by_their_own_join_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry.retail_lines(spark, FOLDER)).split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for key in ("l_suppkey", "l_partkey"):
        (at,) = [i for i, operator in enumerate(plan) if f"Exchange hashpartitioning({key}#" in operator]
        assert "p_name" not in plan[at + 1] and "n_name" not in plan[at + 1]


def test_line_items_meet_their_orders_last_and_move_narrow(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry.retail_lines(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # From the top: nations, then orders, then parts.
    at = [plan.index(f"Exchange hashpartitioning({key}#") for key in ("nation", "l_orderkey", "l_partkey", "l_suppkey")]
    assert at == sorted(at)
    moved = plan[at[1]:at[2]].split("Project [")[1].split("]")[0]
    assert "returned" in moved and "l_returnflag" not in moved and "l_suppkey" not in moved


def test_earlier_copies_cost_no_further_exchange(spark, fact):
    names = {name: raw for raw, name in RAW_TO_FACT.items() if raw in RAW_COLUMNS}
    earlier = fact.withColumnsRenamed(names).select(*RAW_COLUMNS, F.lit(1).cast("bigint").alias("earlier"))
    marked = transform_retail(raw_frame(spark, NINE_LINES), earlier=earlier)
    assert plan_of(marked).count("Exchange ") == 1 and "Join" not in plan_of(marked)
    assert {(r.occurrence, r.is_duplicate) for r in marked.collect()} == {(2, True), (3, True)}

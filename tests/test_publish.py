import json
from pathlib import Path

import pytest
from samples import LOADED, TEXT_SCHEMA, line, only, raw_frame

from pyspark.sql import functions as F

from tillroll.errors import ConcurrentLoadError, DataQualityError, FactNotPublishedError
from tillroll.operators.cleaning import classify_transactions, to_fact, transform_retail
from tillroll.operators.filters import ReportFilter
from tillroll.plans import publish, sales
from tillroll.schema import FACT_SCHEMA


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "fact")


def transformed(spark, rows=LOADED):
    return transform_retail(raw_frame(spark, rows))


def test_missing_table(spark, table):
    with pytest.raises(FactNotPublishedError, match="No published fact"):
        publish.read_fact(spark, table)


def test_roundtrip(spark, table):
    audit = publish.load_transformed(transformed(spark), table, expected_rows=5)
    assert (audit["total_rows"], audit["net_revenue_non_duplicate"], audit["discrepancy"]) == (5, -78.0, 0.0)
    fact = publish.read_fact(spark, table)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT_SCHEMA]
    assert fact.where("customer_id IS NULL").count() == 3
    assert {r.sales_month for r in fact.collect()} == {"2010-12"}


def test_refresh_replaces_and_ids_stay(spark, table):
    publish.load_transformed(transformed(spark), table)
    first = {r.line_id for r in publish.read_fact(spark, table).collect()}
    publish.load_transformed(transformed(spark), table)
    assert {r.line_id for r in publish.read_fact(spark, table).collect()} == first
    assert publish.current_version(spark, table).version == 2
    assert publish.history(spark, table).count() == 2


def test_append_adds(spark, table):
    publish.load_transformed(transformed(spark), table)
    publish.load_transformed(transformed(spark), table, full_refresh=False)
    fact = publish.read_fact(spark, table)
    assert fact.count() == fact.select("line_id").distinct().count() == 10
    assert publish.current_version(spark, table).rows == 10
    publish.load_transformed(transformed(spark), table)
    assert publish.read_fact(spark, table).count() == publish.current_version(spark, table).rows == 5


def test_lines_that_are_added_again_are_duplicates(spark, table):
    publish.load_raw(raw_frame(spark, LOADED[:3]), table)
    more = [LOADED[0], LOADED[0], LOADED[2], line("new", date="2010-12-05 10:00:00"), line("old", date="2009-01-05 10:00:00")]
    audit = publish.load_raw(raw_frame(spark, more), table, full_refresh=False)
    assert (audit["total_rows"], audit["duplicates"]) == (5, 3)
    fact = publish.read_fact(spark, table)
    marks = {(r.invoice_no, r.copies, r.marked) for r in fact.groupBy("invoice_no").agg(F.count("*").alias("copies"), F.sum("is_duplicate").alias("marked")).collect()}
    assert marks == {("536365", 3, 2), ("C536366", 1, 0), ("536367", 2, 1), ("new", 1, 0), ("old", 1, 0)}
    assert {r.transaction_category for r in fact.where("is_duplicate = 1").collect()} == {"DUPLICATE"}
    assert fact.select("line_id").distinct().count() == 8
    assert only(fact.agg(F.sum(F.expr("IF(is_duplicate = 0, line_revenue, 0)")).cast("double").alias("kept")))["kept"] == 15 - 5 + 12 + 1 + 1


@pytest.mark.parametrize("load", ["raw", "transformed"])
def test_a_third_load_goes_on_counting(spark, table, load):
    rows = [LOADED[0]] * 3 + [line(date="2011-05-01 00:00:00", quantity=None, customer=None)]
    for number in range(3):
        raw = raw_frame(spark, rows)
        load_of = publish.load_raw if load == "raw" else lambda frame, *rest: publish.load_transformed(transform_retail(frame), *rest)
        load_of(raw, table, False)
        fact = publish.read_fact(spark, table)
        assert fact.count() == 4 * (number + 1) == fact.select("line_id").distinct().count()
        assert fact.where("is_duplicate = 0").count() == 2


def test_only_the_months_of_new_lines_are_compared(spark, table):
    rows = [line(str(m), date=f"2011-{m:02d}-15 10:00:00") for m in range(1, 13)]
    publish.load_raw(raw_frame(spark, rows), table)
    segments = publish.current_version(spark, table).segments
    dates = [only(spark.sql(f"SELECT TIMESTAMP_NTZ '2011-0{m}-15 10:00:00' AS d"))["d"] for m in (3, 4)]
    found = publish.earlier_copies(spark, table, segments, *dates)
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(sales_month#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "ReadSchema: struct<line_id:string>" in plan
    assert publish.earlier_copies(spark, table, segments, None, None).count() == 0


class Interleaved:
    """Lets another load run to its end between the staging and the publishing of the next one."""

    def __init__(self, monkeypatch, other, times=1):
        check, self.left = publish.check_staged, times

        def checked(*args):
            found = check(*args)
            if self.left:
                self.left -= 1
                left, self.left = self.left, 0
                other()
                self.left = left
            return found

        monkeypatch.setattr(publish, "check_staged", checked)


@pytest.mark.parametrize("full_refresh", [True, False])
def test_two_loads_at_once_lose_nothing(spark, table, monkeypatch, full_refresh):
    publish.load_raw(raw_frame(spark, LOADED[:1]), table)
    Interleaved(monkeypatch, lambda: publish.load_raw(raw_frame(spark, LOADED[:2]), table, False))
    audit = publish.load_raw(raw_frame(spark, LOADED), table, full_refresh)
    fact, version = publish.read_fact(spark, table), publish.current_version(spark, table)
    assert publish.history(spark, table).count() == version.version == 3
    if full_refresh:
        assert fact.count() == version.rows == 5 and audit["duplicates"] == 1
    else:
        assert fact.count() == version.rows == 8 and len(version.segments) == 3
        # Lines of the other load were looked at again.
        assert fact.where("is_duplicate = 0").count() == 4 and audit["duplicates"] == 3


def test_first_loads_at_once(spark, table, monkeypatch):
    Interleaved(monkeypatch, lambda: publish.load_raw(raw_frame(spark, LOADED[:2]), table))
    publish.load_raw(raw_frame(spark, LOADED), table, False)
    assert publish.read_fact(spark, table).count() == 7 and publish.current_version(spark, table).version == 2


def test_a_load_that_is_always_late_gives_up(spark, table, monkeypatch):
    monkeypatch.setattr(publish, "ATTEMPTS", 2)
    Interleaved(monkeypatch, lambda: publish.load_raw(raw_frame(spark, LOADED[:2]), table, False), times=5)
    with pytest.raises(ConcurrentLoadError):
        publish.load_raw(raw_frame(spark, LOADED[2:]), table, False)
    assert publish.current_version(spark, table).version == 2 and publish.read_fact(spark, table).count() == 4


def test_a_version_is_created_once(spark, table):
    name = f"{table}/manifest/v1.json"
    assert publish._put_if_absent(spark, name, "one") and not publish._put_if_absent(spark, name, "two")
    assert [r.value for r in spark.read.text(name).collect()] == ["one"]
    assert len(list((Path(table) / "manifest").glob(".v1*"))) == 0


BAD = [
    line("1", date="soon"), line("2", quantity="9" * 30), line("3", price="1e13"), line("4", quantity="x"), line(None, country=" "),
    line("5", quantity="9223372036854775807", price="999999999999"), line("6", date=None, price="1e13"), line("1", date="soon"), line("7"),
]
REASONS = [
    ["Country:missing"], ["InvoiceDate:missing", "UnitPrice:beyond"], ["InvoiceDate:unreadable"], ["InvoiceDate:unreadable"],
    ["InvoiceNo:missing"], ["LineRevenue:beyond"], ["Quantity:beyond"], ["UnitPrice:beyond"],
]


def test_lines_that_cannot_be_published_are_set_apart(spark, table):
    rows = [tuple(None if x is None else str(x) for x in r) for r in BAD] + [tuple(map(str, line("8", country=None)))[:7] + (None,)]
    raw = raw_frame(spark, rows, TEXT_SCHEMA)
    audit = publish.load_raw(raw, table, expected_rows=10, quarantine_limit=8)
    apart = publish.quarantined(spark, table)
    # A country of white space is text, as it always was; a missing one is a reason.
    assert sorted(r.reasons for r in apart.collect()) == REASONS
    assert audit["total_rows"] == publish.read_fact(spark, table).count() == 2 and audit["quarantined"] == 8
    lines = [json.loads(r.raw_line) for r in apart.where("array_contains(reasons, 'Quantity:beyond')").collect()]
    assert lines[0]["Quantity"] == "9" * 30 and lines[0]["CustomerID"] is None and len(lines[0]) == 8
    version = publish.current_version(spark, table)
    assert (version.rows, version.quarantined) == (2, 8)
    publish.load_raw(raw, table, full_refresh=False, quarantine_limit=8)
    version = publish.current_version(spark, table)
    assert (version.rows, version.quarantined) == (4, 16)
    assert publish.read_fact(spark, table).where("is_duplicate = 1").count() == 2


def test_too_many_lines_to_set_apart_publish_nothing(spark, table):
    raw = raw_frame(spark, [line(date="soon"), line(date="later"), line()])
    with pytest.raises(DataQualityError, match="2 lines can't be published where 1 are allowed"):
        publish.load_raw(raw, table, quarantine_limit=1)
    with pytest.raises(DataQualityError, match="Required columns hold nulls"):
        publish.load_raw(raw, table)
    with pytest.raises(FactNotPublishedError):
        publish.read_fact(spark, table)


def test_all_lines_set_apart(spark, table):
    audit = publish.load_raw(raw_frame(spark, [line(date="soon")]), table, quarantine_limit=1)
    assert audit["total_rows"] == publish.read_fact(spark, table).count() == 0 and publish.quarantined(spark, table).count() == 1


@pytest.mark.parametrize("search", ["LANT", "lantern", "851_3a", "%", "nothing", " ", None])
def test_a_search_in_the_dictionary_finds_what_a_search_in_the_lines_does(spark, table, search):
    publish.load_raw(raw_frame(spark, LOADED), table)
    publish.load_raw(raw_frame(spark, [line("x", description=None), line("y", description="Lantern, red")]), table, full_refresh=False)
    where = ReportFilter("2010-12-01", "2011-12-31", search_query=search)
    found, fact = publish.search_fact(spark, table, where), publish.read_fact(spark, table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The lines, which are scanned first, aren't searched.
    assert "lower(" not in plan.split("FileScan")[0] and plan.count("invoice_no#") and plan.count("FileScan") <= 2
    assert found.columns == fact.columns
    assert sorted(r.line_id for r in found.collect()) == sorted(r.line_id for r in fact.where(where.predicate()).collect())


@pytest.mark.parametrize("load", ["raw", "function", "transformed"])
def test_a_search_finds_copies_whose_pair_stands_with_another_segment(spark, table, load):
    def add(rows):
        frame = raw_frame(spark, rows)
        if load == "raw":
            publish.load_raw(frame, table, False)
        elif load == "function":
            publish.load_transformed(lambda earlier: transform_retail(frame, earlier=earlier), table, False)
        else:
            publish.load_transformed(transform_retail(frame), table, False)

    new = [line("x", stock="9", description="Lantern, red")] * 2
    add([*LOADED, LOADED[0]])
    add([*LOADED, *new])
    fact = publish.read_fact(spark, table)
    first, second = [spark.read.parquet(publish._products_path(table, x)) for x in publish.current_version(spark, table).segments]
    known = {tuple(r) for r in fact.select("stock_code", "description").distinct().collect()}
    # Lines that are transformed already may be called duplicates without a copy anywhere.
    assert {tuple(r) for r in second.collect()} == (known if load == "transformed" else {("9", "Lantern, red")})
    assert {tuple(r) for r in first.unionAll(second).collect()} == known
    for search in ("lantern", LOADED[0][2], "9"):
        where = ReportFilter("2010-12-01", "2011-12-31", search_query=search)
        found = publish.search_fact(spark, table, where)
        assert sorted(r.line_id for r in found.collect()) == sorted(r.line_id for r in fact.where(where.predicate()).collect()) != []


def test_duplicates_without_a_copy_are_found_by_a_search(spark, table):
    publish.load_transformed(classify_transactions(transformed(spark).withColumn("is_duplicate", F.lit(True))), table)
    assert publish.search_fact(spark, table, ReportFilter("2010-12-01", "2011-12-31", search_query=LOADED[0][2])).count() > 0


def test_old_segments_go(spark, table):
    for _ in range(3):
        publish.load_raw(raw_frame(spark, LOADED), table)
    publish.load_raw(raw_frame(spark, LOADED), table, full_refresh=False)
    segments = {tuple(r.segments) for r in publish.history(spark, table).where("version < 3").collect()}
    assert publish.remove_unreferenced(spark, table, 2) == []
    assert publish.remove_unreferenced(spark, table, 2, 0) == sorted(x for s in segments for x in s)
    assert publish.read_fact(spark, table).count() == publish.current_version(spark, table).rows == 10
    assert publish.remove_unreferenced(spark, table, 1, 0) == []
    assert {p.name for p in (Path(table) / "products").iterdir()} == {p.name for p in (Path(table) / "segments").iterdir()}
    with pytest.raises(ValueError):
        publish.remove_unreferenced(spark, table, 0)


def test_append_to_nothing_is_a_first_load(spark, table):
    publish.load_transformed(transformed(spark), table, full_refresh=False)
    assert publish.read_fact(spark, table).count() == 5


@pytest.mark.parametrize("full_refresh", [True, False])
def test_failed_load_publishes_nothing(spark, table, full_refresh):
    publish.load_transformed(transformed(spark), table)
    bad = transformed(spark).withColumn("InvoiceNo", F.lit(None).cast("string"))
    with pytest.raises(DataQualityError, match="Required columns hold nulls"):
        publish.load_transformed(bad, table, full_refresh)
    assert publish.read_fact(spark, table).count() == 5
    assert publish.current_version(spark, table).version == 1


def test_unreadable_date_is_not_published(spark, table):
    with pytest.raises(DataQualityError, match="invoice_date"):
        publish.load_transformed(transformed(spark, [line(date="soon")]), table)
    with pytest.raises(FactNotPublishedError):
        publish.read_fact(spark, table)


def test_date_filter_reads_its_months_only(spark, table):
    rows = [line(str(m), date=f"2011-{m:02d}-15 10:00:00") for m in range(1, 13)]
    publish.load_transformed(transformed(spark, rows), table)
    fact = publish.read_fact(spark, table)
    where = ReportFilter("2011-03-10", "2011-04-20", country="United Kingdom")
    plan = fact.where(where.predicate())._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "sales_month" in partition_filters
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "invoice_date" in pushed and "country" in pushed
    assert len(fact.where(where.predicate()).inputFiles()) <= 12
    assert only(sales.filtered_kpis(fact, where))["total_rows"] == 2


def test_what_can_be_derived_again_is_not_shuffled(spark):
    lines = transformed(spark).withColumn("is_cancelled", F.col("is_cancelled") | F.col("InvoiceNo").startswith("A"))
    moved = publish._without_derived(lines)
    given = [name for name in moved.columns if name.startswith("given_")]
    assert len(given) == 9 and moved.columns == [f"given_{name}" if f"given_{name}" in given else name for name in lines.columns] + ["as_derived"]
    for row in moved.collect():
        assert row.as_derived != row.InvoiceNo.startswith("A") and {row[name] is None for name in given} == {row.as_derived}


def test_derived_columns_that_are_otherwise_are_published_as_given(spark, table):
    one = F.col("InvoiceNo") == "536365"
    lines = transformed(spark).withColumns(
        {
            "LineRevenue": F.when(one, F.lit(15.005)).otherwise(F.col("LineRevenue")).cast("decimal(30,6)"),
            "transaction_category": F.when(one, "SAMPLE").otherwise(F.col("transaction_category")),
            "is_missing_customer": one | F.col("is_missing_customer"),
        }
    )
    wanted = {tuple(r) for r in to_fact(lines).drop("loaded_at").collect()}
    publish.load_transformed(lines, table)
    assert {tuple(r) for r in publish.read_fact(spark, table).drop("loaded_at").collect()} == wanted
    kinds = {r.transaction_category: r.revenue for r in publish.read_fact(spark, table).groupBy("transaction_category").agg(F.sum("line_revenue").cast("double").alias("revenue")).collect()}
    assert kinds["SAMPLE"] == 15.005 and kinds["DUPLICATE"] == 12 and "OTHER" not in kinds
    # A null where a flag could be derived stays one, and is refused; so is a revenue that is off.
    with pytest.raises(DataQualityError, match="is_zero_price"):
        publish.load_transformed(lines.withColumn("is_zero_price", F.when(~one, F.col("is_zero_price"))), table)
    with pytest.raises(DataQualityError, match="1 staged lines have a revenue"):
        publish.load_transformed(lines.withColumn("LineRevenue", F.col("LineRevenue") + one.cast("int")).withColumn("LineRevenue", F.col("LineRevenue").cast("decimal(30,6)")), table)


def test_lines_without_derived_columns_or_of_other_types_are_published_as_before(spark, table):
    lines = transformed(spark).withColumn("is_cancelled", F.col("is_cancelled").cast("int")).drop("transaction_category", "is_zero_price")
    publish.load_transformed(lines, table)
    fact = publish.read_fact(spark, table)
    assert {tuple(r) for r in fact.drop("loaded_at").collect()} == {tuple(r) for r in to_fact(lines).drop("loaded_at").collect()}
    assert {(r.transaction_category, r.is_zero_price) for r in fact.collect()} == {("UNKNOWN", 0)}


@pytest.mark.parametrize("quarantine_limit", [None, 0])
def test_lines_of_a_file_are_sorted_by_time_and_invoice(spark, table, quarantine_limit):
    rows = [line(str(n % 40), stock=str(n), date=f"2011-05-{1 + n * 7 % 20:02d} 10:00:00") for n in range(200)]
    publish.load_raw(raw_frame(spark, rows), table, quarantine_limit=quarantine_limit)
    files = publish.read_fact(spark, table).inputFiles()
    assert files
    for file in files:
        found = [(r.invoice_date, r.invoice_no) for r in spark.read.parquet(file).collect()]
        assert found == sorted(found)


def test_lines_by_time_are_written_where_they_are(spark, table, monkeypatch):
    stage, plans = publish._stage, []

    def staged(fact, table):
        plans.append(fact._jdf.queryExecution().executedPlan().toString())
        return stage(fact, table)

    monkeypatch.setattr(publish, "_stage", staged)
    frame = raw_frame(spark, [*LOADED, *LOADED[:2], line("may", date="2011-05-01 10:00:00")])
    wanted = {tuple(r) for r in to_fact(transform_retail(frame)).drop("loaded_at").collect()}
    publish.load_transformed(transform_retail(frame, by_time=True), table, by_time=True)
    assert {tuple(r) for r in publish.read_fact(spark, table).drop("loaded_at").collect()} == wanted
    # Lines that are added meet the earlier ones, and are gathered after that.
    publish.load_transformed(transform_retail(frame, by_time=True), table, False, by_time=True)
    fact = publish.read_fact(spark, table)
    assert fact.count() == fact.select("line_id").distinct().count() == 16 and fact.where("is_duplicate = 0").count() == 5
    assert [plan.count("REBALANCE") for plan in plans] == [0, 1] and plans[0].count("Exchange") == 1


@pytest.mark.parametrize("load", ["raw", "transformed"])
def test_added_lines_meet_each_other_and_earlier_ones_at_once(spark, table, monkeypatch, load):
    stage, plans = publish._stage, []

    def staged(fact, table):
        plans.append(fact._jdf.queryExecution().executedPlan().toString())
        return stage(fact, table)

    def add(rows):
        frame = raw_frame(spark, rows)
        if load == "raw":
            return publish.load_raw(frame, table, False, by_time=True)
        return publish.load_transformed(lambda earlier: transform_retail(frame, earlier=earlier, by_time=True), table, False, by_time=True)

    monkeypatch.setattr(publish, "_stage", staged)
    first, second = [*LOADED, LOADED[0]], [*LOADED[:3], line("may", date="2011-05-01 10:00:00"), line("may", date="2011-05-01 10:00:00")]
    assert add(first)["duplicates"] == 2 and add(second)["duplicates"] == 4 and add(second)["duplicates"] == 5
    assert [plan.count("REBALANCE") for plan in plans] == [0, 0, 0] and [plan.count("Exchange") for plan in plans] == [1, 1, 1]
    fact = publish.read_fact(spark, table)
    assert fact.count() == fact.select("line_id").distinct().count() == 16
    other = f"{table}-other"
    for rows in (first, second, second):
        publish.load_raw(raw_frame(spark, rows), other, False)
    assert sorted(map(tuple, fact.drop("loaded_at").collect())) == sorted(map(tuple, publish.read_fact(spark, other).drop("loaded_at").collect()))


def test_a_function_is_asked_again_if_another_load_comes_first(spark, table, monkeypatch):
    publish.load_raw(raw_frame(spark, LOADED[:1]), table)
    Interleaved(monkeypatch, lambda: publish.load_raw(raw_frame(spark, LOADED[:2]), table, False))
    publish.load_transformed(lambda earlier: transform_retail(raw_frame(spark, LOADED), earlier=earlier, by_time=True), table, False, by_time=True)
    fact = publish.read_fact(spark, table)
    assert fact.count() == fact.select("line_id").distinct().count() == 8 and fact.where("is_duplicate = 0").count() == 4


@pytest.mark.parametrize("name", ["append_roundtrip", "append_duplicates"])
def test_lines_that_are_loaded_twice_are_derived_once(spark, monkeypatch, name):
    import __spark_entry__ as entry

    stage, derive, plans, derived = publish._stage, entry.retail_lines, [], []

    def staged(fact, table):
        plans.append(fact._jdf.queryExecution().executedPlan().toString())
        return stage(fact, table)

    monkeypatch.setattr(publish, "_stage", staged)
    monkeypatch.setattr(entry, "retail_lines", lambda *args: derived.append(args) or derive(*args))
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(derived) == 1 and [plan.count("Exchange") for plan in plans] == [1, 1]


@pytest.mark.parametrize("name", ["user_sql", "publish_roundtrip", "append_roundtrip"])
def test_a_first_load_moves_whole_lines_once(spark, monkeypatch, name):
    import __spark_entry__ as entry

    stage, plans = publish._stage, []

    def staged(fact, table):
        plans.append(fact._jdf.queryExecution().executedPlan().toString())
        return stage(fact, table)

    monkeypatch.setattr(publish, "_stage", staged)
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    # Exchanges after the line items, stripped and typed, have become lines.
    whole = plans[0].split("Generate explode(CASE WHEN")[0]
    assert whole.count("Exchange") == 1


def test_users_sql_runs_over_the_published_fact(spark, table):
    publish.load_transformed(transformed(spark), table)
    count = "SELECT COUNT(*) AS n FROM retail_transactions WHERE is_normal_sale = 1 AND country = "
    assert only(publish.execute_query(spark, table, count + ":country", {"country": "France"})) == {"n": 1}
    assert only(publish.execute_query(spark, table, count + "?", ["Spain"])) == {"n": 0}
    assert not spark.catalog.tableExists("retail_transactions")


def test_a_view_of_the_user_is_left_to_them(spark, table):
    publish.load_transformed(transformed(spark), table)
    spark.range(3).createOrReplaceTempView("retail_transactions")
    try:
        assert only(publish.execute_query(spark, table, "SELECT COUNT(*) AS n FROM retail_transactions")) == {"n": 5}
        assert spark.table("retail_transactions").columns == ["id"]
    finally:
        spark.catalog.dropTempView("retail_transactions")


def test_segments_are_compressed(spark, table):
    publish.load_raw(raw_frame(spark, LOADED), table)
    files = list(Path(table).rglob("*.parquet"))
    assert files and all(".zstd." in file.name for file in files if file.is_file())


def test_given_dates_spare_looking_for_them(spark, table):
    days = [only(spark.sql(f"SELECT TIMESTAMP_NTZ '2010-12-{d} 00:00:00' AS d"))["d"] for d in ("01", "31")]
    publish.load_transformed(transformed(spark), table)
    publish.load_transformed(transformed(spark), table, full_refresh=False, dates=tuple(days))
    assert publish.read_fact(spark, table).where("is_duplicate = 0").count() == 4

from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from samples import EDGE_CASES, NINE_LINES, TEXT_SCHEMA, dicts, fact_frame, line, only, raw_frame

from pyspark.sql import functions as F

from tillroll.errors import MissingColumnsError
from tillroll.functions.parsing import BEYOND, UNREADABLE, with_values
from tillroll.operators.cleaning import (
    calculate_line_revenue,
    classify_transactions,
    clean_text_fields,
    convert_data_types,
    standardize_columns,
    to_fact,
    transform_retail,
)
from tillroll.operators.duplicates import detect_duplicates
from tillroll.schema import FACT_SCHEMA, RAW_COLUMNS


def cleaned(spark, rows, schema=TEXT_SCHEMA):
    return convert_data_types(clean_text_fields(standardize_columns(raw_frame(spark, rows, schema))))


def text_line(**given):
    values = dict(zip(RAW_COLUMNS, ["1", "S", "thing", "1", "2011-01-01 00:00:00", "1.0", None, "UK"]))
    return tuple({**values, **given}.values())


def test_headers_are_stripped_and_matched_by_name(spark):
    frame = raw_frame(spark, EDGE_CASES).withColumnRenamed("InvoiceNo", " InvoiceNo ")
    shuffled = frame.select(*reversed(frame.columns)).withColumn("Extra", F.lit(1))
    assert standardize_columns(shuffled).columns == RAW_COLUMNS


def test_missing_columns_are_named(spark):
    with pytest.raises(MissingColumnsError, match=r"Missing required columns.*UnitPrice"):
        standardize_columns(raw_frame(spark, EDGE_CASES).drop("UnitPrice"))


def test_text_is_stripped_and_case_kept(spark):
    rows = clean_text_fields(raw_frame(spark, EDGE_CASES)).collect()
    assert (rows[0].StockCode, rows[2].StockCode, rows[0].Country) == ("85123A", "22423", "United Kingdom")
    assert (rows[2].Description, rows[2].is_missing_description) == ("UNSPECIFIED", True)
    assert rows[0].is_missing_description is False


@pytest.mark.parametrize("space", ["\t", "\r\n", " ", " ", "　", " ", "\x85"])
def test_every_white_space_is_stripped_at_both_ends(spark, space):
    row = cleaned(spark, [text_line(StockCode=f"{space}a b{space}", Country=f"É{space}")]).first()
    assert (row.StockCode, row.Country) == ("a b", "É")


def test_blank_description_is_flagged_but_not_renamed(spark):
    rows = cleaned(spark, [text_line(Description=d) for d in [None, "  ", "", "UNSPECIFIED"]]).collect()
    assert [(r.Description, r.is_missing_description) for r in rows] == [
        ("UNSPECIFIED", True),
        ("", True),
        ("", True),
        ("UNSPECIFIED", False),
    ]


@pytest.mark.parametrize(
    "text, number",
    [("6", 6), (" -7 ", -7), ("1.7", 1), ("-1.7", -1), ("1e3", 1000), ("x", 0), ("", 0), (None, 0), ("1d", 0),
     ("NaN", 0), ("Infinity", 0), ("9007199254740993", 9007199254740993), ("1e19", None)],
)
def test_quantity(spark, text, number):
    assert cleaned(spark, [text_line(Quantity=text)]).first().Quantity == number


@pytest.mark.parametrize(
    "text, price",
    [("2.55", "2.55"), ("-11062.06", "-11062.06"), ("0.12345", "0.12345"), ("x", "0"), (None, "0"),
     ("123456789.0", "123456789"), ("0.00001", "0.00001"), ("0.0000", "0"), ("1e12", None), ("0.0000001", None)],
)
def test_price(spark, text, price):
    assert cleaned(spark, [text_line(UnitPrice=text)]).first().UnitPrice == (price and Decimal(price))


@pytest.mark.parametrize("text, customer", [("17850.0", 17850), ("17850", 17850), ("abc", None), (None, None)])
def test_customer(spark, text, customer):
    assert cleaned(spark, [text_line(CustomerID=text)]).first().CustomerID == customer


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2010-12-01 08:26:00", datetime(2010, 12, 1, 8, 26)),
        ("2010-12-01T08:26:00", datetime(2010, 12, 1, 8, 26)),
        ("2010-12-01", datetime(2010, 12, 1)),
        ("12/1/2010 8:26", datetime(2010, 12, 1, 8, 26)),
        ("2011/01/05", datetime(2011, 1, 5)),
        ("2011/1/5 9:05:07", datetime(2011, 1, 5, 9, 5, 7)),
        ("5-Jan-2011", datetime(2011, 1, 5)),
        ("05 September 2011 08:26", datetime(2011, 9, 5, 8, 26)),
        ("5-Foo-2011", None),
        ("31-Feb-2011", None),
        ("2010-13-01", None),
        ("soon", None),
        (None, None),
    ],
)
def test_date(spark, text, moment):
    assert cleaned(spark, [text_line(InvoiceDate=text)]).first().InvoiceDate == moment


def test_typed_columns_are_kept(spark):
    typed = raw_frame(spark, EDGE_CASES).withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))
    row = convert_data_types(clean_text_fields(typed)).first()
    assert (row.Quantity, row.UnitPrice, row.CustomerID) == (6, Decimal("2.55"), 17850)
    assert row.InvoiceDate == datetime(2010, 12, 1, 8, 26)


def test_line_revenue(spark):
    frame = spark.createDataFrame([(10, 2.5), (-2, 15.0), (5, 0.0), (0, 4.0)], "Quantity BIGINT, UnitPrice DOUBLE")
    frame = frame.withColumn("UnitPrice", F.col("UnitPrice").cast("decimal(12,4)"))
    assert [r.LineRevenue for r in calculate_line_revenue(frame).collect()] == [25, -30, 0, 0]


def test_flags_and_categories(spark):
    rows = {(r.InvoiceNo, r.is_duplicate): r for r in transform_retail(raw_frame(spark, EDGE_CASES)).collect()}
    assert len(rows) == 7
    assert rows["536365", False].transaction_category == "NORMAL_SALE"
    cancelled = rows["C536379", False]
    assert cancelled.is_cancelled and cancelled.is_negative_quantity and not cancelled.is_normal_sale
    assert cancelled.transaction_category == "CANCELLED_INVOICE"
    guest = rows["536380", False]
    assert guest.is_missing_customer and guest.is_normal_sale
    copy = rows["536381", True]
    assert not copy.is_normal_sale and copy.transaction_category == "DUPLICATE"
    assert rows["536382", False].transaction_category == "NEGATIVE_PRICE_ADJUSTMENT"
    empty = rows["536383", False]
    assert empty.is_zero_price and empty.is_zero_quantity and empty.transaction_category == "ZERO_PRICE_ITEM"


def test_every_category_can_be_reached(spark):
    rows = [
        line("1"), line("1"), line("C2"), line("3", price=-1.0), line("4", price=0.0),
        line("5", quantity=-1), line("6", quantity=0), line("c7"),
    ]
    found = Counter(r.transaction_category for r in transform_retail(raw_frame(spark, rows)).collect())
    assert found == {
        "NORMAL_SALE": 2, "DUPLICATE": 1, "CANCELLED_INVOICE": 1, "NEGATIVE_PRICE_ADJUSTMENT": 1,
        "ZERO_PRICE_ITEM": 1, "NEGATIVE_QUANTITY_OTHER": 1, "ZERO_QUANTITY": 1,
    }


def test_classify_without_duplicate_flag(spark):
    frame = convert_data_types(clean_text_fields(raw_frame(spark, EDGE_CASES)))
    assert classify_transactions(frame).where("transaction_category = 'DUPLICATE'").count() == 0


def test_duplicates_compare_cleaned_values_and_nulls(spark):
    rows = [line("1 ", customer=None), line("1", customer=None), line("1", customer=5.0), line("1", country=" x"),
            line("1", country="x")]
    found = transform_retail(raw_frame(spark, rows))
    assert found.count() == 5
    assert found.where("is_duplicate").count() == 2


def test_given_description_comes_before_a_missing_one(spark):
    rows = [line(description=None), line(description="UNSPECIFIED"), line(description=None)]
    found = transform_retail(raw_frame(spark, rows)).select("occurrence", "is_missing_description", "is_duplicate")
    assert sorted(tuple(r) for r in found.collect()) == [(1, False, False), (2, True, True), (3, True, True)]


def test_many_copies_are_written_out_in_blocks(spark):
    copies = {"a": 1, "b": 3, "c": 4, "d": 10, "e": 9}
    rows = [line(invoice) for invoice, n in copies.items() for _ in range(n)]
    rows += [line("d", description=None)] * 2
    frame = convert_data_types(clean_text_fields(raw_frame(spark, rows)))
    found = detect_duplicates(frame, copies_per_block=3).collect()
    assert len(found) == len(rows)
    for invoice, n in copies.items():
        numbers = sorted(r.occurrence for r in found if r.InvoiceNo == invoice and r.Description == "thing")
        assert numbers == list(range(1, n + 1))
    assert sum(not r.is_duplicate for r in found) == len(copies) + 1
    assert sum(r.is_missing_description for r in found) == 2


def test_blocks_of_a_hot_line_are_spread_before_their_copies_are_written_out(spark):
    hot = spark.range(300_000).select(
        *[F.lit("hot").alias(name) for name in ("InvoiceNo", "StockCode", "Description")],
        F.lit(1).alias("Quantity"),
        F.lit("2011-01-01").alias("InvoiceDate"),
        F.lit(1.0).alias("UnitPrice"),
        F.lit(None).cast("bigint").alias("CustomerID"),
        F.lit("UK").alias("Country"),
    )
    found = transform_retail(hot, spread=lambda blocks: blocks.repartition(8))
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 300_000 and len(tasks) >= 6
    assert found.select("occurrence").distinct().count() == 300_000


@pytest.mark.parametrize("quarantine", [False, True])
def test_lines_by_time_are_marked_as_others_are(spark, quarantine):
    rows = [*EDGE_CASES, *NINE_LINES, *NINE_LINES[:4]] + [line(None, None, None, None, None, None, None, None)] * 2
    rows += [line("copies", description=None)] * 3 + [line("copies", description="UNSPECIFIED")] + [line("soon", date="soon")] * 2
    frame = raw_frame(spark, rows)
    wanted, found = [transform_retail(frame, quarantine=quarantine, by_time=by_time) for by_time in (False, True)]
    assert found.schema == wanted.schema
    assert Counter(map(str, found.collect())) == Counter(map(str, wanted.collect())) and found.count() == len(rows)


def test_lines_by_time_are_in_order_from_task_to_task_and_moved_once(spark):
    rows = [line(str(n % 7), stock=str(n), date=f"2011-{1 + n % 12:02d}-15 10:00:00") for n in range(600)]
    rows += [line("large", stock=str(n), date="2012-01-01 10:00:00") for n in range(600)] + [line("large")] * 50
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = transform_retail(raw_frame(spark, rows), by_time=True)
        placed = found.select(F.spark_partition_id().alias("task"), *RAW_COLUMNS).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tasks = sorted({r.task for r in placed})
    spans = [(min(r.InvoiceDate for r in placed if r.task == t), max(r.InvoiceDate for r in placed if r.task == t)) for t in tasks]
    assert len(placed) == len(rows) and len(tasks) >= 6
    assert all(earlier[1] <= later[0] for earlier, later in zip(spans, spans[1:]))
    # An invoice is parted, copies of a line are not.
    assert len({r.task for r in placed if r.InvoiceNo == "large" and r.InvoiceDate.year == 2012}) > 1
    assert len({r.task for r in placed if r.InvoiceNo == "large" and r.InvoiceDate.year == 2011}) == 1
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == plan.count("rangepartitioning(line") == 1


def test_a_product_beyond_its_type_is_null_and_stops_a_load(spark):
    lines = [text_line(Quantity="9" * 18, UnitPrice="9" * 11), text_line(Quantity="9" * 12, UnitPrice="99999.0")]
    rows = calculate_line_revenue(cleaned(spark, lines)).collect()
    assert [r.LineRevenue for r in rows] == [None, Decimal("9" * 12) * 99999]


def test_a_third_of_all_rows_in_one_group(spark):
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        F.lit("S").alias("StockCode"),
        F.lit("thing").alias("Description"),
        F.lit(1).alias("Quantity"),
        F.lit("2011-01-01").alias("InvoiceDate"),
        F.lit(1.0).alias("UnitPrice"),
        F.lit(None).cast("bigint").alias("CustomerID"),
        F.lit("UK").alias("Country"),
    )
    counts = transform_retail(rows).agg(
        F.count("*").alias("rows"), F.count_if("is_duplicate").alias("copies"),
        F.count_distinct("InvoiceNo", "occurrence").alias("numbered"),
    )
    assert only(counts) == {"rows": 90_000, "copies": 29_999, "numbered": 90_000}


def test_fact_schema_and_flags(spark):
    fact = fact_frame(spark, NINE_LINES)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT_SCHEMA]
    guest = fact.where("invoice_no = '536369'").first()
    assert guest.customer_id is None and guest.is_missing_customer == 1
    assert guest.sales_month == "2011-02"


def test_absent_flags_and_category_get_defaults(spark):
    bare = calculate_line_revenue(convert_data_types(clean_text_fields(raw_frame(spark, EDGE_CASES))))
    row = to_fact(bare.drop("is_missing_description")).first()
    assert (row.is_duplicate, row.is_normal_sale, row.transaction_category) == (0, 0, "UNKNOWN")


def test_line_ids_are_unique_and_do_not_depend_on_partitioning(spark):
    raw = raw_frame(spark, NINE_LINES)
    one = {r.line_id for r in to_fact(transform_retail(raw.repartition(1))).collect()}
    many = {r.line_id for r in to_fact(transform_retail(raw.repartition(5, "StockCode"))).collect()}
    assert len(one) == 9 and one == many
    other_batch = {r.line_id for r in to_fact(transform_retail(raw), batch=1).collect()}
    assert not one & other_batch


def test_empty_input(spark):
    assert dicts(fact_frame(spark, [])) == []


NUMBERS = {
    "1e2": (100, "100", None, None), "5.": (5, "5", None, None), ".5": (0, "0.5", None, None), "+7": (7, "7", None, None),
    "-3.9": (-3, "-3.9", None, None), "1d": (None, None, UNREADABLE, UNREADABLE), "0x1p3": (None, None, UNREADABLE, UNREADABLE),
    ".": (None, None, UNREADABLE, UNREADABLE), "": (None, None, None, None), " \t": (None, None, None, None),
    "1.2.3": (None, None, UNREADABLE, UNREADABLE), "NaN": (None, None, UNREADABLE, UNREADABLE), "e5": (None, None, UNREADABLE, UNREADABLE),
    "9" * 30: (None, None, BEYOND, BEYOND), "9223372036854775807": (2**63 - 1, None, None, BEYOND), "9223372036854775808": (None, None, BEYOND, BEYOND),
    "1e-9": (0, None, None, BEYOND), "0e-9": (0, "0", None, None), "1e400": (None, None, UNREADABLE, UNREADABLE), None: (None, None, None, None),
}


def test_values_and_states(spark):
    rows = [(str(i), "S", "d", t, "2011-01-01", t, t, "UK") for i, t in enumerate(NUMBERS)]
    found = {int(r.InvoiceNo): r for r in with_values(raw_frame(spark, rows, TEXT_SCHEMA)).collect()}
    for i, (text, (whole, price, whole_state, price_state)) in enumerate(NUMBERS.items()):
        row = found[i]
        # A whole number that only DOUBLE can hold is read as the nearest of its type.
        if text == "9223372036854775808":
            assert row.state_UnitPrice == BEYOND
            continue
        assert (row.value_Quantity, row.state_Quantity) == (whole, whole_state) == (row.value_CustomerID, row.state_CustomerID), text
        assert (row.value_UnitPrice, row.state_UnitPrice) == (None if price is None else Decimal(price), price_state), text


def test_dates_in_every_notation_have_no_state(spark):
    texts = ["2010-12-01 08:26:00", "12/1/2010 8:26", "2011/01/05", "5-Jan-2011", "05 January 2011 8:26", "2011-13-01", "soon", "", None]
    rows = [(str(i), "S", "d", "1", t, "1", "1", "UK") for i, t in enumerate(texts)]
    found = {int(r.InvoiceNo): r for r in with_values(raw_frame(spark, rows, TEXT_SCHEMA)).collect()}
    assert [found[i].value_InvoiceDate is not None for i in range(9)] == [True] * 5 + [False] * 4
    assert [found[i].state_InvoiceDate for i in range(9)] == [None] * 5 + [UNREADABLE] * 2 + [None] * 2


def test_texts_are_searched_once_and_conditions_stay_above_the_reading(spark):
    lines = raw_frame(spark, [tuple(None if x is None else str(x) for x in line())], TEXT_SCHEMA)
    wrong = transform_retail(lines).where(F.abs(F.col("LineRevenue") - F.col("Quantity") * F.col("UnitPrice")) > 1)
    plan = wrong._jdf.queryExecution().optimizedPlan().toString()
    # Three numbers and whole numbers among two of them; one date, and the other notations.
    assert plan.count("RLIKE") <= 9


def test_revenue_is_rounded_to_four_places(spark):
    rows = [tuple(map(str, line("1", quantity=3, price=0.00005)))[:6] + (None, "UK"), tuple(map(str, line("2", quantity=-1, price=0.00005)))[:6] + (None, "UK")]
    found = {r.InvoiceNo: str(r.LineRevenue) for r in transform_retail(raw_frame(spark, rows, TEXT_SCHEMA)).collect()}
    assert found == {"1": "0.000200", "2": "-0.000100"}

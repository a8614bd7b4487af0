import pytest
from samples import EDGE_CASES, NINE_LINES, TEXT_SCHEMA, dicts, line, only, raw_frame

from tillroll.errors import MissingColumnsError
from tillroll.plans import profile


@pytest.fixture(scope="module")
def raw(spark):
    return raw_frame(spark, NINE_LINES)


def test_size_and_columns(raw):
    assert only(profile.profile_size(raw)) == {"rows": 9, "columns": 8}
    rows = {r["column"]: r for r in dicts(profile.profile_columns(raw))}
    assert rows["CustomerID"] == {
        "column": "CustomerID", "dtype": "double", "non_null_count": 7, "null_count": 2, "null_pct": 22.22,
    }
    assert rows["Description"]["null_count"] == 1


def test_duplicates_are_of_raw_rows_in_all_columns(spark, raw):
    assert only(profile.profile_duplicates(raw)) == {"duplicate_rows": 1, "duplicate_pct": 11.11}
    padded = raw_frame(spark, [line("1"), line("1 ")])
    assert only(profile.profile_duplicates(padded))["duplicate_rows"] == 0
    assert only(profile.profile_duplicates(raw_frame(spark, []))) == {"duplicate_rows": 0, "duplicate_pct": 0.0}


def test_timespan_counts_whole_days(spark):
    raw = raw_frame(spark, [line(date="2010-12-01 08:26:00"), line(date="2011-12-09 08:00:00"), line(date="?")])
    assert only(profile.profile_temporal(raw)) == {
        "min_date": "2010-12-01 08:26:00", "max_date": "2011-12-09 08:00:00", "timespan_days": 372,
    }


def test_numeric_summary(spark):
    raw = raw_frame(spark, [line(quantity=q, price=p) for q, p in [(1, 1.5), (2, 2.5), (3, 3.5), (10, -4.0)]])
    rows = {r["statistic"]: (r["quantity"], r["unit_price"]) for r in dicts(profile.profile_numeric(raw))}
    assert rows == {
        "count": (4.0, 4.0), "mean": (4.0, 0.875), "std": (4.0825, 3.3510), "min": (1.0, -4.0),
        "25%": (1.75, 0.125), "50%": (2.5, 2.0), "75%": (4.75, 2.75), "max": (10.0, 3.5),
    }


def test_numeric_summary_of_nothing(spark):
    rows = {r["statistic"]: r["quantity"] for r in dicts(profile.profile_numeric(raw_frame(spark, [])))}
    assert len(rows) == 8 and rows["count"] == 0.0 and rows["50%"] is None


def test_anomalies(spark):
    rows = {r["anomaly"]: (r["n"], r["pct"]) for r in dicts(profile.profile_anomalies(raw_frame(spark, EDGE_CASES)))}
    assert rows == {
        "cancelled_invoices": (1, 14.29), "negative_quantity": (2, 28.57), "negative_quantity_cancelled": (1, 14.29),
        "negative_quantity_not_cancelled": (1, 14.29), "zero_price": (1, 14.29), "negative_price": (1, 14.29),
        "missing_customer": (2, 28.57),
    }


def test_unreadable_values_are_counted(spark):
    rows = [("1", "S", "d", q, d, p, c, "UK") for q, d, p, c in [
        ("1", "2011-01-01", "1", "1"), ("x", "?", "y", "z"), (None, "", None, " "), ("1e3", "1/2/2011", "123456789.0", "7.0"),
    ]]
    found = {r["column"]: r["unreadable"] for r in dicts(profile.parse_failures(raw_frame(spark, rows, TEXT_SCHEMA)))}
    assert found == {"Quantity": 1, "InvoiceDate": 1, "UnitPrice": 1, "CustomerID": 1}


def test_all_sections(raw):
    sections = profile.profile(raw.withColumnRenamed("Country", " Country "))
    assert set(sections) == {
        "size", "columns", "sample", "duplicates", "temporal", "numeric", "anomalies", "parse_failures",
    }
    assert len(dicts(sections["sample"])) == 5
    with pytest.raises(MissingColumnsError):
        profile.profile(raw.drop("Quantity"))

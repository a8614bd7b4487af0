import pytest
from samples import LOADED, dicts, raw_frame

from tillroll.errors import EtlError, SourceNotFoundError
from tillroll.plans.etl import run_etl
from tillroll.plans.publish import read_fact
from tillroll.sources.files import read_raw

CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
536365,85123A,WHITE HEART,6,2010-12-01 08:26:00,2.5,17850.0,United Kingdom
C536366,85123A,WHITE HEART,-2,2010-12-01 09:00:00,2.5,17850.0,United Kingdom
536367,71053,LANTERN,4,2010-12-01 10:00:00,3.0,,France
536367,71053,LANTERN,4,2010-12-01 10:00:00,3.0,,France
"""


@pytest.fixture
def paths(tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text(CSV)
    return str(raw), str(tmp_path / "fact"), tmp_path


def test_csv_to_fact_with_reports(spark, paths):
    raw, table, folder = paths
    result = run_etl(spark, raw, table, profile_path=str(folder / "profile"), report_path=str(folder / "report"))
    assert (result.raw_rows, result.loaded_rows) == (4, 4)
    assert set(result.steps.values()) == {"SUCCESS"} and len(result.steps) == 8
    assert read_fact(spark, table).count() == 4
    report = {(r.section, r.name): r.value for r in spark.read.parquet(str(folder / "report")).collect()}
    assert report["run", "status"] == "SUCCESS" and report["audit", "normal_sales"] == "2"
    assert spark.read.parquet(str(folder / "profile" / "size")).first().rows == 4


def test_reruns_do_not_double(spark, paths):
    raw, table, _ = paths
    for _ in range(2):
        assert run_etl(spark, raw, table).loaded_rows == 4
    assert read_fact(spark, table).count() == 4


def test_missing_file(spark, paths, tmp_path):
    _, table, _ = paths
    with pytest.raises(EtlError, match="Raw dataset not found") as stopped:
        run_etl(spark, str(tmp_path / "none.csv"), table, report_path=str(tmp_path / "report"))
    assert stopped.value.steps == {"verify_raw": "FAILED"}
    report = {r.name: r.value for r in spark.read.parquet(str(tmp_path / "report")).collect()}
    assert report["status"] == "FAILED"
    with pytest.raises(SourceNotFoundError):
        read_raw(spark, str(tmp_path / "none"))


def test_bad_file_leaves_the_table_alone(spark, paths, tmp_path):
    raw, table, _ = paths
    run_etl(spark, raw, table)
    bad = tmp_path / "bad.csv"
    bad.write_text("bad_column\n1\n2\n")
    with pytest.raises(EtlError, match="Data transformation failed: Missing required columns"):
        run_etl(spark, str(bad), table, profile_path=str(tmp_path / "profile"))
    assert read_fact(spark, table).count() == 4


def test_quality_failure_stops_before_publishing(spark, paths, tmp_path):
    raw, table, _ = paths
    run_etl(spark, raw, table)
    bad = tmp_path / "bad.csv"
    bad.write_text(CSV.replace("2010-12-01 10:00:00", "soon"))
    with pytest.raises(EtlError, match="Validation failed: Required columns hold nulls") as stopped:
        run_etl(spark, str(bad), table)
    assert stopped.value.steps["load"] == "SUCCESS" and stopped.value.steps["verify"] == "FAILED"
    assert read_fact(spark, table).count() == 4


def test_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text(
        " Country , Quantity,InvoiceNo,StockCode,Description,InvoiceDate,UnitPrice,CustomerID\n"
        'France,3,007,01,"a ""quoted"", name",12/1/2010 8:26,1.5,12\n'
    )
    row = read_raw(spark, str(path)).first().asDict()
    assert row[" Country "] == "France" and row["InvoiceNo"] == "007"
    run_etl(spark, str(path), str(tmp_path / "fact"))
    fact = read_fact(spark, str(tmp_path / "fact")).first()
    assert (fact.country, fact.quantity, fact.invoice_no, fact.stock_code) == ("France", 3, "007", "01")
    assert fact.description == 'a "quoted", name' and fact.sales_month == "2010-12"


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(CSV + '536368,1,"two\nlines",1,2010-12-01 10:00:00,1.0,,France\n')
    rows = dicts(read_raw(spark, str(path), multi_line=True))
    assert len(rows) == 5 and rows[-1]["Description"] == "two\nlines"


def test_empty_fields_are_null(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text(CSV + '536368,1,"",1,2010-12-01 10:00:00,1.0,,\n')
    row = dicts(read_raw(spark, str(path)))[-1]
    assert row["Description"] is None and row["Country"] is None


def test_parquet_source(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_frame(spark, LOADED).write.parquet(path)
    assert run_etl(spark, path, str(tmp_path / "fact")).loaded_rows == 5


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(CSV)
    (folder / "b.csv").write_text(CSV.replace("Quantity,InvoiceDate", "InvoiceDate,Quantity"))
    with pytest.raises(EtlError):
        run_etl(spark, str(folder), str(tmp_path / "fact"))


def test_profile_follows_a_changed_file(spark, paths, tmp_path):
    raw, table, _ = paths
    for lines in [CSV, CSV + CSV.splitlines()[1] + "\n"]:
        (tmp_path / "raw.csv").write_text(lines)
        run_etl(spark, raw, table, profile_path=str(tmp_path / "profile"))
    assert spark.read.parquet(str(tmp_path / "profile" / "size")).first().rows == 5


def test_line_breaks_inside_quotes_can_be_loaded(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(CSV + '536368,1,"two\nlines, ""quoted""",1,2010-12-01 10:00:00,1.0,,France\n')
    assert run_etl(spark, str(path), str(tmp_path / "fact"), multi_line=True).loaded_rows == 5
    descriptions = {r.description for r in read_fact(spark, str(tmp_path / "fact")).collect()}
    assert 'two\nlines, "quoted"' in descriptions


@pytest.mark.parametrize("line", ["536368,1,d,1,2010-12-01 10:00:00,1.0,,France,junk", "536368,1,d,1,2010-12-01 10:00:00,1.0"])
def test_lines_with_other_numbers_of_fields_are_refused(spark, tmp_path, line):
    path = tmp_path / "fields.csv"
    path.write_text(CSV + line + "\n")
    with pytest.raises(EtlError, match="extract"):
        run_etl(spark, str(path), str(tmp_path / "fact"))


def test_large_and_small_prices_are_loaded_and_what_cannot_be_held_is_refused(spark, tmp_path):
    path, table = tmp_path / "prices.csv", str(tmp_path / "fact")
    line = "536368,1,d,2,2010-12-01 10:00:00,{},,France\n"
    path.write_text(CSV + line.format("123456789.0") + line.format("0.00001") + line.format("n/a"))
    audit = run_etl(spark, str(path), table).audit
    assert (audit["normal_sales"], audit["unreadable_UnitPrice"], audit["beyond_UnitPrice"]) == (4, 1, 0)
    assert read_fact(spark, table).where("line_revenue = 246913578").count() == 1
    path.write_text(CSV + line.format("1e13"))
    with pytest.raises(EtlError, match="Required columns hold nulls: {'unit_price': 1"):
        run_etl(spark, str(path), table)
    assert read_fact(spark, table).count() == 7

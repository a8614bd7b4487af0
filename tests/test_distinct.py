import pytest

from pyspark.sql import functions as F

from tillroll.operators.distinct import distinct_counts

ROWS = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", None), ("c", None), (None, "z"), (None, "z"), (None, "w"), *[("d", str(n % 30)) for n in range(40)]]


@pytest.mark.parametrize("bits", [1, 3, 48])
def test_distinct_values_of_each_group(spark, tmp_path, bits):
    rows = spark.createDataFrame(ROWS, "part STRING, id STRING")
    found = distinct_counts(rows, "part", "id", str(tmp_path / "repeated"), bits)
    assert {r.part: r.distinct for r in found.collect()} == {"a": 2, "b": 1, "c": 0, None: 2, "d": 30}
    assert distinct_counts(rows.limit(0), "part", "id", str(tmp_path / "none"), bits).count() == 0


@pytest.mark.parametrize("bits", [8, 48])
def test_only_values_whose_print_recurs_are_compared(spark, tmp_path, bits):
    ids = spark.range(2000).select(F.lit(1).alias("part"), F.concat(F.lit("id-"), "id").alias("id"))
    found = distinct_counts(ids, "part", "id", str(tmp_path / "repeated"), bits)
    assert found.collect()[0]["distinct"] == 2000
    assert (spark.read.schema("print BIGINT").parquet(str(tmp_path / "repeated")).count() == 0) == (bits == 48)

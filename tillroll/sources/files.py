"""Readers of raw retail files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.errors import SourceNotFoundError


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw lines from ``.csv`` (with a header) or Parquet, as they are in the file.

    CSV columns are text under the names of the header, whatever their order;
    empty fields are null. Files of one dataset must agree in their headers,
    and every line must have as many fields as its header, else reading them
    fails. ``multi_line`` allows line breaks inside quotes, at the price of one
    task per file.
    """
    try:
        if not path.rstrip("/").lower().endswith((".csv", ".csv.gz")):
            return spark.read.parquet(path)
        reader = spark.read.options(
            header=True, escape='"', multiLine=multi_line, enforceSchema=False, mode="FAILFAST", columnPruning=False
        )
        lines = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFoundError(f"Raw dataset not found at: {path}") from error
        raise
    return lines.select(*[F.nullif(F.col(f"`{name}`"), F.lit("")).alias(name) for name in lines.columns])

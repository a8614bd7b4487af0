"""Profile of the raw lines, before any cleaning.

Sections that a single scan can answer are each a list of aggregates and a
function that lays out the one row they give. ``write_profile`` computes the
aggregates of all of them together, so the raw lines are read once for these.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, functions as F

from tillroll.functions import parsing
from tillroll.operators.cleaning import standardize_columns
from tillroll.operators.measures import or_zero, ratio, to_hundredths
from tillroll.operators.quantiles import exact_quantiles

ScanSection = tuple[dict[str, Column], Callable[[DataFrame], DataFrame]]

_PRICE_SCALE = 1_000_000
_NUMBERS = {"quantity": "Quantity", "unit_price": "UnitPrice"}
_QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(to_hundredths(ratio(part, whole) * 100), F.lit(0.0))


def _parsed(name: str) -> Column:
    """The readable values of a raw column; the others are null."""
    return F.col(f"value_{name}")


def _totals(raw: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    return parsing.with_values(raw).agg(*[column.alias(name) for name, column in aggregates.items()])


def _rows(totals: DataFrame, rows: list[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*rows)))


def _from_one_scan(raw: DataFrame, section: Callable[[DataFrame], ScanSection]) -> DataFrame:
    aggregates, layout = section(raw)
    return layout(_totals(raw, aggregates))


def _size(raw: DataFrame) -> ScanSection:
    def layout(totals):
        return totals.select(F.col("size_rows").alias("rows"), F.lit(len(raw.columns)).cast("bigint").alias("columns"))

    return {"size_rows": F.count(F.lit(1))}, layout


def _columns(raw: DataFrame) -> ScanSection:
    given = {field: f"given_{i}" for i, field in enumerate(raw.schema)}

    def layout(totals):
        rows = F.col("column_rows")
        return _rows(
            totals,
            [
                F.struct(
                    F.lit(field.name).alias("column"),
                    F.lit(field.dataType.simpleString()).alias("dtype"),
                    F.col(count).alias("non_null_count"),
                    (rows - F.col(count)).alias("null_count"),
                    _percent(rows - F.col(count), rows).alias("null_pct"),
                )
                for field, count in given.items()
            ],
        )

    counts = {count: F.count(F.col(f"`{field.name}`")) for field, count in given.items()}
    return {"column_rows": F.count(F.lit(1)), **counts}, layout


def _temporal(raw: DataFrame) -> ScanSection:
    def layout(totals):
        text = "yyyy-MM-dd HH:mm:ss"
        return totals.select(
            F.date_format("first_date", text).alias("min_date"),
            F.date_format("last_date", text).alias("max_date"),
            F.timestamp_diff("DAY", "first_date", "last_date").alias("timespan_days"),
        )

    moment = _parsed("InvoiceDate")
    return {"first_date": F.min(moment), "last_date": F.max(moment)}, layout


def _moments(raw: DataFrame) -> ScanSection:
    statistics = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}

    def layout(totals):
        def value(label, column):
            return F.col(f"{label}_{column}") if label in statistics else F.lit(None).cast("double")

        return _rows(
            totals,
            [
                F.struct(
                    F.lit(label).alias("statistic"), *[value(label, column).alias(column) for column in _NUMBERS]
                )
                for label in [*statistics, *_QUARTILES]
            ],
        )

    aggregates = {
        f"{label}_{column}": function(_parsed(name)).cast("double")
        for label, function in statistics.items()
        for column, name in _NUMBERS.items()
    }
    return aggregates, layout


def _anomalies(raw: DataFrame) -> ScanSection:
    cancelled = F.coalesce(F.col("InvoiceNo").cast("string").startswith("C"), F.lit(False))
    negative = F.coalesce(_parsed("Quantity") < 0, F.lit(False))
    price = _parsed("UnitPrice")
    rules = {
        "cancelled_invoices": cancelled,
        "negative_quantity": negative,
        "negative_quantity_cancelled": negative & cancelled,
        "negative_quantity_not_cancelled": negative & ~cancelled,
        "zero_price": price == 0,
        "negative_price": price < 0,
        "missing_customer": F.col("CustomerID").isNull(),
    }

    def layout(totals):
        return _rows(
            totals,
            [
                F.struct(
                    F.lit(name).alias("anomaly"),
                    F.col(name).alias("n"),
                    _percent(F.col(name), F.col("anomaly_rows")).alias("pct"),
                )
                for name in rules
            ],
        )

    return {"anomaly_rows": F.count(F.lit(1)), **{name: F.count_if(rule) for name, rule in rules.items()}}, layout


def _unreadable(raw: DataFrame) -> ScanSection:
    def layout(totals):
        return _rows(
            totals,
            [
                F.struct(F.lit(name).alias("column"), F.col(f"unreadable_{name}").alias("unreadable"))
                for name in parsing.READERS
            ],
        )

    return {
        f"unreadable_{name}": F.count(f"state_{name}")
        for name in parsing.READERS
    }, layout


def profile_size(raw: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return _from_one_scan(raw, _size)


def profile_columns(raw: DataFrame) -> DataFrame:
    """Type and null counts of every column."""
    return _from_one_scan(raw, _columns)


def profile_sample(raw: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in the order of their columns."""
    return raw.orderBy(*raw.columns).limit(rows)


def _any_rows(raw: DataFrame, rows: int = 5) -> DataFrame:
    """Some rows, whichever are read first."""
    return raw.limit(rows)


def profile_duplicates(raw: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every raw column."""
    row = F.struct(*[F.col(f"`{name}`") for name in raw.columns])
    groups = raw.groupBy(row.alias("row")).agg(F.count(F.lit(1)).alias("copies"))
    totals = groups.agg(or_zero(F.sum(F.col("copies") - 1)).alias("duplicate_rows"), F.sum("copies").alias("rows"))
    return totals.select("duplicate_rows", _percent(F.col("duplicate_rows"), F.col("rows")).alias("duplicate_pct"))


def profile_temporal(raw: DataFrame) -> DataFrame:
    """First and last invoice time, and the whole days between them."""
    return _from_one_scan(raw, _temporal)


def _with_quartiles(moments: DataFrame, raw: DataFrame) -> DataFrame:
    whole_numbers = {
        "quantity": _parsed("Quantity"),
        "unit_price": (_parsed("UnitPrice") * _PRICE_SCALE).cast("bigint"),
    }
    pairs = [F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in whole_numbers.items()]
    found = exact_quantiles(parsing.with_values(raw).select(F.inline(F.array(*pairs))), list(_QUARTILES.values()))
    label = F.coalesce(*[F.when(F.col("probability") == p, name) for name, p in _QUARTILES.items()])
    by_label = found.select(
        label.alias("statistic"),
        F.when(F.col("name") == "quantity", F.col("quantile")).alias("quantity"),
        F.when(F.col("name") == "unit_price", F.col("quantile") / _PRICE_SCALE).alias("unit_price"),
    )
    both = moments.unionByName(by_label).groupBy("statistic")
    return both.agg(*[F.round(F.max(column), 4).alias(column) for column in _NUMBERS])


def profile_numeric(raw: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of quantity and price."""
    return _with_quartiles(_from_one_scan(raw, _moments), raw)


def profile_anomalies(raw: DataFrame) -> DataFrame:
    """Counts and shares of unusual raw rows."""
    return _from_one_scan(raw, _anomalies)


def parse_failures(raw: DataFrame) -> DataFrame:
    """Values that are given but cannot be read; cleaning turns them into 0 or null."""
    return _from_one_scan(raw, _unreadable)


_SCANS = {
    "size": _size,
    "columns": _columns,
    "temporal": _temporal,
    "numeric": _moments,
    "anomalies": _anomalies,
    "parse_failures": _unreadable,
}


def _stripped(raw: DataFrame) -> DataFrame:
    standardize_columns(raw)  # raises when a required column is absent
    return raw.toDF(*[name.strip() for name in raw.columns])


def _all_totals(lines: DataFrame) -> DataFrame:
    return _totals(lines, {name: value for scan in _SCANS.values() for name, value in scan(lines)[0].items()})


def _sections(lines: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    sections = {name: scan(lines)[1](totals) for name, scan in _SCANS.items()}
    return {
        **sections,
        "numeric": _with_quartiles(sections["numeric"], lines),
        "sample": _any_rows(lines),
        "duplicates": profile_duplicates(lines),
    }


def profile(raw: DataFrame) -> dict[str, DataFrame]:
    """All sections of the profile by name, still lazy."""
    lines = _stripped(raw)
    return _sections(lines, _all_totals(lines))


def intake(raw: DataFrame) -> DataFrame:
    """One row, from one scan, of all that the sections but sample, duplicates and quartiles need, and of
    values that are numbers beyond their types."""
    lines = _stripped(raw)
    beyond = {f"beyond_{name}": F.col(f"state_{name}") == parsing.BEYOND for name in ("Quantity", "UnitPrice")}
    every = {name: value for scan in _SCANS.values() for name, value in scan(lines)[0].items()}
    return _totals(lines, every | {name: F.count_if(rule) for name, rule in beyond.items()})


def intake_audit(totals: Row) -> dict[str, int]:
    """Of intake's row: the lines, and by column the values that cannot be read or held."""
    names = [f"unreadable_{name}" for name in parsing.READERS] + ["beyond_Quantity", "beyond_UnitPrice"]
    return {"raw_rows": totals["size_rows"]} | {name: totals[name] for name in names}


def write_profile(raw: DataFrame, path: str, totals: Row | None = None) -> None:
    """Write each section as Parquet under ``path``, replacing an earlier profile.

    ``totals`` is the row of ``intake``, computed here if not given. The sample
    has any five rows.
    """
    lines = _stripped(raw)
    totals_of = intake(raw)
    row = totals_of.first() if totals is None else totals
    known = raw.sparkSession.createDataFrame([tuple(row)], totals_of.schema)
    for name, section in _sections(lines, known).items():
        section.write.mode("overwrite").parquet(f"{path}/{name}")

"""The load job: raw file to published fact, with profile, checks and a report."""

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from tillroll.errors import DataQualityError, EtlError, MissingColumnsError, SourceNotFoundError
from tillroll.operators.cleaning import standardize_columns
from tillroll.plans.profile import intake, intake_audit, write_profile
from tillroll.plans.publish import load_raw
from tillroll.plans.validation import require_columns
from tillroll.sources.files import read_raw


@dataclass
class EtlResult:
    """What a finished run did: step outcomes, row counts and the audit row."""

    raw_rows: int
    loaded_rows: int
    elapsed_seconds: float
    audit: dict
    steps: dict[str, str] = field(default_factory=dict)


def _report(spark: SparkSession, report_path: str | None, sections: dict[str, dict]) -> None:
    if report_path is not None:
        rows = [(section, name, str(value)) for section, values in sections.items() for name, value in values.items()]
        frame = spark.createDataFrame(rows, "section STRING, name STRING, value STRING")
        frame.write.mode("overwrite").parquet(report_path)


def _intake(raw: DataFrame) -> Row:
    """The totals of the raw lines; without the required columns, which transforming reports, only their number."""
    try:
        return intake(raw).first()
    except MissingColumnsError:
        return Row(size_rows=raw.count())


def run_etl(
    spark: SparkSession,
    raw_path: str,
    table: str,
    full_refresh: bool = True,
    multi_line: bool = False,
    profile_path: str | None = None,
    report_path: str | None = None,
    quarantine_limit: int | None = None,
) -> EtlResult:
    """Read, profile, clean, check and publish one raw dataset.

    The profile is optional and its failure does not stop the run. Any other
    failure raises ``EtlError``; the table then still serves its former
    version. One scan of the raw lines counts them and the values that cannot be
    read or held, which the audit names, and gives the profile its totals.
    ``multi_line`` allows line breaks inside quoted CSV fields, at the price of
    one task per file. Lines are validated where they are staged, in one scan, before the
    new version is published. ``quarantine_limit`` as in load_raw.
    """
    started = time.monotonic()
    steps: dict[str, str] = {}
    step, problem = "verify_raw", "Failed to open dataset"
    try:
        raw = read_raw(spark, raw_path, multi_line)
        steps["verify_raw"] = "SUCCESS"

        step, problem = "extract", "Failed to extract dataset"
        totals = _intake(raw)
        raw_rows = totals["size_rows"]
        steps[step] = "SUCCESS"

        if profile_path is None:
            steps["profile"] = "SKIPPED"
        else:
            try:
                write_profile(raw, profile_path, totals)
                steps["profile"] = "SUCCESS"
            except Exception as error:
                steps["profile"] = f"FAILED: {error}"

        step, problem = "transform", "Data transformation failed"
        lines = standardize_columns(raw)
        steps[step] = "SUCCESS"

        step, problem = "validate", "Validation failed"
        require_columns(lines)
        steps[step] = "SUCCESS"

        step, problem = "load", "Load failed; the former version stays published"
        try:
            dates = totals["first_date"], totals["last_date"]
            audit = load_raw(raw, table, full_refresh, raw_rows, quarantine_limit, dates)
            audit |= intake_audit(totals)
        except DataQualityError:
            steps[step], step, problem = "SUCCESS", "verify", "Validation failed"
            raise
        steps["load"] = steps["verify"] = steps["summary"] = "SUCCESS"
    except Exception as error:
        steps[step] = "FAILED"
        message = str(error) if isinstance(error, SourceNotFoundError) else f"{problem}: {error}"
        _report(spark, report_path, {"run": {"status": "FAILED", "reason": message}, "steps": steps})
        raise EtlError(message, steps) from error

    result = EtlResult(raw_rows, audit["total_rows"], round(time.monotonic() - started, 2), audit, steps)
    _report(
        spark,
        report_path,
        {
            "run": {
                "status": "SUCCESS",
                "elapsed_seconds": result.elapsed_seconds,
                "raw_rows": raw_rows,
                "loaded_rows": result.loaded_rows,
            },
            "steps": steps,
            "audit": audit,
        },
    )
    return result

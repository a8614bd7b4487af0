"""The published fact table: immutable Parquet segments and a manifest of versions.

A load writes a new segment, checks it, and only then adds a version to the
manifest. Readers take the newest version, so a load that fails or loses its
executors half-way leaves the former one as it was. Any file system that
Spark can write to will do.

Several loads may run on a table at once. A version is one file, named by its
number, that only one of them can create; a load that comes too late takes the
next number, after looking at what the other has published: lines that it adds are
marked against that again. Versions are created by a hard link on local disks and
by a rename that doesn't replace on others, which HDFS does in one step; on a
store without such a rename one load at a time may write a table.

Lines that cannot be published, if a load sets them apart, stand beside the fact
in the segment, with the reasons and the line as it was read.
"""

import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tillroll.errors import ConcurrentLoadError, DataQualityError, FactNotPublishedError
from tillroll.operators.cleaning import (
    calculate_line_revenue,
    classify_transactions,
    clean_text_fields,
    convert_data_types,
    standardize_columns,
    to_fact,
    transform_retail,
)
from tillroll.operators.duplicates import mark_earlier
from tillroll.operators.filters import ReportFilter
from tillroll.plans.validation import check_staged
from tillroll.schema import FACT_SCHEMA, FLAG_COLUMNS, RAW_COLUMNS, RAW_TO_FACT, REJECT_COLUMNS

# Fixed value: the table that users' SQL names.
_VIEW = "retail_transactions"

_MANIFEST_SCHEMA = "version BIGINT, segments ARRAY<STRING>, rows BIGINT, quarantined BIGINT, published_at TIMESTAMP"

# The two lots of a segment.
_FACT, _QUARANTINE = "fact", "quarantine"
_SEGMENT_SCHEMA = T.StructType(
    [
        *FACT_SCHEMA.fields,
        *[T.StructField(name, T.StringType()) for name in REJECT_COLUMNS],
        T.StructField("lot", T.StringType()),
        T.StructField("segment", T.StringType()),
    ]
)

# Line ids are random hex digits, which the default codec leaves as they are.
_CODEC = "zstd"

# What the transformation derives from a line's other columns.
_DERIVED = ["LineRevenue", *[flag for flag in FLAG_COLUMNS if flag not in ("is_duplicate", "is_missing_description")], "transaction_category"]

#: Times that a load tries to publish while others do.
ATTEMPTS = 10


def _segment_path(table: str, segment: str) -> str:
    return f"{table}/segments/segment={segment}"


def _products_path(table: str, segment: str) -> str:
    return f"{table}/products/segment={segment}"


def _read_lot(spark: SparkSession, table: str, segments: list[str], lot: str) -> DataFrame:
    whole = (
        spark.read.schema(_SEGMENT_SCHEMA)
        .option("basePath", f"{table}/segments")
        .parquet(*[_segment_path(table, segment) for segment in segments])
    )
    return whole.where(F.col("lot") == lot)


def _read_segments(spark: SparkSession, table: str, segments: list[str]) -> DataFrame:
    return _read_lot(spark, table, segments, _FACT).select(*FACT_SCHEMA.names)


def history(spark: SparkSession, table: str) -> DataFrame:
    """Every published version of the table."""
    try:
        return spark.read.schema(_MANIFEST_SCHEMA).json(f"{table}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FactNotPublishedError(f"No published fact at {table}. Please run the load job first.") from error
        raise


def current_version(spark: SparkSession, table: str) -> Row:
    """The newest version of the table."""
    newest = history(spark, table).where("version IS NOT NULL").orderBy(F.desc("version"), F.desc("published_at")).first()
    if newest is None:
        raise FactNotPublishedError(f"No published fact at {table}. Please run the load job first.")
    return newest


def read_fact(spark: SparkSession, table: str) -> DataFrame:
    """The published fact, partitioned by ``sales_month``."""
    return _read_segments(spark, table, current_version(spark, table).segments)


def execute_query(spark: SparkSession, table: str, query: str, params: dict | list | None = None) -> DataFrame:
    """Run a user's SQL over the published fact, which it names ``retail_transactions``.

    ``params`` fill ``:name`` markers (dict) or ``?`` markers (list). A view of
    that name which the user has made is theirs again afterwards.
    """
    try:
        former = spark.table(_VIEW) if spark.catalog.getTable(_VIEW).isTemporary else None
    except AnalysisException:
        former = None
    read_fact(spark, table).createOrReplaceTempView(_VIEW)
    try:
        return spark.sql(query, args=params)
    finally:
        if former is None:
            spark.catalog.dropTempView(_VIEW)
        else:
            former.createOrReplaceTempView(_VIEW)


def quarantined(spark: SparkSession, table: str) -> DataFrame:
    """Lines that loads of the newest version set apart: segment, reasons (an array of column:reason) and raw_line, JSON."""
    lines = _read_lot(spark, table, current_version(spark, table).segments, _QUARANTINE)
    return lines.select("segment", F.split("reasons", ",").alias("reasons"), "raw_line")


def _write_products(spark: SparkSession, table: str, segment: str, copies_known: bool) -> None:
    """Beside a segment, the distinct pairs of stock code and description that it holds.

    With ``copies_known`` a duplicate has its first copy, and so its pair, in this
    segment or in one that it is added to, which has the pair already.
    """
    lines = _read_segments(spark, table, [segment])
    pairs = (lines.where("is_duplicate = 0") if copies_known else lines).select("stock_code", "description").distinct()
    pairs.write.option("compression", _CODEC).parquet(_products_path(table, segment))


def search_fact(spark: SparkSession, table: str, where: ReportFilter) -> DataFrame:
    """The lines of the published fact that a filter lets through.

    A search text is looked for in the table's product pairs, which are as many
    as its products have names and not as many as its lines; lines are then those
    whose pair was found.
    """
    version = current_version(spark, table)
    lines = _read_segments(spark, table, version.segments).where(where.without_search().predicate())
    wanted = where.search_predicate()
    if wanted is None:
        return lines
    pairs = spark.read.schema("stock_code STRING, description STRING").parquet(*[_products_path(table, x) for x in version.segments])
    return lines.join(pairs.where(wanted).distinct(), ["stock_code", "description"], "left_semi").select(*lines.columns)


def _path(spark: SparkSession, name: str):
    """A Hadoop path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _put_if_absent(spark: SparkSession, name: str, text: str) -> bool:
    """Create a file with all of its text, unless there is one of its name; whether it was created."""
    jvm = spark.sparkContext._jvm
    target, files = _path(spark, name)
    draft = target.suffix(f".{uuid.uuid4().hex}")
    # Readers pass over names that begin with a dot.
    draft = jvm.org.apache.hadoop.fs.Path(draft.getParent(), f".{draft.getName()}")
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    local = files.getUri().getScheme() == "file"
    try:
        if local:
            places = [jvm.java.io.File(path.toUri().getPath()).toPath() for path in (target, draft)]
            jvm.java.nio.file.Files.createLink(*places)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            never = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(draft, target, never)
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        files.delete(draft, False)


def _stage(fact: DataFrame, table: str) -> str:
    """Write a new segment that nobody reads yet; rows are sorted by time so that
    date filters skip row groups, and by invoice, as its lines have much in common."""
    segment = uuid.uuid4().hex
    path, folders = _segment_path(table, segment), ["lot", "sales_month"]
    if "reasons" in fact.columns:
        fact = fact.withColumn("lot", F.when(F.col("reasons").isNull(), _FACT).otherwise(_QUARANTINE))
    else:
        # Spark leaves a constant out of an order, and would sort anew, by folder alone, if the lot were one.
        path, folders = f"{path}/lot={_FACT}", ["sales_month"]
    (
        fact.sortWithinPartitions(*folders, "invoice_date", "invoice_no")
        .write.mode("errorifexists")
        .partitionBy(*folders)
        .option("compression", _CODEC)
        .parquet(path)
    )
    return segment


def by_month(lines: DataFrame) -> DataFrame:
    """Lines, or counted ones (see detect_duplicates), gathered by month into few files; adaptive execution splits a large month."""
    month = F.year("InvoiceDate") * 12 + F.month("InvoiceDate")
    return lines.withColumn("month", month).hint("rebalance", F.col("month")).drop("month")


def _derive(lines: DataFrame) -> DataFrame:
    return classify_transactions(calculate_line_revenue(lines))


def _given(name: str) -> str:
    return f"given_{name}" if name in _DERIVED else name


def _derived_in(transformed: DataFrame) -> list[str]:
    """The derived columns that these lines have, of the types that would be derived again."""
    types = {field.name: field.dataType for field in _derive(transformed).schema}
    return [name for name in _DERIVED if name in transformed.columns and transformed.schema[name].dataType == types[name]]


def _without_derived(transformed: DataFrame) -> DataFrame:
    """Lines whose derived columns are null, which takes no room in a shuffle, where they are what would be derived again (``as_derived``)."""
    names = _derived_in(transformed)
    given = transformed.withColumnsRenamed({name: _given(name) for name in transformed.columns})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(_given(name))) for name in names], F.lit(True))
    compared = _derive(given).withColumn("as_derived", same).select(*given.columns, "as_derived")
    return compared.withColumns({_given(name): F.when(~F.col("as_derived"), F.col(_given(name))) for name in names})


def _with_derived(lines: DataFrame, transformed: DataFrame) -> DataFrame:
    """The columns of ``transformed`` out of lines that _without_derived has made of it."""
    names = _derived_in(transformed)
    again = {name: F.when(F.col("as_derived"), F.col(name)).otherwise(F.col(_given(name))) for name in names}
    return _derive(lines).select(*[again.get(name, F.col(_given(name))).alias(name) for name in transformed.columns])


def _span(lines: DataFrame) -> tuple[datetime | None, datetime | None]:
    return tuple(lines.agg(F.min("InvoiceDate"), F.max("InvoiceDate")).first())


def _months(first: datetime | None, last: datetime | None) -> Column:
    return F.col("sales_month").between(*[F.date_format(F.lit(x).cast("timestamp_ntz"), "yyyy-MM") for x in (first, last)])


def earlier_lines(spark: SparkSession, table: str, segments: list[str], first: datetime | None, last: datetime | None) -> DataFrame:
    """The raw columns of the lines that the segments hold in the months from first to last, and ``earlier``, which copy each is."""
    copy = F.split("line_id", "-")[2].cast("bigint")
    raw = [F.col(RAW_TO_FACT[name]).alias(name) for name in RAW_COLUMNS]
    return _read_segments(spark, table, segments).where(_months(first, last)).select(*raw, copy.alias("earlier"))


def earlier_copies(spark: SparkSession, table: str, segments: list[str], first: datetime | None, last: datetime | None) -> DataFrame:
    """``content`` and ``earlier``: how many copies of each line the segments hold, in the months from first to last.

    A line's id says what it is and which copy, so this one column of those
    months is all that is read; equal lines are of one month.
    """
    parts = F.split("line_id", "-")
    lines = _read_segments(spark, table, segments).where(_months(first, last))
    ids = lines.select(F.unhex(parts[0]).alias("content"), parts[2].cast("bigint").alias("copy"))
    return ids.groupBy("content").agg(F.max("copy").alias("earlier"))


def _set_apart(spark: SparkSession, table: str, segment: str, most: int | None) -> int:
    """How many lines a staged segment sets apart; raises if there are more than ``most``."""
    lines = _read_lot(spark, table, [segment], _QUARANTINE)
    reasons = {r["reasons"]: r["count"] for r in lines.groupBy("reasons").count().collect()}  # at most one row for each mix of reasons
    count = sum(reasons.values())
    if most is not None and count > most:
        raise DataQualityError(f"{count:,} lines can't be published where {most:,} are allowed: {reasons}")
    return count


def _publish(
    spark: SparkSession,
    table: str,
    full_refresh: bool,
    lines: Callable[[list[str]], DataFrame],
    expected_rows: int | None,
    most_quarantined: int | None,
    copies_known: bool,
) -> dict:
    """Stage the lines that ``lines`` gives for the segments they are added to, check them, and add a version.

    ``copies_known`` says that its lines are duplicates only of each other and of those segments' lines.
    Another load's version that comes first is looked at: unless this one
    replaces everything, its lines are staged again, marked against that version.
    """
    staged_for = segment = audit = None
    for _ in range(ATTEMPTS):
        try:
            former = current_version(spark, table)
        except FactNotPublishedError:
            former = None
        kept = [] if full_refresh or former is None else list(former.segments)
        if segment is None or kept != staged_for:
            segment, staged_for = _stage(to_fact(lines(kept), batch=len(kept)), table), kept
            apart = _set_apart(spark, table, segment, most_quarantined)
            audit = check_staged(_read_segments(spark, table, [segment]), None if expected_rows is None else expected_rows - apart)
            audit["quarantined"] = apart
            _write_products(spark, table, segment, copies_known)
        number = former.version + 1 if former else 1
        version = {
            "version": number,
            "segments": [*kept, segment],
            "rows": audit["total_rows"] + (former.rows if kept else 0),
            "quarantined": apart + ((former.quarantined or 0) if kept else 0),
            "published_at": datetime.now(timezone.utc).isoformat(),
        }
        if _put_if_absent(spark, f"{table}/manifest/v{number:012}.json", json.dumps(version) + "\n"):
            return audit
    raise ConcurrentLoadError(f"Other loads published on {table} each of the {ATTEMPTS} times that this one tried.")


def load_raw(
    raw: DataFrame,
    table: str,
    full_refresh: bool = True,
    expected_rows: int | None = None,
    quarantine_limit: int | None = None,
    dates: tuple[datetime | None, datetime | None] | None = None,
    by_time: bool = False,
) -> dict:
    """Clean, mark, stage, check and publish raw lines; returns the audit row of the load.

    A full refresh replaces the table's content, otherwise the lines are added
    to it, and those that it holds already are marked as duplicates. Raises
    ``DataQualityError`` and publishes nothing if a check fails. With a
    ``quarantine_limit`` up to so many lines that cannot be published are set
    apart beside the fact, in the same pass, instead of failing the load; the
    audit's ``quarantined`` counts them. ``dates``, the first and last of the
    lines, spares looking for them when lines are added. ``by_time``, as in
    ``detect_duplicates``, moves lines once, to be counted and gathered in one;
    leave it off where one line may be much of the table.
    """
    spark, quarantine = raw.sparkSession, quarantine_limit is not None

    def lines(kept):
        earlier = None
        if kept:
            typed = convert_data_types(clean_text_fields(standardize_columns(raw)))
            earlier = earlier_lines(spark, table, kept, *(dates or _span(typed)))
        return transform_retail(raw, None if by_time else by_month, earlier, quarantine, by_time)

    return _publish(spark, table, full_refresh, lines, expected_rows, quarantine_limit, copies_known=True)


def load_transformed(
    transformed: DataFrame | Callable[[DataFrame | None], DataFrame],
    table: str,
    full_refresh: bool = True,
    expected_rows: int | None = None,
    dates: tuple[datetime | None, datetime | None] | None = None,
    by_time: bool = False,
) -> dict:
    """load_raw for lines that are transformed already.

    Rebalancing gathers each month into few files and lets adaptive execution
    split a month that is too big for one task. It comes before the mapping to
    the fact, so that line ids, which do not compress, are not shuffled, nor are
    revenue, flags and category where they can be derived again. Lines that
    ``transform_retail`` has put ``by_time`` are of few months in each task: said
    so here, a load that adds to nothing writes them where they are.

    Lines that are added to others have to meet these, after they have met each other.
    A function that transforms them, given the lines there are (``earlier_lines``)
    or None, lets them do both at once, so they move once less; by time, they are then
    written where they are as well. It has to mark copies as ``transform_retail`` does,
    or lines that it calls duplicates of others may not be found by a search.
    """
    given = callable(transformed)
    alone = transformed(None) if given else transformed
    spark = alone.sparkSession

    def lines(kept):
        if not kept:
            marked = alone
        elif given:
            marked = transformed(earlier_lines(spark, table, kept, *(dates or _span(alone))))
        else:
            marked = classify_transactions(mark_earlier(alone, earlier_copies(spark, table, kept, *(dates or _span(alone)))))
        stays = by_time and (given or not kept)
        return marked if stays else _with_derived(by_month(_without_derived(marked)), marked)

    return _publish(spark, table, full_refresh, lines, expected_rows, None, copies_known=given)


def remove_unreferenced(spark: SparkSession, table: str, keep_versions: int = 2, least_age_seconds: float = 86_400) -> list[str]:
    """Delete segments that none of the newest ``keep_versions`` versions names and that are old enough; returns their names.

    The age spares segments that a running load has staged; no load may take
    longer than that. Older versions stay in the history, but are no longer readable.
    """
    if keep_versions < 1:
        raise ValueError("keep_versions must be 1 or more.")
    newest = history(spark, table).where("version IS NOT NULL").orderBy(F.desc("version")).limit(keep_versions)
    # A few versions, each with its segments.
    used = {segment for row in newest.collect() for segment in row.segments}
    base, files = _path(spark, f"{table}/segments")
    removed = []
    for status in files.listStatus(base):
        segment = status.getPath().getName().removeprefix("segment=")
        if segment not in used and status.getModificationTime() / 1000 <= time.time() - least_age_seconds:
            files.delete(_path(spark, _products_path(table, segment))[0], True)
            files.delete(status.getPath(), True)
            removed.append(segment)
    return sorted(removed)

"""Exact-duplicate marking that holds up when one row repeats a billion times."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.schema import RAW_COLUMNS, REJECT_COLUMNS

# Copies that are written out from one row of the counted groups.
COPIES_PER_BLOCK = 10_000

# What the lines of an invoice have in common comes first and texts of many lengths last, so that neighbours compress well.
_BY_TIME = ["InvoiceDate", "InvoiceNo", "CustomerID", "Country", "UnitPrice", "Quantity", "StockCode", "Description"]


def detect_duplicates(
    lines: DataFrame,
    copies_per_block: int = COPIES_PER_BLOCK,
    spread: Callable[[DataFrame], DataFrame] | None = None,
    earlier: DataFrame | None = None,
    by_time: bool = False,
) -> DataFrame:
    """Flag the second and later copies of rows equal on all eight columns.

    Rows of a group differ in nothing but ``is_missing_description``, so they
    are counted, which combines copies before the shuffle, and then written
    out again, those with a given description first. No task ever sorts or
    holds a group, as a window over the eight columns would. Every group is
    cut into blocks of copies; ``spread`` may deal the blocks, which are as
    many rows as there are distinct lines and a few more, over the cluster
    before their copies are written out, as the load does when it gathers
    months. The columns are grouped as one struct, which takes half the time of
    eight keys where nearly every line is unique.

    ``earlier`` has the lines there were before these: the eight columns and
    ``earlier``, which copy each was. The numbers go on from the largest. They
    are grouped together with these lines, so that their copies combine as well and
    no line moves once more to meet its earlier copies.

    With ``by_time`` lines move to where they are counted by ranges of time, then
    of the other columns, so that the result is in order of time from task to task
    and a load need not move it again to gather months. Ranges part lines of one
    moment or invoice, but copies move uncombined and one task counts those of a
    line: it holds one of them, but takes as long as reading them all. Where one
    line may be much of the table, leave it off.

    Adds ``occurrence`` (1 for the first copy) and ``is_duplicate``; the row
    count stays, nulls are equal to each other. Lines with a ``reasons`` column
    are equal only if that and ``raw_line`` are.
    """
    if "is_missing_description" not in lines.columns:
        lines = lines.withColumn("is_missing_description", F.lit(False))
    kept = [*RAW_COLUMNS, *[name for name in REJECT_COLUMNS if name in lines.columns]]
    copies, missing, block = F.col("copies"), F.col("missing_copies"), F.col("block")
    order = [*_BY_TIME, *[name for name in kept if name not in _BY_TIME]] if by_time else kept
    line = F.struct(*order).alias("line")
    before = F.lit(0).cast("bigint")
    if earlier is None:
        one = lines.select(line, "is_missing_description")
        groups = (one.repartitionByRange("line") if by_time else one).groupBy("line").agg(
            F.count(F.lit(1)).alias("copies"),
            F.count_if("is_missing_description").alias("missing_copies"),
        )
    else:
        published = earlier.withColumns({name: F.lit(None).cast("string") for name in kept if name not in RAW_COLUMNS})
        both = lines.select(line, "is_missing_description", F.lit(None).cast("bigint").alias("earlier")).unionAll(
            published.select(line, F.lit(False), "earlier")
        )
        groups = (both.repartitionByRange("line") if by_time else both).groupBy("line").agg(
            F.count_if(F.col("earlier").isNull()).alias("copies"),
            F.count_if("is_missing_description").alias("missing_copies"),
            F.max("earlier").alias("earlier"),
        )
        groups = groups.where(copies > 0)
        before = F.coalesce("earlier", before)
    last_block = F.call_function("div", copies - 1, F.lit(copies_per_block).cast("bigint"))
    flat = groups.select("line.*", *[name for name in groups.columns if name != "line"])
    blocks = flat.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    blocks = blocks if spread is None else blocks.transform(spread)
    numbers = F.sequence(block * copies_per_block + 1, F.least(copies, (block + 1) * copies_per_block))
    occurrence = F.col("occurrence")
    number = occurrence + before
    return blocks.withColumn("occurrence", F.explode(numbers)).select(
        *kept,
        (occurrence > copies - missing).alias("is_missing_description"),
        number.alias("occurrence"),
        (number > 1).alias("is_duplicate"),
    )


def content_hash() -> Column:
    """32 hex digits that tell the content of a cleaned line."""
    text = [F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") if name == "InvoiceDate" else F.col(name).cast("string") for name in RAW_COLUMNS]
    return F.md5(F.to_json(F.array(*text)))


def mark_earlier(marked: DataFrame, earlier: DataFrame) -> DataFrame:
    """Lines that detect_duplicates has marked, with the copies that are in ``earlier`` counted in.

    ``earlier`` has ``content``, the bytes of a content_hash, one row each, and
    ``earlier``, the copies there were. For lines that are no longer in groups; a
    hot content meets one row here, and adaptive execution splits its lines.
    """
    marked = marked if "occurrence" in marked.columns else marked.withColumn("occurrence", F.lit(1).cast("bigint"))
    joined = marked.withColumn("content", F.unhex(content_hash())).join(earlier.select("content", "earlier"), "content", "left")
    number = F.col("occurrence") + F.coalesce("earlier", F.lit(0).cast("bigint"))
    numbered = joined.withColumn("occurrence", number).withColumn("is_duplicate", F.col("occurrence") > 1)
    return numbered.select(*dict.fromkeys([*marked.columns, "is_duplicate"]))

"""Exact distinct counts of a column that hardly repeats, such as ids."""

from pyspark.sql import DataFrame, functions as F

#: Bits of a value's print: of 10^9 values some two in a million share theirs with another.
PRINT_BITS = 48


def distinct_counts(rows: DataFrame, group: str, name: str, folder: str, bits: int = PRINT_BITS) -> DataFrame:
    """``distinct`` for each group: how many values of a column it has, nulls left out.

    Instead of the values, which may be long and do not compress, short prints
    of them are counted. Only values whose print recurs, be it by chance, are then
    compared as they are. Those prints are written to ``folder``, so that Spark
    knows how many they are before it joins them; if all values recur, all are compared.
    """
    mask = F.lit(2**bits - 1).cast("bigint")
    prints = rows.where(F.col(name).isNotNull()).select(group, name, F.xxhash64(name).bitwiseAND(mask).alias("print"))
    recurring = prints.groupBy("print").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    recurring.select("print").write.option("compression", "zstd").parquet(folder)
    looked_at = prints.join(rows.sparkSession.read.schema("print BIGINT").parquet(folder), "print", "left_semi")
    again = looked_at.groupBy(group, name).agg((F.count(F.lit(1)) - 1).alias("again"))
    counts = rows.groupBy(group).agg(F.count(name).alias("n")).select(group, "n")
    fewer = again.groupBy(group).agg((-F.sum("again")).alias("n"))
    return counts.unionAll(fewer).groupBy(group).agg(F.sum("n").alias("distinct"))

"""Exact, interpolated quantiles without bringing a column's values together.

``percentile`` and ``median`` keep every distinct value in one task. Here equal
values are counted first; the wanted ranks are then found 22 bits at a time, so
no window ever sees more than four million rows, however many values there are.
"""

from pyspark.sql import DataFrame, Window, functions as F

# Bits of the value still to be told apart before and after each step.
_STEPS = [(64, 42), (42, 20), (20, 0)]


def exact_quantiles(values: DataFrame, probabilities: list[float]) -> DataFrame:
    """Quantiles of ``values(name STRING, value BIGINT)`` for each name.

    Returns ``name, probability, quantile`` with linear interpolation between
    the two nearest ranks; nulls are ignored. Callers scale decimals to whole
    numbers.
    """
    # Laid out by a generator, a name that is the same everywhere stays a join key.
    named = values.select(F.inline(F.array(F.struct("name", "value"))))
    counts = named.where(F.col("value").isNotNull()).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    position = F.col("probability") * (F.col("total") - 1)
    wanted = (
        counts.groupBy("name")
        .agg(F.sum("n").alias("total"))
        .withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))))
        .select(
            F.col("name").alias("of"),
            "probability",
            "rank",
            F.when(F.col("rank") == F.floor(position), 1 - (position - F.floor(position)))
            .otherwise(position - F.floor(position))
            .alias("weight"),
            (F.col("rank") + 1).alias("remaining"),
        )
    )
    target = ["of", "probability", "rank", "weight", "remaining"]
    by_digit = Window.partitionBy("of", "probability", "rank").orderBy("digit")
    for before, after in _STEPS:
        digits = counts.select(
            "name", "n", F.shiftright("value", after).alias("digit"), F.shiftright("value", min(before, 63)).alias("begins")
        )
        # Null-safe keys put no condition on the counts, so that all steps share one exchange.
        same = F.col("name").eqNullSafe(F.col("of"))
        if before < 64:
            same = same & F.col("begins").eqNullSafe(F.col("prefix"))
        # ``wanted`` has at most two rows per name and probability, whatever the data.
        wanted = (
            digits.join(F.broadcast(wanted), same)
            .groupBy(*target, "digit")
            .agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(by_digit))
            .where((F.col("upto") >= F.col("remaining")) & (F.col("upto") - F.col("n") < F.col("remaining")))
            .select(
                "of",
                "probability",
                "rank",
                "weight",
                (F.col("remaining") - (F.col("upto") - F.col("n"))).alias("remaining"),
                F.col("digit").alias("prefix"),
            )
        )
    return wanted.groupBy(F.col("of").alias("name"), "probability").agg(
        F.sum(F.col("prefix") * F.col("weight")).alias("quantile")
    )

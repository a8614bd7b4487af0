"""Placement of rows on shards through a look-up table filled by permutations.

Every shard prefers the slots of a table of prime size in an order of its own.
The shards take turns, and each claims the slot it likes best of those still
free, until none is. So all shards hold equally many slots, within one, and when
a shard is added or taken away few slots change hands. A row's slot is a hash of
its key; its shard is looked up in the broadcast table.

The order of a shard: slot s has rank (s - offset) * step modulo the table size,
offset and step coming from the shard's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Largest table that is filled and broadcast.
MOST_SLOTS = 65_537


def _number(text: Column) -> Column:
    """The first 32 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(spark: SparkSession, shards: list[str], slots: int = 4099) -> DataFrame:
    """slot and shard, one row for each slot.

    slots must be a prime from the number of shards up to MOST_SLOTS; a hundred
    for each shard keep them within one percent of each other. Filling takes
    slots * slots / 2 comparisons in all. Shards must be distinct and not empty;
    their order doesn't matter.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("Shards must be given and distinct.")
    if not _is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MOST_SLOTS}.")
    shard = F.struct(
        F.col("name"),
        (_number(F.concat(F.lit("offset "), F.col("name"))) % slots).alias("offset"),
        (1 + _number(F.concat(F.lit("step "), F.col("name"))) % (slots - 1)).alias("step"),
    )
    names = spark.createDataFrame([(name,) for name in shards], "name string")
    prepared = names.agg(F.sort_array(F.collect_list(shard)).alias("shards"))

    def claim(state: Column, turn: Column) -> Column:
        owner = F.element_at("shards", (turn % len(shards) + 1).cast("int"))
        rank = lambda s: F.pmod((s - owner["offset"]) * owner["step"], F.lit(slots))
        best = F.array_min(F.transform(state["free"], lambda s: rank(s) * slots + s)) % slots
        taken = F.transform(
            F.array(best),
            lambda b: F.struct(F.array_remove(state["free"], b).alias("free"), F.array_append(state["order"], b).alias("order")),
        )
        return F.element_at(taken, 1)

    all_slots = F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))
    start = F.struct(all_slots.alias("free"), F.array().cast("array<long>").alias("order"))
    order = F.aggregate(all_slots, start, claim, lambda state: state["order"])
    claims = prepared.select("shards", F.posexplode(order).alias("turn", "slot"))
    return claims.select("slot", F.element_at("shards", F.col("turn") % len(shards) + 1)["name"].alias("shard"))


def place(frame: DataFrame, shards: list[str], key: str = "doc_id", slots: int = 4099) -> DataFrame:
    """All columns with slot and shard by the key; a null key counts as an empty text.

    Nothing is shuffled. Rows of equal keys meet in one shard. Columns named
    slot or shard are refused.
    """
    clash = {"slot", "shard"} & {c.lower() for c in frame.columns}
    if clash:
        raise ValueError(f"The frame already has the columns {sorted(clash)}.")
    slot = _number(F.coalesce(F.col(key).cast("string"), F.lit(""))) % slots
    found = lookup_table(frame.sparkSession, shards, slots)
    # At most MOST_SLOTS rows.
    return frame.withColumn("slot", slot).join(F.broadcast(found), "slot").select(*frame.columns, "slot", "shard")

"""Retail lines derived from order tables (lineitem, orders, customer, ...).

Keys decide which lines become cancellations, write-offs, gifts, adjustments
or copies, so every run and every engine derives the same rows.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


def retail_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The eight raw columns for every line item in ``folder``."""
    return _keyed_lines(spark, folder).drop("k")


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines as the text of a carelessly kept file: padded, in several notations, here and there unreadable."""
    lines = _keyed_lines(spark, folder)

    def every(n):
        return F.col("k") % n == 0

    def padded(column):
        return F.concat(F.lit("\t "), column, F.lit("\xa0"))

    day = F.col("InvoiceDate")
    whole = F.col("Quantity").cast("string")
    return lines.select(
        F.when(every(73), F.lit(None)).otherwise(padded(F.col("InvoiceNo"))).alias("InvoiceNo"),
        padded(F.col("StockCode")).alias("StockCode"),
        F.when(every(79), F.lit("\t\xa0")).otherwise(padded(F.col("Description"))).alias("Description"),
        F.when(every(37), F.concat(whole, F.lit(".7")))
        .when(every(41), "abc")
        .when(every(43), F.lit(None))
        .otherwise(padded(whole))
        .alias("Quantity"),
        F.when(every(71), "soon")
        .when(every(29), F.date_format(day, "yyyy/MM/dd"))
        .when(every(31), F.date_format(day, "M/d/yyyy H:mm"))
        .when(every(19), F.date_format(day, "d-MMM-yyyy"))
        .otherwise(padded(F.date_format(day, "yyyy-MM-dd HH:mm:ss")))
        .alias("InvoiceDate"),
        F.when(every(47), "n/a")
        .when(every(83), "123456789.0")
        .when(every(89), "0.00001")
        .otherwise(padded(F.col("UnitPrice").cast("string")))
        .alias("UnitPrice"),
        F.when(every(59), "guest").otherwise(F.concat(F.col("CustomerID").cast("string"), F.lit(".0"))).alias("CustomerID"),
        padded(F.col("Country")).alias("Country"),
    )


def order_dates(spark: SparkSession, folder: str) -> tuple[datetime | None, datetime | None]:
    """The first and last date of the orders in ``folder``: no line is outside them."""
    return tuple(spark.read.parquet(f"{folder}/orders.parquet").agg(F.min("o_orderdate"), F.max("o_orderdate")).first())


def _keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The eight raw columns and the key ``k`` that decides about each line.

    All joins are plain equi-joins: Spark broadcasts a dimension only where its
    measured size is under the session's threshold, and adaptive execution
    splits hot keys. Orders meet customers before the far larger line items are touched.
    Line items carry what is derived from them instead of wider columns, and meet orders last,
    so that lines of an order are neighbours from there on, which compresses what moves
    them next. Copies are added by a generator, so line items are scanned once.
    """

    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    nation = table("nation").select("n_nationkey", "n_name")

    def placed(people, key):
        """Those whose nation is known; its key, which is narrower than its name, is what the lines carry."""
        return people.join(nation, F.col(key) == F.col("n_nationkey"), "left_semi")

    buyers = placed(table("customer").select("c_custkey", "c_nationkey"), "c_nationkey")
    orders = (
        table("orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "c_nationkey")
    )
    sellers = placed(table("supplier").select("s_suppkey", "s_nationkey"), "s_nationkey")
    parts = table("part").select("p_partkey", "p_name", "p_retailprice")

    def every(n):
        return F.col("k") % n == 0

    items = (
        table("lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("k", F.col("l_orderkey") + F.col("l_partkey") + F.col("l_linenumber"))
        .select(
            *["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"],
            ((F.col("l_returnflag") == "R") & every(4)).alias("returned"),
            F.when(every(23), F.col("s_nationkey")).alias("s_nationkey"),
        )
    )
    lines = (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .drop("p_partkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("k", F.col("l_orderkey") + F.col("l_partkey") + F.col("l_linenumber"))
        .withColumn("nation", F.when(every(23), F.col("s_nationkey")).otherwise(F.col("c_nationkey")))
        .join(nation, F.col("nation") == F.col("n_nationkey"))
    )

    order_no = F.col("l_orderkey").cast("string")
    returned, adjusted = F.col("returned"), every(397)
    quantity = F.col("l_quantity").cast("bigint")
    price = F.col("p_retailprice").cast("decimal(12,4)")
    copies = F.when(every(101), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("copy", F.explode(copies)).select(
        F.when(returned, F.concat(F.lit("C"), order_no))
        .when(adjusted, F.concat(F.lit("A"), order_no))
        .otherwise(order_no)
        .alias("InvoiceNo"),
        F.when(adjusted, "B")
        .when(F.col("l_partkey") % 97 == 0, "POST")
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("StockCode"),
        F.when(adjusted, "Adjust bad debt")
        .when(F.col("l_partkey") % 53 == 0, F.lit(None))
        .when(every(211), "   ")
        .when(F.col("l_linenumber") == 7, F.concat("p_name", F.lit(" boxed")))
        .otherwise(F.col("p_name"))
        .alias("Description"),
        F.when(returned, -quantity)
        .when(adjusted, F.lit(1))
        .when(every(61), -quantity)
        .when(every(307), F.lit(0))
        .when(every(503), -quantity)
        .otherwise(quantity)
        .alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when(returned, price)
        .when(adjusted, -price)
        .when(every(61) | every(67), F.lit(0).cast("decimal(12,4)"))
        .otherwise(price)
        .alias("UnitPrice"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None))
        .otherwise(F.col("o_custkey") * 8 + F.col("l_orderkey") % 8)
        .alias("CustomerID"),
        F.col("n_name").alias("Country"),
        "k",
    )

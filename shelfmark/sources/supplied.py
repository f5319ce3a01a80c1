"""The supplied Parquet tables in the shape of the bronze tables and the event streams.

Every function maps its whole table; the joins are ordinary equi-joins, left to Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, number: str) -> Column:
    return F.concat(F.lit(prefix), F.col(number))


def _pick(number: Column, *values: str) -> Column:
    """values[number mod len(values) + 1]: NULL past the listed ones."""
    choice = F.when(number == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        choice = choice.when(number == i, value)
    return choice


def _order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and dates per order, built once per order and not once per line."""
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _id("ORD_", "o_orderkey").alias("order_id"),
        _id("CUST_", "o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line; the smallest quantity becomes 0, so that it is rejected."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _order_headers(spark, sf_dir)
    products = _table(spark, sf_dir, "part").select(
        "p_partkey",
        _id("PROD_", "p_partkey").alias("product_id"),
        F.col("p_retailprice").alias("price"),
    )
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(products, lines.l_partkey == products.p_partkey)
        .select(
            "order_id",
            "customer_id",
            "product_id",
            (F.col("l_quantity") - 1).alias("quantity"),
            "price",
            "order_date",
        )
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per returned order line, with missing orders, reasons and values among them."""
    lines = _table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    orders = _order_headers(spark, sf_dir)
    key = F.col("l_orderkey")
    order_id = F.when(key % 89 == 0, None).otherwise(
        F.when(key % 97 == 0, _id("MISSING_", "l_orderkey")).otherwise(F.col("order_id"))
    )
    after = (F.col("l_linenumber") * 4 + 1).cast("int")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(_id("RET_", "l_orderkey"), _id("_", "l_linenumber")).alias("return_id"),
        order_id.alias("order_id"),
        "customer_id",
        _id("PROD_", "l_partkey").alias("product_id"),
        F.date_add(F.to_date("order_date"), after).cast("timestamp").alias("return_date"),
        _pick(
            F.col("l_suppkey") % 6,
            "Defective",
            "Wrong size",
            "Not as described",
            "Changed mind",
            "Arrived late",
        ).alias("return_reason"),
        F.when(F.col("l_discount") == 0, 0.0)
        .otherwise(F.col("l_extendedprice"))
        .alias("return_value"),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One promotion per part, -3 to 46 days long, starting on one of 60 days two months apart, so
    that many overlap and gaps remain between them."""
    offset = (F.col("p_partkey") * 60 % 3600).cast("int")
    start = F.date_add(F.lit("1995-02-01").cast("date"), offset)
    return _table(spark, sf_dir, "part").select(
        _id("PROMO_", "p_partkey").alias("promo_id"),
        F.col("p_name").alias("promo_name"),
        F.col("p_size").cast("double").alias("discount_pct"),
        start.alias("start_date"),
        F.date_add(start, F.col("p_size") - 4).alias("end_date"),
        F.col("p_type").alias("target_segment"),
        F.when(F.col("p_partkey") % 2 == 0, "Expired").otherwise("Active").alias("status"),
    )


def clickstream(events: DataFrame) -> DataFrame:
    """Events as clickstream messages; some event types are outside the contract."""
    return events.select(
        _id("EV_", "event_id").alias("event_id"),
        _id("USER_", "user_id").alias("user_id"),
        F.concat(_id("S_", "user_id"), F.lit("_"), F.to_date("ts")).alias("session_id"),
        F.concat(
            F.lit("https://shop.example/"),
            _pick(F.col("event_id") % 4, "home", "product", "cart", "checkout"),
        ).alias("page_url"),
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"),
        _pick(F.col("event_id") % 4, "mobile", "desktop", "tablet").alias("device_type"),
    )


def offers(events: DataFrame) -> DataFrame:
    """Events as offer messages; one status in five is outside the contract."""
    return events.select(
        _id("OFF_", "event_id").alias("offer_id"),
        _id("USER_", "user_id").alias("user_id"),
        F.concat(F.lit("PROMO_"), F.col("event_id") % 20).alias("promo_id"),
        (F.col("event_id") % 40 + 10).cast("double").alias("discount_pct"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("offer_time"),
        _pick(
            F.col("event_id") % 5, "sent", "viewed", "accepted", "expired", "unknown"
        ).alias("status"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders")

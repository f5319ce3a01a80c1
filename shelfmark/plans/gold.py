"""Silver rows to the four marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.audit import stamped
from shelfmark.functions.dates import month_start
from shelfmark.functions.money import money_avg, money_avg_rounded, money_sum
from shelfmark.functions.ratios import pct_change, safe_ratio
from shelfmark.operators.coverage import covered_days

# The labels of every promotion-revenue row.
PROMO_ID, PROMO_NAME = "Multiple/Overlapping", "Active Promos"


def customer_ltv(sales: DataFrame) -> DataFrame:
    """Per customer: revenue, distinct orders, mean sale row, first and last date."""
    marts = sales.groupBy("customer_id").agg(
        money_sum("total_amount").alias("lifetime_value"),
        F.countDistinct("order_id").alias("total_orders"),
        money_avg_rounded("total_amount").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return stamped(marts)


def daily_sales(sales: DataFrame) -> DataFrame:
    """Per day: revenue, distinct orders, mean sale row."""
    marts = sales.groupBy("order_date").agg(
        money_sum("total_amount").alias("total_revenue"),
        F.countDistinct("order_id").alias("total_orders"),
        money_avg_rounded("total_amount").alias("avg_order_value"),
    )
    return stamped(marts)


def daily_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per day with sales: one row per calendar day at most."""
    return sales.groupBy("order_date").agg(money_sum("total_amount").alias("daily_revenue"))


def promo_revenue(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per day with sales and a promotion: revenue against the mean of days without one.

    Sales are read and shuffled once: the baseline and the result share the per-day sums. Both take
    them through the same outer join, because Spark would push a semi or anti join below the sum,
    to every sale row; and the comparison is null-safe, because a plain one would filter the dates
    of one use only. Days without a date count as uncovered.
    """
    promo_days = covered_days(promotions, "start_date", "end_date", "promo_date")
    daily = daily_revenue(sales).join(
        promo_days, F.col("order_date").eqNullSafe(F.col("promo_date")), "left"
    )
    baseline = (
        daily.where(F.col("promo_date").isNull())
        .agg(money_avg("daily_revenue").alias("revenue_without_promo"))
        .scalar()
    )
    covered = daily.where(F.col("promo_date").isNotNull()).withColumn(
        "revenue_without_promo", baseline
    )
    return stamped(
        covered.select(
            "order_date",
            F.lit(PROMO_ID).alias("promo_id"),
            F.lit(PROMO_NAME).alias("promo_name"),
            F.col("daily_revenue").alias("revenue_with_promo"),
            "revenue_without_promo",
            pct_change(F.col("daily_revenue"), F.col("revenue_without_promo")).alias("uplift_pct"),
        )
    )


def return_rate_by_product(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Per product and month of sale: units sold, and the returns dated in that month.

    The published rate is returned rows over returned value, not over units sold. Units are summed
    like money, so that fractions of a unit add up exactly before the whole is taken. Both sides are
    summed by the join keys first, so the join needs no further shuffle.
    """
    keys = ["product_id", "return_month"]
    sold = (
        sales.withColumn("return_month", month_start("order_date"))
        .groupBy(keys)
        .agg(money_sum("quantity").alias("sold_qty"))
    )
    returned = (
        returns.withColumn("return_month", month_start("return_date"))
        .groupBy(keys)
        .agg(
            money_sum("return_value").alias("total_return_value"),
            F.count(F.lit(1)).alias("returned_qty"),
        )
    )
    rate = safe_ratio(F.col("returned_qty"), F.col("total_return_value"), 4)
    return stamped(
        sold.join(returned, keys, "left")
        .fillna(0, subset=["returned_qty", "total_return_value"])
        .withColumn("return_rate", rate)
    ).to(schemas.GOLD_RETURN_RATE.schema)

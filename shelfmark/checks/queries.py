"""One query per operator, each over whole supplied tables.

A query takes (spark, sf_dir) and returns a DataFrame without the load time, which differs per run.
Queries on files, tables and streams first write their input, derived from the supplied tables, to
the shared scratch folder.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.audit import INGESTION_TIME, stamped
from shelfmark.functions.dates import days_between, days_spanned, month_start
from shelfmark.functions.money import money_avg, money_avg_rounded, money_sum
from shelfmark.functions.ratios import pct_change, safe_ratio
from shelfmark.operators import sampling
from shelfmark.operators.coverage import covered_days
from shelfmark.operators.existence import existence_flag
from shelfmark.plans import bronze, gold, jobs, silver
from shelfmark.schemas import TableSpec
from shelfmark.session import scratch_dir
from shelfmark.sources import supplied
from shelfmark.sources.csv_files import read_csv, write_csv
from shelfmark.sources.tables import Lakehouse
from shelfmark.streaming.contracts import CLICKSTREAM, OFFERS, Contract, typed
from shelfmark.streaming.ingest import file_stream, ingest, read_ingested

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs -------------------------------------------------------------------------------


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(INGESTION_TIME)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.sales(bronze.sales(supplied.sales(spark, sf_dir)))


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze.returns(supplied.returns(spark, sf_dir))
    return silver.returns(raw, _sales(spark, sf_dir))


def _promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.promotions(bronze.promotions(supplied.promotions(spark, sf_dir)))


def _sold_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units sold per product and month."""
    return (
        _sales(spark, sf_dir)
        .withColumn("month", month_start("order_date"))
        .groupBy("product_id", "month")
        .agg(F.sum("quantity").cast("bigint").alias("sold_qty"))
    )


def _returned_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rows and value per product and month."""
    return (
        supplied.returns(spark, sf_dir)
        .withColumn("month", month_start(F.to_date("return_date")))
        .groupBy("product_id", "month")
        .agg(
            F.count(F.lit(1)).alias("returned_qty"),
            money_sum("return_value").alias("total_return_value"),
        )
    )


def _with_promo_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-day revenue with the matching promotion day, if there is one. See gold.promo_revenue for
    why the join is an outer one."""
    days = covered_days(supplied.promotions(spark, sf_dir), "start_date", "end_date", "promo_date")
    daily = gold.daily_revenue(_sales(spark, sf_dir))
    return daily.join(days, F.col("order_date").eqNullSafe(F.col("promo_date")), "left")


_SUPPLIED = {
    "sales": supplied.sales,
    "returns": supplied.returns,
    "promotions": supplied.promotions,
}


def _lake(spark: SparkSession) -> Lakehouse:
    """A lakehouse of its own in the scratch folder; its databases go when the process ends."""
    lake = Lakehouse(spark, scratch_dir(spark, "lake"), prefix=f"run_{uuid.uuid4().hex}_")
    atexit.register(_forget, lake)
    return lake


def _forget(lake: Lakehouse) -> None:
    if SparkSession.getActiveSession() is not None:
        lake.drop_databases()


def _table(lake: Lakehouse, spec: TableSpec) -> None:
    lake.ensure_databases()
    lake.ensure_table(spec)


def _csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The supplied rows of a bronze table as a CSV directory."""
    path = scratch_dir(spark, f"csv-{name}")
    write_csv(_SUPPLIED[name](spark, sf_dir), path)
    return path


def _ingested(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    lake = _lake(spark)
    jobs.ingest_raw(lake, spec, _csv(spark, sf_dir, spec.name))
    return _plain(lake.read(spec))


# --- the ten jobs --------------------------------------------------------------------------------


@query
def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.BRONZE_SALES)


@query
def bronze_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.BRONZE_RETURNS)


@query
def bronze_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.BRONZE_PROMOTIONS)


@query
def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_sales(spark, sf_dir))


@query
def silver_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_returns(spark, sf_dir))


@query
def silver_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_promotions(spark, sf_dir))


@query
def gold_customer_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.customer_ltv(_sales(spark, sf_dir)))


@query
def gold_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.daily_sales(_sales(spark, sf_dir)))


@query
def gold_promo_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.promo_revenue(_sales(spark, sf_dir), _promotions(spark, sf_dir)))


@query
def gold_return_rate_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        gold.return_rate_by_product(_sales(spark, sf_dir), _returns(spark, sf_dir))
    )


# --- scans, sinks, tables ------------------------------------------------------------------------


@query
def scan_csv_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _csv(spark, sf_dir, "returns"), schemas.BRONZE_RETURNS)


@query
def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _csv(spark, sf_dir, "sales"), schemas.BRONZE_SALES, infer=True)


@query
def scan_csv_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in two places that match the pattern, next to returns that do not."""
    folder = scratch_dir(spark, "raw")
    rows = supplied.sales(spark, sf_dir)
    early = F.col("order_date") < "1997-01-01"
    write_csv(rows.where(early), f"{folder}/sales_early.csv")
    write_csv(rows.where(~early), f"{folder}/sales_late.csv")
    write_csv(supplied.returns(spark, sf_dir), f"{folder}/returns_all.csv")
    return read_csv(spark, f"{folder}/sales_*.csv", schemas.BRONZE_SALES)


@query
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    _table(lake, schemas.SILVER_SALES)
    lake.append(_sales(spark, sf_dir), schemas.SILVER_SALES)
    return _plain(lake.table(schemas.SILVER_SALES)).drop(
        schemas.SILVER_SALES.partition_column
    )


@query
def ddl_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table in each of the three databases, created twice; the rows each one then holds."""
    lake = _lake(spark)
    specs = (schemas.BRONZE_SALES, schemas.SILVER_SALES, schemas.GOLD_DAILY_SALES)
    for spec in specs * 2:
        _table(lake, spec)
    lake.append(bronze.sales(supplied.sales(spark, sf_dir)), schemas.BRONZE_SALES)
    jobs.silver_sales(lake)
    jobs.gold_daily_sales(lake)
    counts = [
        lake.read(spec).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(spec.layer).alias("namespace"), "n_rows"
        )
        for spec in specs
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def ddl_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating a table that exists keeps its rows."""
    lake = _lake(spark)
    _table(lake, schemas.SILVER_PROMOTIONS)
    lake.append(_promotions(spark, sf_dir), schemas.SILVER_PROMOTIONS)
    _table(lake, schemas.SILVER_PROMOTIONS)
    return _plain(lake.read(schemas.SILVER_PROMOTIONS))


@query
def partition_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    spec = schemas.SILVER_SALES
    _table(lake, spec)
    lake.append(_sales(spark, sf_dir), spec)
    return (
        spark.table(lake.table_name(spec))
        .groupBy(F.col(spec.partition_column).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
        )
    )


@query
def partition_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    spec = schemas.SILVER_PROMOTIONS
    _table(lake, spec)
    lake.append(_promotions(spark, sf_dir), spec)
    return (
        spark.table(lake.table_name(spec))
        .groupBy(F.col(spec.partition_column).alias("year"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("start_date").alias("first_date"))
    )


@query
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows appended twice are there twice."""
    lake = _lake(spark)
    _table(lake, schemas.BRONZE_SALES)
    for _ in range(2):
        lake.append(bronze.sales(supplied.sales(spark, sf_dir)), schemas.BRONZE_SALES)
    return _plain(lake.read(schemas.BRONZE_SALES)).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity")
    )


@query
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write leaves nothing of the first, in no partition."""
    lake = _lake(spark)
    _table(lake, schemas.GOLD_DAILY_SALES)
    daily = gold.daily_sales(_sales(spark, sf_dir))
    shifted = daily.withColumn("order_date", F.date_add("order_date", 400))
    lake.overwrite(shifted, schemas.GOLD_DAILY_SALES)
    lake.overwrite(daily, schemas.GOLD_DAILY_SALES)
    return _plain(lake.read(schemas.GOLD_DAILY_SALES))


@query
def sink_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fractional DOUBLE goes into a BIGINT column, an INT into a DOUBLE one; the columns come in
    another order than the table's."""
    lake = _lake(spark)
    spec = schemas.GOLD_RETURN_RATE
    _table(lake, spec)
    rows = _sold_by_month(spark, sf_dir).select(
        F.col("month").alias("return_month"),
        (F.col("sold_qty") / 4).alias("sold_qty"),
        F.col("sold_qty").cast("int").alias("total_return_value"),
        F.lit(0).alias("returned_qty"),
        F.lit(1).alias("return_rate"),
        "product_id",
    )
    lake.append(stamped(rows), spec)
    return _plain(lake.read(spec))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count that each write reports, beside the rows then found in the table."""
    lake = _lake(spark)
    counts = []
    for spec in (schemas.BRONZE_SALES, schemas.BRONZE_RETURNS, schemas.BRONZE_PROMOTIONS):
        _table(lake, spec)
        written = lake.append(stamped(_SUPPLIED[spec.name](spark, sf_dir)), spec)
        counts.append(
            lake.read(spec)
            .agg(F.count(F.lit(1)).alias("stored_rows"))
            .select(
                F.lit(spec.name).alias("table_name"),
                F.lit(written).cast("bigint").alias("written_rows"),
                "stored_rows",
            )
        )
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def audit_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row has the load time, and all the same one."""
    rows = bronze.sales(supplied.sales(spark, sf_dir))
    return rows.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(INGESTION_TIME).alias("n_stamped"),
        (F.min(INGESTION_TIME) == F.max(INGESTION_TIME)).alias("one_time"),
    )


# --- projections, filters, predicates ------------------------------------------------------------


@query
def project_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.sales(spark, sf_dir).select("product_id", "order_id", "price", "quantity")


@query
def project_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.sales(spark, sf_dir).withColumns(
        {
            "total_amount": F.round(F.col("quantity") * F.col("price"), 2),
            "order_date": F.to_date("order_date"),
        }
    )


@query
def project_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_revenue(_sales(spark, sf_dir)).select(
        "order_date",
        F.lit(gold.PROMO_ID).alias("promo_id"),
        F.lit(gold.PROMO_NAME).alias("promo_name"),
        F.lit(True).alias("is_valid"),
        F.lit(0.0).alias("uplift_pct"),
    )


@query
def project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets with columns of one name, told apart by their aliases: returns beside the sales
    of the same product in the month of the return."""
    returned = _returned_by_month(spark, sf_dir).alias("returned")
    sold = _sold_by_month(spark, sf_dir).alias("sold")
    same = (F.col("returned.product_id") == F.col("sold.product_id")) & (
        F.col("returned.month") == F.col("sold.month")
    )
    return returned.join(sold, same, "left").select(
        F.col("returned.product_id").alias("returned_product"),
        F.col("sold.product_id").alias("sold_product"),
        "returned.month",
        "returned.returned_qty",
        "sold.sold_qty",
    )


@query
def filter_compare_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.sales(spark, sf_dir).where((F.col("quantity") > 0) & (F.col("price") > 0))


@query
def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.returns(spark, sf_dir).where(F.col("return_value") > 0)


@query
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        supplied.returns(spark, sf_dir)
        .where(F.col("order_id").isNotNull())
        .withColumn("has_reason", F.when(F.col("return_reason").isNotNull(), True).otherwise(False))
    )


@query
def pred_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.returns(spark, sf_dir).where(
        F.col("return_reason").isin(*silver.VALID_REASONS)
    )


@query
def pred_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.promotions(spark, sf_dir).where(
        F.col("discount_pct").between(silver.MIN_DISCOUNT, silver.MAX_DISCOUNT)
    )


@query
def pred_column_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.promotions(spark, sf_dir).where(F.col("start_date") < F.col("end_date"))


@query
def pred_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.returns(spark, sf_dir).where(F.col("return_value") != 0)


@query
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL condition takes the default."""
    counted = F.col("return_reason").isin(*silver.VALID_REASONS)
    return supplied.returns(spark, sf_dir).select(
        "return_id",
        "return_reason",
        F.when(counted, True).otherwise(False).alias("reason_counts"),
        F.when(F.col("return_value") > 20000, "high")
        .when(F.col("return_value") > 0, "low")
        .otherwise("none")
        .alias("value_class"),
    )


@query
def fill_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _sold_by_month(spark, sf_dir).join(
        _returned_by_month(spark, sf_dir), ["product_id", "month"], "left"
    )
    return joined.fillna(0, subset=["returned_qty", "total_return_value"])


# --- joins ---------------------------------------------------------------------------------------


@query
def join_left_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The right side's own key column tells whether there was a match."""
    orders = supplied.orders(spark, sf_dir).select(
        F.concat(F.lit("ORD_"), "o_orderkey").alias("order_id"), "o_orderpriority"
    )
    return supplied.returns(spark, sf_dir).join(orders, "order_id", "left").select(
        "return_id",
        "order_id",
        orders["order_id"].isNotNull().alias("order_found"),
        "o_orderpriority",
    )


@query
def join_left_multikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold_by_month(spark, sf_dir).join(
        _returned_by_month(spark, sf_dir), ["product_id", "month"], "left"
    )


@query
def join_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with sales and no promotion."""
    return (
        _with_promo_day(spark, sf_dir).where(F.col("promo_date").isNull()).drop("promo_date")
    )


@query
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with sales and a promotion, on differently named keys."""
    days = covered_days(supplied.promotions(spark, sf_dir), "start_date", "end_date", "promo_date")
    daily = gold.daily_revenue(_sales(spark, sf_dir))
    return daily.join(days, daily.order_date == days.promo_date, "inner")


@query
def join_existence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return existence_flag(
        supplied.returns(spark, sf_dir), _sales(spark, sf_dir), on="order_id", flag="order_known"
    )


@query
def scalar_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean day beside every day."""
    daily = gold.daily_revenue(_sales(spark, sf_dir))
    mean = daily.agg(money_avg("daily_revenue")).scalar()
    return daily.withColumn("mean_day", mean)


@query
def interval_cover_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day with sales, and whether a promotion covers it."""
    return _with_promo_day(spark, sf_dir).select(
        "order_date", F.col("promo_date").isNotNull().alias("covered")
    )


# --- aggregations --------------------------------------------------------------------------------


@query
def agg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).groupBy("product_id").agg(
        money_sum("total_amount").alias("revenue"), F.sum("quantity").alias("quantity")
    )


@query
def agg_count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.returns(spark, sf_dir).groupBy("return_reason").agg(
        F.count("*").alias("returned_qty")
    )


@query
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).groupBy("product_id").agg(
        F.countDistinct("order_id").alias("total_orders")
    )


@query
def agg_avg_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).groupBy("product_id").agg(
        money_avg_rounded("total_amount").alias("avg_order_value")
    )


@query
def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )


@query
def agg_global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).agg(money_avg("total_amount").alias("avg_amount"))


@query
def group_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).groupBy("customer_id").agg(
        F.count("*").alias("n_rows"), money_sum("total_amount").alias("revenue")
    )


@query
def group_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold_by_month(spark, sf_dir)


@query
def agg_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per day, then the mean day of each month."""
    return (
        gold.daily_revenue(_sales(spark, sf_dir))
        .groupBy(month_start("order_date").alias("month"))
        .agg(money_avg("daily_revenue").alias("mean_day"), F.count("*").alias("n_days"))
    )


# --- set operations ------------------------------------------------------------------------------


@query
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).select("order_id").distinct()


@query
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered_days(
        supplied.promotions(spark, sf_dir), "start_date", "end_date", "promo_date"
    )


@query
def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV directories of one schema, read apart and put together by column name."""
    folder = scratch_dir(spark, "raw")
    rows = supplied.sales(spark, sf_dir)
    cheap = F.col("price") < 1000
    write_csv(rows.where(cheap), f"{folder}/cheap")
    write_csv(rows.where(~cheap).select(*reversed(rows.columns)), f"{folder}/dear")
    parts = [read_csv(spark, f"{folder}/{p}", schemas.BRONZE_SALES) for p in ("cheap", "dear")]
    return parts[0].unionByName(parts[1])


# --- scalar functions ----------------------------------------------------------------------------


@query
def fn_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a timestamp, and from text."""
    text = F.date_format("return_date", "yyyy-MM-dd")
    return supplied.returns(spark, sf_dir).select(
        "return_id",
        F.to_date("return_date").alias("from_timestamp"),
        F.to_date(text).alias("from_text"),
    )


@query
def fn_datediff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.promotions(spark, sf_dir).select(
        "promo_id", days_between("start_date", "end_date").alias("duration_days")
    )


@query
def fn_trunc_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.returns(spark, sf_dir).select(
        "return_id", month_start(F.to_date("return_date")).alias("return_month")
    )


@query
def fn_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = days_spanned("start_date", "end_date")
    return supplied.promotions(spark, sf_dir).select(
        "promo_id",
        F.size(days).alias("n_days"),
        F.element_at(days, 1).alias("first_day"),
        F.element_at(days, -1).alias("last_day"),
    )


@query
def fn_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = days_spanned("start_date", "end_date")
    return supplied.promotions(spark, sf_dir).select("promo_id", F.explode(days).alias("day"))


@query
def fn_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.sales(spark, sf_dir).select(
        "order_id",
        "product_id",
        F.round(F.col("quantity") * F.col("price"), 2).alias("two_places"),
        F.round(F.col("quantity") / F.col("price"), 4).alias("four_places"),
    )


@query
def fn_arith_mul(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.sales(spark, sf_dir).select(
        "order_id", "product_id", (F.col("quantity") * F.col("price")).alias("amount")
    )


@query
def fn_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue against a fixed base of 100,000, and against none."""
    return gold.daily_revenue(_sales(spark, sf_dir)).select(
        "order_date",
        pct_change(F.col("daily_revenue"), F.lit(100000.0)).alias("pct"),
        pct_change(F.col("daily_revenue"), F.lit(0.0)).alias("pct_of_nothing"),
    )


@query
def fn_safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rows per returned value; product-months with no value get 0."""
    return _returned_by_month(spark, sf_dir).select(
        "product_id",
        "month",
        safe_ratio(F.col("returned_qty"), F.col("total_return_value"), 4).alias("return_rate"),
    )


# --- streams and sampling ------------------------------------------------------------------------


_MESSAGES = {"clickstream": supplied.clickstream, "offers": supplied.offers}


def _landed(spark: SparkSession, sf_dir: str, contract: Contract) -> DataFrame:
    """The supplied events as a file stream of messages."""
    path = scratch_dir(spark, f"landing-{contract.topic}")
    _MESSAGES[contract.topic](supplied.events(spark, sf_dir)).write.parquet(path)
    return file_stream(spark, path, contract)


def _streamed(
    spark: SparkSession, sf_dir: str, contract: Contract, rejects: bool = False
) -> DataFrame:
    target = scratch_dir(spark, f"bronze-{contract.topic}")
    checkpoint = scratch_dir(spark, f"checkpoint-{contract.topic}")
    messages = _landed(spark, sf_dir, contract)
    ingest(messages, contract, target, checkpoint).awaitTermination()
    return _plain(read_ingested(spark, target, contract, rejects))


@query
def stream_clickstream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, CLICKSTREAM)


@query
def stream_offers_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, OFFERS)


@query
def stream_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected messages of both streams, with what is wrong with them."""
    clicks = _streamed(spark, sf_dir, CLICKSTREAM, rejects=True)
    offers = _streamed(spark, sf_dir, OFFERS, rejects=True)
    return clicks.select(
        F.lit("clickstream").alias("topic"),
        F.col("event_id").alias("message_id"),
        F.col("event_type").alias("value"),
        "rejected_for",
    ).unionByName(
        offers.select(
            F.lit("offers").alias("topic"),
            F.col("offer_id").alias("message_id"),
            F.col("status").alias("value"),
            "rejected_for",
        )
    )


@query
def stream_event_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = supplied.offers(supplied.events(spark, sf_dir)).withColumn(
        "millis", F.col("offer_time")
    )
    return typed(messages, OFFERS).select("offer_id", "millis", "offer_time")


@query
def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by order: an order has several rows, of which the last sampled one may cut some off."""
    return sampling.sample_exact(supplied.sales(spark, sf_dir), key="order_id", rate=0.08, seed=999)

"""What the plans must look like to hold on large tables."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators.coverage import covered_days
from shelfmark.operators.existence import existence_flag
from shelfmark.plans import gold, silver
from shelfmark.sources import supplied


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run(df) -> str:
    """The plan as it was run, without the plans Spark started from."""
    df.collect()
    kept, skip_below = [], None
    for line in plan(df).splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if skip_below is not None and depth > skip_below:
            continue
        skip_below = depth if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


def scans(text) -> list[set[str]]:
    return [
        {c.split(":")[0] for c in re.findall(r"\w+:\w+", found)}
        for found in re.findall(r"ReadSchema: struct<([^>\n]*)", text)
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver sales, returns and promotions as files, much as the tables hold them."""
    sf_dir = "/root/testdata/sf0.001"
    root = str(tmp_path_factory.mktemp("stored"))
    raw = supplied.sales(spark, sf_dir)
    raw.write.parquet(f"{root}/raw")
    sales = silver.sales(raw)
    frames = {
        "sales": sales,
        "returns": silver.returns(supplied.returns(spark, sf_dir), sales),
        "promotions": silver.promotions(supplied.promotions(spark, sf_dir)),
    }
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def test_gold_reads_only_the_columns_it_needs(stored):
    (columns,) = scans(plan(gold.daily_sales(stored("sales"))))
    assert columns == {"order_id", "total_amount", "order_date"}


def test_silver_filters_are_pushed_to_the_scan(stored):
    text = plan(silver.sales(stored("raw")))
    assert "GreaterThan(quantity,0.0)" in text and "GreaterThan(price,0.0)" in text


def test_referential_check_reads_only_the_order_ids_of_sales(spark, stored):
    with settings(spark, **LARGE):
        text = plan(silver.returns(stored("returns"), stored("sales")))
    assert [c for c in scans(text) if c == {"order_id"}]
    assert len(scans(text)) == 2, "returns and sales are read once each, in the first plan too"


def test_referential_check_splits_a_hot_order(spark, tmp_path):
    """A third of the rows have one key: their partition is split over tasks."""
    key = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id")))
    spark.range(0, 600_000, 1, 8).select(key.alias("order_id"), F.rand(1).alias("v")).write.parquet(
        str(tmp_path / "rows")
    )
    rows = spark.read.parquet(str(tmp_path / "rows"))
    small = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
    }
    with settings(spark, **LARGE, **small):
        flagged = existence_flag(rows, rows.where("v < 0.5"), "order_id", "known")
        assert "skew=true" in run(flagged)
        assert flagged.count() == 600_000


def test_promo_revenue_shuffles_sales_once(spark, stored):
    with settings(spark, **LARGE):
        text = run(gold.promo_revenue(stored("sales"), stored("promotions")))
    sums = [c for c in scans(text) if "total_amount" in c]
    assert len(sums) == 1, "the baseline and the result share one scan of sales"
    assert "ReusedExchange" in text


def test_return_rate_join_needs_no_shuffle_of_its_own(spark, stored):
    with settings(spark, **LARGE):
        text = run(gold.return_rate_by_product(stored("sales"), stored("returns")))
    assert len(re.findall(r"Exchange hashpartitioning\(product_id", text)) == 2
    assert len(re.findall("Exchange ", text)) == 2
    assert text.count("partial_sum") >= 2, "summed before the shuffle"


def test_distinct_orders_are_shuffled_by_day_and_order(stored):
    """So that a day with most of the orders is spread, and only its counts meet again."""
    text = plan(gold.daily_sales(stored("sales")))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert any("order_id" in k and "order_date" in k for k in keys)


def test_a_day_with_most_sales_is_summed_in_parts(spark):
    """Every task sends at most one row per (day, order) it has seen."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("O"), F.col("id") % 100).alias("order_id"),
        F.lit(0.01).alias("total_amount"),
        F.lit(date(2024, 1, 1)).alias("order_date"),
    )
    result = gold.daily_sales(rows).first()
    assert (result.total_revenue, result.total_orders, result.avg_order_value) == (400.0, 100, 0.01)


def test_many_overlapping_promotions_are_merged_before_they_are_exploded(spark):
    """100,000 promotions on ten first days give ten spans."""
    promos = spark.range(0, 100_000, 1, 8).select(
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("start_date"),
        F.date_add(F.lit(date(2024, 2, 1)), (F.col("id") % 300).cast("int")).alias("end_date"),
    )
    days = covered_days(promos, "start_date", "end_date", "day")
    text = plan(days)
    assert text.index("Generate explode") < text.index("partial_max"), "merged below the explode"
    assert days.count() == 31 + 300


def test_tables_use_declared_types():
    assert {s.schema["_ingestion_time"].dataType.simpleString() for s in schemas.TABLES.values()} == {
        "timestamp"
    }

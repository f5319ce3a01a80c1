"""The rules that the supplied tables do not reach, on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.plans import bronze, gold, silver

DAY = datetime(2024, 3, 5, 13, 30)


def frame(spark, spec, rows):
    return spark.createDataFrame(rows, spec.raw_schema)


def sale(order="O1", customer="C1", product="P1", quantity=1.0, price=10.0, day=DAY):
    return (order, customer, product, quantity, price, day)


def silver_sale(order="O1", customer="C1", product="P1", quantity=1.0, amount=10.0, day=None):
    return (order, customer, product, quantity, 1.0, amount, day or DAY.date(), True)


def returned(rid="R1", order="O1", reason="Defective", value=5.0, product="P1", day=DAY):
    return (rid, order, "C1", product, day, reason, value)


def promo(pid="X", pct=10.0, start=date(2024, 3, 1), end=date(2024, 3, 3)):
    return (pid, "name", pct, start, end, "All", "Active")


@pytest.mark.parametrize(
    "quantity,price",
    [(None, 1.0), (1.0, None), (0.0, 1.0), (1.0, 0.0), (-1.0, 1.0), (1.0, -1.0)],
)
def test_unusable_sales_are_dropped(spark, quantity, price):
    rows = frame(spark, schemas.BRONZE_SALES, [sale(quantity=quantity, price=price), sale("O2")])
    assert [r.order_id for r in silver.sales(rows).collect()] == ["O2"]


def test_sale_amount_is_rounded_half_up_and_dated(spark):
    row = silver.sales(frame(spark, schemas.BRONZE_SALES, [sale(quantity=3.0, price=0.335)])).first()
    assert (row.total_amount, row.order_date, row.is_valid) == (1.01, DAY.date(), True)


def test_returns_are_flagged_not_dropped(spark):
    sales = frame(spark, schemas.SILVER_SALES, [silver_sale("O1"), silver_sale("O1")])
    rows = [
        returned("good"),
        returned("size", reason="Wrong size"),
        returned("described", reason="Not as described"),
        returned("mind", reason="Changed mind"),
        returned("no reason", reason=None),
        returned("no order", order="O9"),
        returned("null order", order=None),
        returned("free", value=0.0),
        returned("negative", value=-1.0),
        returned("null value", value=None),
    ]
    result = silver.returns(frame(spark, schemas.BRONZE_RETURNS, rows), sales)
    assert {r.return_id: r.is_valid for r in result.collect()} == {
        "good": True,
        "size": True,
        "described": True,
        "mind": False,
        "no reason": False,
        "no order": False,
    }
    assert result.count() == 6, "two sale rows of one order must not double a return"


def test_order_whose_sales_were_all_dropped_is_unknown(spark):
    sales = silver.sales(frame(spark, schemas.BRONZE_SALES, [sale("O1", quantity=0.0)]))
    result = silver.returns(frame(spark, schemas.BRONZE_RETURNS, [returned()]), sales)
    assert [r.is_valid for r in result.collect()] == [False]


@pytest.mark.parametrize(
    "pct,start,end,valid,days",
    [
        (5.0, date(2024, 3, 1), date(2024, 3, 2), True, 1),
        (50.0, date(2024, 3, 1), date(2024, 3, 2), True, 1),
        (4.99, date(2024, 3, 1), date(2024, 3, 2), False, 1),
        (50.01, date(2024, 3, 1), date(2024, 3, 2), False, 1),
        (10.0, date(2024, 3, 1), date(2024, 3, 1), False, 0),
        (10.0, date(2024, 3, 4), date(2024, 3, 1), False, -3),
        (10.0, None, date(2024, 3, 1), False, None),
        (10.0, date(2024, 3, 1), None, False, None),
        (None, date(2024, 3, 1), date(2024, 3, 2), False, 1),
    ],
)
def test_promotions_are_flagged_not_dropped(spark, pct, start, end, valid, days):
    rows = frame(spark, schemas.BRONZE_PROMOTIONS, [promo(pct=pct, start=start, end=end)])
    row = silver.promotions(rows).first()
    assert (row.is_valid, row.duration_days) == (valid, days)


def test_malformed_date_text_raises(spark):
    raw = spark.createDataFrame([("2024-03-01", "not a date")], "start_date string, end_date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        bronze.promotions(raw).collect()


def test_customer_value_is_averaged_per_sale_row(spark):
    rows = [
        silver_sale("O1", amount=0.1, day=date(2024, 1, 2)),
        silver_sale("O1", amount=0.2, day=date(2024, 1, 1)),
        silver_sale("O2", amount=0.0, day=date(2024, 1, 9)),
    ]
    row = gold.customer_ltv(frame(spark, schemas.SILVER_SALES, rows)).first()
    assert (row.lifetime_value, row.total_orders, row.avg_order_value) == (0.3, 2, 0.1)
    assert (row.first_order_date, row.last_order_date) == (date(2024, 1, 1), date(2024, 1, 9))


def promo_revenue(spark, daily, promos):
    sales = frame(spark, schemas.SILVER_SALES, [silver_sale(day=d, amount=a) for d, a in daily])
    promotions = silver.promotions(frame(spark, schemas.BRONZE_PROMOTIONS, promos))
    rows = gold.promo_revenue(sales, promotions).collect()
    return {
        r.order_date.day: (r.revenue_with_promo, r.revenue_without_promo, r.uplift_pct)
        for r in rows
    }


def days(*numbers):
    return [(date(2024, 3, n), 100.0 * n) for n in numbers]


def test_promotion_days_include_both_ends_once(spark):
    overlapping = [promo(), promo(start=date(2024, 3, 2), end=date(2024, 3, 4))]
    result = promo_revenue(spark, days(1, 2, 4, 5, 7), overlapping)
    assert result == {
        1: (100.0, 600.0, -83.33),
        2: (200.0, 600.0, -66.67),
        4: (400.0, 600.0, -33.33),
    }


def test_reversed_and_invalid_promotions_cover_their_days(spark):
    reversed_dates = promo(pct=99.0, start=date(2024, 3, 2), end=date(2024, 3, 1))
    assert set(promo_revenue(spark, days(1, 2, 8), [reversed_dates])) == {1, 2}


def test_promotion_without_a_date_covers_nothing(spark):
    assert promo_revenue(spark, days(1), [promo(start=None), promo(end=None)]) == {}


def test_no_promotion_gives_no_rows(spark):
    assert promo_revenue(spark, days(1, 2), []) == {}


def test_no_uncovered_day_gives_null_baseline_and_no_uplift(spark):
    assert promo_revenue(spark, days(1, 2), [promo()]) == {
        1: (100.0, None, 0.0),
        2: (200.0, None, 0.0),
    }


def test_zero_baseline_gives_no_uplift(spark):
    daily = [(date(2024, 3, 1), 5.0), (date(2024, 3, 9), 0.0)]
    assert promo_revenue(spark, daily, [promo()]) == {1: (5.0, 0.0, 0.0)}


def test_days_without_a_date_count_for_the_baseline(spark):
    sales = frame(spark, schemas.SILVER_SALES, [silver_sale(day=date(2024, 3, 1), amount=50.0)])
    undated = sales.withColumn("order_date", F.lit(None).cast("date")).withColumn(
        "total_amount", F.lit(25.0)
    )
    promotions = silver.promotions(frame(spark, schemas.BRONZE_PROMOTIONS, [promo()]))
    rows = gold.promo_revenue(sales.unionByName(undated), promotions).collect()
    assert [(r.revenue_without_promo, r.uplift_pct) for r in rows] == [(25.0, 100.0)]


def test_return_rate_counts_rows_over_value(spark):
    sales = frame(
        spark,
        schemas.SILVER_SALES,
        [silver_sale(quantity=2.5), silver_sale(quantity=1.25), silver_sale(product="P2")],
    )
    returns = silver.returns(
        frame(
            spark,
            schemas.BRONZE_RETURNS,
            [
                returned(value=3.0),
                returned(value=5.0, reason="Changed mind"),
                returned(value=7.0, day=datetime(2024, 4, 1)),
                returned(value=7.0, product="P3"),
            ],
        ),
        sales,
    )
    rows = gold.return_rate_by_product(sales, returns).drop("_ingestion_time").collect()
    assert {tuple(r) for r in rows} == {
        ("P1", date(2024, 3, 1), 3, 2, 0.25, 8.0),
        ("P2", date(2024, 3, 1), 1, 0, 0.0, 0.0),
    }


def test_fractions_of_a_unit_add_up(spark):
    """Thirty tenths are three units; added as doubles they would be a little less, and cut to two."""
    sales = frame(spark, schemas.SILVER_SALES, [silver_sale(quantity=0.1)] * 30)
    returns = frame(spark, schemas.SILVER_RETURNS, [])
    assert gold.return_rate_by_product(sales, returns).first().sold_qty == 3


def test_every_layer_restamps(spark):
    old = frame(spark, schemas.BRONZE_SALES, [sale()]).withColumn(
        "_ingestion_time", F.lit("2000-01-01").cast("timestamp")
    )
    assert silver.sales(old).first()["_ingestion_time"].year > 2000

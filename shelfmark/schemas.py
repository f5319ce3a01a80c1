"""The ten tables: columns, types and partition granularity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class TableSpec:
    """A table of one layer; `partition` is (date column, "month" or "year") or None."""

    layer: str
    name: str
    schema: T.StructType
    partition: tuple[str, str] | None = None

    @property
    def partition_column(self) -> str | None:
        """Name of the derived partition column, such as order_date_month."""
        return "_".join(self.partition) if self.partition else None

    @property
    def raw_schema(self) -> T.StructType:
        """The columns a raw file carries: all but the audit stamp."""
        return T.StructType([f for f in self.schema if not f.name.startswith("_")])


def _spec(layer: str, name: str, columns: str, partition: tuple[str, str] | None = None):
    pairs = [c.split() for c in (columns + ", _ingestion_time timestamp").split(",")]
    schema = T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])
    return TableSpec(layer, name, schema, partition)


# The names, types and partition granularity of the published tables.
BRONZE_SALES = _spec(
    "bronze",
    "sales",
    "order_id string, customer_id string, product_id string, quantity double, price double,"
    " order_date timestamp",
    ("order_date", "month"),
)
BRONZE_RETURNS = _spec(
    "bronze",
    "returns",
    "return_id string, order_id string, customer_id string, product_id string,"
    " return_date timestamp, return_reason string, return_value double",
    ("return_date", "month"),
)
BRONZE_PROMOTIONS = _spec(
    "bronze",
    "promotions",
    "promo_id string, promo_name string, discount_pct double, start_date date, end_date date,"
    " target_segment string, status string",
    ("start_date", "year"),
)
SILVER_SALES = _spec(
    "silver",
    "sales",
    "order_id string, customer_id string, product_id string, quantity double, price double,"
    " total_amount double, order_date date, is_valid boolean",
    ("order_date", "month"),
)
SILVER_RETURNS = _spec(
    "silver",
    "returns",
    "return_id string, order_id string, customer_id string, product_id string, return_date date,"
    " return_reason string, return_value double, is_valid boolean",
    ("return_date", "month"),
)
SILVER_PROMOTIONS = _spec(
    "silver",
    "promotions",
    "promo_id string, promo_name string, discount_pct double, start_date date, end_date date,"
    " target_segment string, status string, duration_days int, is_valid boolean",
    ("start_date", "year"),
)
GOLD_CUSTOMER_LTV = _spec(
    "gold",
    "customer_ltv",
    "customer_id string, lifetime_value double, total_orders bigint, avg_order_value double,"
    " first_order_date date, last_order_date date",
)
GOLD_DAILY_SALES = _spec(
    "gold",
    "daily_sales",
    "order_date date, total_revenue double, total_orders bigint, avg_order_value double",
    ("order_date", "month"),
)
GOLD_PROMO_REVENUE = _spec(
    "gold",
    "promo_revenue",
    "order_date date, promo_id string, promo_name string, revenue_with_promo double,"
    " revenue_without_promo double, uplift_pct double",
    ("order_date", "month"),
)
GOLD_RETURN_RATE = _spec(
    "gold",
    "return_rate_by_product",
    "product_id string, return_month date, sold_qty bigint, returned_qty bigint,"
    " return_rate double, total_return_value double",
    ("return_month", "month"),
)

LAYERS = ("bronze", "silver", "gold")
TABLES = {
    f"{spec.layer}.{spec.name}": spec
    for spec in (
        BRONZE_SALES,
        BRONZE_RETURNS,
        BRONZE_PROMOTIONS,
        SILVER_SALES,
        SILVER_RETURNS,
        SILVER_PROMOTIONS,
        GOLD_CUSTOMER_LTV,
        GOLD_DAILY_SALES,
        GOLD_PROMO_REVENUE,
        GOLD_RETURN_RATE,
    )
}

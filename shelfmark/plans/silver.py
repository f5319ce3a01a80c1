"""Bronze rows to cleaned and flagged silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.audit import stamped
from shelfmark.functions.dates import days_between
from shelfmark.operators.existence import existence_flag

# The reasons and discounts that make a row valid.
VALID_REASONS = ("Defective", "Wrong size", "Not as described")
MIN_DISCOUNT, MAX_DISCOUNT = 5, 50


def sales(bronze: DataFrame) -> DataFrame:
    """Rows with a positive quantity and price (a NULL drops the row), with their amount."""
    kept = bronze.where((F.col("quantity") > 0) & (F.col("price") > 0))
    return stamped(
        kept.withColumns(
            {
                "total_amount": F.round(F.col("quantity") * F.col("price"), 2),
                "order_date": F.to_date("order_date"),
                "is_valid": F.lit(True),
            }
        )
    ).select(schemas.SILVER_SALES.schema.names)


def returns(bronze: DataFrame, silver_sales: DataFrame) -> DataFrame:
    """Returns with a value and an order id; valid if silver has the order and the reason counts.

    Invalid returns are flagged, not dropped.
    """
    kept = bronze.where((F.col("return_value") > 0) & F.col("order_id").isNotNull())
    checked = existence_flag(kept, silver_sales, on="order_id", flag="_order_known")
    valid = F.col("_order_known") & F.col("return_reason").isin(*VALID_REASONS)
    return stamped(
        checked.withColumns(
            {
                "return_date": F.to_date("return_date"),
                "is_valid": F.coalesce(valid, F.lit(False)),
            }
        )
    ).select(schemas.SILVER_RETURNS.schema.names)


def promotions(bronze: DataFrame) -> DataFrame:
    """All promotions; valid if start is before end and the discount is in range."""
    dated = bronze.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    valid = (F.col("start_date") < F.col("end_date")) & F.col("discount_pct").between(
        MIN_DISCOUNT, MAX_DISCOUNT
    )
    return stamped(
        dated.withColumns(
            {
                "duration_days": days_between("start_date", "end_date"),
                "is_valid": F.coalesce(valid, F.lit(False)),
            }
        )
    ).select(schemas.SILVER_PROMOTIONS.schema.names)

"""The queries of `queries.py` in plain SQL (DuckDB) over the supplied tables.

Money is summed as whole cents, as in the Spark plans, so that both sides are exact.
"""

from __future__ import annotations

import re



def _round(value: str, places: int) -> str:
    """Half up on the decimal digits of the double, as Spark rounds; DuckDB's own rounding of
    doubles multiplies first, which moves some ties."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


# Named steps; a query uses the ones it mentions, and those they mention.
_STEPS = {
    "bronze_sales": """
        SELECT concat('ORD_', l_orderkey) AS order_id, concat('CUST_', o_custkey) AS customer_id,
               concat('PROD_', l_partkey) AS product_id, l_quantity - 1 AS quantity,
               p_retailprice AS price, o_orderdate AS order_date
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey""",
    "bronze_returns": """
        SELECT concat('RET_', l_orderkey, '_', l_linenumber) AS return_id,
               CASE WHEN l_orderkey % 89 = 0 THEN NULL
                    WHEN l_orderkey % 97 = 0 THEN concat('MISSING_', l_orderkey)
                    ELSE concat('ORD_', l_orderkey) END AS order_id,
               concat('CUST_', o_custkey) AS customer_id,
               concat('PROD_', l_partkey) AS product_id,
               CAST(CAST(o_orderdate AS DATE) + CAST(1 + 4 * l_linenumber AS INTEGER) AS TIMESTAMP)
                   AS return_date,
               CASE l_suppkey % 6 WHEN 0 THEN 'Defective' WHEN 1 THEN 'Wrong size'
                    WHEN 2 THEN 'Not as described' WHEN 3 THEN 'Changed mind'
                    WHEN 4 THEN 'Arrived late' END AS return_reason,
               CASE WHEN l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END
                   AS return_value
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R'""",
    "promo_starts": """
        SELECT *, DATE '1995-02-01' + CAST(60 * p_partkey % 3600 AS INTEGER) AS start_date
        FROM part""",
    "bronze_promotions": """
        SELECT concat('PROMO_', p_partkey) AS promo_id, p_name AS promo_name,
               CAST(p_size AS DOUBLE) AS discount_pct, start_date,
               start_date + (p_size - 4) AS end_date, p_type AS target_segment,
               CASE WHEN p_partkey % 2 = 0 THEN 'Expired' ELSE 'Active' END AS status
        FROM promo_starts""",
    "silver_sales": f"""
        SELECT order_id, customer_id, product_id, quantity, price,
               {_round("quantity * price", 2)} AS total_amount,
               CAST(order_date AS DATE) AS order_date, true AS is_valid
        FROM bronze_sales
        WHERE quantity > 0 AND price > 0""",
    "sale_cents": """
        SELECT *, CAST(round(total_amount * 100) AS BIGINT) AS cents FROM silver_sales""",
    "known_orders": "SELECT DISTINCT order_id AS known_id FROM silver_sales",
    "silver_returns": """
        SELECT return_id, order_id, customer_id, product_id,
               CAST(return_date AS DATE) AS return_date, return_reason, return_value,
               known_id IS NOT NULL AND coalesce(
                   return_reason IN ('Defective', 'Wrong size', 'Not as described'), false
               ) AS is_valid
        FROM bronze_returns
        LEFT JOIN known_orders ON order_id = known_id
        WHERE return_value > 0 AND order_id IS NOT NULL""",
    "silver_promotions": """
        SELECT *, CAST(date_diff('day', start_date, end_date) AS INTEGER) AS duration_days,
               coalesce(start_date < end_date AND discount_pct BETWEEN 5 AND 50, false) AS is_valid
        FROM bronze_promotions""",
    "promo_span": """
        SELECT promo_id, start_date, end_date,
               unnest(generate_series(least(start_date, end_date), greatest(start_date, end_date),
                                      INTERVAL 1 DAY)) AS spanned
        FROM bronze_promotions""",
    "promo_days": "SELECT DISTINCT CAST(spanned AS DATE) AS promo_date FROM promo_span",
    "daily_cents": """
        SELECT order_date, sum(cents) AS cents FROM sale_cents GROUP BY order_date""",
    "daily": "SELECT order_date, CAST(cents AS BIGINT) / 100 AS daily_revenue FROM daily_cents",
    "daily_cover": """
        SELECT order_date, cents, promo_date
        FROM daily_cents LEFT JOIN promo_days ON order_date = promo_date""",
    "baseline": """
        SELECT CAST(sum(cents) AS BIGINT) / 100 / count(*) AS base
        FROM daily_cover WHERE promo_date IS NULL""",
    "gold_daily_sales": """
        SELECT order_date, CAST(sum(cents) AS BIGINT) / 100 AS total_revenue,
               count(DISTINCT order_id) AS total_orders,
               CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100
                   AS avg_order_value
        FROM sale_cents GROUP BY order_date""",
    "sold_by_month": """
        SELECT product_id, CAST(date_trunc('month', order_date) AS DATE) AS month,
               CAST(sum(quantity) AS BIGINT) AS sold_qty
        FROM silver_sales GROUP BY 1, 2""",
    "returned_by_month": """
        SELECT product_id, CAST(date_trunc('month', return_date) AS DATE) AS month,
               count(*) AS returned_qty,
               CAST(sum(CAST(round(return_value * 100) AS BIGINT)) AS BIGINT) / 100
                   AS total_return_value
        FROM bronze_returns GROUP BY 1, 2""",
    "silver_returned_by_month": """
        SELECT product_id, CAST(date_trunc('month', return_date) AS DATE) AS month,
               count(*) AS returned_qty,
               CAST(sum(CAST(round(return_value * 100) AS BIGINT)) AS BIGINT) / 100
                   AS total_return_value
        FROM silver_returns GROUP BY 1, 2""",
    "clicks": """
        SELECT concat('EV_', event_id) AS event_id, concat('USER_', user_id) AS user_id,
               concat('S_', user_id, '_', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
               concat('https://shop.example/', CASE event_id % 4 WHEN 0 THEN 'home'
                   WHEN 1 THEN 'product' WHEN 2 THEN 'cart' ELSE 'checkout' END) AS page_url,
               event_type, date_trunc('millisecond', ts) AS event_time,
               CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet'
                   END AS device_type
        FROM events""",
    "offers": """
        SELECT concat('OFF_', event_id) AS offer_id, concat('USER_', user_id) AS user_id,
               concat('PROMO_', event_id % 20) AS promo_id,
               CAST(10 + event_id % 40 AS DOUBLE) AS discount_pct,
               date_trunc('millisecond', ts) AS offer_time,
               CASE event_id % 5 WHEN 0 THEN 'sent' WHEN 1 THEN 'viewed' WHEN 2 THEN 'accepted'
                   WHEN 3 THEN 'expired' ELSE 'unknown' END AS status
        FROM events""",
}

_QUERIES = {
    # the ten jobs
    "bronze_sales": "SELECT * FROM bronze_sales",
    "bronze_returns": "SELECT * FROM bronze_returns",
    "bronze_promotions": "SELECT * FROM bronze_promotions",
    "silver_sales": "SELECT * FROM silver_sales",
    "silver_returns": "SELECT * FROM silver_returns",
    "silver_promotions": "SELECT * FROM silver_promotions",
    "gold_customer_ltv": """
        SELECT customer_id, CAST(sum(cents) AS BIGINT) / 100 AS lifetime_value,
               count(DISTINCT order_id) AS total_orders,
               CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100
                   AS avg_order_value,
               min(order_date) AS first_order_date, max(order_date) AS last_order_date
        FROM sale_cents GROUP BY customer_id""",
    "gold_daily_sales": "SELECT * FROM gold_daily_sales",
    "gold_promo_revenue": f"""
        SELECT order_date, 'Multiple/Overlapping' AS promo_id, 'Active Promos' AS promo_name,
               CAST(cents AS BIGINT) / 100 AS revenue_with_promo, base AS revenue_without_promo,
               CASE WHEN base > 0
                    THEN {_round("(CAST(cents AS BIGINT) / 100 - base) / base * 100", 2)}
                    ELSE 0.0::DOUBLE END AS uplift_pct
        FROM daily_cover, baseline WHERE promo_date IS NOT NULL""",
    "gold_return_rate_by_product": f"""
        SELECT product_id, month AS return_month, sold_qty,
               coalesce(returned_qty, 0) AS returned_qty,
               CASE WHEN total_return_value <> 0
                    THEN {_round("returned_qty / total_return_value", 4)}
                    ELSE 0.0::DOUBLE END AS return_rate,
               coalesce(total_return_value, 0) AS total_return_value
        FROM sold_by_month LEFT JOIN silver_returned_by_month USING (product_id, month)""",
    # scans, sinks, tables
    "scan_csv_dir": "SELECT * FROM bronze_returns",
    "scan_csv_infer": "SELECT * FROM bronze_sales",
    "scan_csv_glob": "SELECT * FROM bronze_sales",
    "scan_table": "SELECT * FROM silver_sales",
    "ddl_namespace": """
        SELECT 'bronze' AS namespace, count(*) AS n_rows FROM bronze_sales
        UNION ALL SELECT 'silver', count(*) FROM silver_sales
        UNION ALL SELECT 'gold', count(*) FROM gold_daily_sales""",
    "ddl_table": "SELECT * FROM silver_promotions",
    "partition_month": """
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS n_rows,
               min(order_date) AS first_date, max(order_date) AS last_date
        FROM silver_sales GROUP BY 1""",
    "partition_year": """
        SELECT CAST(date_trunc('year', start_date) AS DATE) AS year, count(*) AS n_rows,
               min(start_date) AS first_date
        FROM silver_promotions GROUP BY 1""",
    "sink_append": """
        SELECT order_id, 2 * count(*) AS n_rows, 2 * sum(quantity) AS quantity
        FROM bronze_sales GROUP BY order_id""",
    "sink_overwrite": "SELECT * FROM gold_daily_sales",
    "sink_cast": """
        SELECT product_id, month AS return_month, CAST(trunc(sold_qty / 4) AS BIGINT) AS sold_qty,
               0::BIGINT AS returned_qty, 1::DOUBLE AS return_rate,
               CAST(sold_qty AS DOUBLE) AS total_return_value
        FROM sold_by_month""",
    "row_count": """
        SELECT 'sales' AS table_name, count(*) AS written_rows, count(*) AS stored_rows
        FROM bronze_sales
        UNION ALL SELECT 'returns', count(*), count(*) FROM bronze_returns
        UNION ALL SELECT 'promotions', count(*), count(*) FROM bronze_promotions""",
    "audit_timestamp": """
        SELECT order_id, count(*) AS n_rows, count(*) AS n_stamped, true AS one_time
        FROM bronze_sales GROUP BY order_id""",
    # projections, filters, predicates
    "project_select": "SELECT product_id, order_id, price, quantity FROM bronze_sales",
    "project_derive": f"""
        SELECT order_id, customer_id, product_id, quantity, price,
               CAST(order_date AS DATE) AS order_date,
               {_round("quantity * price", 2)} AS total_amount
        FROM bronze_sales""",
    "project_literal": """
        SELECT order_date, 'Multiple/Overlapping' AS promo_id, 'Active Promos' AS promo_name,
               true AS is_valid, 0.0::DOUBLE AS uplift_pct
        FROM daily""",
    "project_alias": """
        SELECT r.product_id AS returned_product, s.product_id AS sold_product, r.month,
               r.returned_qty, s.sold_qty
        FROM returned_by_month r
        LEFT JOIN sold_by_month s ON r.product_id = s.product_id AND r.month = s.month""",
    "filter_compare_and": "SELECT * FROM bronze_sales WHERE quantity > 0 AND price > 0",
    "filter_positive": "SELECT * FROM bronze_returns WHERE return_value > 0",
    "filter_not_null": """
        SELECT *, return_reason IS NOT NULL AS has_reason
        FROM bronze_returns WHERE order_id IS NOT NULL""",
    "pred_isin": """
        SELECT * FROM bronze_returns
        WHERE return_reason IN ('Defective', 'Wrong size', 'Not as described')""",
    "pred_between": "SELECT * FROM bronze_promotions WHERE discount_pct BETWEEN 5 AND 50",
    "pred_column_compare": "SELECT * FROM bronze_promotions WHERE start_date < end_date",
    "pred_not_equal": "SELECT * FROM bronze_returns WHERE return_value <> 0",
    "case_when": """
        SELECT return_id, return_reason,
               CASE WHEN return_reason IN ('Defective', 'Wrong size', 'Not as described')
                    THEN true ELSE false END AS reason_counts,
               CASE WHEN return_value > 20000 THEN 'high' WHEN return_value > 0 THEN 'low'
                    ELSE 'none' END AS value_class
        FROM bronze_returns""",
    "fill_null": """
        SELECT product_id, month, sold_qty, coalesce(returned_qty, 0) AS returned_qty,
               coalesce(total_return_value, 0) AS total_return_value
        FROM sold_by_month LEFT JOIN returned_by_month USING (product_id, month)""",
    # joins
    "join_left_using": """
        SELECT return_id, order_id, o_orderkey IS NOT NULL AS order_found, o_orderpriority
        FROM bronze_returns LEFT JOIN orders ON order_id = concat('ORD_', o_orderkey)""",
    "join_left_multikey": """
        SELECT product_id, month, sold_qty, returned_qty, total_return_value
        FROM sold_by_month LEFT JOIN returned_by_month USING (product_id, month)""",
    "join_left_anti": """
        SELECT order_date, daily_revenue FROM daily
        WHERE NOT EXISTS (SELECT 1 FROM promo_days WHERE promo_date = order_date)""",
    "join_inner": """
        SELECT order_date, daily_revenue, promo_date
        FROM daily JOIN promo_days ON order_date = promo_date""",
    "join_existence_flag": """
        SELECT *, EXISTS (SELECT 1 FROM known_orders WHERE known_id = r.order_id) AS order_known
        FROM bronze_returns r""",
    "scalar_broadcast": """
        SELECT order_date, daily_revenue,
               (SELECT CAST(sum(cents) AS BIGINT) / 100 / count(*) FROM daily_cents) AS mean_day
        FROM daily""",
    "interval_cover_join": """
        SELECT order_date, promo_date IS NOT NULL AS covered FROM daily_cover""",
    # aggregations
    "agg_sum": """
        SELECT product_id, CAST(sum(cents) AS BIGINT) / 100 AS revenue, sum(quantity) AS quantity
        FROM sale_cents GROUP BY product_id""",
    "agg_count_star": """
        SELECT return_reason, count(*) AS returned_qty FROM bronze_returns GROUP BY return_reason""",
    "agg_count_distinct": """
        SELECT product_id, count(DISTINCT order_id) AS total_orders
        FROM silver_sales GROUP BY product_id""",
    "agg_avg_round": """
        SELECT product_id, CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100
                   AS avg_order_value
        FROM sale_cents GROUP BY product_id""",
    "agg_min_max": """
        SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date
        FROM silver_sales GROUP BY customer_id""",
    "agg_global_avg": """
        SELECT CAST(sum(cents) AS BIGINT) / 100 / count(*) AS avg_amount FROM sale_cents""",
    "group_single_key": """
        SELECT customer_id, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) / 100 AS revenue
        FROM sale_cents GROUP BY customer_id""",
    "group_multi_key": "SELECT * FROM sold_by_month",
    "agg_two_level": """
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
               CAST(sum(cents) AS BIGINT) / 100 / count(*) AS mean_day, count(*) AS n_days
        FROM daily_cents GROUP BY 1""",
    # set operations
    "distinct_keys": "SELECT DISTINCT order_id FROM silver_sales",
    "distinct_days": "SELECT promo_date FROM promo_days",
    "union_files": """
        SELECT * FROM bronze_sales WHERE price < 1000
        UNION ALL SELECT * FROM bronze_sales WHERE NOT price < 1000""",
    # scalar functions
    "fn_to_date": """
        SELECT return_id, CAST(return_date AS DATE) AS from_timestamp,
               CAST(strftime(return_date, '%Y-%m-%d') AS DATE) AS from_text
        FROM bronze_returns""",
    "fn_datediff": "SELECT promo_id, duration_days FROM silver_promotions",
    "fn_trunc_month": """
        SELECT return_id, CAST(date_trunc('month', return_date) AS DATE) AS return_month
        FROM bronze_returns""",
    "fn_sequence": """
        SELECT promo_id, CAST(count(*) AS INTEGER) AS n_days, start_date AS first_day,
               end_date AS last_day
        FROM promo_span GROUP BY promo_id, start_date, end_date""",
    "fn_explode": "SELECT promo_id, CAST(spanned AS DATE) AS day FROM promo_span",
    "fn_round": f"""
        SELECT order_id, product_id, {_round("quantity * price", 2)} AS two_places,
               {_round("quantity / price", 4)} AS four_places
        FROM bronze_sales""",
    "fn_arith_mul": "SELECT order_id, product_id, quantity * price AS amount FROM bronze_sales",
    "fn_pct_change": f"""
        SELECT order_date,
               {_round("(daily_revenue - 100000::DOUBLE) / 100000::DOUBLE * 100", 2)} AS pct,
               0.0::DOUBLE AS pct_of_nothing
        FROM daily""",
    "fn_safe_ratio": f"""
        SELECT product_id, month,
               CASE WHEN total_return_value <> 0
                    THEN {_round("returned_qty / total_return_value", 4)}
                    ELSE 0.0::DOUBLE END AS return_rate
        FROM returned_by_month""",
    # streams and sampling
    "stream_clickstream_bronze": """
        SELECT * FROM clicks WHERE event_type IN ('view', 'click', 'add_to_cart', 'purchase')""",
    "stream_offers_bronze": """
        SELECT * FROM offers WHERE status IN ('sent', 'viewed', 'accepted', 'expired')""",
    "stream_contract_check": """
        SELECT 'clickstream' AS topic, event_id AS message_id, event_type AS value,
               'event_type' AS rejected_for
        FROM clicks WHERE event_type NOT IN ('view', 'click', 'add_to_cart', 'purchase')
        UNION ALL
        SELECT 'offers', offer_id, status, 'status'
        FROM offers WHERE status NOT IN ('sent', 'viewed', 'accepted', 'expired')""",
    "stream_event_millis": """
        SELECT offer_id, epoch_ms(offer_time) AS millis, offer_time FROM offers""",
    "sample_exact": """
        SELECT order_id, customer_id, product_id, quantity, price, order_date
        FROM (SELECT *, concat('{"order_id":"', order_id, '","customer_id":"', customer_id,
                               '","product_id":"', product_id, '","quantity":', quantity,
                               ',"price":', price, ',"order_date":"',
                               strftime(order_date, '%Y-%m-%dT%H:%M:%S.000Z'), '"}') AS row_text
              FROM bronze_sales)
        ORDER BY md5(concat(order_id, '|999')), order_id, md5(row_text), row_text
        LIMIT (SELECT greatest(1, CAST(floor(count(*) * 0.08::DOUBLE) AS BIGINT)) FROM lineitem)""",
}


def _mentioned(sql: str) -> list[str]:
    """Steps that the SQL reads from, in the order they are defined."""
    names = set(re.findall(r"\w+", sql))
    return [name for name in _STEPS if name in names]


def _with_steps(sql: str) -> str:
    needed: set[str] = set()
    pending = _mentioned(sql)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += _mentioned(_STEPS[name])
    steps = ", ".join(f"{name} AS ({_STEPS[name]})" for name in _STEPS if name in needed)
    return f"WITH {steps} {sql}" if steps else sql


ORACLE = {key: _with_steps(sql) for key, sql in _QUERIES.items()}

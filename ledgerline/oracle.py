"""Independent DuckDB SQL for every registered query.

Each string runs on the driver's tables (``customer``, ``part``, ``orders``,
``lineitem``, ``events`` registered as views) and restates, in plain SQL, the
order-model mapping, the layer transforms and the query.  Exactness choices
shared with the Spark side:

* money sums are exact decimals cast to double at the end;
* ``round(double, 2)`` is HALF_UP on the shortest decimal form of the double
  (what Spark does), written as a cast through text and decimal;
* averages that are rounded are computed on whole cents with integer
  arithmetic (HALF_UP), since DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import datetime as dt

from ledgerline.functions.constants import STATUS_MASTER

AS_OF = dt.date(1998, 9, 1)
SINCE = dt.date(1998, 7, 1)
ORDERS_AS_OF = dt.datetime(1998, 7, 1)
EVENTS_AS_OF = dt.datetime(2024, 1, 15)


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def _ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def round2(expr: str) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(28,14)), 2) AS DOUBLE)"


def cents(expr: str) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(28,14)) * 100) AS HUGEINT)"


def avg_cents_half_up(sum_cents: str, n: str) -> str:
    """round(sum/n, 2) HALF_UP for non-negative sums, as double."""
    return f"CAST(((2 * ({sum_cents}) + ({n})) // (2 * ({n}))) AS DOUBLE) / 100.0"


ITEM_STATUS = ("CASE WHEN l_returnflag = 'R' THEN 'Cancelled' WHEN l_returnflag = 'N' "
               "THEN 'Initial' WHEN l_linestatus = 'O' THEN 'Shipped' ELSE 'Delivered' END")
ORDER_STATUS = ("CASE WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'P' "
                "THEN 'Cancelled' WHEN o_orderpriority = '5-LOW' THEN 'Initial' "
                "ELSE 'In-Progress' END")

BASE = {
    "customers_raw": """
        SELECT c_custkey AS customer_id, 'Customer' AS first_name,
               string_split(c_name, '#')[-1] AS last_name,
               CASE WHEN c_custkey % 50 = 0 THEN NULL
                    WHEN c_custkey % 50 = 1 THEN 'customer' || string_split(c_name, '#')[-1] || '.example.com'
                    ELSE 'customer' || string_split(c_name, '#')[-1] || '@example.com' END AS email,
               CAST(c_nationkey * 1000 + c_custkey % 1000 AS INTEGER) AS zipcode,
               CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
               CASE WHEN c_acctbal < 0 THEN TIMESTAMP '1999-01-01 00:00:00' END AS deleted_at
        FROM customer""",
    "products_raw": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_sku, p_name AS product_name,
               p_type AS category,
               CASE WHEN p_partkey % 40 = 0 THEN -p_retailprice
                    WHEN p_partkey % 40 = 1 THEN NULL ELSE p_retailprice END AS price,
               CAST(p_size * 10 AS INTEGER) AS stock_quantity,
               DATE '1994-01-01' AS created_at,
               CASE WHEN p_size > 45 THEN DATE '1999-01-01' END AS deleted_at
        FROM part""",
    "orders_raw": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered_at,
               {ORDER_STATUS} AS order_status,
               o_totalprice AS subtotal_amount, CAST(0.0 AS DOUBLE) AS tax_amount,
               CAST(0.0 AS DOUBLE) AS shipping_fee, o_totalprice AS total_amount,
               o_orderdate AS updated_at,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders""",
    "items_raw": f"""
        SELECT l_orderkey * 100 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               CAST(l_partkey AS VARCHAR) AS product_sku,
               CAST(trunc(l_quantity) AS INTEGER) AS quantity,
               l_extendedprice * l_discount AS discount_applied,
               l_extendedprice AS line_amount,
               {ITEM_STATUS} AS item_status,
               l_shipdate AS updated_at,
               CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(month(l_shipdate) AS INTEGER) AS month
        FROM lineitem""",
    "status_raw": """
        SELECT type, status, CAST(code AS INTEGER) AS "order" FROM (
          SELECT DISTINCT 'order' AS type, order_status AS status FROM orders_raw
          UNION SELECT DISTINCT 'item', item_status FROM items_raw) u
        LEFT JOIN (VALUES """ + ", ".join(
            f"('{k}', '{s}', {c})" for k, s, c in STATUS_MASTER) + """) AS m(mt, ms, code)
          ON u.type = m.mt AND u.status = m.ms""",
    "silver_products": "SELECT * EXCLUDE (deleted_at), deleted_at IS NULL AS active FROM products_raw",
    "silver_customers": "SELECT * EXCLUDE (deleted_at), deleted_at IS NULL AS active FROM customers_raw",
    "silver_orders": """
        SELECT *, CAST(year(ordered_at) AS INTEGER) AS order_year,
               CAST(month(ordered_at) AS INTEGER) AS order_month,
               CAST(day(ordered_at) AS INTEGER) AS order_day
        FROM orders_raw""",
    "silver_items": """
        SELECT * EXCLUDE (discount_applied), coalesce(discount_applied > 0, false) AS discounted
        FROM items_raw""",
    "dim_products": """
        SELECT product_sku, product_name, category, price FROM silver_products WHERE active""",
    "dim_customers": """
        SELECT customer_id, last_name || ', ' || first_name AS customer_name, email, created_at
        FROM silver_customers WHERE active""",
    "fact_orders": """
        SELECT order_id, customer_id, CAST(ordered_at AS DATE) AS order_date, order_status,
               total_amount, updated_at, order_year, order_month, order_day
        FROM silver_orders WHERE order_status != 'Cancelled'""",
    "fact_items": f"""
        SELECT order_item_id, order_id, product_sku, quantity,
               {round2('line_amount / quantity')} AS unit_price, item_status, updated_at
        FROM silver_items""",
    "pipeline_dim_products": """
        SELECT * FROM dim_products WHERE product_sku IS NOT NULL AND coalesce(price >= 0, false)""",
    "pipeline_dim_customers": """
        SELECT * FROM dim_customers
        WHERE customer_id IS NOT NULL AND coalesce(email IS NOT NULL AND email LIKE '%@%', false)""",
    "shipped": """
        SELECT l_orderkey AS order_id, l_shipdate AS updated_at, max(l_linestatus) AS ls
        FROM lineitem GROUP BY 1, 2""",
    "order_feed_raw": """
        SELECT order_id, customer_id, ordered_at, 'Initial' AS order_status, subtotal_amount,
               tax_amount, shipping_fee, total_amount, updated_at FROM orders_raw
        UNION ALL
        SELECT s.order_id, o.customer_id, o.ordered_at,
               CASE WHEN o.order_status = 'Cancelled' THEN 'Cancelled'
                    WHEN s.ls = 'O' THEN 'In-Progress' ELSE 'Complete' END,
               o.subtotal_amount, o.tax_amount, o.shipping_fee, o.total_amount, s.updated_at
        FROM shipped s JOIN orders_raw o ON s.order_id = o.order_id""",
    "stage_orders": """
        SELECT order_id, customer_id, CAST(ordered_at AS DATE) AS order_date, order_status,
               total_amount, updated_at, CAST(year(ordered_at) AS INTEGER) AS order_year,
               CAST(month(ordered_at) AS INTEGER) AS order_month,
               CAST(day(ordered_at) AS INTEGER) AS order_day
        FROM order_feed_raw WHERE order_status != 'Cancelled'""",
    "stage_items": "SELECT * FROM fact_items",
}
BASE_ORDER = list(BASE)


def scd2_sql(name: str, src: str, keys: list[str], seq: str, columns: list[str],
             tracked: list[str]) -> dict[str, str]:
    """CTEs computing the version history of ``src`` (columns in Spark order)."""
    k = ", ".join(keys)
    others = [c for c in columns if c not in keys and c != seq]
    tie = ", ".join(f"{c} DESC NULLS LAST" for c in others)
    same = " AND ".join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c}" for c in tracked)
    cols = ", ".join(columns)
    return {
        f"{name}_d": f"""
            SELECT {cols} FROM {src} WHERE {seq} IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY {k}, {seq} ORDER BY {tie}) = 1""",
        f"{name}_c": f"""
            SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1 WHEN {same} THEN 0 ELSE 1 END AS _chg
            FROM {name}_d WINDOW w AS (PARTITION BY {k} ORDER BY {seq})""",
        f"{name}_g": f"""
            SELECT *, sum(_chg) OVER (PARTITION BY {k} ORDER BY {seq} ROWS UNBOUNDED PRECEDING) AS _vid
            FROM {name}_c""",
        f"{name}_v": f"""
            SELECT {cols}, min({seq}) OVER (PARTITION BY {k}, _vid) AS __START_AT FROM {name}_g
            QUALIFY row_number() OVER (PARTITION BY {k}, _vid ORDER BY {seq} DESC) = 1""",
        name: f"""
            SELECT *, lead(__START_AT) OVER (PARTITION BY {k} ORDER BY __START_AT) AS __END_AT,
                   lead(__START_AT) OVER (PARTITION BY {k} ORDER BY __START_AT) IS NULL AS __CURRENT
            FROM {name}_v""",
    }


ORDER_STAGE_COLS = ["order_id", "customer_id", "order_date", "order_status", "total_amount",
                    "updated_at", "order_year", "order_month", "order_day"]
ITEM_STAGE_COLS = ["order_item_id", "order_id", "product_sku", "quantity", "unit_price",
                   "item_status", "updated_at"]
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

HISTORY = {}
HISTORY.update(scd2_sql("h_orders", "stage_orders", ["order_id"], "updated_at",
                        ORDER_STAGE_COLS, ["order_status", "total_amount"]))
HISTORY.update(scd2_sql("h_items", "stage_items", ["order_item_id"], "updated_at",
                        ITEM_STAGE_COLS, ["item_status", "quantity", "unit_price"]))
HISTORY.update(scd2_sql("h_events", "events", ["user_id"], "ts", EVENT_COLS, ["event_type"]))


def with_ctes(body: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every CTE it (transitively) needs."""
    allc = dict(BASE)
    allc.update(HISTORY)
    allc.update(ctes or {})
    order = list(allc)
    import re
    needed: list[str] = []

    def visit(text: str):
        for name in order:
            if name in needed:
                continue
            if re.search(rf"\b{re.escape(name)}\b", text):
                needed.append(name)
                visit(allc[name])
    visit(body)
    ordered = [n for n in order if n in needed]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({allc[n]})" for n in ordered) + "\n" + body

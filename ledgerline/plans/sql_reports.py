"""The reports as Spark SQL over named views (or catalog tables).

``register_views`` exposes the layers of a ``Lakehouse`` as temporary views
(lazy: nothing is computed until a query runs); ``report_sql`` renders the SQL
text of a report for given table names and report date, and ``run_report``
executes it.  Catalyst plans the SQL like the DataFrame version in
``operators.reports``: the CTE is inlined, and the previous calendar month is
written as constant expressions on the partition columns, which fold to
literals and prune partitions (no one-row parameter relation to cross join).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "gold_dim_customers": "dim_customers",
    "gold_dim_products": "dim_products",
    "gold_fact_orders": "fact_orders",
    "gold_fact_order_items": "fact_order_items",
    "pipeline_dim_customers": "pipeline_dim_customers",
    "pipeline_dim_products": "pipeline_dim_products",
    "history_fact_orders": "history_orders",
    "history_fact_order_items": "history_order_items",
}

PLAIN = {"items": "gold_fact_order_items", "orders": "gold_fact_orders",
         "products": "gold_dim_products"}
HISTORY = {"items": "history_fact_order_items", "orders": "history_fact_orders",
           "products": "pipeline_dim_products"}


def register_views(lakehouse, views=None) -> list[str]:
    """Create or replace temp views of the layer tables; return their names.

    ``views`` selects view names (default: all).  Building a history view
    plans its hot-key split (a sampling job), so register only what a query
    reads.
    """
    out = []
    for view in (views or VIEWS):
        getattr(lakehouse, VIEWS[view]).createOrReplaceTempView(view)
        out.append(view)
    return out


# Materialized table path (``Lakehouse.materialize`` name) -> view name.
TABLE_VIEWS = {
    "gold/dim_customers": "gold_dim_customers",
    "gold/dim_products": "gold_dim_products",
    "gold/fact_orders": "gold_fact_orders",
    "gold/fact_order_items": "gold_fact_order_items",
    "pipeline/dim_customers": "pipeline_dim_customers",
    "pipeline/dim_products": "pipeline_dim_products",
    "pipeline/fact_orders": "history_fact_orders",
    "pipeline/fact_order_items": "history_fact_order_items",
}


def register_table_views(spark: SparkSession, paths: dict[str, str],
                         fmt: str = "parquet") -> list[str]:
    """Views over written tables (the table hand-off): reports then scan the
    stored files, with partition pruning on the partitioned order facts."""
    out = []
    for name, path in paths.items():
        if name in TABLE_VIEWS:
            spark.read.format(fmt).load(path).createOrReplaceTempView(TABLE_VIEWS[name])
            out.append(TABLE_VIEWS[name])
    return out


def _window(kind: str, as_of: dt.date, days: int) -> tuple[str, str, str]:
    """(extra CTE, extra FROM item, order predicate) for the time window."""
    d = f"DATE'{as_of.isoformat()}'"
    if kind == "rolling":
        start = f"date_sub({d}, {days})"
        # the same window stated on the calendar partition columns (redundant
        # for the result, lets partitioned tables skip other months)
        months = (f"o.order_year * 100 + o.order_month BETWEEN "
                  f"year({start}) * 100 + month({start}) AND year({d}) * 100 + month({d})")
        return "", "", f"o.order_date >= {start} AND o.order_date < {d} AND {months}"
    if kind == "month":
        # constant expressions (folded to literals): partition pruning on the
        # order calendar columns without joining a one-row parameter relation
        return "", "", (f"o.order_year = year(add_months({d}, -1)) "
                        f"AND o.order_month = month(add_months({d}, -1))")
    raise ValueError(kind)


def _text(value: str) -> str:
    """A SQL string literal of any text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def report_sql(report: str, as_of: dt.date, window: str = "rolling", days: int = 30,
               tables: dict[str, str] | None = None, top: int = 10,
               current_only: bool = False, with_avg_price: bool = False,
               sold_status: str | None = None) -> str:
    """SQL text of ``report`` in {'top', 'category'}.

    ``current_only`` adds the ``__CURRENT`` filters of history tables;
    ``sold_status`` counts only items of that status (default: all but
    Cancelled).
    """
    t = dict(PLAIN if not current_only else HISTORY)
    t.update(tables or {})
    cte, cross, pred = _window(window, as_of, days)
    item_pred = (f"i.item_status = {_text(sold_status)}" if sold_status
                 else "i.item_status <> 'Cancelled'")
    current = " AND i.__CURRENT AND o.__CURRENT" if current_only else ""
    sold = f"""WITH {cte}sold AS (
    SELECT i.product_sku,
           SUM(i.quantity) AS quantity,
           COUNT(DISTINCT i.order_id) AS orders,
           SUM(CAST(i.quantity AS DECIMAL(12,0)) * CAST(i.unit_price AS DECIMAL(18,2))) AS revenue,
           SUM(CAST(i.unit_price AS DECIMAL(18,2))) / COUNT(i.unit_price) AS avg_price
    FROM {t['items']} i
    JOIN {t['orders']} o ON o.order_id = i.order_id{cross}
    WHERE {pred}
      AND o.order_status <> 'Cancelled' AND {item_pred}{current}
    GROUP BY i.product_sku)
"""
    if report == "top":
        avg = ",\n       CAST(ROUND(s.avg_price, 2) AS DOUBLE) AS avg_unit_price" \
            if with_avg_price else ""
        return sold + f"""SELECT p.product_sku, p.product_name, p.category,
       s.quantity AS total_quantity_sold, s.orders AS number_of_orders,
       CAST(s.revenue AS DOUBLE) AS total_revenue{avg}
FROM sold s JOIN {t['products']} p ON p.product_sku = s.product_sku
ORDER BY total_quantity_sold DESC, p.product_sku
LIMIT {top}"""
    if report == "category":
        if with_avg_price:
            return sold + f"""SELECT p.category,
       COUNT(DISTINCT p.product_sku) AS unique_products,
       SUM(s.quantity) AS total_quantity_sold,
       SUM(s.orders) AS number_of_orders,
       CAST(SUM(s.revenue) AS DOUBLE) AS total_revenue,
       CAST(ROUND(AVG(s.avg_price), 2) AS DOUBLE) AS avg_unit_price
FROM sold s JOIN {t['products']} p ON p.product_sku = s.product_sku
GROUP BY p.category
ORDER BY total_revenue DESC, p.category"""
        return sold + f"""SELECT p.category,
       SUM(s.quantity) AS total_quantity_sold,
       COUNT(DISTINCT p.product_sku) AS distinct_products,
       SUM(s.orders) AS number_of_orders,
       CAST(SUM(s.revenue) AS DOUBLE) AS total_revenue
FROM sold s JOIN {t['products']} p ON p.product_sku = s.product_sku
GROUP BY p.category
ORDER BY total_quantity_sold DESC, p.category"""
    raise ValueError(report)


def run_report(spark: SparkSession, report: str, as_of: dt.date, **kw) -> DataFrame:
    return spark.sql(report_sql(report, as_of, **kw))

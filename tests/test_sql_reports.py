"""The SQL reports equal the DataFrame reports (plain and history tables)."""

import datetime as dt

import pytest

from ledgerline.operators import reports as R
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.plans.sql_reports import register_views, report_sql, run_report
from tests.shop import FrameSource

AS_OF = dt.date(2026, 6, 14)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def lh(spark):
    lake = Lakehouse(FrameSource(spark), scd_options={"rows_per_chunk": 0})
    register_views(lake)
    return lake


@pytest.mark.parametrize("window", ["rolling", "month"])
def test_plain_reports(spark, lh, window):
    filt = R.rolling_30d(AS_OF) if window == "rolling" else R.previous_calendar_month(AS_OF)
    args = (lh.fact_order_items, lh.fact_orders, lh.dim_products, filt)
    assert rows(run_report(spark, "top", AS_OF, window=window)) == rows(R.top_products(*args))
    assert rows(run_report(spark, "category", AS_OF, window=window)) == \
        rows(R.category_sales(*args))


@pytest.mark.parametrize("window", ["rolling", "month"])
def test_history_reports(spark, lh, window):
    filt = R.rolling_30d(AS_OF) if window == "rolling" else R.previous_calendar_month(AS_OF)
    args = (R.current_only(lh.history_order_items), R.current_only(lh.history_orders),
            lh.pipeline_dim_products, filt)
    got = run_report(spark, "top", AS_OF, window=window, current_only=True, with_avg_price=True)
    assert rows(got) == rows(R.top_products(*args, with_avg_price=True))
    got = run_report(spark, "category", AS_OF, window=window, current_only=True,
                     with_avg_price=True)
    assert rows(got) == rows(R.category_sales(*args, with_avg_price=True))
    got = run_report(spark, "top", AS_OF, window=window, current_only=True,
                     with_avg_price=True, top=1, sold_status="Delivered")
    assert rows(got) == rows(R.top_delivered(*args))


def test_month_report_sql_uses_constant_month(spark):
    from ledgerline.sources.model import OrderModel
    sql = report_sql("top", AS_OF, window="month")
    assert "CROSS JOIN" not in sql and "add_months(DATE'2026-06-14', -1)" in sql
    lake = Lakehouse(OrderModel(spark, "/root/testdata/sf0.001"))
    register_views(lake, ["gold_fact_orders", "gold_fact_order_items", "gold_dim_products"])
    plan = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString()
    # the month is folded to literals (no add_months left, no join)
    assert "= 2026)" in plan and "= 5)" in plan and "add_months" not in plan
    assert "Join Cross" not in plan


def test_a_status_with_quotes_is_text(spark):
    from ledgerline.plans.sql_reports import _text
    for value in ("Delivered", "it's", "a\\'b", "' OR '1' = '1"):
        assert spark.sql(f"SELECT {_text(value)} AS v").first().v == value

import datetime as dt

from ledgerline.operators import reports as R
from ledgerline.plans.lakehouse import Lakehouse
from tests.shop import FrameSource

AS_OF = dt.date(2026, 6, 14)


def inputs(spark):
    lh = Lakehouse(FrameSource(spark))
    return lh.fact_order_items, lh.fact_orders, lh.dim_products


def test_top_products_rolling_window(spark):
    items, orders, dims = inputs(spark)
    rows = [tuple(r) for r in R.top_products(items, orders, dims, R.rolling_30d(AS_OF)).collect()]
    # inactive D-9 disappears at the dimension join; B-2 and C-1 tie on 3 (SKU order)
    assert rows == [
        ("A-1", "Trail Shoe", "Shoes/Outdoor", 4, 3, 319.99),
        ("B-2", "Wool Cap", "Apparel/Head", 3, 2, 45.0),
        ("C-1", "Water Bottle", "Gear", 3, 1, 28.5),
    ]


def test_top_products_limit_and_avg(spark):
    items, orders, dims = inputs(spark)
    rows = R.top_products(items, orders, dims, R.rolling_30d(AS_OF), top=2,
                          with_avg_price=True).collect()
    assert [(r.product_sku, r.avg_unit_price) for r in rows] == [("A-1", 80.0), ("B-2", 15.0)]


def test_category_sales(spark):
    items, orders, dims = inputs(spark)
    rows = {r.category: tuple(r)[1:] for r in
            R.category_sales(items, orders, dims, R.rolling_30d(AS_OF)).collect()}
    assert rows == {"Shoes/Outdoor": (4, 1, 3, 319.99), "Apparel/Head": (3, 1, 2, 45.0),
                    "Gear": (3, 1, 1, 28.5)}


def test_category_with_avg_orders_by_revenue(spark):
    items, orders, dims = inputs(spark)
    out = R.category_sales(items, orders, dims, R.rolling_30d(AS_OF), with_avg_price=True)
    assert out.columns == ["category", "unique_products", "total_quantity_sold",
                           "number_of_orders", "total_revenue", "avg_unit_price"]
    assert [r.category for r in out.collect()] == ["Shoes/Outdoor", "Apparel/Head", "Gear"]


def test_previous_month(spark):
    items, orders, dims = inputs(spark)
    rows = [(r.product_sku, r.total_quantity_sold, r.number_of_orders, r.total_revenue)
            for r in R.top_products(items, orders, dims,
                                    R.previous_calendar_month(AS_OF)).collect()]
    assert rows == [("A-2", 4, 1, 380.0), ("A-1", 3, 2, 239.99), ("B-2", 3, 2, 45.0)]


def test_top_delivered(spark):
    items, orders, dims = inputs(spark)
    rows = R.top_delivered(items, orders, dims, R.rolling_30d(AS_OF), top=5).collect()
    assert [(r.product_sku, r.total_quantity_sold) for r in rows] == [("A-1", 2), ("B-2", 1)]


def test_orders_since(spark):
    _, orders, _ = inputs(spark)
    got = sorted(r.order_id for r in R.orders_since(orders, "2026-06-01").collect())
    assert got == [2, 6]

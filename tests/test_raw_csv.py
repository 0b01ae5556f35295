"""End to end from the raw CSV layout (invented rows, region-named zones)."""

import datetime as dt
import os

from ledgerline.operators import reports as R
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.session import local_path
from ledgerline.sources.raw_csv import RawCsvSource

FILES = {
    "master_data/status/status.csv":
        "type,status,order\norder,Cancelled,0\norder,Initial,10\norder,In-Progress,20\n"
        "order,Complete,30\nitem,Cancelled,0\nitem,Initial,1000\nitem,Shipped,2000\n"
        "item,Delivered,3000\n",
    "master_data/products/p.csv":
        "product_sku,product_name,category,price,stock_quantity,created_at,deleted_at\n"
        "K-1,Kettle,Kitchen,25.5,10,2025-01-01,\nK-2,Pan,Kitchen,40,5,2025-01-01,\n"
        "K-2,Old Pan,Kitchen,30,0,2024-01-01,2025-06-01\n",
    "master_data/customers/c.csv":
        "customer_id,first_name,last_name,email,zipcode,created_at,deleted_at\n"
        "1,Mia,Lind,mia@example.org,11111,2025-01-01 10:00:00 Europe/Stockholm,\n",
    "transactions_data/orders/year=2026/month=05/o.csv":
        "order_id,customer_id,ordered_at,order_status,subtotal_amount,tax_amount,shipping_fee,"
        "total_amount,updated_at\n"
        "100,1,2026-05-20 10:00:00 America/New_York,Complete,51,0,0,51,"
        "2026-05-21 10:00:00 America/New_York\n",
    "transactions_data/orders/year=2026/month=06/o.csv":
        "order_id,customer_id,ordered_at,order_status,subtotal_amount,tax_amount,shipping_fee,"
        "total_amount,updated_at\n"
        "200,1,2026-05-31 22:30:00 America/Los_Angeles,Initial,80,0,0,80,"
        "2026-05-31 22:30:00 America/Los_Angeles\n",
    "transactions_data/order_items/year=2026/month=05/i.csv":
        "order_item_id,order_id,product_sku,quantity,discount_applied,line_amount,item_status,"
        "updated_at\n1,100,K-1,2,0,51,Delivered,2026-05-21 10:00:00 America/New_York\n",
    "transactions_data/order_items/year=2026/month=06/i.csv":
        "order_item_id,order_id,product_sku,quantity,discount_applied,line_amount,item_status,"
        "updated_at\n2,200,K-2,2,5,80,Initial,2026-05-31 22:30:00 America/Los_Angeles\n",
}


def make_drop(root):
    for rel, text in FILES.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write(text)


def test_raw_csv_drop_end_to_end(spark, scratch):
    root = local_path(scratch("drop"))
    make_drop(root)
    for infer in (False, True):
        lh = Lakehouse(RawCsvSource(spark, root, infer=infer))
        orders = {r.order_id: r for r in lh.silver_orders.collect()}
        # placed 22:30 on 31 May in Los Angeles = 05:30 UTC on 1 June, but
        # it arrived in the June folder either way
        assert orders[200].ordered_at == dt.datetime(2026, 6, 1, 5, 30)
        assert (orders[200].order_month, orders[200].month) == (6, 6)
        assert orders[100].ordered_at == dt.datetime(2026, 5, 20, 14, 0)
        assert sorted(r.product_sku for r in lh.dim_products.collect()) == ["K-1", "K-2"]
        top = R.top_products(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                             R.rolling_30d(dt.date(2026, 6, 10))).collect()
        assert [(r.product_sku, r.total_quantity_sold, r.total_revenue) for r in top] == \
            [("K-1", 2, 51.0), ("K-2", 2, 80.0)]      # tie on quantity: SKU order
        hist = lh.history_orders.collect()
        assert len(hist) == 2 and all(r["__CURRENT"] for r in hist)


def test_raw_csv_drop_materialized(spark, scratch):
    from ledgerline.sources.files import read_table
    root = local_path(scratch("drop2"))
    make_drop(root)
    lh = Lakehouse(RawCsvSource(spark, root))
    paths = lh.materialize(scratch("lake"), only=("silver/orders__active", "gold/fact_orders",
                                                  "gold/dim_products"))
    assert lh.written_rows == {"silver/orders__active": 2, "gold/fact_orders": 2,
                               "gold/dim_products": 2}
    facts = read_table(spark, paths["gold/fact_orders"])
    types = dict(facts.dtypes)
    assert types["order_year"] == "int" and types["order_day"] == "int"
    got = sorted((r.order_id, r.order_date, r.order_day) for r in facts.collect())
    assert got == [(100, dt.date(2026, 5, 20), 20), (200, dt.date(2026, 6, 1), 1)]


def test_bad_field_stops_the_read_or_is_counted(spark, tmp_path):
    import pytest

    from ledgerline.operators.scd2 import count_null_sequences
    folder = tmp_path / "transactions_data/orders/year=2026/month=05"
    folder.mkdir(parents=True)
    (folder / "o.csv").write_text(
        "order_id,customer_id,ordered_at,order_status,subtotal_amount,tax_amount,shipping_fee,"
        "total_amount,updated_at\n"
        "1,1,2026-05-20 10:00:00 America/New_York,Complete,51,0,0,51,2026-05-21 10:00:00 America/New_York\n"
        "2,1,2026-05-20 10:00:00 America/New_York,Complete,51,0,0,51,2026-05-21 10:00:00\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        RawCsvSource(spark, str(tmp_path)).orders().collect()
    kept = RawCsvSource(spark, str(tmp_path), on_bad="null").orders()
    assert kept.count() == 2
    assert count_null_sequences(kept, "updated_at").first()[0] == 1

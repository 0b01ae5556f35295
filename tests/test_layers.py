import datetime as dt


from ledgerline.operators import profile as P
from ledgerline.plans.lakehouse import Lakehouse
from tests.shop import FrameSource


def lake(spark):
    return Lakehouse(FrameSource(spark))


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_master_data(spark):
    lh = lake(spark)
    assert counts(lh.silver_status, "type") == {"order": 4, "item": 4}
    assert counts(lh.silver_products, "active") == {True: 6, False: 2}
    assert counts(P.product_availability(lh.bronze_products), "product_availability") == \
        {"Active": 1, "Inactive": 1}  # groups; sizes checked below
    avail = {r[0]: r[1] for r in P.product_availability(lh.bronze_products).collect()}
    assert avail == {"Active": 6, "Inactive": 2}
    # customer retired at a future date is inactive: only IS NULL is checked
    assert counts(lh.silver_customers, "active") == {True: 5, False: 1}
    assert "deleted_at" not in lh.silver_products.columns


def test_dimensions(spark):
    lh = lake(spark)
    skus = [r[0] for r in lh.dim_products.collect()]
    assert sorted(skus) == ["A-1", "A-2", "B-1", "B-2", "C-1", "E-1"]  # C-1 once
    names = {r.customer_id: r.customer_name for r in lh.dim_customers.collect()}
    assert names[1] == "Lovelace, Ada" and names[5] is None and 6 not in names


def test_pipeline_dims_drop_rule_failures(spark):
    lh = lake(spark)
    assert sorted(r[0] for r in lh.pipeline_dim_products.collect()) == \
        ["A-1", "A-2", "B-1", "B-2", "C-1"]
    # NULL email and an address without '@' fail; 'mailto_' prefix passes
    assert sorted(r[0] for r in lh.pipeline_dim_customers.collect()) == [1, 2, 5]


def test_order_split_and_calendar(spark):
    lh = lake(spark)
    act = {r.order_id: r for r in lh.silver_orders_active.collect()}
    inact = [r.order_id for r in lh.silver_orders_inactive.collect()]
    assert sorted(act) == [1, 2, 4, 5, 6] and inact == [3]   # NULL status: neither
    assert (act[5].month, act[5].order_month, act[5].order_day) == (6, 5, 31)
    assert counts(lh.silver_orders_active, "order_status") == \
        {"Complete": 2, "In-Progress": 1, "Initial": 2}


def test_items(spark):
    lh = lake(spark)
    assert counts(lh.silver_order_items, "discounted") == {True: 3, False: 8}
    price = {r.order_item_id: r.unit_price for r in lh.fact_order_items.collect()}
    assert price[20] == 15.0 and price[17] == 79.99 and price[13] == 9.5


def test_fact_orders_columns(spark):
    lh = lake(spark)
    assert lh.fact_orders.columns == ["order_id", "customer_id", "order_date", "order_status",
                                      "total_amount", "updated_at", "order_year",
                                      "order_month", "order_day"]
    r = lh.fact_orders.where("order_id = 5").first()
    assert r.order_date == dt.date(2026, 5, 31)


def test_status_distribution(spark):
    lh = lake(spark)
    rows = [tuple(r) for r in P.status_distribution(lh.fact_orders).collect()]
    assert rows[0][0] in ("Complete", "Initial") and rows[0][1] == 2
    assert dict((r[0], r[2]) for r in rows)["Complete"] == 555.0


def test_schema_profile(spark):
    lh = lake(spark)
    prof = {r.column_name: (r.data_type, r.null_count, r.non_null_count)
            for r in P.schema_profile(lh.bronze_orders).collect()}
    assert prof["order_status"] == ("string", 1, 6)
    assert prof["ordered_at"][0] == "timestamp_ntz"

"""Driver contract: entry(), queries() and oracle_sql() agree at sf0.001."""

import datetime as dt
import math
import re
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels", "benchmark"]
FAST = ["report_top10_30d", "report_category_prev_month", "report_scd2_category_30d",
        "report_top1_delivered_30d", "scd2_events", "scd2_order_items", "dq_metrics",
        "silver_utc_columns", "profile_schema", "join_status_broadcast", "scd2_as_of",
        "scd2_order_lookup", "scd2_item_lookup", "scd2_orders_except", "scd2_current_join",
        "scd2_current_orders", "filter_current_orders_since", "report_scd2_category_prev_month"]


def norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["product_sku", "product_name", "category"]
    assert 0 < df.count() <= 10


def test_every_query_has_an_oracle():
    """Apart from the optional corpus operators, which have tests of their own."""
    own = {name for name in E.queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, cur.fetchall())


def test_every_oracle_plans_in_duckdb(con):
    for name, sql in E.oracle_sql().items():
        con.execute("EXPLAIN " + sql)           # raises on any error


def test_item_lookup_takes_the_least_key_of_the_history(spark, scratch):
    root = scratch("items")
    day = lambda d: dt.datetime(1997, 1, d)
    rows = [(4, 1, None, "N"), (5, 2, day(3), "N"), (5, 2, day(9), "A"), (9, 3, day(1), "R")]
    spark.createDataFrame(
        [(o, 1, n, 2.0, 10.0, 0.0, s, "F", at) for o, n, at, s in rows],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{root}/lineitem.parquet")
    got = E.queries()["scd2_item_lookup"](spark, root).collect()
    assert [(r.order_item_id, r.item_status, r.is_current) for r in got] == [(502, "Initial", False), (502, "Delivered", True)]

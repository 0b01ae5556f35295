import datetime as dt


from ledgerline.functions import columns as C
from ledgerline.functions import dates as D


def test_flags_and_names(spark):
    df = spark.createDataFrame(
        [(None, 1.5, "Doe", "Jane"), (dt.datetime(2030, 1, 1), 0.0, None, "Ann"),
         (None, None, "Roe", None)],
        "deleted_at timestamp, discount double, last_name string, first_name string")
    rows = df.select(C.active_flag().alias("a"), C.discount_flag("discount").alias("d"),
                     C.customer_name().alias("n")).collect()
    assert [tuple(r) for r in rows] == [(True, True, "Doe, Jane"), (False, False, None),
                                        (True, False, None)]


def test_unit_price_half_up_and_zero_quantity(spark):
    df = spark.createDataFrame([(35.50, 2), (119.98, 2), (10.0, 3), (5.0, 0), (0.125, 1)],
                               "line_amount double, quantity int")
    got = [r[0] for r in df.select(C.unit_price()).collect()]
    assert got == [17.75, 59.99, 3.33, None, 0.13]


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    assert df.agg(C.money_sum(C.money("x"))).first()[0] == 3.0


def test_previous_month_rolls_year_and_clamps_day(spark):
    out = []
    for as_of in ("2026-01-15", "2026-03-31", "2026-07-01"):
        y, m = D.previous_month(as_of)
        out.append(tuple(spark.range(1).select(y, m).first()))
    assert out == [(2025, 12), (2026, 2), (2026, 6)]


def test_rolling_window_is_half_open(spark):
    days = [dt.date(2026, 6, 14) - dt.timedelta(days=i) for i in range(0, 35)]
    df = spark.createDataFrame([(d, d.year, d.month) for d in days],
                               "order_date date, order_year int, order_month int")
    kept = df.where(D.rolling_window_predicate("order_date", dt.date(2026, 6, 14), 30,
                                               "order_year", "order_month"))
    got = sorted(r[0] for r in kept.collect())
    assert got[0] == dt.date(2026, 5, 15) and got[-1] == dt.date(2026, 6, 13)
    assert len(got) == 30


def test_to_utc_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 10, 0), "x")],
                               "t timestamp_ntz, s string")
    same = C.to_utc_columns(df).first()
    assert same.t == dt.datetime(2024, 1, 15, 10, 0)
    shifted = C.to_utc_columns(df, "America/Sao_Paulo").first()
    assert shifted.t == dt.datetime(2024, 1, 15, 13, 0) and shifted.s == "x"

import os

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.session import local_path
from ledgerline.sources.files import create_schema, read_csv, read_table, write_table


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_hive_partitions_become_int_columns(spark, scratch):
    root = local_path(scratch("raw-orders"))
    header = ("order_id,customer_id,ordered_at,order_status,subtotal_amount,tax_amount,"
              "shipping_fee,total_amount,updated_at\n")
    _write(f"{root}/year=2026/month=05/a.csv",
           header + "1,7,2026-05-03 10:00:00,Complete,10,1,0,11,2026-05-04 10:00:00\n")
    _write(f"{root}/year=2026/month=06/b.csv",
           header + "2,8,2026-05-30 09:00:00,Initial,5,0.5,1,6.5,2026-06-01 09:00:00\n"
           "3,9,2026-06-02 09:00:00,Cancelled,150,0,0,150,2026-06-02 09:00:00\n")
    typed = read_csv(spark, root, schema=schemas.ORDERS, partition_columns=("year", "month"))
    assert dict(typed.dtypes)["month"] == "int"
    assert sorted((r.order_id, r.month) for r in typed.collect()) == [(1, 5), (2, 6), (3, 6)]
    inferred = read_csv(spark, root, infer=True)
    dt = dict(inferred.dtypes)
    assert dt["month"] == "int" and dt["total_amount"] == "double"
    assert inferred.where(F.col("month") == 6).count() == 2


def test_single_csv_file_with_inference(spark, scratch):
    root = local_path(scratch("status"))
    _write(f"{root}/status.csv", "type,status,order\norder,Initial,10\nitem,Shipped,2000\n")
    df = read_csv(spark, f"{root}/status.csv", infer=True)
    assert dict(df.dtypes) == {"type": "string", "status": "string", "order": "int"}
    assert df.orderBy("type", "order").first().status == "Shipped"


def test_table_sinks(spark):
    create_schema(spark, "shop_bronze")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    write_table(df, "shop_bronze.things")
    write_table(df.where("id = 2").withColumn("w", F.lit(1)), "shop_bronze.things")
    back = read_table(spark, "shop_bronze.things")
    assert back.columns == ["id", "v", "w"] and back.count() == 1   # overwrite replaces schema


def test_partitioned_sink_prunes(spark, scratch):
    path = scratch("facts")
    rows = [(i, 2026, m, d) for i, (m, d) in enumerate([(5, 1), (5, 2), (6, 1), (7, 3)])]
    df = spark.createDataFrame(rows, "order_id long, order_year int, order_month int, order_day int")
    write_table(df, path, partition_by=("order_year", "order_month", "order_day"))
    q = read_table(spark, path).where("order_year = 2026 AND order_month = 5")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "order_month" in plan.split("PartitionFilters")[1]
    assert q.count() == 2

from ledgerline.operators import quality as Q


def test_expect_or_drop_stacks_and_drops_null_results(spark):
    df = spark.createDataFrame([(1, "a@x"), (None, "b@x"), (3, None), (4, "nope")],
                               "customer_id long, email string")
    kept = Q.expect_or_drop(df, Q.CUSTOMER_RULES)
    assert [r.customer_id for r in kept.collect()] == [1]
    assert Q.expect_or_drop(df, {}).count() == 4


def test_expectation_metrics(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", -2.0), (None, None), ("D", 0.0)],
                               "product_sku string, price double")
    got = {r.rule: (r.passed_records, r.failed_records)
           for r in Q.expectation_metrics(df, Q.PRODUCT_RULES, "p").collect()}
    assert got == {"valid_product_sku": (3, 1), "valid_price": (2, 2)}


def test_observed_metrics_come_with_the_write(spark, scratch):
    df = spark.createDataFrame([("A", 1.0), ("B", -2.0)], "product_sku string, price double")
    kept, obs = Q.expect_or_drop_observed(df, Q.PRODUCT_RULES)
    kept.write.parquet(scratch("observed"))
    assert obs.get == {"total": 2, "valid_product_sku": 2, "valid_price": 1}

"""A key holding a third of all rows, groups of copies and of ties that large, and bursts."""

from pyspark.sql import functions as F

from ledgerline.operators.scd2 import apply_scd2, find_hot_keys, range_carries, split_ranges


def skewed(spark, n=300_000):
    # key 0 gets every third row; the others are spread over 50k keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50_000).alias("k"),
        F.col("id").alias("s"),
        F.when((F.col("id") / 1000).cast("int") % 2 == 0, "A").otherwise("B").alias("t"),
        (F.col("id") % 7).alias("x"))


def canon(df):
    h = F.pmod(F.xxhash64(*df.columns), F.lit(1_000_000_007)).cast("decimal(38,0)")
    return df.select(F.sum(h).alias("h"), F.count("*").alias("n")).first()


def sizes(ranged):
    return [r["count"] for r in ranged.groupBy("_scd_range").count().collect()]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hot_key_is_found_split_and_exact(spark):
    df = skewed(spark)
    hot = find_hot_keys(df, ["k"], "s", rows_per_chunk=20_000, sample_fraction=0.05)
    assert [h["k"] for h in hot.collect()] == [0]
    ranged = split_ranges(df.where("k = 0"), ["k"], "s", ranges=8)
    found = sizes(ranged)
    assert len(found) == 8 and max(found) <= 2 * 100_000 / 8
    assert range_carries(ranged, ["k"], "s", ["t"]).count() == 8
    split = apply_scd2(df, ["k"], "s", ["t"], hot_keys=hot.select("k"), ranges=8)
    plain = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=0)
    assert canon(split) == canon(plain)
    assert split.where("k = 0 AND __CURRENT").count() == 1


def test_plan_has_one_pass_for_cold_keys_and_no_bound(spark):
    df = skewed(spark, 3000)
    split = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=500, sample_fraction=1.0, ranges=3)
    plan, plain = plan_of(split), plan_of(apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=0))
    assert "Limit" not in plan and "ResolvedHint" not in plan and "broadcast" not in plan.lower()
    # the windows of the single pass once, and those of the ranges and of the carries
    windows = lambda p: p.count("+- Window") + p.count(":- Window")
    assert windows(plan) == windows(plain) + 5, (windows(plan), windows(plain))
    # the list of hot keys is read once, and the written ranges twice: for the carries and for the versions
    assert plan.count("parquet") == 3


def test_hot_group_of_copies_is_combined_first(spark):
    base = spark.range(60_000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("s"),
                                      F.lit("A").alias("t"), F.lit(1).alias("x"))
    copies = spark.range(100_000).select(F.lit(5).cast("long").alias("k"), F.lit(7).cast("long").alias("s"),
                                         F.lit("B").alias("t"), F.lit(1).alias("x"))
    df = base.unionByName(copies)
    assert [h["k"] for h in find_hot_keys(df, ["k"], "s", 20_000, 0.1).collect()] == [5]
    auto = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=20_000, sample_fraction=0.1)
    ranged = split_ranges(copies, ["k"], "s", ranges=4)
    assert ranged.count() == 1
    assert canon(auto) == canon(apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=0))


def test_different_rows_of_one_sequence_are_reduced_in_several_tasks(spark):
    # 100,000 different rows of one (key, sequence): every map task keeps one of its own
    ties = spark.range(0, 100_000, 1, 8).select(F.lit(3).cast("long").alias("k"), F.lit(9).cast("long").alias("s"),
                                                F.col("id").cast("string").alias("t"), F.col("id").alias("x"))
    rest = spark.range(5000).select((F.col("id") % 50).alias("k"), F.col("id").alias("s"), F.lit("A").alias("t"),
                                    F.lit(0).cast("long").alias("x"))
    df = ties.unionByName(rest)
    from ledgerline.operators.scd2 import deduplicate_changes
    reduced = deduplicate_changes(ties, ["k"], "s")
    assert "partial_max" in reduced._jdf.queryExecution().executedPlan().toString()
    auto = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=20_000, sample_fraction=0.1, ranges=4)
    plain = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=0)
    assert canon(auto) == canon(plain)
    assert auto.where("k = 3 AND t = '99999'").count() == 1


def test_bursty_hot_key_is_split_by_quantiles(spark):
    # key 0: 100k rows, 90k of them inside 1% of its sequence range
    burst = spark.range(90_000).select(F.lit(0).cast("long").alias("k"),
                                       (F.lit(500_000) + F.col("id") / 10).alias("s"))
    spread = spark.range(10_000).select(F.lit(0).cast("long").alias("k"),
                                        (F.col("id") * 100 + 0.05).cast("double").alias("s"))
    others = spark.range(50_000).select((F.col("id") % 5000 + 1).alias("k"),
                                        F.col("id").cast("double").alias("s"))
    df = burst.unionByName(spread).unionByName(others).select(
        "k", "s", F.when((F.col("s") / 7).cast("int") % 2 == 0, "A").otherwise("B").alias("t"),
        F.lit(0).alias("x"))
    hot = find_hot_keys(df, ["k"], "s", rows_per_chunk=10_000, sample_fraction=0.2)
    assert [h["k"] for h in hot.collect()] == [0]
    found = sizes(split_ranges(df.where("k = 0"), ["k"], "s", ranges=10))
    assert len(found) == 10 and max(found) <= 2 * 10_000      # the burst is split too
    assert canon(apply_scd2(df, ["k"], "s", ["t"], hot_keys=hot.select("k"), ranges=10)) == \
        canon(apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=0))

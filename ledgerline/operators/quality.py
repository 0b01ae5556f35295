"""Data-quality rules: drop failing rows, and count passes per rule.

A rule is a SQL predicate.  A row is kept only when every rule is TRUE; a rule
that evaluates to NULL counts as failed (SQL ``WHERE`` semantics).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _all_rules(rules: Mapping[str, str]):
    cond = F.lit(True)
    for predicate in rules.values():
        cond = cond & F.coalesce(F.expr(predicate), F.lit(False))
    return cond


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep rows meeting every rule (rules stack, like stacked decorators)."""
    return df.where(_all_rules(rules)) if rules else df


def expectation_metrics(df: DataFrame, rules: Mapping[str, str],
                        dataset: str) -> DataFrame:
    """One row per rule: dataset, rule, passed_records, failed_records.

    Every rule is evaluated in one aggregation pass over ``df`` (partial
    aggregation, one small row per task), then unpivoted.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    names = list(rules)
    for i, name in enumerate(names):
        aggs.append(F.count_if(F.coalesce(F.expr(rules[name]), F.lit(False)))
                    .alias(f"_p{i}"))
    counts = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_p{i}").alias("passed"))
        for i, name in enumerate(names)]))
    return counts.select(F.col("_total"), stacked.alias("r")).select(
        F.lit(dataset).alias("dataset"),
        F.col("r.rule").alias("rule"),
        F.col("r.passed").alias("passed_records"),
        (F.col("_total") - F.col("r.passed")).alias("failed_records"),
    )


def expect_or_drop_observed(df: DataFrame, rules: Mapping[str, str],
                            name: str = "expectations"):
    """``expect_or_drop`` that also reports per-rule pass counts.

    Uses ``DataFrame.observe``: the counts are collected as a side product of
    whatever action consumes the result (for example the table write), so the
    data is not read twice.  Returns (kept DataFrame, Observation).
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("total")]
    metrics += [F.count_if(F.coalesce(F.expr(p), F.lit(False))).alias(r)
                for r, p in rules.items()]
    return expect_or_drop(df.observe(obs, *metrics), rules), obs


# Rules of the pipeline dimensions.
CUSTOMER_RULES = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_email": "email IS NOT NULL AND email LIKE '%@%'",
}
PRODUCT_RULES = {
    "valid_product_sku": "product_sku IS NOT NULL",
    "valid_price": "price >= 0",
}

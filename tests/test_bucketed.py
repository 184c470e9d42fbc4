"""The wide table from buckets: no exchange for sessions that are not hot, and the same rows however many are."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import CFG
from checks.queries import Chain, _flat
from promolens.plans.bucketed import cold_funnel, funnel_from_buckets, write_funnel_buckets
from promolens.session import stage


@pytest.fixture(scope="module")
def inputs(spark):
    c = Chain(spark, "/root/testdata/sf0.001")
    return c.pattern_table, stage(c.sessions, "sessions"), sorted(map(str, _flat(c.wide).collect()))


@pytest.mark.parametrize("hot_rows", [0, 2, 1_000_000])
def test_equal_to_the_shuffled_form(spark, inputs, hot_rows):
    patterns, sessions, expected = inputs
    names = write_funnel_buckets(patterns, sessions, CFG, f"bucket_test_{hot_rows}", 4, hot_rows)
    found = sorted(map(str, _flat(funnel_from_buckets(spark, names, CFG)).collect()))
    assert found == expected and (names.n_hot > 0) == (hot_rows < 1_000_000)
    names.drop(spark)
    assert not spark.catalog.tableExists(names.rows)


def test_no_exchange_between_buckets(spark, inputs):
    patterns, sessions, _ = inputs
    names = write_funnel_buckets(patterns, sessions, CFG, "bucket_plan", 4)
    # As for tables too large to be sent to every task.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = cold_funnel(spark, names)
        df.select(F.count("*")).collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and "SelectedBucketsCount: 4 out of 4" in plan
    names.drop(spark)

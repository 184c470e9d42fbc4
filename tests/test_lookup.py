"""Joins with a lookup side that failed its size check."""

from collections import Counter

import pytest

from promolens.operators import patterns as pat
from promolens.operators.lookup import hot_keys, lookup_join
from tests.data import ROWS, catalog, row


@pytest.fixture(scope="module")
def sides(spark):
    facts = [(i, 7 if i % 3 else i % 50) for i in range(3000)] + [(3000 + i, None) for i in range(40)]
    big = spark.createDataFrame(facts, "id bigint, k bigint")
    small = spark.createDataFrame([(k, f"{k}-{j}") for k in [*range(0, 40), None] for j in range(2)], "k bigint, name string")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left"])
def test_unbounded_join_equals_a_plain_one(sides, how):
    big, small = sides
    got = lookup_join(big, small, ["k"], how, False, ["id"], hot_rows=100)
    assert got.columns == ["k", "id", "name"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, big.join(small, "k", how).collect()))


def test_unbounded_lookup_is_neither_broadcast_nor_multiplied(spark, sides):
    big, small = sides
    assert [tuple(r) for r in hot_keys(big, ["k"], 100).collect()] == [(7, 21)]
    joined = lookup_join(big, small, ["k"], "inner", False, ["id"], hot_rows=100)
    joined.collect()
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") >= 1
    many = spark.range(1000).selectExpr("id as k", "cast(id as string) as name")
    before = lookup_join(big, many, ["k"], "inner", False, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 63" not in before and "strategy=merge" in before


def test_rules_of_products_that_occur(spark):
    c = catalog(spark, [(p, p, 2, 2, None) for p in range(1, 29)], max_rows=5)
    df = spark.createDataFrame([row(q, 2) for q in (3, 4, None)], ROWS)
    simple, combined, few = pat.occurring_rules(df, c)
    assert not c.rules_bounded and few and simple.count() == 2 and combined.count() == 0

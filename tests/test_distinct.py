"""Distinct counts from states by day: any order, days that come again, any window, numbers that stay."""

import pytest
from pyspark.sql import functions as F

from promolens.operators.distinct import LANES, DistinctStore, number_members, rates_of

DDL = "day string, u string, item string, kind bigint"
ROWS = [
    (f"2024-01-{1 + i % 5:02d}", None if i % 17 == 0 else f"u{i % 7}", None if i % 13 == 0 else f"i{i * 7 % 90}", i % 3 if i % 19 else None)
    for i in range(600)
]


def expected(rows, days):
    out = {}
    for day, u, item, kind in rows:
        if day in days and item is not None and kind is not None:
            out.setdefault(u, set()).add((item, kind))
    return {u: len(s) for u, s in out.items()}


def found(df):
    return {r.u: r.n for r in df.collect()}


def test_days_in_any_order_and_again(spark, tmp_path):
    rows = spark.createDataFrame(ROWS + ROWS[:200], DDL)
    days = sorted({r[0] for r in ROWS})
    for broadcast_rows in (0, 1000):
        store = DistinctStore(spark, str(tmp_path / f"s{broadcast_rows}"), ["u"], ["item", "kind"], broadcast_rows=broadcast_rows)
        store.put(days[3:], rows)
        store.put(days[:1], rows.where("kind = 1"))
        before = {tuple(r) for r in store._numbers.read().select("item", "kind", "number").collect()}
        store.put(days[:3], rows)
        after = {tuple(r) for r in store._numbers.read().select("item", "kind", "number").collect()}
        assert before < after and len({n for _, _, n in after}) == len(after)
        assert found(store.counts()) == expected(ROWS, days)
        assert found(store.counts(days[1:3])) == expected(ROWS, days[1:3])
        assert {u: n for u, n in found(store.estimates()).items() if n} == pytest.approx(expected(ROWS, days), rel=0.07)
        store.put(days[4:], rows.where("false"))
        assert found(store.counts()) == expected(ROWS, days[:4])


def test_numbers_go_on_in_each_lane(spark):
    first = number_members(spark.range(3000), None, ["id"])
    more = number_members(spark.range(2000, 6000), first, ["id"])
    both = first.unionByName(more)
    assert both.select("number").distinct().count() == both.count() == 6000
    assert more.select("id").where("id < 3000").count() == 0
    lane = F.pmod(F.xxhash64("id"), F.lit(LANES))
    places = both.where(F.pmod("number", F.lit(LANES)) == lane).groupBy(lane).agg((F.max("number") / LANES).cast("int"), F.count("*"))
    assert all(top + 1 == n for _, top, n in places.collect())


def test_words_combine_before_the_shuffle(spark, tmp_path):
    store = DistinctStore(spark, str(tmp_path / "s"), ["u"], ["item"])
    store.put(["2024-01-01", "2024-01-02"], spark.createDataFrame(ROWS, DDL))
    plan = store.counts(["2024-01-02"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan
    assert store._words.read(partitions=["2024-01-02"]).select("day").distinct().count() == 1


def test_rates(spark):
    n = spark.createDataFrame([("session", 8), ("cart", 4), ("checkout", 2)], "stage string, n bigint")
    assert tuple(rates_of(n).first()) == (8, 0.5, 0.0, 0.0)
    assert tuple(rates_of(n.where("false")).first()) == (0, None, None, None)


def test_a_store_may_keep_exact_states_alone(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, DDL)
    days = sorted({r[0] for r in ROWS})
    for broadcast_rows in (0, 1000):
        store = DistinctStore(spark, str(tmp_path / f"s{broadcast_rows}"), ["u"], ["item", "kind"], broadcast_rows=broadcast_rows, sketched=False)
        store.put(days, rows)
        assert found(store.counts()) == expected(ROWS, days)
        assert not store._sketches.versions()
        with pytest.raises(ValueError):
            store.estimates()

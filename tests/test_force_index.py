"""Rules by day blocks, division by bitmaps, writes that measure."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from promolens.operators import division, force_index as force
from promolens.operators import patterns as pat
from promolens.operators.lookup import widest
from promolens.sinks.checked import read_clean, read_every, read_quarantine, write_checked
from tests.data import ROWS, catalog, row


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_case(seed):
    rng = random.Random(seed)
    validity = []
    for p in range(1, 13):
        start = dt.date(2022, 1, 1) + dt.timedelta(days=rng.randrange(1200))
        end = dt.datetime.combine(start, dt.time(rng.randrange(24), 30)) + dt.timedelta(days=rng.choice([0, 1, 15, 16, 17, 300, 700, -2]))
        validity.append((p, None if p == 12 else start.isoformat(), end.isoformat()))
    conditions = [(rng.randrange(1, 13), rng.randrange(1, 5), rng.randrange(1, 9), rng.randrange(0, 5), rng.choice([None, 0, 5])) for _ in range(40)]
    combos = [(p, q, rng.randrange(0, 4)) for p in (9, 10, 11) for q in rng.sample(range(1, 6), 3)]
    rows = []
    for i in range(300):
        day = dt.datetime(2022, 1, 1) + dt.timedelta(days=rng.randrange(1300), hours=rng.randrange(24))
        rows.append(row(
            rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 1, 2, 3]), rng.randrange(4), rng.randrange(4), user=rng.choice(["u", "v", None]),
            session=rng.choice([1, 2, 3, None]), at=rng.choice(["bad", *[day.strftime("%d/%m/%Y %H:%M:%S")] * 9]), attempt=i,
        ))
    return conditions, combos, validity, rows


@pytest.mark.parametrize("max_rows", [200_000, 0])
def test_patterns_by_day_equal_patterns(spark, max_rows):
    conditions, combos, validity, rows = random_case(5)
    c = catalog(spark, conditions, combos, validity, max_rows=max_rows)
    df = spark.createDataFrame(rows, ROWS)
    want = sorted(map(str, pat.patterns(df, c).collect()))
    by_day = force.patterns_by_day(df, c)
    assert sorted(map(str, by_day.select(*pat.patterns(df, c).columns).collect())) == want
    assert sum("'SI'" in r for r in want) > 10


def test_day_blocks_cover_each_day_once(spark):
    rng = random.Random(2)
    spans = [(a, a + n) for a in [0, -1, -5000, 15, 16, 255, 256, 4095, 19_000] for n in [0, 1, 14, 15, 16, 17, 255, 256, 257, 9000, -1]]
    spans += [(a, a + rng.randrange(3000)) for a in rng.sample(range(-3000, 30_000), 20)]
    df = spark.createDataFrame(spans, "a bigint, b bigint")
    for r in df.select("a", "b", force.day_blocks(F.col("a"), F.col("b")).alias("x")).collect():
        days = sorted(d for x in r.x for d in range(x["_block"] * force.LENGTHS[x["_level"]], (x["_block"] + 1) * force.LENGTHS[x["_level"]]))
        assert days == list(range(r.a, r.b + 1))
        assert len([x for x in r.x if x["_level"] < 3]) <= 90


def test_rules_tested_are_fewer_and_rows_do_not_move(spark):
    validity = [(p, f"2024-01-{p:02d}", f"2024-01-{p:02d}T20:00:00") for p in range(1, 29)]
    c = catalog(spark, [(p, 7, 2, 2, None) for p in range(1, 29)], validity=validity)
    df = spark.createDataFrame([row(7, 1, 2, at=f"{d:02d}/01/2024 10:00:00", attempt=d) for d in range(1, 29)], ROWS)
    assert force.rules_tested(df, c).first().asDict() == {"rows": 28, "by_product": 28 * 28, "by_day": 28, "by_quantity": 2 * 28}
    text = plan(force._packed(pat.timed_rows(df), force.day_rules(c)))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= len(force.LENGTHS)
    empty = df.limit(0)
    assert force.rules_tested(empty, c).first().asDict() == {"rows": 0, "by_product": 0, "by_day": 0, "by_quantity": 0}
    assert force.patterns_by_day(empty, c).count() == 0


def test_a_product_with_many_rules_is_not_packed(spark):
    c = catalog(spark, [(p, 7, 2, 2, None) for p in range(1, 29)])
    assert c.rules_bounded and widest(c.conditions, c.requirements_all) == 28
    c = catalog(spark, [(p, 7, 2, 2, None) for p in range(1, 29)])
    c.max_per_product = 27
    assert not c.rules_bounded


def test_division_by_bits_equals_counting(spark):
    conditions, combos, validity, rows = random_case(11)
    validity = [(p, "2021-01-01", "2026-01-01T00:00:00") for p in (9, 10, 11)]
    df = spark.createDataFrame(rows, ROWS)
    for max_rows in (200_000, 0):
        c = catalog(spark, conditions, combos, validity, max_rows=max_rows)
        state = division.session_state(df)
        got = division.complete_by_bits(state, c)
        want = sorted(map(str, pat.combo_session_complete(df, c).select(*got.columns).collect()))
        assert sorted(map(str, got.collect())) == want and want


def test_division_beyond_one_word_and_the_sign_bit(spark):
    combos = [(9, q, 1) for q in range(1, 131)] + [(8, q, 1) for q in range(1, 65)]
    c = catalog(spark, combos=combos, validity=[(9, "2024-01-01", "2024-12-31T00:00:00"), (8, "2024-01-01", "2024-12-31T00:00:00")])
    every = [row(q, 1, session=1) for q in range(1, 131)]
    most = [row(q, 1, session=2) for q in range(1, 131) if q != 64]
    got = division.complete_by_bits(division.session_state(spark.createDataFrame(every + most, ROWS)), c)
    assert sorted((r.SESION, r.clave_promocion) for r in got.collect()) == [(1, 8), (1, 9)]


def test_deliveries_add_up_and_are_replaced(spark, tmp_path):
    c = catalog(spark, combos=[(9, 1, 3), (9, 2, 1)], validity=[(9, "2024-01-01", "2024-12-31T00:00:00")])
    store = division.DivisionStore(spark, str(tmp_path / "s"))
    put = lambda name, rows: store.put(name, spark.createDataFrame(rows, ROWS))
    done = lambda: [r.ADD_CART_COMPLETE for r in store.complete(c).collect()]
    put("d2", [row(1, add=2), row(2, add=1)])
    assert done() == []
    put("d1", [row(1, add=1, at="29/02/2024 10:00:00")])
    assert done() == [True]
    put("d2", [row(1, add=1), row(2, add=1)])
    assert done() == []
    put("d2", [row(1, add=5), row(2, add=1)])
    assert done() == [True]
    put("d2", [])
    assert done() == []


DDL = "day date, k string, n int"


def checked(spark, rows, path, key=("k",)):
    df = spark.createDataFrame(rows, DDL)
    seen = write_checked(df, path, "day", ("n",), {"negative": F.col("n") < 0}, {"total": F.sum("n"), "rows": F.count("*")}, key)
    return df, seen


def test_checked_write_measures_and_parts_the_rows(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    rows = [(day, "a", 1), (day, "a", 2), (day, "a", 3), (day, "b", -5), (None, "c", None), (day, None, 4), (day, None, 4)]
    path = str(tmp_path / "t")
    for _ in range(2):  # a second write replaces the first
        df, seen = checked(spark, rows, path)
    assert seen == {"total": 9, "rows": 7, "negative": 1, "duplicates": 2}
    assert sorted(map(str, read_every(spark, path, df).collect())) == sorted(map(str, df.collect()))
    bad = read_quarantine(spark, path, df)
    assert sorted((str(r.k), r.n, tuple(r.violations)) for r in bad.collect()) == [
        ("None", 4, ("duplicates",)), ("a", 2, ("duplicates",)), ("a", 3, ("duplicates",)), ("b", -5, ("negative",))
    ]
    clean = read_clean(spark, path, df)
    assert sorted((str(r.k), r.n) for r in clean.collect()) == [("None", 4), ("a", 1), ("c", None)]
    assert "PartitionFilters: [isnotnull(quarantined" in plan(clean) or "quarantined" in plan(clean)


def test_checked_write_of_nothing(spark, tmp_path):
    df, seen = checked(spark, [], str(tmp_path / "t"))
    assert seen == {"total": None, "rows": 0, "negative": 0, "duplicates": 0}
    _, seen = checked(spark, [(None, "a", 1)] * 2, str(tmp_path / "u"), key=())
    assert seen == {"total": 2, "rows": 2, "negative": 0}


def test_measures_of_a_frame_that_moves(spark, tmp_path):
    df = spark.range(100).selectExpr("date'2024-01-01' as day", "cast(id as string) as k", "cast(id as int) as n")
    seen = write_checked(df.repartition(7), str(tmp_path / "t"), "day", ("n",), {}, {"rows": F.count("*")}, ("k",))
    assert seen == {"rows": 100, "duplicates": 0}

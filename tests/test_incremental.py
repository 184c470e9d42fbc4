"""Attempts fed by days, in any order, against one full run."""

import random

import pytest
from pyspark.sql import functions as F

from promolens.operators.attempts import attempts
from promolens.operators.incremental import changed_groups, day_states
from promolens.plans.incremental import AttemptStore
from promolens.session import work_dir
from tests.data import CFG, EVENTS, event

DAY = 86_400


def shard_rows(seed=1, n=260, days=5):
    """Events of five days; a session may go over several, and a shard may hold events of the next day."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = rng.randint(0, days * DAY - 1)
        name = rng.choice(["add_to_cart", "add_to_cart", "begin_checkout", "purchase"])
        items = rng.choice([[], [("x", rng.randint(1, 4))], [("x", 2), ("y", None)], [("z", 1)]])
        row = event(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), name, at, items, f"T{i}" if name == "purchase" else None, bundle=i, offset=rng.randint(0, 3))
        rows.append((f"d{max(0, at // DAY - rng.choice([0, 0, 1]))}", *row))
        if rng.random() < 0.1:  # a copy in another shard
            rows.append((f"d{at // DAY}", *row))
    rows.append(("d1", *event("a", 1, "purchase", 0, [("x", 1)])[:3], None, *event("a", 1, "purchase", 0, [("x", 1)])[4:]))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, f"ds string, {EVENTS}").repartition(3)


@pytest.fixture
def store(spark):
    return AttemptStore(spark, work_dir(spark), CFG)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def full(spark, rows):
    return table(attempts(frame(spark, rows).drop("ds"), CFG))


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_days_in_any_order_equal_one_run(spark, store):
    rows = shard_rows()
    seen: list[str] = []
    for batch in (["d3"], ["d0", "d4"], ["d2"], ["d1"]):
        seen += batch
        there = [r for r in rows if r[0] in seen]
        store.update(frame(spark, there), batch)
        assert table(store.read()) == full(spark, there)
    assert len(table(store.read(1))) < len(table(store.read()))


def test_a_changed_and_a_removed_shard(spark, store):
    rows = shard_rows(2)
    store.update(frame(spark, rows), [f"d{i}" for i in range(5)])
    changed = [r for i, r in enumerate(rows) if r[0] != "d2" or i % 2] + [("d2", *event("new", 9, "purchase", 2 * DAY + 5, [("x", 3)], "T"))]
    store.update(frame(spark, changed), ["d2"])
    assert table(store.read()) == full(spark, changed)
    gone = [r for r in changed if r[0] != "d1"]
    store.update(frame(spark, gone), ["d1"])
    assert table(store.read()) == full(spark, gone)


def test_untouched_partitions_keep_their_files(spark, store):
    rows = [(f"d{d}", *event(f"u{d}", 1, n, d * DAY + 40_000 + i, [("x", 1)])) for d in range(4) for i, n in enumerate(["add_to_cart", "purchase"])]
    store.update(frame(spark, rows), ["d0", "d1", "d2", "d3"])
    dates = {str(r.attempt_date): None for r in store.read().select("attempt_date").distinct().collect()}
    before = {d: files(store.result.read(partitions=[d])) for d in dates}
    more = rows + [("d2", *event("u2", 1, "add_to_cart", 2 * DAY + 30_000, [("x", 5)]))]
    done = store.update(frame(spark, more), ["d2"])
    assert done.days == [str((1_709_251_200 + 2 * DAY) // DAY)] and done.dates == ["2024-03-03"]
    after = {d: files(store.result.read(partitions=[d])) for d in dates}
    assert {d for d in dates if before[d] != after[d]} == {"2024-03-03"}
    assert table(store.read()) == full(spark, more)


def test_a_late_day_renumbers_later_ones_without_reading_their_events(spark, store):
    late = ("d0", *event("a", 1, "purchase", 100, [("x", 1)], "T0"))
    later = [("d3", *event("a", 1, "add_to_cart", 3 * DAY + 100, [("x", 1)]))]
    store.update(frame(spark, later), ["d3"])
    # The later shard is replaced by rows that would fail if they were evaluated.
    poison = frame(spark, later).withColumn("event_timestamp", F.raise_error(F.lit("read")).cast("long"))
    shown = frame(spark, [late]).unionByName(poison.where("ds = 'd9'"))
    store.update(shown, ["d0"])
    assert [(r.INTENTO, r.STATUS) for r in store.read().orderBy("INTENTO").collect()] == [(1, "PURCHASED"), (2, "NO_PURCHASE")]


def test_an_update_that_stopped_is_finished_by_the_next(spark, store, monkeypatch):
    rows = shard_rows(3, n=80)
    first = [r for r in rows if r[0] in ("d0", "d2")]
    store.update(frame(spark, first), ["d0", "d2"])
    kept = table(store.read())

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(store, "_update_result", stop)
        with pytest.raises(RuntimeError):
            store.update(frame(spark, rows), ["d1", "d3", "d4"])
    assert table(store.read()) == kept
    store.update(frame(spark, rows), [])
    assert table(store.read()) == full(spark, rows)


def test_the_same_shard_again_changes_no_row(spark, store):
    rows = shard_rows(4, n=60)
    store.update(frame(spark, rows), [f"d{i}" for i in range(5)])
    done = store.update(frame(spark, rows), ["d1"])
    assert done.dates == [] and table(store.read()) == full(spark, rows)


def test_nothing_yet(spark, store):
    assert store.update(frame(spark, []), []).dates == []
    assert store.read().collect() == []
    assert store.update(frame(spark, []), ["d0"]).days == []


def test_changed_groups(spark):
    one = frame(spark, [("d", *event("a", 1, "add_to_cart", 5, [("x", 1)])), ("d", *event("b", 1, "purchase", 5, [("x", 1)], "T"))]).drop("ds")
    two = frame(spark, [("d", *event("a", 1, "add_to_cart", 5, [("x", 1)])), ("d", *event("b", 1, "purchase", 5, [("x", 2)], "T"))]).drop("ds")
    before, after = day_states(one, CFG), day_states(two, CFG)
    assert [r.user_pseudo_id for r in changed_groups(before, after).collect()] == ["b"]
    assert changed_groups(before, before).collect() == []


def test_groups_do_not_pass_through_the_driver(spark):
    from promolens.operators.attempts import GROUP
    from promolens.operators.incremental import of_groups

    rows = spark.range(5).selectExpr(*[f"id as {c}" for c in GROUP], "id as n")
    for how in ("left_semi", "left_anti"):
        got = of_groups(rows, rows.where("n < 2").select(*GROUP), how)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == (2 if how == "left_semi" else 3)

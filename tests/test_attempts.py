import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from promolens.config import NO_ITEM, RunConfig
from promolens.operators import attempts as att
from promolens.operators import sessions as ses
from tests.data import CFG, EVENTS, event


def brute_attempts(rows):
    """Plain restatement of the attempt rules on a list of event tuples."""
    lines = {}
    for r in rows:
        user, ses_, name, ts, txn, _, bundle, offset, items = r[:9]
        for item, _, qty in items or [(None, None, None)]:
            key = (user, ts, name, item)
            rank = (offset, bundle, 1 if qty is None else qty, ses_ is not None, ses_ or 0, txn is not None, txn or "")
            if key not in lines or rank > lines[key][0]:
                lines[key] = (rank, ses_, txn, bundle, offset, 1 if qty is None else qty)
    grouped = defaultdict(list)
    for (user, ts, name, item), (_, ses_, txn, bundle, offset, qty) in lines.items():
        grouped[(user, ses_, item or NO_ITEM)].append((ts, offset, bundle, name, qty, txn))
    out = {}
    for (user, ses_, item), events in grouped.items():
        attempt = 1
        for ts, offset, bundle, name, qty, txn in sorted(events, key=lambda e: e[:4]):
            a = out.setdefault((user, ses_, item, attempt), {"cart": 0, "chk": 0, "pur": 0, "txn": None, "p": None, "last": 0})
            a["last"] = max(a["last"], ts)
            if name == "add_to_cart":
                a["cart"] += qty
            elif name == "begin_checkout":
                a["chk"] = qty
            else:
                a["pur"] += qty
                a["txn"], a["p"] = txn, ts
                attempt += 1
    result = {}
    for (user, ses_, item, n), a in out.items():
        chk = 0 if user is None or ses_ is None else a["chk"]
        result[(user, ses_, item, n)] = (
            max(a["cart"], a["pur"]), max(chk, a["pur"]), a["pur"], a["txn"], a["p"] is not None, a["p"] or a["last"]
        )
    return result


def random_events(seed, n=600, hot=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice(["a", "a", "a"] if hot else ["a", "b", "c", None])
        session = 1 if hot else rng.choice([1, 2, 3, None])
        name = rng.choice(["add_to_cart", "add_to_cart", "begin_checkout", "purchase"])
        items = rng.choice([[], [("x", rng.randint(1, 4))], [("x", 2), ("y", None)], [("x", 1), ("x", 3)]])
        txn = f"T{i}" if name == "purchase" else None
        r = event(user, session, name, rng.randint(0, 40_000) if not hot else i * 60, items, txn, bundle=i, offset=rng.randint(0, 3))
        rows.append(r)
        if rng.random() < 0.2:
            rows.append(r[:7] + (r[7] + 1,) + r[8:])
    rng.shuffle(rows)
    return rows


def run(spark, rows, cfg, parts=None):
    df = spark.createDataFrame(rows, EVENTS)
    if parts:
        df = df.repartition(parts)
    out = att.attempts(df, cfg)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    back = F.timestamp_diff("MICROSECOND", epoch, F.col("attempt_dt_mx")) + 6 * 3600 * 1_000_000
    got = {}
    for r in out.withColumn("_us", back).collect():
        key = (r.USER, r.SESION, r.ITEM, r.INTENTO)
        assert key not in got
        got[key] = (r.qty_add_to_cart, r.qty_begin_checkout, r.qty_purchase, r.transaction_id, r.STATUS == "PURCHASED", r._us)
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_attempts_match_brute_force(spark, seed):
    rows = random_events(seed)
    assert run(spark, rows, CFG) == brute_attempts(rows)


@pytest.mark.parametrize("minutes", [1, 7, 60, 100_000])
def test_slice_width_does_not_change_a_hot_group(spark, minutes):
    rows = random_events(9, hot=True)
    cfg = RunConfig(chunk_minutes=minutes)
    assert run(spark, rows, cfg, parts=3) == brute_attempts(rows)


def test_many_copies_of_one_event_count_once(spark):
    rows = [event(name="purchase", at=5, items=[("x", 2)], txn="T", offset=i % 7) for i in range(500)]
    got = run(spark, rows, CFG)
    assert len(got) == 1 and next(iter(got.values()))[:3] == (2, 2, 2)


def test_quantities_cover_the_purchase_and_last_checkout_wins(spark):
    rows = [
        event(name="add_to_cart", at=1, items=[("x", 1)]),
        event(name="begin_checkout", at=2, items=[("x", 9)]),
        event(name="begin_checkout", at=3, items=[("x", 4)]),
        event(name="purchase", at=4, items=[("x", 3)], txn="T1"),
        event(name="add_to_cart", at=5, items=[("x", 2)]),
    ]
    got = run(spark, rows, CFG)
    assert got[("u", 1, "x", 1)][:3] == (3, 4, 3)
    assert got[("u", 1, "x", 2)][:3] == (2, 0, 0)


def test_attempt_ids_cover_every_deduplicated_event(spark):
    rows = random_events(5)
    df = spark.createDataFrame(rows, EVENTS)
    numbered = att.attempt_ids(df, CFG).collect()
    assert len(numbered) == att.dedup_event_items(att.event_item_qty(att.dedup_items(att.flatten_items(df)))).count()
    per_attempt = defaultdict(int)
    for r in numbered:
        per_attempt[(r.user_pseudo_id, r.session_id, r.product_key, r.attempt_id)] += r.is_purchase
    assert max(per_attempt.values()) == 1


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame(random_events(6), EVENTS)
    once = att.dedup_items(att.flatten_items(df))
    assert sorted(map(str, once.collect())) == sorted(map(str, att.dedup_items(once).collect()))


def test_context_values_survive(spark):
    r = att.attempts(spark.createDataFrame([event(items=[("x", 1)])], EVENTS), CFG).first()
    assert (r.device_category, r.geo_city, r.traffic_medium) == ("mobile", "MTY", "cpc")
    assert r.DATETIME == "29/02/2024 18:00:00" and str(r.attempt_date) == "2024-02-29"


def test_attempts_window_filters_and_renames(spark):
    df = att.attempts(spark.createDataFrame([event(items=[("x", 1)])], EVENTS), CFG)
    assert att.attempts_window(df, CFG).count() == 1
    import datetime as dt

    later = RunConfig(date_start=dt.date(2024, 3, 1), date_end=dt.date(2024, 3, 2))
    assert att.attempts_window(df, later).count() == 0


def test_session_markers_match_brute_force(spark):
    rng = random.Random(4)
    names = ["login", "logout", "view_item_list", "select_item", "add_to_cart", "begin_checkout", "purchase", "sign_up", "remove_from_cart"]
    rows = []
    for i in range(400):
        r = event(rng.choice("ab"), rng.choice([1, 2, None]), rng.choice(names), rng.randint(0, 900), (), discount=rng.choice([None, None, 5]), bundle=i, offset=i % 3)
        rows += [r] * rng.choice([1, 1, 2])
    latest = {}
    for r in rows:
        key, rank = (r[0], r[1], r[2], r[3]), (r[7], r[6], r[5] or -1)
        if key not in latest or rank > latest[key][0]:
            latest[key] = (rank, r)
    want = defaultdict(lambda: {"n": 0, "first": {}, "disc": []})
    for (user, session, name, ts), (_, r) in latest.items():
        w = want[(user, session)]
        w["n"] += 1
        w["first"][name] = min(ts, w["first"].get(name, ts))
        if r[5] is not None:
            w["disc"].append(ts)
    got = ses.session_markers(spark.createDataFrame(rows, EVENTS)).withColumn("seen", ses.discount_seen()).collect()
    assert len(got) == len(want)
    for g in got:
        w = want[(g.user_pseudo_id, g.session_id)]
        assert g.event_count == w["n"]
        for n in names[:-1]:
            assert g[f"{n}_time"] == w["first"].get(n)
        login = w["first"].get("login")
        seen = login is not None and any(t >= login for t in w["disc"])
        assert g.seen == (None if g.session_id is None else seen)


def test_a_hot_hour_without_user_and_session_is_numbered_alike_for_any_slice_width(spark):
    rows = [
        event(user=None, session=None, name=("purchase" if i % 7 == 0 else "add_to_cart"), at=i * 11, items=[("a", 1)], txn=f"t{i}", bundle=i)
        for i in range(300)
    ]
    results = []
    for minutes in (1, 60, 600):
        df = spark.createDataFrame(rows, EVENTS)
        got = att.attempts(df, replace(CFG, chunk_minutes=minutes)).select("INTENTO", "qty_add_to_cart", "qty_purchase").collect()
        results.append(sorted(map(tuple, got)))
    assert results[0] == results[1] == results[2] and len(results[0]) == 44

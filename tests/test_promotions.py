import random

import pytest
from pyspark.sql import functions as F

from promolens.operators import catalog as cat
from promolens.operators import patterns as pat
from tests.data import CFG, PRODUCTS, ROWS, catalog, row

ALWAYS = ("2024-01-01", "2024-12-31T23:59:59")


def detect(spark, rows, c):
    df = spark.createDataFrame(rows, ROWS)
    return {(r.USER, r.SESION, r.ITEM, r.INTENTO): r for r in pat.patterns(df, c).collect()}


def test_simple_rules_active_inactive_and_near_miss(spark):
    c = catalog(
        spark,
        conditions=[(1, 7, 2, 3, None), (2, 7, 1, 3, None), (3, 7, 8, 3, None), (4, 7, 3, 3, None), (4, 7, 2, 9, None), (5, 7, 2, 2, None)],
        validity=[(p, *ALWAYS) for p in (1, 2, 3, 4)],
    )
    r = next(iter(detect(spark, [row(7, add=2, chk=3, pur=8)], c).values()))
    assert r.PROMOS_ADD_CART_COMPLETAS == [4]
    assert r.PROMOS_ADD_CART_INCOMPLETAS == [1, 2, 3]
    assert r.PROMOS_ADD_CART_TODAS == [1, 2, 3, 4, 5]  # promotion 5 is met but never valid
    assert r.PROMOS_CHECKOUT_COMPLETAS == [1, 2, 4] and r.PROMOS_CHECKOUT_INCOMPLETAS == []
    assert r.DESC_CHECKOUT_COMPLETAS == "Exactamente 3 unidades | Máximo 3 unidades | Mínimo 3 unidades"
    # promotion 4 has two conditions on the product: near miss of one, unmet other; promotion 1 complete
    assert r.PROMOS_PURCHASE_COMPLETAS == [1] and r.PROMOS_PURCHASE_INCOMPLETAS == [4]
    assert (r.PATRON_ADD_CART, r.PATRON_BEGIN_CHECKOUT, r.TIENE_PATRON_COMPLETO, r.TIENE_PATRON_INCOMPLETO) == ("SI",) * 4


def test_validity_includes_both_ends(spark):
    c = catalog(spark, conditions=[(1, 7, 2, 1, None)], validity=[(1, "2024-03-01", "2024-03-02T10:00:00.500000")])
    rows = [
        row(7, 1, at=t, attempt=i)
        for i, t in enumerate(["29/02/2024 23:59:59", "01/03/2024 00:00:00", "02/03/2024 10:00:00", "02/03/2024 10:00:01"])
    ]
    got = detect(spark, rows, c)
    assert [got[("u", 1, "item 7", i)].PATRON_ADD_CART for i in range(4)] == ["NO", "SI", "SI", "NO"]


def test_combined_promotions(spark):
    c = catalog(
        spark,
        conditions=[(9, 1, 2, 1, None)],
        combos=[(9, 1, 2), (9, 2, 2), (8, 1, 1), (8, 3, 0), (6, 1, 0), (6, 2, 0), (5, 1, 1), (5, 2, 1)],
        validity=[(9, *ALWAYS), (8, *ALWAYS), (6, *ALWAYS)],
    )
    rows = [
        row(1, add=1, chk=2, attempt=1), row(1, add=1, attempt=2), row(2, add=2, chk=1, item="b"),
        row(1, add=3, session=2), row(2, add=0, session=2, item="b"),
    ]
    got = detect(spark, rows, c)
    first, second, other = got[("u", 1, "item 1", 1)], got[("u", 1, "item 1", 2)], got[("u", 1, "b", 1)]
    # The session sums to 2 + 2, yet no single row of product 1 reaches 2: the row does not own promotion 9.
    assert first.PROMOS_ADD_CART_COMPLETAS == [6, 8] and second.PROMOS_ADD_CART_COMPLETAS == [6, 8]
    assert other.PROMOS_ADD_CART_COMPLETAS == [6, 9]
    # Checkout: product 1 reaches 2 on its row, product 2 stays below 2.
    assert first.PROMOS_CHECKOUT_INCOMPLETAS == [9] and first.PROMOS_CHECKOUT_TODAS == [6, 8, 9]
    # Promotion 9 is combined, so its simple condition is ignored; 5 has no validity window.
    assert got[("u", 2, "item 1", 1)].PROMOS_ADD_CART_INCOMPLETAS == [9]


def test_session_date_decides_the_session_result(spark):
    c = catalog(spark, combos=[(9, 1, 1), (9, 2, 1)], validity=[(9, "2024-03-02", "2024-03-05T00:00:00")])
    rows = [row(1, add=1, at="01/03/2024 10:00:00"), row(2, add=1, at="03/03/2024 10:00:00", item="b")]
    got = detect(spark, rows, c)
    assert got[("u", 1, "item 1", 1)].PROMOS_ADD_CART_TODAS == []
    assert got[("u", 1, "b", 1)].PROMOS_ADD_CART_INCOMPLETAS == [9]


def test_rows_without_product_session_or_time_stay_with_empty_sets(spark):
    c = catalog(spark, conditions=[(1, 7, 2, 1, None)], validity=[(1, *ALWAYS)])
    rows = [row(None, add=5, item="x"), row(7, add=5, session=None), row(7, add=5, at="bad", item="y"), row(7, add=None, item="z")]
    for r in detect(spark, rows, c).values():
        assert r.PROMOS_ADD_CART_TODAS == [] and r.PATRON_ADD_CART == "NO" and r.DESC_ADD_CART_COMPLETAS == ""


# Worked out by hand: quantities 1 to 6 that meet the conditions of the random test, by (type, n); m is 5, 0 or missing.
MET = {
    (1, 1): {1}, (1, 2): {2}, (1, 3): {3}, (1, 4): {4},
    (2, 0): {1, 2, 3, 4, 5, 6}, (2, 1): {1, 2, 3, 4, 5, 6}, (2, 2): {2, 3, 4, 5, 6}, (2, 3): {3, 4, 5, 6}, (2, 4): {4, 5, 6},
    (3, 1): {1}, (3, 2): {1, 2}, (3, 3): {1, 2, 3}, (3, 4): {1, 2, 3, 4},
    (5, 0): {1, 2, 3, 4, 5, 6}, (5, 1): {1, 2, 3, 4, 5, 6}, (5, 2): {2, 3, 4, 5, 6}, (5, 3): {3, 4, 5, 6}, (5, 4): {4, 5, 6},
    (6, 1): {1, 2, 3, 4, 5, 6}, (6, 2): {2, 4, 6}, (6, 3): {3, 6}, (6, 4): {4},
    (7, 1): {1, 2, 3, 4, 5, 6}, (7, 2): {2, 4, 6}, (7, 3): {3, 6}, (7, 4): {4},
}
UP_TO_FIVE = {0: {1, 2, 3, 4, 5}, 1: {1, 2, 3, 4, 5}, 2: {2, 3, 4, 5}, 3: {3, 4, 5}, 4: {4, 5}}


def met(q, kind, n, m):
    if kind == 4:
        return q in (UP_TO_FIVE[n] if m else {n} - {0})
    return q in MET.get((kind, n), ())


def brute(rows, conditions, combos, spans):
    combined = {p for p, _, _ in combos}

    def live(p):
        return p in spans

    out = {}
    for user, ses, at, item, n, *qty, prod in rows:
        sets = []
        for stage in range(3):
            q = qty[stage]
            full, near, every = set(), set(), set()
            for p, cp, kind, cn, cm in conditions:
                if cp != prod or p in combined:
                    continue
                if met(q, kind, cn, cm):
                    every.add(p)
                    if live(p):
                        full.add(p)
                elif live(p) and q > 0 and q == cn - 1:
                    near.add(p)
                    every.add(p)
            for p, cp, need in combos:
                if cp != prod or not live(p) or q < need:
                    continue
                every.add(p)
                sums = {}
                for r in rows:
                    if r[0] == user and r[1] == ses:
                        sums[r[8]] = sums.get(r[8], 0) + r[5 + stage]
                done = all(sums.get(x, 0) >= k for pp, x, k in combos if pp == p)
                (full if done else near).add(p)
            sets += [sorted(full), sorted(near), sorted(every)]
        out[(user, ses, item, n)] = sets
    return out


@pytest.mark.parametrize("max_rows", [200_000, 0])
def test_random_rows_match_brute_force_on_both_lookup_paths(spark, max_rows):
    rng = random.Random(11)
    conditions = [(p, rng.randint(1, 4), rng.randint(1, 8), rng.randint(0, 4), rng.choice([None, 0, 5])) for p in range(1, 13)]
    combos = [(20, 1, 2), (20, 2, 1), (21, 3, 4), (21, 4, 0), (22, 1, 1), (22, 3, 1), (22, 4, 2)]
    conditions += [(20, 1, 2, 1, None)]
    valid = {p for p in [*range(1, 13), 20, 21, 22] if p % 4}
    c = catalog(spark, conditions, combos, [(p, *ALWAYS) for p in valid], max_rows=max_rows)
    rows = [
        row(p, *[rng.randint(0, 6) for _ in range(3)], user=u, session=s, attempt=a)
        for u in "ab" for s in (1, 2, 3) for p in rng.sample([1, 2, 3, 4, 5], 4) for a in (1, 2)
    ]
    want = brute(rows, conditions, combos, valid)
    got = detect(spark, rows, c)
    assert len(got) == len(want)
    names = [f"PROMOS_{s}_{k}" for _, _, s, _ in pat.STAGES for k in ("COMPLETAS", "INCOMPLETAS", "TODAS")]
    for key, r in got.items():
        assert [r[n] for n in names] == want[key], key
        for _, _, s, _ in pat.STAGES:
            assert set(r[f"PROMOS_{s}_COMPLETAS"]) <= set(r[f"PROMOS_{s}_TODAS"])


def test_both_rule_paths_agree_on_texts_and_flags(spark):
    rng = random.Random(5)
    conditions = [(p, rng.randint(1, 3), rng.randint(1, 8), rng.randint(0, 3), None) for p in range(1, 20)]
    rows = [row(p, *[rng.choice([None, 0, 1, 2, 3, 4]) for _ in range(3)], session=s) for p in (1, 2, 3) for s in range(9)]
    results = []
    for max_rows in (200_000, 0):
        c = catalog(spark, conditions, [(30, 1, 1), (30, 2, 2)], [(p, *ALWAYS) for p in (*range(1, 20, 2), 30)], max_rows=max_rows)
        df = spark.createDataFrame(rows, ROWS)
        every = [pat.patterns(df, c), pat.simple_promos(df, c), pat.combo_promos(df, c)]
        results.append([sorted(str(r.asDict()) for r in x.select(sorted(x.columns)).collect()) for x in every])
    assert results[0] == results[1]
    assert any("unidades" in r for r in results[0][1])


def test_two_raw_names_of_one_clean_name_keep_their_own_results(spark):
    """Attempts are numbered by raw name, so two attempts can agree in all but it."""
    dims = "device_category string, geo_country string, geo_region string, geo_city string, traffic_source string, traffic_medium string"
    ddl = (
        f"USER string, SESION bigint, DATETIME string, ITEM string, INTENTO bigint, {dims}, STATUS string, CANTIDAD_ADD_TO_CART bigint, "
        "CANTIDAD_BEGIN_CHECKOUT bigint, CANTIDAD_PURCHASE bigint"
    )
    rows = [
        ("u", 1, "01/03/2024 12:00:00", name, 1, *[None] * 6, "NO_PURCHASE", n, 0, 0) for name, n in (("LQ 12", 3), ("Sorteo Lo Quiero 12", 5))
    ]
    for max_rows in (200_000, 0):
        c = catalog(
            spark,
            conditions=[(7, 1, 1, 3, None), (8, 1, 1, 5, None)],
            combos=[(99, 1, 4), (99, 2, 0)],
            validity=[(p, *ALWAYS) for p in (7, 8, 99)],
            products=[(1, "Sorteo Lo Quiero", "t", 12, 1.0, None)],
            max_rows=max_rows,
        )
        enriched = pat.enrich_attempts(spark.createDataFrame(rows, ddl), c, CFG)
        got = {r.CANTIDAD_ADD_TO_CART: r for r in pat.patterns(enriched, c).collect()}
        assert got[3].ITEM == got[5].ITEM == "Sorteo Lo Quiero 12"
        assert got[3].PROMOS_ADD_CART_COMPLETAS == [7] and got[5].PROMOS_ADD_CART_COMPLETAS == [8, 99]
        assert not [x for x in pat.patterns(enriched, c).columns if x.startswith("_")]


def test_the_window_that_ends_last_counts(spark):
    spans = spark.createDataFrame([(1, "2024-01-05", "2024-02-01"), (1, "2024-01-01", "2024-03-01"), (1, "2024-01-02", "2024-03-01"), (None, "2024-01-01", "2024-01-02")],
        "clave_promocion bigint, d_inicio_promocion string, d_cierre_promocion string")
    assert [(r[0], str(r[1]), str(r[2])) for r in cat.validity_lookup(spans).collect()] == [(1, "2024-01-02 00:00:00", "2024-03-01 00:00:00")]


def test_enrichment_fans_out_on_equal_names_unless_told_otherwise(spark):
    import datetime as dt

    products = [
        (2, "Gana Ya", "t", 5, 10.0, dt.datetime(2024, 3, 11, 3)), (1, "Gana Ya", "t", 5, 12.0, dt.datetime(2024, 3, 11, 3)),
        (3, "Solo", "t", None, 7.0, None),
    ]
    rows = [row(None, add=2, chk=1, item="Gana Ya"), row(None, add=3, item="Solo 0"), row(None, add=3, chk=1, item="Otro")]
    df = spark.createDataFrame(rows, ROWS).drop("clave_edicion_producto")
    for max_rows in (200_000, 0):
        c = catalog(spark, products=products, max_rows=max_rows)
        assert pat.enrich_attempts(df, c, CFG).count() == 4
        got = {r.ITEM: r for r in pat.enrich_attempts(df, c, CFG, dedup_catalog=True).collect()}
        assert len(got) == 3
        first = got["Gana Ya 5"]
        assert (first.clave_edicion_producto, first.MONTO_ADD_TO_CART, first.dias_para_sorteo) == (1, 24.0, 10.0)
        assert got["Solo 0"].MONTO_ADD_TO_CART == 21.0
        other = got["Otro"]
        assert (other.MONTO_ADD_TO_CART, other.MONTO_BEGIN_CHECKOUT, other.clave_edicion_producto) == (0.0, None, None)


def test_requirements_accept_any_case_and_lenient_numbers(spark):
    df = spark.createDataFrame(
        [("1", "10", "2.0"), ("1", "10", "3"), ("1", "11", "x"), ("1", None, "1"), (None, "10", "1"), ("2", "bad", "1")],
        "CLAVE_PROMOCION string, CLAVE_EDICION_PRODUCTO string, CANTIDAD_INICIAL string",
    )
    every = cat.combo_requirements_all(df)
    assert sorted(map(tuple, cat.combo_requirements(every).collect())) == [(1, 10, 3)]
    assert sorted(r[0] for r in cat.combo_ids(every).collect()) == [1, 2]
    assert cat.requirement_lists(cat.combo_requirements(every)).first().requisitos[0].cantidad_requerida == 3


def test_validity_of_unpaid_promotions_is_null(spark):
    bought = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (3, 8)], "agrupador_interno_compra bigint, clave_promocion bigint")
    paid = spark.sql(
        "select '1' agrupador_interno_compra, timestamp_ntz'2024-01-05 10:00:00' fecha_pagado "
        "union all select '1', timestamp_ntz'2024-01-04 23:00:00' union all select '2', timestamp_ntz'2024-01-09 01:02:03'"
    )
    got = {r[0]: (str(r[1]), str(r[2])) for r in cat.promo_validity(bought, paid).collect()}
    assert got == {7: ("2024-01-04", "2024-01-09 01:02:03"), 8: ("None", "None")}


def test_catalog_names(spark):
    df = spark.createDataFrame([(1, "A", "t", None, 1.0, None), (2, None, "t", 4, 1.0, None)], PRODUCTS)
    assert [r.item_completo for r in cat.catalog_items(df).orderBy("clave_edicion_producto").collect()] == ["A 0", None]
    assert cat.catalog_items(df).where(F.col("item_completo").isNull()).count() == 1

import itertools

import pytest
from pyspark.sql import functions as F

from promolens.config import ITEM_OVERRIDES, NAME_REWRITES
from promolens.functions import labels, rules, text, times


# Worked out by hand: which of the quantities 1 to 12 meet (type, n, m). Any other combination below meets none.
MEETS = {
    (1, 1, None): {1}, (1, 2, None): {2}, (1, 3, None): {3},
    (2, 0, None): set(range(1, 13)), (2, 1, None): set(range(1, 13)), (2, 3, None): {3, 4, 5, 6, 7, 8, 9, 10, 11, 12},
    (2, -2, None): set(range(1, 13)),
    (3, 1, None): {1}, (3, 3, None): {1, 2, 3}, (3, 4, None): {1, 2, 3, 4},
    (4, 2, 5): {2, 3, 4, 5}, (4, 3, None): {3}, (4, 3, 0): {3}, (4, 2, 2): {2}, (4, 0, 5): {1, 2, 3, 4, 5}, (4, -2, 5): {1, 2, 3, 4, 5},
    (5, 2, None): {2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12}, (5, 4, None): {4, 5, 6, 7, 8, 9, 10, 11, 12},
    (6, 1, None): set(range(1, 13)), (6, 2, None): {2, 4, 6, 8, 10, 12}, (6, 3, None): {3, 6, 9, 12}, (6, 4, None): {4, 8, 12},
    (6, -2, None): {2, 4, 6, 8, 10, 12},
    (7, 1, None): set(range(1, 13)), (7, 3, None): {3, 6, 9, 12}, (7, 4, None): {4, 8, 12},
}
NONE_MEETS = [
    (1, 0, None), (1, -2, None), (3, 0, None), (3, -2, None), (4, 5, 2), (6, 0, None), (7, 0, None), (7, -2, None), (8, 3, None),
    (None, 3, None), *[(k, None, None) for k in range(1, 9)], (4, None, 5),
]


def test_rules_on_hand_made_cases(spark):
    quantities = [None, 0, *range(1, 13)]
    cases = {**MEETS, **{c: set() for c in NONE_MEETS}}
    grid = [(q, *case) for case in cases for q in quantities]
    df = spark.createDataFrame(grid, "q bigint, kind bigint, n bigint, m bigint")
    q, kind, n, m = (F.col(c) for c in ("q", "kind", "n", "m"))
    b = rules.rule_bounds(kind, n, m)
    got = df.select(
        "q", "kind", "n", "m", rules.meets(q, b["lo"], b["hi"], b["step"]).alias("met"), rules.one_short(q, n - 1).alias("near")
    ).collect()
    for r in got:
        assert r.met == (r.q in cases[r.kind, r.n, r.m]), r
    near = {(r.q, r.n) for r in got if r.near}
    assert near == {(1, 2), (2, 3), (3, 4), (4, 5)}


def test_quantity_text(spark):
    df = spark.createDataFrame(
        [(1, 3, None), (4, 3, 5), (4, 3, None), (6, 3, None), (7, 3, None), (9, 3, None)], "k bigint, n bigint, m bigint"
    )
    got = [r[0] for r in df.select(rules.quantity_text(F.col("k"), F.col("n"), F.col("m"))).collect()]
    assert got == [
        "Exactamente 3 unidades", "Entre 3 y 5 unidades", "Entre 3 y <NA> unidades", "Por cada 3 unidades",
        "Múltiplo de 3", "Tipo 9: 3",
    ]


# Worked out by hand from the description of the three steps: leading number to the end, rewrite, drop a repeated number.
CLEAN = {
    "123": " 123", "5 6 X": "6 X 5", "5° X": "X 5", "5 °X  ": "X 5", "LQ 12": "Sorteo Lo Quiero 12", "LQ12": "Sorteo Lo Quiero12",
    "X LQ Y": "X Sorteo Lo Quiero Y", "Sorteo Efectivo 3": "Efectivo 3", "El Sorteo Efectivo": "El Efectivo", "X 12 12": "X 12",
    "X 5 55": "X 5 55", "X 12  12": "X 12", "Gana Ya": "Gana Ya", "Sorteo Educativo 7 7": "Sorteo Educativo 7", "": "",
    "LQ LQ 4": "Sorteo Lo Quiero Sorteo Lo Quiero 4", "12° LQ": "Sorteo Lo Quiero 12", None: None,
}


def test_clean_item(spark):
    df = spark.createDataFrame([(n,) for n in CLEAN], "x string")
    clean = text.clean_item(F.col("x"), NAME_REWRITES)
    for r in df.select("x", clean.alias("c"), text.override_item(clean, ITEM_OVERRIDES).alias("o")).collect():
        assert r.c == CLEAN[r.x], r.x
        assert r.o == ("Gana Ya 5" if r.c == "Gana Ya" else r.c)


def test_clean_item_takes_names_literally(spark):
    df = spark.createDataFrame([("A+ 3",), ("xA+",)], "x string")
    got = [r[0] for r in df.select(text.clean_item(F.col("x"), (("A+", "B$1"),))).collect()]
    assert got == ["B$1 3", "xB$1"]


def test_times_ignore_the_session_zone(spark):
    us = 1_709_280_000_123_456  # 2024-03-01 08:00:00.123456 UTC
    df = spark.createDataFrame([(us, "31/03/2024 02:30:00"), (us, "01/03/2024 02:00:00.5"), (us, "2024-03-01"), (us, None)], "us bigint, t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Madrid", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(
                times.time_text(times.local_wall(F.col("us"), "America/Mexico_City")).alias("a"),
                times.parse_time_text(F.col("t")).cast("string").alias("p"),
                times.minute_of(times.utc_wall(F.col("us"))).cast("string").alias("m"),
            ).collect()
            assert {r.a for r in got} == {"01/03/2024 02:00:00"}
            assert [r.p for r in got] == ["2024-03-31 02:30:00", "2024-03-01 02:00:00.5", None, None]
            assert got[0].m == "2024-03-01 08:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


STEPS = ("VIEW_ITEM_LIST", "SELECT_ITEM", "ADD_TO_CART", "BEGIN_CHECKOUT")


def expected_category(login, present):
    if login is None:
        return "SIN LOGIN EN SESIÓN"
    order = sorted((t, s) for s, t in present.items() if t is not None)
    if not order:
        return "CON LOGIN SIN EVENTOS DE FUNNEL"
    earlier = [s for t, s in order if t <= login]
    later = [s for t, s in order if t > login]
    if not earlier:
        return f"LOGIN ANTES DE {later[0]}"
    if not later:
        return f"LOGIN DESPUÉS DE {earlier[-1]}"
    return f"LOGIN ENTRE {earlier[-1]} Y {later[0]}"


def test_login_labels_for_all_small_timelines(spark):
    options = [None, 1, 2, 3]
    rows = [(login, *ts) for login in options for ts in itertools.product(options, repeat=4)]
    df = spark.createDataFrame(rows, "login bigint, a bigint, b bigint, c bigint, d bigint")
    steps = labels.ordered_steps(dict(zip(STEPS, (F.col(x) for x in "abcd"))))
    got = df.select("*", labels.login_category(F.col("login"), steps).alias("cat"), labels.login_vs_step(F.col("login"), F.col("a")).alias("vs")).collect()
    for r in got:
        assert r["cat"] == expected_category(r.login, dict(zip(STEPS, (r.a, r.b, r.c, r.d)))), r
        want = (
            "SIN LOGIN" if r.login is None else "SIN EVENTO" if r.a is None
            else "ANTES" if r.login < r.a else "DESPUÉS" if r.login > r.a else "EMPATE"
        )
        assert r.vs == want


@pytest.mark.parametrize(
    ("row", "want"),
    [
        ((True, None, 9, None, None, None, None, 5), "LOGIN YA INICIADO"),
        ((True, None, 4, None, None, None, None, 5), "PROBABLE LOGIN YA INICIADO"),
        ((True, None, None, None, None, None, None, 5), "PROBABLE LOGIN YA INICIADO"),
        ((False, None, 3, None, None, None, None, None), "LOGIN INICIADO SIN COMPRA"),
        ((False, None, None, 1, None, None, None, None), "SIN LOGIN EN SESIÓN"),
        ((None, None, None, None, None, None, None, None), "SIN LOGIN EN SESIÓN"),
        ((True, 5, None, None, None, 9, 4, 6), "LOGIN DESPUÉS DE BEGIN_CHECKOUT"),
        ((True, 3, None, None, None, 1, 4, 6), "LOGIN ANTES DE BEGIN_CHECKOUT"),
        ((True, 4, None, None, None, 9, 4, 6), "LOGIN ANTES DE ADD_TO_CART"),
        ((True, 4, None, None, 9, 2, 4, 6), "LOGIN TEMPRANO - ANTES DE SELECT_ITEM"),
        ((True, 4, None, 9, 2, 2, 4, 6), "LOGIN TEMPRANO - ANTES DE VIEW_ITEM_LIST"),
        ((False, 4, None, None, None, None, None, None), "CON LOGIN SIN EVENTOS DE FUNNEL"),
        ((True, 4, None, None, None, None, 4, 6), "OTROS"),
    ],
)
def test_login_bucket(spark, row, want):
    cols = ["hp", "login", "logout", "vl", "sel", "cart", "chk", "pur"]
    df = spark.createDataFrame([row], "hp boolean, " + ", ".join(f"{c} bigint" for c in cols[1:]))
    assert df.select(labels.login_bucket(*[F.col(c) for c in cols])).first()[0] == want

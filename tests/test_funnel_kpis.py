import datetime as dt

import pytest
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.operators import funnel as fun
from promolens.operators import kpis, quality
from tests.data import CFG, PRODUCTS

ATTEMPT = "user_pseudo_id string, session_id bigint, ITEM string, intento bigint, attempt_dt_mx timestamp_ntz"


def at(minute, second=0):
    return dt.datetime(2024, 3, 1, 10, minute, second)


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_density_and_products_per_session(spark, bound):
    rows = [
        ("a", 1, "x", 1, at(0, 1)), ("a", 1, "y", 1, at(0, 59)), ("b", 1, "x", 1, at(0)), ("a", None, "x", 1, at(1)),
        ("a", None, "z", 1, at(1)), (None, 1, "x", 1, None),
    ]
    df = spark.createDataFrame(rows, ATTEMPT)
    cfg = RunConfig(date_start=CFG.date_start, date_end=CFG.date_end, calendar_rows=bound)
    dense = {(r[0], r[1], r[2]): r.traffic_density_score for r in fun.traffic_density(df, cfg).collect()}
    assert [dense[k] for k in [("a", 1, "x"), ("a", 1, "y"), ("b", 1, "x"), ("a", None, "x")]] == [3, 3, 3, 2]
    assert len(dense) == 6
    many = {(r[0], r[1], r[2]): r.products_in_session_count for r in fun.products_in_session(df).collect()}
    assert [many[k] for k in [("a", 1, "x"), ("b", 1, "x"), ("a", None, "z"), (None, 1, "x")]] == [2, 1, 2, 1]


@pytest.mark.parametrize("bound", [200_000, 0])
def test_price_from_purchase_else_catalogue(spark, bound):
    products = [(2, "Gana Ya", "t", 5, 11.0, None), (1, "Gana Ya", "t", 5, 10.0, None)]
    rows = [("u", 1, 1, "5° Gana Ya", 2, 1, 0, None), ("u", 1, 2, "Gana Ya 5", 3, 2, 2, 8.0), ("u", 1, 3, "Gana Ya", 1, 1, 0, None)]
    df = spark.createDataFrame(
        rows,
        "user_pseudo_id string, session_id bigint, intento bigint, ITEM string, qty_add_to_cart bigint, "
        "qty_begin_checkout bigint, qty_purchase bigint, precio_unitario_inferido double",
    )
    cfg = RunConfig(broadcast_rows=bound)
    got = {r.intento: r for r in fun.price_inference(df, spark.createDataFrame(products, PRODUCTS), cfg).collect()}
    assert (got[1].ITEM, got[1].precio_unitario_inferido, got[1].MONTO_ADD_TO_CART, got[1].MONTO_PURCHASE) == ("Gana Ya 5", 10.0, 20.0, 0.0)
    assert (got[2].MONTO_ADD_TO_CART, got[2].MONTO_BEGIN_CHECKOUT, got[2].MONTO_PURCHASE) == (24.0, 16.0, 16.0)
    # Pricing does not apply the exact-name override.
    assert got[3].ITEM == "Gana Ya" and got[3].MONTO_ADD_TO_CART is None


FUNNEL = (
    "user_pseudo_id string, session_id bigint, ITEM string, intento bigint, STATUS string, TRANSACTION_ID string, "
    "categoria_login string, qty_add_to_cart double, qty_begin_checkout double, qty_purchase double, "
    "precio_unitario_inferido double, MONTO_BEGIN_CHECKOUT double, MONTO_PURCHASE double, PATRON_BEGIN_CHECKOUT string, "
    "TIENE_PATRON_COMPLETO string, TIENE_PATRON_INCOMPLETO string, PROMOS_ADD_CART_COMPLETAS array<bigint>, "
    "PROMOS_ADD_CART_INCOMPLETAS array<bigint>, event_count bigint"
)
NO = "SIN LOGIN EN SESIÓN"


def fact(user, session, cat=NO, chk=None, pur=None, patron="NO", full=(), near=(), attempt=1, item="x", qty=(1.0, 1.0, 0.0), status="NO_PURCHASE", txn=None, price=1.0, events=3):
    return (
        user, session, item, attempt, status, txn, cat, *qty, price, chk, pur, patron,
        "SI" if full else "NO", "SI" if near else "NO", full if full is None else list(full), near if near is None else list(near), events,
    )


def funnel_frame(spark, rows):
    return spark.createDataFrame(rows, FUNNEL)


def test_kpi_groups_and_headline(spark):
    rows = [
        fact("a", 1, NO, 100.0, None, "SI"), fact("a", 1, NO, 20.0, 0.0, attempt=2),
        fact("b", 1, "LOGIN ANTES DE ADD_TO_CART", 50.0, 0.0, "SI"), fact("c", 1, None, 30.0, 5.0),
        fact("d", 1, NO, 40.0, 40.0, "SI"), fact("e", None, NO, 999.0, 999.0, "SI"), fact("f", 1, NO, None, None),
    ]
    r = kpis.session_kpis(kpis.session_rollup(funnel_frame(spark, rows))).first().asDict()
    assert (r["total_sesiones_count"], r["total_sesiones_monto_begin_checkout"], r["total_sesiones_monto_purchase"]) == (5, 240.0, 45.0)
    assert (r["sesiones_con_login_count"], r["sesiones_con_login_monto_begin_checkout"]) == (2, 80.0)
    assert r["sesiones_con_login_sin_purchase_count"] == 1
    assert r["sesiones_sin_login_sin_purchase_con_patron_bc_monto_begin_checkout"] == 120.0
    assert r["sesiones_login_sin_registrar_con_purchase_con_patron_bc_count"] == 1
    head = kpis.kpi_summary(kpis.session_kpis(kpis.session_rollup(funnel_frame(spark, rows)))).first()[0]
    assert head == pytest.approx(120.0 - 50.0 / 80.0 * 120.0)
    alone = kpis.session_kpis(kpis.session_rollup(funnel_frame(spark, rows[:1])))
    assert kpis.kpi_summary(alone).first()[0] is None


def test_row_and_session_flags(spark):
    combos = spark.createDataFrame([(7,), (8,)], "clave_promocion bigint")
    rows = [
        fact("a", 1, full=[1], near=[7]), fact("a", 1, near=[2], attempt=2), fact("b", 1, full=[8]),
        fact("c", 1, full=None, near=None), fact("d", None, near=[7]),
    ]
    flags = kpis.promo_row_flags(funnel_frame(spark, rows), combos)
    got = {(r.user_pseudo_id, r.intento): [r[c] for c in kpis.ROW_FLAGS] for r in flags.collect()}
    assert got[("a", 1)] == [False, True, True, False] and got[("a", 2)] == [True, False, False, False]
    assert got[("b", 1)] == [False, False, False, True] and got[("c", 1)] == [False] * 4
    assert kpis.row_flag_summary(flags).first().asDict() == {
        "total_filas": 5, "filas_simple_incompleta": 1, "filas_combinada_incompleta": 2, "filas_ambas": 0
    }
    inc = kpis.promo_incidence(kpis.session_promo_flags(flags)).first()
    assert (inc.total_sesiones, inc.sesiones_ambas, inc.sesiones_con_simple, inc.sesiones_con_combinada) == (3, 1, 1, 2)
    assert inc.pct_combinada_incompleta_sobre_con_combinada == 0.5


def test_row_flags_start_no_job_and_hold_no_ids(spark):
    combos = spark.range(50_000).withColumnRenamed("id", "clave_promocion")
    frame = funnel_frame(spark, [fact("a", 1, near=[7])])
    group = "row-flags"
    spark.sparkContext.setJobGroup(group, group)
    try:
        flags = kpis.promo_row_flags(frame, combos)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(group) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = flags._jdf.queryExecution().toString()
    assert "collect_set" not in text and " IN (" not in text and "INSET" not in text


def test_validity_and_event_checks(spark):
    spans = spark.sql("select 1L clave_promocion, date'2024-01-01' d_inicio_promocion, timestamp_ntz'2024-01-10 00:00:00' d_cierre_promocion "
                      "union all select 2L, null, null")
    rows = [("2024-01-05 00:00:00", [1, 2], [], []), ("2024-02-05 00:00:00", [1, 3], [1], None)]
    df = spark.createDataFrame(rows, "t string, PROMOS_ADD_CART_COMPLETAS array<bigint>, PROMOS_CHECKOUT_COMPLETAS array<bigint>, PROMOS_PURCHASE_COMPLETAS array<bigint>")
    got = quality.validity_checks(df.withColumn("attempt_dt_mx", F.col("t").cast("timestamp_ntz")), spans)
    assert sorted(map(tuple, got.collect())) == [("ADD_CART", 4, 2, 1), ("CHECKOUT", 1, 0, 1)]
    lines = spark.createDataFrame([("u", 1, "a", 5)] * 3 + [("u", 1, "b", 5), ("u", None, "a", 5)], "user_pseudo_id string, session_id bigint, item_name string, event_timestamp bigint")
    assert tuple(quality.event_checks(lines).first()) == (5, 3, 3)


def test_flags_without_combined_promotions(spark):
    none = spark.createDataFrame([], "clave_promocion bigint")
    flags = kpis.promo_row_flags(funnel_frame(spark, [fact("a", 1, near=[7])]), none).first()
    assert (flags.HAS_SIMPLE_INCOMPLETE, flags.HAS_COMBINED_INCOMPLETE) == (True, False)
    inc = kpis.promo_incidence(kpis.session_promo_flags(kpis.promo_row_flags(funnel_frame(spark, []), none))).first()
    assert inc.total_sesiones == 0 and inc.pct_simple_incompleta_sobre_con_simple == 0.0


def test_rates_impact_and_integrity(spark):
    rows = [
        fact("a", 1, full=[1], pur=10.0, qty=(2.0, 2.0, 2.0), price=5.0, status="PURCHASED", txn="T"),
        fact("b", 1, near=[1], qty=(1.0, 2.0, 0.0), price=None, pur=None), fact("c", 1, qty=(1.0, 0.0, 0.0), price=-1.0, pur=0.0),
        fact("d", 1, qty=(1.0, 1.0, 1.0), pur=3.0, price=1.0, status="PURCHASED", events=None),
        fact("d", 1, qty=(1.0, 1.0, 1.0), pur=1.0, price=1.0, status="PURCHASED", txn="T"),
    ]
    df = funnel_frame(spark, rows)
    rate = quality.conversion_rates(df).first()
    assert (rate.total_sesiones, rate.cart_to_checkout, rate.checkout_to_purchase, rate.overall) == (4, 0.75, pytest.approx(2 / 3), 0.5)
    impact = quality.promo_impact(df).first()
    assert (impact.con_patron, impact.sin_patron, impact.lift) == (1.0, pytest.approx(1 / 3), pytest.approx(2.0))
    lost = quality.lost_opportunity(df).first()
    assert lost.oportunidad_perdida == pytest.approx(1 * 7.0 * 0.5)
    bad = quality.integrity_checks(df).first()
    assert (bad.total_filas, bad.cart_below_checkout, bad.checkout_below_purchase, bad.price_not_positive, bad.price_missing) == (5, 1, 0, 1, 1)
    assert (bad.duplicate_attempts, bad.purchase_without_transaction, bad.amount_mismatch, bad.rows_without_session) == (1, 1, 1, 1)
    assert bad.qty_purchase_total == 4.0 and bad.monto_purchase_total == 14.0


def test_promos_seen_and_coverage(spark):
    df = spark.createDataFrame([([1, 2],), ([2],), ([],), (None,)], "p array<bigint>")
    assert sorted(r[0] for r in kpis.promos_seen(df, "p").collect()) == [1, 2]
    cov = kpis.condition_coverage(spark.createDataFrame([(dt.date(2024, 1, 1),), (None,)], "d_inicio_promocion date")).first()
    assert tuple(cov) == (2, 1, 1)
    assert df.where(F.size("p") > 1).count() == 1

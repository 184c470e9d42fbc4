"""Small hand-made inputs."""

from __future__ import annotations

import datetime as dt

from promolens.config import RunConfig
from promolens.operators.catalog import Catalog

CFG = RunConfig(date_start=dt.date(2024, 1, 1), date_end=dt.date(2024, 12, 31))
EVENTS = (
    "user_pseudo_id string, session_id bigint, event_name string, event_timestamp bigint, transaction_id string, "
    "discount bigint, event_bundle_sequence_id bigint, event_server_timestamp_offset bigint, "
    "items array<struct<item_name:string,item_id:string,quantity:bigint>>, device_category string, geo_country string, "
    "geo_region string, geo_city string, traffic_source string, traffic_medium string"
)
ROWS = (
    "USER string, SESION bigint, DATETIME string, ITEM string, INTENTO bigint, CANTIDAD_ADD_TO_CART bigint, "
    "CANTIDAD_BEGIN_CHECKOUT bigint, CANTIDAD_PURCHASE bigint, clave_edicion_producto bigint"
)
CONDITIONS = (
    "clave_grupo_condiciones bigint, clave_edicion_producto bigint, clave_tipo_cantidad_condicion bigint, "
    "cantidad_inicial bigint, cantidad_final bigint"
)
VALIDITY = "clave_promocion bigint, d_inicio_promocion date, d_cierre_promocion timestamp_ntz"
PRODUCTS = (
    "clave_edicion_producto bigint, desc_sorteo string, tipo_producto string, numero_sorteo bigint, "
    "precio_unitario double, fecha_celebracion timestamp"
)
MIDNIGHT = 1_709_251_200_000_000  # 2024-03-01 00:00 UTC


def event(user="u", session=1, name="add_to_cart", at=0, items=(), txn=None, discount=None, bundle=0, offset=0):
    """``at`` in seconds after midnight; ``items`` as (name, quantity) pairs."""
    lines = [(n, None, q) for n, q in items]
    return (
        user, session, name, MIDNIGHT + int(at * 1_000_000), txn, discount, bundle, offset, lines,
        "mobile", "MX", "NL", "MTY", "google", "cpc",
    )


def row(product, add=0, chk=0, pur=0, user="u", session=1, at="01/03/2024 12:00:00", item=None, attempt=1):
    return (user, session, at, item or f"item {product}", attempt, add, chk, pur, product)


def catalog(spark, conditions=(), combos=(), validity=(), products=(), max_rows=200_000):
    """``conditions`` as (promo, product, type, n, m); ``combos`` as (promo, product, need)."""
    conds = [(100 + p, prod, kind, n, m) for p, prod, kind, n, m in conditions]
    groups = sorted({(100 + p, p) for p, *_ in conditions})
    kinds = [(i, f"kind {i}") for i in range(1, 8)]
    return Catalog(
        products=spark.createDataFrame(list(products), PRODUCTS),
        source_conditions=spark.createDataFrame(conds, CONDITIONS),
        groups=spark.createDataFrame(groups, "clave_grupo_condiciones bigint, clave_promocion bigint"),
        quantity_types=spark.createDataFrame(kinds, "clave_tipo_cantidad_condicion bigint, descripcion string"),
        source_validity=spark.createDataFrame(
            [(p, dt.date.fromisoformat(a) if a else None, dt.datetime.fromisoformat(b) if b else None) for p, a, b in validity],
            VALIDITY,
        ),
        combos=spark.createDataFrame(
            list(combos), "clave_promocion bigint, clave_edicion_producto bigint, cantidad_inicial bigint"
        ),
        max_rows=max_rows,
    )

"""Declared schemas and the step that conforms a frame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_DDL = (
    "user_pseudo_id string, event_name string, event_timestamp bigint, event_bundle_sequence_id bigint, "
    "event_server_timestamp_offset bigint, platform string, "
    "event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>, "
    "ecommerce struct<transaction_id:string>, "
    "items array<struct<item_name:string,item_id:string,quantity:bigint>>, "
    "device struct<category:string>, geo struct<country:string,region:string,city:string>, "
    "traffic_source struct<source:string,medium:string>, ds string"
)

ATTEMPTS_DDL = (
    "USER string, SESION bigint, ITEM string, INTENTO bigint, attempt_dt_mx timestamp_ntz, DATETIME string, "
    "attempt_date date, HAS_PURCHASE_INT bigint, STATUS string, device_category string, geo_country string, "
    "geo_region string, geo_city string, traffic_source string, traffic_medium string, qty_add_to_cart bigint, "
    "qty_begin_checkout bigint, qty_purchase bigint, transaction_id string"
)

SESSIONS_DDL = (
    "user_pseudo_id string, session_id bigint, session_start_mx timestamp_ntz, session_end_mx timestamp_ntz, "
    "login_time_mx timestamp_ntz, logout_time_mx timestamp_ntz, view_item_list_time_mx timestamp_ntz, "
    "select_item_time_mx timestamp_ntz, add_to_cart_time_mx timestamp_ntz, begin_checkout_time_mx timestamp_ntz, "
    "purchase_time_mx timestamp_ntz, sign_up_time_mx timestamp_ntz, session_date date, event_count bigint, "
    "has_purchase boolean, has_sign_up boolean, discount_seen_after_login boolean, login_vs_view_item_list string, "
    "login_vs_select_item string, login_vs_add_to_cart string, login_vs_begin_checkout string, categoria_login string"
)

_STAGES = (("ADD_CART", "ADD_CART"), ("BEGIN_CHECKOUT", "CHECKOUT"), ("PURCHASE", "PURCHASE"))


def _stage_columns(with_text: bool) -> str:
    out = []
    for flag, stage in _STAGES:
        out.append(f"PATRON_{flag} string")
        out += [f"PROMOS_{stage}_{kind} array<bigint>" for kind in ("COMPLETAS", "INCOMPLETAS", "TODAS")]
        if with_text:
            out.append(f"DESC_{stage}_COMPLETAS string")
    return ", ".join(out)


PATTERNS_DDL = (
    "USER string, SESION bigint, DATETIME string, ITEM string, INTENTO bigint, device_category string, "
    "geo_country string, geo_region string, geo_city string, traffic_source string, traffic_medium string, "
    "STATUS string, CANTIDAD_ADD_TO_CART bigint, CANTIDAD_BEGIN_CHECKOUT bigint, CANTIDAD_PURCHASE bigint, "
    "TRANSACTION_ID string, item_id bigint, clave_edicion_producto bigint, precio_unitario double, "
    "fecha_celebracion timestamp, dias_para_sorteo double, MONTO_ADD_TO_CART double, MONTO_BEGIN_CHECKOUT double, "
    f"MONTO_PURCHASE double, {_stage_columns(True)}, TIENE_PATRON_COMPLETO string, TIENE_PATRON_INCOMPLETO string"
)

FUNNEL_DDL = (
    "user_pseudo_id string, session_id bigint, intento bigint, ITEM string, STATUS string, "
    "attempt_dt_mx timestamp_ntz, attempt_date date, datetime_str string, TRANSACTION_ID string, "
    "device_category string, geo_country string, geo_region string, geo_city string, traffic_source string, "
    "traffic_medium string, dias_para_sorteo double, traffic_density_score double, "
    "products_in_session_count double, qty_add_to_cart double, qty_begin_checkout double, qty_purchase double, "
    "precio_unitario_inferido double, MONTO_ADD_TO_CART double, MONTO_BEGIN_CHECKOUT double, MONTO_PURCHASE double, "
    f"{_stage_columns(False)}, session_date date, session_start_mx timestamp_ntz, session_end_mx timestamp_ntz, "
    "login_time_mx timestamp_ntz, logout_time_mx timestamp_ntz, view_item_list_time_mx timestamp_ntz, "
    "select_item_time_mx timestamp_ntz, add_to_cart_time_mx timestamp_ntz, begin_checkout_time_mx timestamp_ntz, "
    "purchase_time_mx timestamp_ntz, sign_up_time_mx timestamp_ntz, event_count bigint, has_purchase boolean, "
    "has_sign_up boolean, discount_seen_after_login boolean, categoria_login string, TIENE_PATRON_COMPLETO string, "
    "TIENE_PATRON_INCOMPLETO string, ready_at_checkout boolean, ready_at_purchase boolean, login_bucket_bc string"
)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of the declared schema only, in its order and types. Missing array values become empty arrays; a
    missing column is an error."""
    have = set(df.columns)
    out = []
    for field in schema_of(ddl).fields:
        if field.name not in have:
            raise ValueError(f"column {field.name} is missing")
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if isinstance(field.dataType, T.ArrayType):
            value = F.coalesce(value, F.array().cast(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)

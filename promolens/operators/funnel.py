"""Wide attempt-by-session table, price inference and amounts.

The wide rows move once, on (user, session); product counts and session context arrive on the same key. Hot
sessions are split by adaptive skew joins, minute counts by the broadcast or salted lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import DIMENSIONS, RunConfig
from promolens.functions.labels import login_bucket
from promolens.functions.text import clean_item
from promolens.functions.times import minute_of, parse_time_text
from promolens.operators.catalog import catalog_items
from promolens.operators.lookup import fits, lookup_join
from promolens.operators.patterns import STAGES
from promolens.session import stage

KEY = ["user_pseudo_id", "session_id"]
_NO_USER, _NO_SESSION = "\u0000", -(2**63)
# Amount column and quantity column of each stage in the wide table.
AMOUNTS = (
    ("MONTO_ADD_TO_CART", "qty_add_to_cart"),
    ("MONTO_BEGIN_CHECKOUT", "qty_begin_checkout"),
    ("MONTO_PURCHASE", "qty_purchase"),
)
_SESSION_COLUMNS = (
    "session_date",
    "session_start_mx",
    "session_end_mx",
    "login_time_mx",
    "logout_time_mx",
    "view_item_list_time_mx",
    "select_item_time_mx",
    "add_to_cart_time_mx",
    "begin_checkout_time_mx",
    "purchase_time_mx",
    "sign_up_time_mx",
    "event_count",
    "has_purchase",
    "has_sign_up",
    "discount_seen_after_login",
    "categoria_login",
)


def _between(column: str, cfg: RunConfig) -> Column:
    keep = F.col(column).isNotNull()
    if cfg.date_start is not None:
        keep = keep & (F.col(column) >= F.lit(cfg.date_start))
    if cfg.date_end is not None:
        keep = keep & (F.col(column) <= F.lit(cfg.date_end))
    return keep


def traffic_density(rows: DataFrame, cfg: RunConfig) -> DataFrame:
    """Rows per minute of ``attempt_dt_mx`` as ``traffic_density_score``. Counted per minute first (combined before
    the shuffle), then looked up, so a busy minute does not pile up in one task."""
    rows = rows.withColumn("_minute", minute_of(F.col("attempt_dt_mx")))
    counts = rows.groupBy("_minute").agg(F.count("*").alias("traffic_density_score"))
    days = cfg.window_days
    bounded = days is not None and days * 1440 <= cfg.calendar_rows
    return lookup_join(rows, counts, ["_minute"], "left", bounded, [*KEY, "ITEM"]).drop("_minute")


def _join_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_user": F.coalesce("user_pseudo_id", F.lit(_NO_USER)),
            "_session": F.coalesce("session_id", F.lit(_NO_SESSION).cast("bigint")),
        }
    )


def _products_in_session(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("_user", "_session").agg(F.count_distinct("ITEM").alias("products_in_session_count"))


def products_in_session(rows: DataFrame) -> DataFrame:
    """Distinct items of the session on every row. A two-step distinct count, not a window over the session."""
    keyed = _join_keys(rows)
    return keyed.join(_products_in_session(keyed), ["_user", "_session"], "left").drop("_user", "_session")


def funnel_rows(patterns: DataFrame, cfg: RunConfig) -> DataFrame:
    """Pattern rows under funnel names, with parsed time, inside the date window."""
    at = parse_time_text(F.col("DATETIME"))
    promos = [f"PROMOS_{s}_{k}" for _, _, s, _ in STAGES for k in ("COMPLETAS", "INCOMPLETAS", "TODAS")]
    rows = patterns.select(
        F.col("USER").alias("user_pseudo_id"),
        F.col("SESION").alias("session_id"),
        F.col("DATETIME").alias("datetime_str"),
        at.alias("attempt_dt_mx"),
        F.to_date(at).alias("attempt_date"),
        "ITEM",
        F.col("INTENTO").try_cast("bigint").alias("intento"),
        "STATUS",
        F.col("CANTIDAD_ADD_TO_CART").try_cast("bigint").alias("qty_add_to_cart"),
        F.col("CANTIDAD_BEGIN_CHECKOUT").try_cast("bigint").alias("qty_begin_checkout"),
        F.col("CANTIDAD_PURCHASE").try_cast("bigint").alias("qty_purchase"),
        "TRANSACTION_ID",
        *DIMENSIONS,
        "dias_para_sorteo",
        *[a for a, _ in AMOUNTS],
        *[f"PATRON_{flag}" for _, flag, _, _ in STAGES],
        *promos,
        "TIENE_PATRON_COMPLETO",
        "TIENE_PATRON_INCOMPLETO",
    )
    return rows.where(_between("attempt_date", cfg))


def bucket_of_session() -> Column:
    return login_bucket(
        F.col("has_purchase"),
        F.col("login_time_mx"),
        F.col("logout_time_mx"),
        F.col("view_item_list_time_mx"),
        F.col("select_item_time_mx"),
        F.col("add_to_cart_time_mx"),
        F.col("begin_checkout_time_mx"),
        F.col("purchase_time_mx"),
    ).alias("login_bucket_bc")


def session_context(sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    """What the wide table takes from a session, under join keys without nulls."""
    return (
        sessions.where(_between("session_date", cfg) & F.col("user_pseudo_id").isNotNull() & F.col("session_id").isNotNull())
        .select(F.col("user_pseudo_id").alias("_user"), F.col("session_id").alias("_session"), *_SESSION_COLUMNS)
    )


def funnel(patterns: DataFrame, sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    """Attempts with density, products in session, session context, readiness and login bucket."""
    rows = _join_keys(traffic_density(funnel_rows(patterns, cfg), cfg))
    # Counted from the rows themselves, before any lookup, so that the count reads two columns of the table.
    counts = _products_in_session(_join_keys(funnel_rows(patterns, cfg)))
    return _wide(rows, counts, session_context(sessions, cfg))


def _wide(rows: DataFrame, counts: DataFrame, context: DataFrame) -> DataFrame:
    return _derived(rows.join(counts, ["_user", "_session"], "left").join(context, ["_user", "_session"], "left"))


def _derived(wide: DataFrame) -> DataFrame:
    return wide.drop("_user", "_session").select(
        "*",
        F.try_divide(F.col("MONTO_PURCHASE"), F.nullif(F.col("qty_purchase"), F.lit(0))).alias(
            "precio_unitario_inferido"
        ),
        (F.size("PROMOS_CHECKOUT_COMPLETAS") > 0).alias("ready_at_checkout"),
        (F.size("PROMOS_PURCHASE_COMPLETAS") > 0).alias("ready_at_purchase"),
        bucket_of_session(),
    )


def item_prices(products: DataFrame) -> DataFrame:
    """Catalogue price per display name; of equal names the lowest product id counts."""
    w = Window.partitionBy("item_completo").orderBy(F.asc_nulls_last("clave_edicion_producto"))
    return (
        catalog_items(products)
        .where(F.col("item_completo").isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .select(F.col("item_completo").alias("ITEM"), F.col("precio_unitario").cast("double").alias("_price"))
    )


def price_inference(wide: DataFrame, products: DataFrame, cfg: RunConfig) -> DataFrame:
    """Unit price from the purchase, else from the catalogue by cleaned item; amounts of all stages from it."""
    rows = wide.withColumn("ITEM", clean_item(F.col("ITEM"), cfg.name_rewrites))
    bounded = fits(products.select("desc_sorteo"), cfg.broadcast_rows)
    if not bounded:
        rows = stage(rows, "clean_wide")
    priced = lookup_join(rows, item_prices(products), ["ITEM"], "left", bounded, [*KEY, "intento"])
    price = F.coalesce(F.col("precio_unitario_inferido").cast("double"), F.col("_price"))
    priced = priced.withColumns(
        {"precio_unitario_inferido": price, **{q: F.col(q).cast("double") for _, q in AMOUNTS}}
    )
    return stage_amounts(priced.drop("_price"))


def stage_amounts(rows: DataFrame) -> DataFrame:
    """Amount of each stage: unit price times quantity."""
    return rows.withColumns({a: F.col("precio_unitario_inferido") * F.col(q) for a, q in AMOUNTS})

"""Derived rates and integrity checks described by the business rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.catalog import validity_lookup

KEY = ["user_pseudo_id", "session_id"]


def _session_facts(funnel: DataFrame) -> DataFrame:
    return (
        funnel.where(F.col("user_pseudo_id").isNotNull() & F.col("session_id").isNotNull())
        .groupBy(*KEY)
        .agg(
            F.bool_or(F.col("qty_add_to_cart") > 0).alias("cart"),
            F.bool_or(F.col("qty_begin_checkout") > 0).alias("checkout"),
            F.bool_or(F.col("qty_purchase") > 0).alias("purchase"),
            F.bool_or(F.col("TIENE_PATRON_COMPLETO") == "SI").alias("complete"),
            F.bool_or(F.col("TIENE_PATRON_INCOMPLETO") == "SI").alias("incomplete"),
            F.sum("MONTO_PURCHASE").alias("amount"),
        )
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def conversion_rates(funnel: DataFrame) -> DataFrame:
    """Session conversion between stages."""
    s = _session_facts(funnel)
    n = {c: F.count_if(c) for c in ("cart", "checkout", "purchase")}
    return s.agg(
        F.count("*").alias("total_sesiones"),
        _ratio(n["checkout"], n["cart"]).alias("cart_to_checkout"),
        _ratio(n["purchase"], n["checkout"]).alias("checkout_to_purchase"),
        _ratio(n["purchase"], F.count("*")).alias("overall"),
    )


def promo_impact(funnel: DataFrame) -> DataFrame:
    """Conversion of sessions with and without a complete pattern, and the lift."""
    rate = _session_facts(funnel).agg(
        F.avg(F.when(F.col("complete"), F.col("purchase").cast("double"))).alias("con_patron"),
        F.avg(F.when(~F.col("complete"), F.col("purchase").cast("double"))).alias("sin_patron"),
    )
    return rate.select("*", (F.try_divide("con_patron", "sin_patron") - 1).alias("lift"))


def lost_opportunity(funnel: DataFrame) -> DataFrame:
    """Sessions with an incomplete pattern x mean purchase amount x overall conversion."""
    parts = _session_facts(funnel).agg(
        F.count_if("incomplete").alias("sesiones_con_patron_incompleto"),
        F.avg(F.when(F.col("purchase"), F.col("amount"))).alias("valor_promedio_compra"),
        F.avg(F.col("purchase").cast("double")).alias("tasa_conversion"),
    )
    return parts.select(
        "*",
        (
            F.col("sesiones_con_patron_incompleto") * F.col("valor_promedio_compra") * F.col("tasa_conversion")
        ).alias("oportunidad_perdida"),
    )


def row_checks() -> dict[str, Column]:
    """What a row of the wide table must not be, by the name of the check."""
    price, bought = F.col("precio_unitario_inferido"), F.col("qty_purchase")
    return {
        "cart_below_checkout": F.col("qty_add_to_cart") < F.col("qty_begin_checkout"),
        "checkout_below_purchase": F.col("qty_begin_checkout") < bought,
        "price_not_positive": price <= 0,
        "price_missing": price.isNull(),
        "purchase_without_transaction": (F.col("STATUS") == "PURCHASED") & F.col("TRANSACTION_ID").isNull(),
        "amount_mismatch": F.abs(F.col("MONTO_PURCHASE") - bought * price) > 0.005,
        "rows_without_session": F.coalesce("event_count", F.lit(0)) < 1,
    }


def control_totals() -> dict[str, Column]:
    """Totals that are kept beside the checks."""
    return {
        "total_filas": F.count("*"),
        "qty_purchase_total": F.sum("qty_purchase"),
        "monto_purchase_total": F.sum("MONTO_PURCHASE"),
    }


#: Columns that name one attempt of the wide table.
ATTEMPT_KEY = (*KEY, "ITEM", "intento")


def integrity_checks(funnel: DataFrame) -> DataFrame:
    """Violation counts and control totals of the wide table, in one pass plus a duplicate-key count."""
    counts = {**control_totals(), **{name: F.count_if(test) for name, test in row_checks().items()}}
    keyed = funnel.groupBy(*ATTEMPT_KEY).agg(*[c.alias(name) for name, c in counts.items()])
    return keyed.agg(*[F.sum(name).alias(name) for name in counts], F.count_if(F.col("total_filas") > 1).alias("duplicate_attempts"))


def validity_checks(funnel: DataFrame, validity: DataFrame) -> DataFrame:
    """Per stage, how many complete promotions rows name, and how many of those have no validity window or a window
    that the attempt time of the row lies outside of. Combined promotions may be outside of it: their session decides."""
    named = [
        F.struct(F.lit(stage).alias("stage"), F.col(f"PROMOS_{stage}_COMPLETAS").alias("ids")) for stage in ("ADD_CART", "CHECKOUT", "PURCHASE")
    ]
    ids = funnel.select("attempt_dt_mx", F.explode(F.array(*named)).alias("n")).select("attempt_dt_mx", "n.stage", F.explode("n.ids").alias("clave_promocion"))
    timed = ids.groupBy("stage", "clave_promocion", "attempt_dt_mx").agg(F.count("*").alias("n")).join(validity_lookup(validity), "clave_promocion", "left")
    at, start, end = F.col("attempt_dt_mx"), F.col("d_inicio_promocion"), F.col("d_cierre_promocion")
    known = start.isNotNull() & end.isNotNull()
    weigh = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    return timed.groupBy("stage").agg(
        F.sum("n").alias("complete"),
        weigh(~known).alias("without_window"),
        weigh(known & ~((start <= at) & (at <= end))).alias("outside_window"),
    )


def event_checks(lines: DataFrame) -> DataFrame:
    """Item lines, and how many of them share user, session, product and timestamp with another one."""
    key = ["user_pseudo_id", "session_id", "item_name", "event_timestamp"]
    same = lines.groupBy(*key).agg(F.count("*").alias("n"))
    return same.agg(
        F.sum("n").alias("lines"), F.count("*").alias("keys"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated_lines")
    )

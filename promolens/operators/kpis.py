"""Session KPIs and promotion incidence. Every report is one aggregate over session rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.config import NO_LOGIN

KEY = ["user_pseudo_id", "session_id"]
ROW_FLAGS = ("HAS_SIMPLE_INCOMPLETE", "HAS_COMBINED_INCOMPLETE", "HAS_SIMPLE_COMPLETA", "HAS_COMBINED_COMPLETA")


def _known_sessions(df: DataFrame) -> DataFrame:
    """Rows without user or session belong to no session."""
    return df.where(F.col("user_pseudo_id").isNotNull() & F.col("session_id").isNotNull())


def session_rollup(funnel: DataFrame) -> DataFrame:
    """One row per session: login category, amounts, any checkout pattern. The category is the same on all rows of a
    session, so the smallest non-null value is the first one."""
    return (
        _known_sessions(funnel)
        .groupBy(*KEY)
        .agg(
            F.min("categoria_login").alias("categoria_login"),
            F.coalesce(F.sum("MONTO_BEGIN_CHECKOUT"), F.lit(0.0)).alias("MONTO_BEGIN_CHECKOUT"),
            F.coalesce(F.sum("MONTO_PURCHASE"), F.lit(0.0)).alias("MONTO_PURCHASE"),
            F.coalesce(F.bool_or(F.col("PATRON_BEGIN_CHECKOUT") == "SI"), F.lit(False)).alias("tiene_patron_bc"),
        )
    )


def session_kpis(rollup: DataFrame) -> DataFrame:
    """Seven session groups, each with count, checkout amount and purchase amount (21 measures)."""
    no_login = F.col("categoria_login").eqNullSafe(NO_LOGIN)
    bought = F.col("MONTO_PURCHASE") > 0
    pattern = F.col("tiene_patron_bc")
    # Report names. A missing category counts as a session with login.
    groups = {
        "total_sesiones": F.lit(True),
        "sesiones_con_login": ~no_login,
        "sesiones_con_login_sin_purchase": ~no_login & ~bought,
        "sesiones_con_login_sin_purchase_con_patron_bc": ~no_login & ~bought & pattern,
        "sesiones_sin_login_sin_purchase_con_patron_bc": no_login & ~bought & pattern,
        "sesiones_login_sin_registrar_con_purchase": no_login & bought,
        "sesiones_login_sin_registrar_con_purchase_con_patron_bc": no_login & bought & pattern,
    }

    def amount(mask: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(mask, F.col(column))), F.lit(0.0))

    out = []
    for name, mask in groups.items():
        out += [
            F.count_if(mask).alias(f"{name}_count"),
            amount(mask, "MONTO_BEGIN_CHECKOUT").alias(f"{name}_monto_begin_checkout"),
            amount(mask, "MONTO_PURCHASE").alias(f"{name}_monto_purchase"),
        ]
    return rollup.agg(*out)


def kpi_summary(kpis: DataFrame) -> DataFrame:
    """Headline KPI: checkout amount of sessions without login or purchase but with a pattern, less the share of
    login sessions that stall in the same place. NULL when no login session has a checkout amount."""
    a = F.col("sesiones_sin_login_sin_purchase_con_patron_bc_monto_begin_checkout")
    b = F.col("sesiones_con_login_sin_purchase_con_patron_bc_monto_begin_checkout")
    c = F.col("sesiones_con_login_monto_begin_checkout")
    return kpis.select((a - F.try_divide(b, c) * a).alias("KPI_sesiones_resumen"))


def promo_row_flags(funnel: DataFrame, combos: DataFrame) -> DataFrame:
    """Row flags on the cart stage: any simple / combined id among the incomplete / complete promotions.

    Rows share few different id lists. The different lists are exploded, their ids are looked up among the combined
    ones in one join, and each list gets its two flags, which the rows take over. An empty or missing list has neither.
    """
    lists = ("PROMOS_ADD_CART_INCOMPLETAS", "PROMOS_ADD_CART_COMPLETAS")
    ids = combos.select(F.col("clave_promocion").cast("bigint").alias("_id")).dropna().distinct().withColumn("_known", F.lit(True))
    different = funnel.select(F.explode(F.array(*lists)).alias("_list")).where(F.size("_list") > 0).distinct()
    named = different.select("_list", F.explode("_list").alias("_id")).join(ids, "_id", "left")
    known = F.coalesce("_known", F.lit(False))
    told = named.groupBy("_list").agg(F.bool_or(~known).alias("_simple"), F.bool_or(known).alias("_combined"))
    out = funnel
    for column, kind in zip(lists, ("INCOMPLETE", "COMPLETA")):
        mine = told.select(F.col("_list").alias(column), *[F.col(c).alias(f"HAS{c.upper()}_{kind}") for c in ("_simple", "_combined")])
        out = out.join(mine, column, "left")
    flags = {c: F.coalesce(c, F.lit(False)) for c in ROW_FLAGS}
    return out.withColumns(flags).select(*funnel.columns, *ROW_FLAGS)


def row_flag_summary(flags: DataFrame) -> DataFrame:
    """Row counts behind the flags."""
    both = F.col("HAS_SIMPLE_INCOMPLETE") & F.col("HAS_COMBINED_INCOMPLETE")
    return flags.agg(
        F.count("*").alias("total_filas"),
        F.count_if("HAS_SIMPLE_INCOMPLETE").alias("filas_simple_incompleta"),
        F.count_if("HAS_COMBINED_INCOMPLETE").alias("filas_combinada_incompleta"),
        F.count_if(both).alias("filas_ambas"),
    )


def session_promo_flags(flags: DataFrame) -> DataFrame:
    """Any of the row flags per session."""
    return _known_sessions(flags).groupBy(*KEY).agg(*[F.bool_or(c).alias(f"{c}_SESION") for c in ROW_FLAGS])


def promo_incidence(session_flags: DataFrame) -> DataFrame:
    """Counts and shares of sessions with incomplete promotions, over all sessions and over those with the kind."""
    s_inc, c_inc = F.col("HAS_SIMPLE_INCOMPLETE_SESION"), F.col("HAS_COMBINED_INCOMPLETE_SESION")
    s_any = F.col("HAS_SIMPLE_COMPLETA_SESION") | s_inc
    c_any = F.col("HAS_COMBINED_COMPLETA_SESION") | c_inc
    counts = session_flags.agg(
        F.count("*").alias("total_sesiones"),
        F.count_if(s_inc).alias("sesiones_simple_incompleta"),
        F.count_if(c_inc).alias("sesiones_combinada_incompleta"),
        F.count_if(s_inc & c_inc).alias("sesiones_ambas"),
        F.count_if(s_any).alias("sesiones_con_simple"),
        F.count_if(c_any).alias("sesiones_con_combinada"),
    )

    def share(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(whole))

    return counts.select(
        "*",
        share("sesiones_simple_incompleta", "total_sesiones").alias("pct_sesiones_simple_incompleta"),
        share("sesiones_combinada_incompleta", "total_sesiones").alias("pct_sesiones_combinada_incompleta"),
        share("sesiones_ambas", "total_sesiones").alias("pct_sesiones_ambas"),
        F.coalesce(share("sesiones_simple_incompleta", "sesiones_con_simple"), F.lit(0.0)).alias(
            "pct_simple_incompleta_sobre_con_simple"
        ),
        F.coalesce(share("sesiones_combinada_incompleta", "sesiones_con_combinada"), F.lit(0.0)).alias(
            "pct_combinada_incompleta_sobre_con_combinada"
        ),
    )


def pattern_counts() -> dict[str, Column]:
    """Rows, rows with a complete / incomplete pattern, complete rows per stage, as aggregates."""
    told = {
        "filas_completo": "TIENE_PATRON_COMPLETO",
        "filas_incompleto": "TIENE_PATRON_INCOMPLETO",
        "add_to_cart_completo": "PATRON_ADD_CART",
        "begin_checkout_completo": "PATRON_BEGIN_CHECKOUT",
        "purchase_completo": "PATRON_PURCHASE",
    }
    return {"total_filas": F.count("*"), **{name: F.count_if(F.col(flag) == "SI") for name, flag in told.items()}}


def pattern_summary(patterns: DataFrame) -> DataFrame:
    """One row of ``pattern_counts``."""
    return patterns.agg(*[c.alias(name) for name, c in pattern_counts().items()])


def condition_coverage(conditions: DataFrame) -> DataFrame:
    """Condition rows with and without a validity window."""
    start = F.col("d_inicio_promocion")
    return conditions.agg(
        F.count("*").alias("total_filas"),
        F.count_if(start.isNotNull()).alias("con_fechas"),
        F.count_if(start.isNull()).alias("sin_fechas"),
    )


def promos_seen(rows: DataFrame, column: str) -> DataFrame:
    """Distinct promotion ids of an array column."""
    return rows.select(F.explode(column).alias("clave_promocion")).distinct()

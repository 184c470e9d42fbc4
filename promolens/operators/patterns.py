"""Promotion detection on attempts.

Rules travel to the rows: when the catalogue passes its size check, all conditions of a product form one array that
is broadcast to the attempts, and every stage is evaluated with array functions. No row is multiplied and nothing is
regrouped, so simple promotions need no shuffle of the attempts at all. Of a larger catalogue the rules of the products
that occur are taken; if these are still too many, a join that salts hot products takes the place of the arrays. Combined promotions need the session totals; these are reduced to one short row per session that closes at
least one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import DESC_SEPARATOR, RunConfig
from promolens.functions.rules import active, meets, one_short, rule_bounds
from promolens.functions.text import clean_item, override_item
from promolens.functions.times import days_between_dates, parse_time_text, utc_wall_column
from promolens.operators.catalog import Catalog, catalog_items, combo_ids
from promolens.operators.lookup import fits, lookup_join, widest
from promolens.session import stage as write_once

# Quantity column, flag column suffix, promo column infix and amount column of each stage.
STAGES = (
    ("CANTIDAD_ADD_TO_CART", "ADD_CART", "ADD_CART", "MONTO_ADD_TO_CART"),
    ("CANTIDAD_BEGIN_CHECKOUT", "BEGIN_CHECKOUT", "CHECKOUT", "MONTO_BEGIN_CHECKOUT"),
    ("CANTIDAD_PURCHASE", "PURCHASE", "PURCHASE", "MONTO_PURCHASE"),
)
_ROW = ["USER", "SESION", "ITEM", "INTENTO"]
# The name of an attempt's item before cleaning. Attempts are numbered by it, so it belongs to the identity of a row:
# two raw names may clean to one. ``_at`` is the attempt time in whole seconds. Both are for detection only.
RAW_ITEM, AT = "_raw_item", "_at"
_NO_IDS = "array<bigint>"


def enrich_attempts(window: DataFrame, catalog: Catalog, cfg: RunConfig, dedup_catalog: bool = False) -> DataFrame:
    """Clean item names, then add product id, price, draw date, days to the draw and stage amounts.

    Catalogue rows that share a display name multiply the attempt, unless ``dedup_catalog`` keeps the lowest id. The raw
    name stays beside the clean one as ``_raw_item``.
    """
    items = catalog_items(catalog.products)
    lookup = items.select(
        F.col("item_completo").alias("ITEM"),
        F.col("clave_edicion_producto").try_cast("bigint").alias("clave_edicion_producto"),
        F.col("precio_unitario").cast("double").alias("precio_unitario"),
        "fecha_celebracion",
        utc_wall_column(items, "fecha_celebracion").alias("_draw"),
    )
    if dedup_catalog:
        w = Window.partitionBy("ITEM").orderBy(F.asc_nulls_last("clave_edicion_producto"))
        lookup = lookup.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    name = override_item(F.col("_clean"), cfg.item_overrides)
    rows = window.withColumns({RAW_ITEM: F.col("ITEM"), "_clean": clean_item(F.col("ITEM"), cfg.name_rewrites)})
    rows = rows.withColumn("ITEM", name).drop("_clean")
    if not catalog.products_bounded:
        rows = write_once(rows, "clean_attempts")
    joined = lookup_join(
        rows, lookup, ["ITEM"], "left", catalog.products_bounded, ["USER", "SESION", "INTENTO"]
    )
    price = F.col("precio_unitario")
    amounts = {amount: price * F.col(qty) for qty, _, _, amount in STAGES}
    # Only the cart amount of an unpriced item is zero; the two others stay NULL.
    amounts["MONTO_ADD_TO_CART"] = F.coalesce(amounts["MONTO_ADD_TO_CART"], F.lit(0.0))
    return joined.withColumns(
        {"dias_para_sorteo": days_between_dates(F.col("_draw"), attempt_time(rows)), **amounts}
    ).drop("_draw")


def attempt_time(df: DataFrame) -> Column:
    """Attempt time in whole seconds: carried as a timestamp by ``attempts_window``, else read from its text."""
    return F.col(AT) if AT in df.columns else parse_time_text(F.col("DATETIME"))


def session_products(rows: DataFrame) -> DataFrame:
    """Units per session, product and stage, with the first attempt time. Combined before the shuffle."""
    return rows.groupBy("USER", "SESION", "clave_edicion_producto").agg(
        *[F.sum(F.coalesce(F.col(qty), F.lit(0))).alias(stage) for qty, _, stage, _ in STAGES],
        F.min(attempt_time(rows)).alias("_at"),
    )


def combo_session_complete(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """Combined promotions whose products all reach their quantity within one session, per stage.

    Relational division: a promotion is complete when the number of its met requirements equals the number of its
    requirements. Requirements of zero or fewer units are met by definition and are not counted. After the per-product
    sums a session has at most one row per catalogue product, so regrouping by session is safe even for a hot one.
    """
    sums = session_products(rows.where(F.col("USER").isNotNull() & F.col("SESION").isNotNull()))
    per_session = sums.repartition("USER", "SESION").withColumn(
        "_session_at", F.min("_at").over(Window.partitionBy("USER", "SESION"))
    )
    if not catalog.requirements_bounded:
        per_session = write_once(per_session, "session_products")
    hits = lookup_join(
        per_session, catalog.requirements, ["clave_edicion_producto"], "inner", catalog.requirements_bounded,
        ["USER", "SESION"],
    ).where(active(F.col("_session_at"), F.col("d_inicio_promocion"), F.col("d_cierre_promocion")))
    need = F.col("cantidad_requerida")
    done = hits.groupBy("USER", "SESION", "clave_promocion").agg(
        *[F.count_if((need > 0) & (F.col(s) >= need)).alias(s) for _, _, s, _ in STAGES],
        F.max("n_required").alias("_n"),
    )
    flags = done.select(
        "USER", "SESION", "clave_promocion", *[(F.col(s) == F.col("_n")).alias(f"{s}_COMPLETE") for _, _, s, _ in STAGES]
    )
    return flags.where(" or ".join(f"{s}_COMPLETE" for _, _, s, _ in STAGES))


def _closed_window(start: str, end: str) -> tuple[Column, Column]:
    """Validity ends without NULLs: an unknown window never opens."""
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    never, always = F.lit("9999-12-31").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")
    return F.when(known, F.col(start)).otherwise(never), F.when(known, F.col(end)).otherwise(always)


def simple_rules(catalog: Catalog) -> DataFrame:
    """One row per simple condition, ready to be tested against a quantity and a time."""
    bounds = rule_bounds(
        F.col("clave_tipo_cantidad_condicion"), F.col("cantidad_inicial"), F.col("cantidad_final")
    )
    start, end = _closed_window("d_inicio_promocion", "d_cierre_promocion")
    combos = combo_ids(catalog.requirements_all)
    combos = combos if catalog.requirements_bounded else combos.hint("merge")
    conditions = catalog.conditions.where(
        F.col("clave_promocion").isNotNull() & F.col("clave_edicion_producto").isNotNull()
    ).join(combos, "clave_promocion", "left_anti")
    return conditions.withColumn("_b", bounds).select(
        "clave_edicion_producto",
        F.col("clave_promocion").cast("bigint").alias("promo"),
        "_b.lo",
        "_b.hi",
        "_b.step",
        (F.col("cantidad_inicial") - 1).cast("bigint").alias("short"),
        F.col("interpretacion").alias("text"),
        start.alias("start"),
        end.alias("end"),
    )


def combined_rules(catalog: Catalog) -> DataFrame:
    """One row per requirement of a combined promotion."""
    start, end = _closed_window("d_inicio_promocion", "d_cierre_promocion")
    return catalog.requirements.select(
        "clave_edicion_producto",
        F.col("clave_promocion").alias("promo"),
        F.col("cantidad_requerida").alias("need"),
        start.alias("start"),
        end.alias("end"),
    )


def product_rules(simple: DataFrame, combined: DataFrame) -> DataFrame:
    """Per product: its simple conditions and its combined requirements, as two arrays. Only for rules that passed the
    size checks, of all and of the widest product."""
    def packed(rules: DataFrame, name: str) -> DataFrame:
        fields = [c for c in rules.columns if c != "clave_edicion_producto"]
        return rules.groupBy("clave_edicion_producto").agg(F.collect_list(F.struct(*fields)).alias(name))

    return packed(simple, "_simple").join(packed(combined, "_combined"), "clave_edicion_producto", "full")


def occurring_rules(rows: DataFrame, catalog: Catalog) -> tuple[DataFrame, DataFrame, bool]:
    """Simple and combined rules of the products that occur in ``rows``, written, and whether they may travel to the rows:
    attempts often touch few products of a large catalogue."""
    products = rows.select("clave_edicion_producto").dropna().distinct().hint("merge")
    simple, combined = (
        write_once(rules.join(products, "clave_edicion_producto", "left_semi"), label)
        for rules, label in ((simple_rules(catalog), "simple_rules"), (combined_rules(catalog), "combined_rules"))
    )
    few = fits(simple, catalog.max_rows) and fits(combined, catalog.max_rows)
    return simple, combined, few and widest(simple, combined) <= catalog.max_per_product


def _ids(entries: Column) -> Column:
    return F.transform(entries, lambda c: c["promo"])


def _id_set(*arrays: Column) -> Column:
    safe = [F.coalesce(a, F.array().cast(_NO_IDS)) for a in arrays]
    return F.sort_array(F.array_distinct(F.concat(*safe)))


# Tests of one rule ``c`` (a struct or a mapping of columns) against a quantity and the time of the row.
def in_force(c) -> Column:
    return (c["start"] <= F.col("_at")) & (F.col("_at") <= c["end"])


def met(c, qty: Column) -> Column:
    return meets(qty, c["lo"], c["hi"], c["step"])


def near(c, qty: Column) -> Column:
    return one_short(qty, c["short"]) & in_force(c) & ~met(c, qty)


def owned(c, qty: Column) -> Column:
    return (F.coalesce(qty, F.lit(0)) >= c["need"]) & in_force(c)


def timed_rows(rows: DataFrame) -> DataFrame:
    """Rows with the time at which their rules are tested; NULL for a row that no rule applies to."""
    usable = (
        F.col("USER").isNotNull()
        & F.col("SESION").isNotNull()
        & F.col("clave_edicion_producto").isNotNull()
    )
    return rows.withColumn(AT, F.when(usable, attempt_time(rows)))


def _with_rules(rows: DataFrame, catalog: Catalog, stored: DataFrame | None = None) -> DataFrame:
    """Per stage, the conditions met, those of them in force, the near misses in force and the owned combined
    promotions of every row. Rows without user, session, product or readable time match nothing. ``stored`` holds the
    products of ``rows`` where it is cheaper to read."""
    timed, stored = timed_rows(rows), rows if stored is None else stored
    if catalog.rules_bounded:
        return _with_packed_rules(timed, simple_rules(catalog), combined_rules(catalog))
    simple, combined, few = occurring_rules(stored, catalog)
    return _with_packed_rules(timed, simple, combined) if few else _with_joined_rules(timed, simple, combined, stored)


def _with_packed_rules(rows: DataFrame, simple: DataFrame, combined: DataFrame) -> DataFrame:
    """Rules as arrays next to the row. Stages without units skip the evaluation, and nothing is shuffled."""
    joined = rows.join(F.broadcast(product_rules(simple, combined)), "clave_edicion_producto", "left")
    joined = joined.withColumns(
        {c: F.when(F.col("_at").isNotNull(), F.col(c)) for c in ("_simple", "_combined")}
    )
    out, live = {}, {}
    for name, _, stage, _ in STAGES:
        qty = F.col(name)
        out[f"_met_{stage}"] = F.when(qty != 0, F.filter("_simple", lambda c: met(c, qty)))
        out[f"_near_{stage}"] = F.when(qty > 0, _ids(F.filter("_simple", lambda c: near(c, qty))))
        out[f"_own_{stage}"] = _ids(F.filter("_combined", lambda c: owned(c, qty)))
        live[f"_live_{stage}"] = F.filter(f"_met_{stage}", in_force)
    return joined.withColumns(out).withColumns(live).drop("_simple", "_combined")


def _with_joined_rules(rows: DataFrame, simple: DataFrame, of_combined: DataFrame, stored: DataFrame) -> DataFrame:
    """The same columns for a catalogue of any size: a join with the rule rows, hot products salted, only the hits of a row are
    collected, and they come back by the key of the row: user, session, raw and clean item, attempt and product."""
    keys = [*_ROW, *[c for c in (RAW_ITEM,) if c in rows.columns], "clave_edicion_producto"]
    narrow = rows.where(F.col("_at").isNotNull()).select(*keys, "_at", *[q for q, _, _, _ in STAGES])
    parts = []
    for rules, combined in ((simple, False), (of_combined, True)):
        c = {name: F.col(name) for name in rules.columns}
        entry = F.struct("promo", (F.lit(None).cast("string").alias("text") if combined else F.col("text")))
        hits = {}
        for name, _, stage, _ in STAGES:
            qty = F.col(name)
            hit = F.lit(False) if combined else met(c, qty)
            close = F.lit(False) if combined else near(c, qty)
            hits[f"_met_{stage}"] = F.when(hit, entry)
            hits[f"_live_{stage}"] = F.when(hit & in_force(c), entry)
            hits[f"_near_{stage}"] = F.when(close, F.col("promo"))
            hits[f"_own_{stage}"] = F.when(owned(c, qty) if combined else F.lit(False), F.col("promo"))
        found = lookup_join(narrow, rules, ["clave_edicion_producto"], "inner", False, _ROW, counted=stored)
        parts.append(found.select(*keys, *[v.alias(k) for k, v in hits.items()]))
    names = [c for c in parts[0].columns if c not in keys]
    every = parts[0].unionByName(parts[1]).where(" or ".join(f"{c} is not null" for c in names))
    collected = every.groupBy(*keys).agg(*[F.collect_set(c).alias(c) for c in names])
    return rows.join(collected, keys, "left")


def _texts(entries: Column) -> Column:
    named = F.filter(F.transform(entries, lambda c: c["text"]), lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(F.array_join(F.sort_array(F.array_distinct(named)), DESC_SEPARATOR), F.lit(""))


def simple_promos(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """Simple promotions only: complete, near miss and all ids per row and stage, with the rule texts."""
    ruled = _with_rules(rows, catalog)
    out = {}
    for _, _, stage, _ in STAGES:
        every, live, close = F.col(f"_met_{stage}"), F.col(f"_live_{stage}"), F.col(f"_near_{stage}")
        out[f"PROMOS_{stage}_COMPLETAS"] = _id_set(_ids(live))
        out[f"PROMOS_{stage}_INCOMPLETAS"] = _id_set(close)
        out[f"PROMOS_{stage}_TODAS"] = _id_set(_ids(every), close)
        out[f"DESC_{stage}_COMPLETAS"] = _texts(live)
    return _finish(ruled.withColumns(out))


def _finish(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def with_sessions(rows: DataFrame, complete: DataFrame) -> DataFrame:
    """Add, per stage, the combined promotions that the row's session completes. Joined before the rules, so that the
    shuffle on (user, session) moves plain rows and not their rule arrays."""
    closed = complete.groupBy("USER", "SESION").agg(
        *[
            F.collect_set(F.when(F.col(f"{s}_COMPLETE"), F.col("clave_promocion"))).alias(f"_closed_{s}")
            for _, _, s, _ in STAGES
        ]
    )
    return rows.join(closed, ["USER", "SESION"], "left")


def _combined_sets(stage: str) -> tuple[Column, Column]:
    """(complete, incomplete) combined promotions of the row: owned ids split by the session's result."""
    none = F.array().cast(_NO_IDS)
    own, closed = F.coalesce(f"_own_{stage}", none), F.coalesce(f"_closed_{stage}", none)
    return F.array_intersect(own, closed), F.array_except(own, closed)


def combo_promos(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """Combined promotions only. A row counts when its own quantity reaches its product's requirement."""
    ruled = _with_rules(with_sessions(rows, combo_session_complete(rows, catalog)), catalog, rows)
    out = {}
    for _, _, stage, _ in STAGES:
        complete, incomplete = _combined_sets(stage)
        out[f"PROMOS_{stage}_COMPLETAS"] = _id_set(complete)
        out[f"PROMOS_{stage}_INCOMPLETAS"] = _id_set(incomplete)
        out[f"PROMOS_{stage}_TODAS"] = _id_set(F.col(f"_own_{stage}"))
    return _finish(ruled.withColumns(out))


def patterns(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """Pattern table: simple and combined promotions per row and stage, plus the summary flags."""
    return pattern_table(_with_rules(with_sessions(rows, combo_session_complete(rows, catalog)), catalog, rows))


def pattern_table(ruled: DataFrame) -> DataFrame:
    """The pattern table of rows that carry their rule hits and the promotions that their session completes."""
    sets = {}
    for _, _, stage, _ in STAGES:
        complete, incomplete = _combined_sets(stage)
        every, live, close = F.col(f"_met_{stage}"), F.col(f"_live_{stage}"), F.col(f"_near_{stage}")
        sets[f"PROMOS_{stage}_COMPLETAS"] = _id_set(_ids(live), complete)
        sets[f"PROMOS_{stage}_INCOMPLETAS"] = _id_set(close, incomplete)
        sets[f"PROMOS_{stage}_TODAS"] = _id_set(_ids(every), close, F.col(f"_own_{stage}"))
        sets[f"DESC_{stage}_COMPLETAS"] = _texts(live)
    flags = {
        f"PATRON_{flag}": F.when(F.size(f"PROMOS_{stage}_COMPLETAS") > 0, "SI").otherwise("NO")
        for _, flag, stage, _ in STAGES
    }
    return pattern_flags(_finish(ruled.withColumns(sets)).withColumns(flags))


def pattern_flags(df: DataFrame) -> DataFrame:
    """Any complete / any incomplete promotion over the three stages."""
    complete = F.lit(False)
    incomplete = F.lit(False)
    for _, flag, stage, _ in STAGES:
        complete = complete | (F.col(f"PATRON_{flag}") == "SI")
        incomplete = incomplete | (F.size(f"PROMOS_{stage}_INCOMPLETAS") > 0)
    return df.withColumns(
        {
            "TIENE_PATRON_COMPLETO": F.when(complete, "SI").otherwise("NO"),
            "TIENE_PATRON_INCOMPLETO": F.when(incomplete, "SI").otherwise("NO"),
        }
    )

"""Promotion catalogue: validity, conditions, combined promotions and their requirements."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.functions.rules import quantity_text
from promolens.functions.text import catalog_name
from promolens.functions.times import utc_wall_column
from promolens.operators.lookup import fits, widest
from promolens.session import stage


def catalog_items(products: DataFrame) -> DataFrame:
    """Catalogue rows with their display name."""
    return products.withColumn(
        "item_completo", catalog_name(F.col("desc_sorteo"), F.col("numero_sorteo"))
    )


def promo_validity(purchases: DataFrame, payments: DataFrame) -> DataFrame:
    """Validity window of each promotion, from the first paid day to the last paid moment of its purchases.

    Both sides are reduced to one row per join key first, so a purchase with many payments or a promotion with
    most of the purchases costs one row per map task.
    """
    paid = utc_wall_column(payments, "fecha_pagado")
    spans = (
        payments.where(F.col("agrupador_interno_compra").isNotNull())
        .groupBy(F.col("agrupador_interno_compra").alias("_key"))
        .agg(F.min(paid).alias("_first"), F.max(paid).alias("_last"))
    )
    bought = purchases.select(
        "clave_promocion", F.col("agrupador_interno_compra").cast("string").alias("_key")
    ).distinct()
    return (
        bought.join(spans.hint("merge"), "_key", "left")
        .groupBy("clave_promocion")
        .agg(
            F.to_date(F.min("_first")).alias("d_inicio_promocion"),
            F.max("_last").alias("d_cierre_promocion"),
        )
    )


def validity_lookup(validity: DataFrame) -> DataFrame:
    """Promotion -> (start, end) as wall clocks; unreadable dates become NULL, rows without promotion are dropped. Of
    several windows of one promotion the one that ends last counts, then the one that starts last."""
    def wall(name: str) -> Column:
        return F.col(name).try_cast("timestamp_ntz") if isinstance(
            validity.schema[name].dataType, T.StringType
        ) else F.col(name).cast("timestamp_ntz")

    spans = validity.select(
        "clave_promocion", wall("d_inicio_promocion").alias("d_inicio_promocion"), wall("d_cierre_promocion").alias("d_cierre_promocion")
    ).dropna(subset=["clave_promocion"])
    last = F.max(F.struct("d_cierre_promocion", "d_inicio_promocion")).alias("w")
    return spans.groupBy("clave_promocion").agg(last).select("clave_promocion", "w.d_inicio_promocion", "w.d_cierre_promocion")


def combo_catalog(
    promotions: DataFrame,
    groups: DataFrame,
    conditions: DataFrame,
    products: DataFrame,
    benefits: DataFrame,
    benefit_types: DataFrame,
    quantity_types: DataFrame,
    criterion_types: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """Promotions over more than one distinct product, with benefit, criterion and category text.

    The distinct count is a grouped aggregate joined back, not a window, so a promotion with very many conditions
    is counted in parallel. Sides that grow with the catalogue are merged: the planner's guess of their size may be far
    too low, and a side that is broadcast passes through the driver.
    """
    def text(df: DataFrame, key: str, col: str, alias: str) -> DataFrame:
        return df.select(key, F.col(col).alias(alias))

    conds = conditions.select(
        "clave_grupo_condiciones",
        "clave_edicion_producto",
        "clave_tipo_cantidad_condicion",
        "clave_tipo_criterio_condicion",
        "cantidad_inicial",
    ).join(
        products.select(
            "clave_edicion_producto", "desc_sorteo", "tipo_producto", "numero_sorteo", "precio_unitario",
            F.col("clave_edicion_producto").alias("_known"),
        ).hint("merge"),
        "clave_edicion_producto",
        "left",
    )
    base = (
        promotions.select("clave_promocion", "desc_promocion", "descl_promocion", "clave_categoria")
        .join(groups.select("clave_promocion", "clave_grupo_condiciones").hint("merge"), "clave_promocion", "left")
        .join(conds.hint("merge"), "clave_grupo_condiciones", "left")
    )
    combined = base.groupBy("clave_promocion").agg(F.count_distinct("_known").alias("cant_sorteos")).where(
        "cant_sorteos > 1"
    )
    out = (
        base.join(combined.hint("merge"), "clave_promocion")
        .join(benefits.select("clave_grupo_condiciones", "clave_tipo_beneficio", "cantidad").hint("merge"), "clave_grupo_condiciones", "left")
        .join(text(benefit_types, "clave_tipo_beneficio", "descripcion", "desc_beneficio_promocion"), "clave_tipo_beneficio", "left")
        .join(text(quantity_types, "clave_tipo_cantidad_condicion", "descripcion", "desc_tipo_cantidad_promocion"), "clave_tipo_cantidad_condicion", "left")
        .join(text(criterion_types, "clave_tipo_criterio_condicion", "descripcion", "desc_tipo_criterio_condicion"), "clave_tipo_criterio_condicion", "left")
        .join(text(categories, "clave_categoria", "desc_categoria", "desc_categoria_promocion"), "clave_categoria", "left")
    )
    return out.select(
        "clave_promocion",
        "desc_promocion",
        "descl_promocion",
        F.col("_known").alias("clave_edicion_producto"),
        "desc_sorteo",
        "tipo_producto",
        "numero_sorteo",
        "precio_unitario",
        "cantidad_inicial",
        "desc_tipo_cantidad_promocion",
        "desc_tipo_criterio_condicion",
        "desc_beneficio_promocion",
        "cantidad",
        "desc_categoria_promocion",
        "cant_sorteos",
    )


def _whole(df: DataFrame, name: str) -> Column:
    """Lenient whole number: text and fractions are accepted, anything else is NULL."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return F.col(name).try_cast("double").try_cast("bigint")


def combo_requirements_all(combos: DataFrame) -> DataFrame:
    """(promotion, product, units) of combined promotions, one row per promotion and product. Column names are
    accepted in any case; of several quantities the highest counts."""
    names = {c: c.lower() for c in combos.columns}
    df = combos.withColumnsRenamed(names)
    df = df.select(
        *[_whole(df, c).alias(c) for c in ("clave_promocion", "clave_edicion_producto", "cantidad_inicial")]
    )
    return df.groupBy("clave_promocion", "clave_edicion_producto").agg(
        F.max("cantidad_inicial").alias("cantidad_requerida")
    )


def combo_ids(requirements_all: DataFrame) -> DataFrame:
    """Ids of the combined promotions."""
    return requirements_all.select("clave_promocion").dropna().distinct()


def combo_requirements(requirements_all: DataFrame) -> DataFrame:
    """Complete requirement rows only."""
    return requirements_all.dropna()


def promo_conditions(
    conditions: DataFrame, groups: DataFrame, validity: DataFrame, quantity_types: DataFrame
) -> DataFrame:
    """Conditions with promotion, validity window, quantity-type text and a readable rule."""
    spans = validity_lookup(validity)
    types = quantity_types.select("clave_tipo_cantidad_condicion", "descripcion")
    out = (
        conditions.join(groups.select("clave_grupo_condiciones", "clave_promocion").hint("merge"), "clave_grupo_condiciones", "left")
        .join(spans.hint("merge"), "clave_promocion", "left")
        .join(types, "clave_tipo_cantidad_condicion", "left")
    )
    return out.withColumn(
        "interpretacion",
        quantity_text(F.col("clave_tipo_cantidad_condicion"), F.col("cantidad_inicial"), F.col("cantidad_final")),
    )


def requirement_lists(requirements: DataFrame) -> DataFrame:
    """Requirements of one promotion as a sorted array, for display."""
    return requirements.groupBy("clave_promocion").agg(
        F.sort_array(F.collect_list(F.struct("clave_edicion_producto", "cantidad_requerida"))).alias("requisitos")
    )


@dataclass
class Catalog:
    """Catalogue of one run: source frames, and the prepared frames that promotion detection reads.

    A prepared frame is written once, on first use: several later steps read it, and its derivation touches the
    purchase tables. The size checks also run once, on the written tables.
    """

    products: DataFrame
    source_conditions: DataFrame
    groups: DataFrame
    quantity_types: DataFrame
    source_validity: DataFrame
    combos: DataFrame
    max_rows: int
    max_per_product: int = 1_000

    @cached_property
    def validity(self) -> DataFrame:
        return stage(self.source_validity, "validity")

    @cached_property
    def conditions(self) -> DataFrame:
        prepared = promo_conditions(self.source_conditions, self.groups, self.validity, self.quantity_types)
        return stage(prepared, "conditions")

    @cached_property
    def requirements_all(self) -> DataFrame:
        return stage(combo_requirements_all(self.combos), "requirements")

    @cached_property
    def requirements(self) -> DataFrame:
        """Requirement rows with the validity window of their promotion and the number of products still needed."""
        rows = combo_requirements(self.requirements_all)
        needed = rows.groupBy("clave_promocion").agg(
            F.count_if(F.col("cantidad_requerida") > 0).alias("n_required")
        )
        spans = validity_lookup(self.validity)
        return stage(rows.join(needed.hint("merge"), "clave_promocion").join(spans.hint("merge"), "clave_promocion", "left"), "timed_requirements")

    @cached_property
    def products_bounded(self) -> bool:
        return fits(self.products.select("desc_sorteo"), self.max_rows)

    @cached_property
    def rules_bounded(self) -> bool:
        """Rules may travel to the rows: few in all, and few for each product, as a row tests all of its product."""
        few = fits(self.conditions, self.max_rows) and self.requirements_bounded
        return few and widest(self.conditions, self.requirements_all) <= self.max_per_product

    @cached_property
    def requirements_bounded(self) -> bool:
        return fits(self.requirements_all, self.max_rows)

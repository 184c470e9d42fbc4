"""Event export and promotion catalogue derived from the given tables (rules in FIXTURES.md).

Every rule is arithmetic on row values, so that the SQL side can repeat it. Users buy in one of eight popular product
families; the catalogue itself has a family for every four rows of ``part``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.schemas import EVENT_DDL
from promolens.sources.tables import CatalogTables

CFG = RunConfig(date_start=dt.date(2024, 1, 1), date_end=dt.date(2024, 1, 31))

# Product family names in the catalogue, short lists of context values.
CATALOG_NAMES = ("Gana Ya", "Sorteo Lo Quiero", "Efectivo", "Sorteo Educativo")
DEVICES = ("mobile", "desktop", "tablet")
COUNTRIES = ("Mexico", "United States")
REGIONS = ("Nuevo Leon", "Jalisco", "Texas", "Puebla")
CITIES = ("Monterrey", "Guadalajara", "Houston", "Puebla", "San Pedro")
SOURCES = ("google", "facebook", "direct")
MEDIUMS = ("organic", "cpc")
# Fixed values: (promotion slot, quantity type, n, m) of the conditions on each product of a family.
CONDITIONS = (
    ((0, 1, 3, None), (4, 5, 3, None), (7, 2, 2, None), (0, 6, 0, None), (4, 8, 3, None)),
    ((1, 2, 3, None), (5, 6, 3, None), (9, 2, 2, None), (7, 2, 2, None), (1, 7, 0, None), (5, 4, 2, 0)),
    ((2, 3, 3, None), (6, 7, 3, None), (8, 2, 1, None), (2, 4, 2, None)),
    ((3, 4, 3, 5), (8, 2, 3, None), (3, 2, None, None)),
)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


def _raw_name(position: Column, family: Column, k: Column) -> Column:
    """Item name as the source writes it. Two spellings of the second family clean to one name."""
    n = (family + 1).cast("string")
    return (
        F.when(position == 0, F.when(family == 4, F.lit("Gana Ya")).otherwise(F.concat(n, F.lit("° Gana Ya"))))
        .when(position == 1, F.concat(F.when(k % 5 == 0, "Sorteo Lo Quiero ").otherwise("LQ "), n))
        .when(position == 2, F.concat(F.lit("Sorteo Efectivo "), n))
        .otherwise(F.concat(F.lit("Sorteo Educativo "), n, F.lit(" "), n))
    )


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def base(self) -> DataFrame:
        """Source events with the numbers that the rules use."""
        e = self.table("events")
        k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return e.select(
            "event_id", "ts", "user_id", "event_type",
            k.alias("k"),
            F.floor("value").cast("bigint").alias("v"),
            F.dayofmonth("ts").alias("day"),
            F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("us"),
            (F.col("user_id") % 8).alias("g"),
        )

    @cached_property
    def _nested(self) -> DataFrame:
        k, v, g = F.col("k"), F.col("v"), F.col("g")
        kind = F.col("event_type")
        name = (
            F.when(kind == "view", F.when(k % 2 == 0, "view_item_list").otherwise("select_item"))
            .when(kind == "click", F.when(k % 3 == 0, "begin_checkout").otherwise("add_to_cart"))
            .when(kind == "purchase", "purchase")
            .when(kind == "signup", F.when(k % 4 == 0, "sign_up").otherwise("login"))
            .otherwise(F.when(k % 2 == 0, "logout").otherwise("remove_from_cart"))
        )
        txn = F.concat(F.lit("T"), F.col("event_id").cast("string"))
        bought = kind == "purchase"

        def param(key: str, text: Column | None, number: Column | None) -> Column:
            return F.struct(
                F.lit(key).alias("key"),
                F.struct(
                    (F.lit(None) if text is None else text).cast("string").alias("string_value"),
                    (F.lit(None) if number is None else number).cast("bigint").alias("int_value"),
                ).alias("value"),
            )

        def line(position: Column, quantity: Column) -> Column:
            return F.struct(
                _raw_name(position, g, k).alias("item_name"),
                F.lit(None).cast("string").alias("item_id"),
                quantity.cast("bigint").alias("quantity"),
            )

        session = F.when(k == 97, F.lit(None)).otherwise(F.floor((F.col("day") - 1) / 3))
        none = F.lit(None)
        params = F.array_compact(
            F.array(
                F.when(k != 98, param("ga_session_id", None, session)).otherwise(none),
                F.when(bought & (k % 2 == 0), param("transaction_id", txn, None)).otherwise(none),
                F.when(k % 11 == 0, param("discount", None, k)).otherwise(none),
            )
        )
        first = line(k % 4, 1 + v % 6)
        items = F.when(
            k % 17 != 0,
            F.array_compact(
                F.array(
                    first,
                    F.when(k % 7 == 0, first).otherwise(none),
                    F.when(k % 3 == 1, line((k + 1) % 4, F.lit(1))).otherwise(none),
                )
            ),
        )
        user = F.col("user_id")
        once = self.base.select(
            user.cast("string").alias("user_pseudo_id"),
            name.alias("event_name"),
            F.col("us").alias("event_timestamp"),
            F.col("event_id").alias("event_bundle_sequence_id"),
            (F.col("event_id") % 1000).alias("event_server_timestamp_offset"),
            F.when(k % 13 == 0, "APP").otherwise("WEB").alias("platform"),
            params.alias("event_params"),
            F.struct(F.when(bought & (k % 2 == 1), txn).alias("transaction_id")).alias("ecommerce"),
            items.alias("items"),
            F.struct(_pick(DEVICES, user).alias("category")).alias("device"),
            F.struct(
                _pick(COUNTRIES, user).alias("country"),
                _pick(REGIONS, user).alias("region"),
                _pick(CITIES, user).alias("city"),
            ).alias("geo"),
            F.struct(_pick(SOURCES, user).alias("source"), _pick(MEDIUMS, user).alias("medium")).alias("traffic_source"),
            F.date_format("ts", "yyyyMMdd").alias("ds"),
            F.col("day"),
        )
        copies = F.when(F.col("event_bundle_sequence_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        twice = once.withColumn("_copy", F.explode(copies))
        return twice.withColumn(
            "event_server_timestamp_offset", (F.col("event_server_timestamp_offset") + F.col("_copy")).cast("bigint")
        ).drop("_copy")

    @cached_property
    def daily(self) -> DataFrame:
        return self._nested.where("day <= 25").drop("day")

    @cached_property
    def intraday(self) -> DataFrame:
        return self._nested.where("day >= 24").drop("day")

    @cached_property
    def _parts(self) -> DataFrame:
        p = F.col("p_partkey")
        return self.table("part").select(
            p.alias("p"), (p % 4).alias("r"), F.floor(p / 4).cast("bigint").alias("g"), "p_type", "p_retailprice"
        )

    @cached_property
    def sorteo(self) -> DataFrame:
        p, r, g = F.col("p"), F.col("r"), F.col("g")
        draw = F.lit(1706756400) + (p % 40) * 86400  # 2024-02-01 03:00 UTC
        return self._parts.select(
            p.alias("clave_edicion_producto"),
            F.when((r == 3) & (g % 8 == 7), "Sorteo Archivado").otherwise(_pick(CATALOG_NAMES, r)).alias("desc_sorteo"),
            F.col("p_type").alias("tipo_producto"),
            F.when(g % 10 != 9, g + 1).alias("numero_sorteo"),
            F.col("p_retailprice").alias("precio_unitario"),
            F.timestamp_micros(draw * 1_000_000).alias("fecha_celebracion"),
        )

    @cached_property
    def promocion(self) -> DataFrame:
        first = F.col("g") * 10
        ids = self._parts.select("g").distinct().select(F.explode(F.sequence(first, first + 9)).alias("clave_promocion"))
        text = F.col("clave_promocion").cast("string")
        return ids.select(
            "clave_promocion",
            F.concat(F.lit("Promo "), text).alias("desc_promocion"),
            F.concat(F.lit("Promocion "), text).alias("descl_promocion"),
            (F.col("clave_promocion") % 25).alias("clave_categoria"),
        )

    @cached_property
    def grupo(self) -> DataFrame:
        return self.promocion.select(
            (F.col("clave_promocion") + 100000).alias("clave_grupo_condiciones"), "clave_promocion"
        )

    @cached_property
    def condicion(self) -> DataFrame:
        def entries(rows: tuple) -> Column:
            return F.array(
                *[
                    F.struct(
                        F.lit(j).cast("bigint").alias("j"),
                        F.lit(kind).cast("bigint").alias("kind"),
                        F.lit(n).cast("bigint").alias("n"),
                        F.lit(m).cast("bigint").alias("m"),
                    )
                    for j, kind, n, m in rows
                ]
            )

        r = F.col("r")
        lists = (
            F.when(r == 0, entries(CONDITIONS[0]))
            .when(r == 1, entries(CONDITIONS[1]))
            .when(r == 2, entries(CONDITIONS[2]))
            .otherwise(entries(CONDITIONS[3]))
        )
        promo = F.col("g") * 10 + F.col("c.j")
        return self._parts.select("p", "g", F.explode(lists).alias("c")).select(
            (promo + 100000).alias("clave_grupo_condiciones"),
            F.col("p").alias("clave_edicion_producto"),
            F.col("c.kind").alias("clave_tipo_cantidad_condicion"),
            (promo % 5).alias("clave_tipo_criterio_condicion"),
            F.col("c.n").alias("cantidad_inicial"),
            F.col("c.m").alias("cantidad_final"),
        )

    @cached_property
    def compras(self) -> DataFrame:
        return self._bought.select(F.col("event_id").alias("agrupador_interno_compra"), "clave_promocion")

    @cached_property
    def detalle(self) -> DataFrame:
        j = F.col("k") % 10
        open_days = (F.col("day") >= 1 + j) & (F.col("day") <= 30 - 2 * j)
        paid = self._bought.where(open_days & ~((j == 9) & (F.col("g") % 4 == 3)))
        return paid.select(
            F.col("event_id").cast("string").alias("agrupador_interno_compra"), F.col("ts").alias("fecha_pagado")
        )

    @cached_property
    def _bought(self) -> DataFrame:
        return self.base.where("event_type = 'purchase'").withColumn(
            "clave_promocion", F.col("g") * 10 + F.col("k") % 10
        )

    @cached_property
    def catalog(self) -> CatalogTables:
        region, nation = self.table("region"), self.table("nation")
        return CatalogTables(
            sorteo=self.sorteo,
            promocion=self.promocion,
            grupo_condiciones_promocion=self.grupo,
            condicion_promocion=self.condicion,
            tipo_cantidad_promocion=nation.select(
                F.col("n_nationkey").alias("clave_tipo_cantidad_condicion"), F.col("n_name").alias("descripcion")
            ),
            tipo_criterio_condicion=region.select(
                F.col("r_regionkey").alias("clave_tipo_criterio_condicion"), F.col("r_name").alias("descripcion")
            ),
            beneficio_promocion=self.grupo.select(
                "clave_grupo_condiciones",
                (F.col("clave_promocion") % 3).alias("clave_tipo_beneficio"),
                (1 + F.col("clave_promocion") % 2).alias("cantidad"),
            ),
            tipo_beneficio=region.select(
                F.col("r_regionkey").alias("clave_tipo_beneficio"), F.col("r_name").alias("descripcion")
            ),
            categoria_promocion=nation.select(
                F.col("n_nationkey").alias("clave_categoria"), F.col("n_name").alias("desc_categoria")
            ),
            compras=self.compras,
            detalle_compra=self.detalle,
        )

    def write_events(self, root: str) -> tuple[DataFrame, DataFrame]:
        """Store both shard families partitioned by day, as the source system would, and read them back."""
        out = []
        for name, df in (("daily", self.daily), ("intraday", self.intraday)):
            df.write.mode("overwrite").partitionBy("ds").parquet(f"{root}/{name}")
            out.append(self.spark.read.schema(EVENT_DDL).parquet(f"{root}/{name}"))
        return out[0], out[1]

"""Completed combined promotions by bitmaps, from session totals that merge over deliveries.

Each product that a promotion requires has a position in it. A session that reaches the quantity of a product sets the
bit of its position, and a promotion is complete when its words hold as many bits as it has positions. Words of 64 bits
are joined with OR: repeated rows and totals that arrive in any order cannot count a product twice, and a word costs
eight bytes while it is combined (the built-in bitmap aggregates hold four kilobytes per group, whatever the promotion).

Whether a quantity is reached is only known from the sum over all deliveries of a session, so the stored state is the
sums, which add up; bits are made from them when a result is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.operators.catalog import Catalog
from promolens.operators.lookup import lookup_join
from promolens.operators.patterns import STAGES, session_products
from promolens.functions.rules import active
from promolens.session import stage
from promolens.sinks.versions import VersionedTable

KEY = ["USER", "SESION"]
PRODUCT = "clave_edicion_producto"
WORD = 64
_STAGES = [s for _, _, s, _ in STAGES]


def session_state(rows: DataFrame) -> DataFrame:
    """Units per session, product and stage with the first attempt time: states of the same columns add up."""
    return session_products(rows.where(F.col("USER").isNotNull() & F.col("SESION").isNotNull()))


def merge_states(states: DataFrame) -> DataFrame:
    """One state of several: sums of the units, first of the times. Combined before the shuffle."""
    return states.groupBy(*KEY, PRODUCT).agg(*[F.sum(s).alias(s) for s in _STAGES], F.min("_at").alias("_at"))


def requirement_bits(requirements: DataFrame) -> DataFrame:
    """Requirements with the word and the bit of their position. Requirements of zero or fewer units are met by
    definition and have no bit."""
    counts = F.col("cantidad_requerida") > 0
    order = Window.partitionBy("clave_promocion").orderBy(F.desc_nulls_last(counts), PRODUCT)
    at = F.when(counts, F.row_number().over(order) - 1)
    placed = requirements.withColumn("_position", at)
    # 1 << 63 is the sign bit, which is a bit like the others.
    return placed.withColumns(
        {
            "_word": F.coalesce(F.floor(F.col("_position") / WORD), F.lit(0)),
            "_bit": F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_position") % WORD).cast("int")),
        }
    ).drop("_position")


def complete_by_bits(state: DataFrame, catalog: Catalog) -> DataFrame:
    """Combined promotions that a session completes, per stage, as ``combo_session_complete`` gives them.

    ``state`` holds any number of rows per session and product. Rows move once, by session; the later groupings keep
    that placement while requirements are broadcast.
    """
    sums = merge_states(state)
    first = F.min("_at").over(Window.partitionBy(*KEY))
    sessions = sums.repartition(*KEY).withColumn("_session_at", first)
    if not catalog.requirements_bounded:
        sessions = stage(sessions, "session_totals")
    bits = requirement_bits(catalog.requirements)
    hits = lookup_join(sessions, bits, [PRODUCT], "inner", catalog.requirements_bounded, KEY)
    hits = hits.where(active(F.col("_session_at"), F.col("d_inicio_promocion"), F.col("d_cierre_promocion")))
    need = F.col("cantidad_requerida")
    words = hits.groupBy(*KEY, "clave_promocion", "_word").agg(
        *[F.bit_or(F.when(F.col(s) >= need, F.col("_bit"))).alias(s) for s in _STAGES], F.max("n_required").alias("_n")
    )
    done = words.groupBy(*KEY, "clave_promocion").agg(
        *[F.sum(F.bit_count(F.coalesce(s, F.lit(0).cast("bigint")))).alias(s) for s in _STAGES], F.max("_n").alias("_n")
    )
    flags = done.select(*KEY, "clave_promocion", *[(F.col(s) == F.col("_n")).alias(f"{s}_COMPLETE") for s in _STAGES])
    return flags.where(" or ".join(f"{s}_COMPLETE" for s in _STAGES))


class DivisionStore:
    """Session totals kept by delivery. A delivery that comes again replaces what it brought before; the others keep
    their files. Results are those of one pass over the rows of all deliveries, whatever the order."""

    def __init__(self, spark: SparkSession, path: str):
        self._table = VersionedTable(spark, path)

    def put(self, delivery: str, rows: DataFrame) -> int:
        """Add or replace one delivery, for instance a day of attempts; returns the version. One without rows removes
        what it had brought."""
        state = session_state(rows).withColumn("delivery", F.lit(delivery))
        return self._table.replace_partitions(state, "delivery", [delivery], tuple(KEY))

    def state(self, version: int | None = None) -> DataFrame:
        return self._table.read(version).drop("delivery")

    def complete(self, catalog: Catalog) -> DataFrame:
        return complete_by_bits(self.state(), catalog)

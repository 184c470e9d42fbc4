"""Lookup joins whose small side is broadcast only after a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.session import stage

#: Fact rows of one key that a task may take in a join with an unbounded side.
HOT_ROWS = 100_000
NULL_SALTS = 64


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Stops counting right above the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(big: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """(key columns, ``_salts``) of the keys that more than ``hot_rows`` rows of ``big`` share, with the number of parts
    of at most about ``hot_rows`` rows that each is cut into. There are at most ``rows / hot_rows`` of them."""
    n = big.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    return n.select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))


def lookup_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str, bounded: bool, salt_by: list[str],
    counted: DataFrame | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join (inner or left) of a fact frame with a lookup side.

    ``bounded`` says that the lookup side passed its size check: it is broadcast and the fact side does not move.
    Otherwise both sides are shuffled and merged, whatever size the planner expects. The fact rows of a hot key (see
    ``hot_keys``) are spread over its sub-keys (drawn from ``salt_by``) and only the lookup rows of that key are repeated,
    once per sub-key, so a hot key never lands in one task and the lookup side is not multiplied as a whole. Keys are
    counted in ``counted``, a frame with the keys of ``big`` that is cheaper to read, or in ``big`` itself; that is then
    read twice, so it should be a stored table.
    """
    if bounded:
        return big.join(F.broadcast(small), on, how)
    hot = stage(hot_keys(big if counted is None else counted, on, hot_rows), "hot_keys")
    spread = F.xxhash64(*salt_by)
    # Rows with a NULL in the key find nothing; they are only kept from piling up in one task.
    no_key = F.exists(F.array(*[F.col(c).isNull() for c in on]), lambda x: x)
    parts = F.when(no_key, F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = big.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(spread, parts).cast("int")).drop("_salts")
    copies = small.join(F.broadcast(hot), on, "left")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def widest(*sides: DataFrame, key: str = "clave_edicion_producto") -> int:
    """The most rows that one key has in any of the frames; rows without key do not count."""
    most = [s.where(F.col(key).isNotNull()).groupBy(key).count().agg(F.max("count")).first()[0] for s in sides]
    return max(m or 0 for m in most)

"""Distinct counts that merge over days.

A distinct count cannot be added up over days; what can be merged is kept instead, by day:

* exact: every member has a number; 64 numbers make a word, and a state row holds the bits of the members seen for one
  (day, scope, word). Words of any days are joined with OR and their bits counted, so a window costs no second look at
  the rows, and a scope with very many members is many short rows, never one long one;
* sketch: one HLL state per (day, scope), with a relative standard error of about ``1.04 / sqrt(2**lg_k)``.

Numbers are given once and never change. A new member takes the next free place of its own lane (its hash modulo
``LANES``), so numbering needs no total order over all members.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.operators.lookup import fits, lookup_join
from promolens.sinks.versions import VersionedTable

LANES = 1024
WORD = 64
DAY, BATCH = "day", "batch"
LG_K = 12
STAGES = {"cart": "add_to_cart", "checkout": "begin_checkout", "purchase": "purchase"}


def number_members(members: DataFrame, known: DataFrame | None, key: list[str]) -> DataFrame:
    """(key columns, number) of the rows of ``members`` that ``known`` lacks; members with a NULL are left out."""
    new = members.select(*key).dropna().distinct()
    lane = F.pmod(F.xxhash64(*key), F.lit(LANES))
    if known is None:
        return new.withColumn("_lane", lane).withColumn("number", _next("_lane", key, F.lit(0))).drop("_lane")
    used = known.groupBy(F.pmod("number", F.lit(LANES)).alias("_lane")).agg((F.max(F.floor(F.col("number") / LANES)) + 1).alias("_used"))
    fresh = new.join(known, key, "left_anti").withColumn("_lane", lane)
    placed = fresh.join(F.broadcast(used), "_lane", "left")  # one row per lane
    return placed.withColumn("number", _next("_lane", key, F.coalesce("_used", F.lit(0)))).drop("_lane", "_used")


def _next(lane: str, key: list[str], used: Column) -> Column:
    place = F.row_number().over(Window.partitionBy(lane).orderBy(*key)) - 1
    return ((place + used) * LANES + F.col(lane)).cast("bigint")


def member_words(numbered: DataFrame, scope: list[str]) -> DataFrame:
    """State rows (day, scope, word, bits) of rows with a member's ``number``. Combined before the shuffle."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("number") % WORD).cast("int"))
    word = F.floor(F.col("number") / WORD).alias("word")
    return numbered.groupBy(DAY, *scope, word).agg(F.bit_or(bit).alias("bits"))


def count_words(words: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, n): different members of all days of ``words``."""
    merged = words.groupBy(*scope, "word").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*scope).agg(F.sum(F.bit_count("bits")).cast("bigint").alias("n"))


def member_sketches(rows: DataFrame, scope: list[str], member: list[str], lg_k: int = LG_K) -> DataFrame:
    """State rows (day, scope, sketch). Members with a NULL are left out."""
    whole = F.when(F.forall(F.array(*[F.col(m).isNotNull() for m in member]), lambda x: x), F.to_json(F.struct(*member)))
    return rows.groupBy(DAY, *scope).agg(F.hll_sketch_agg(whole, lg_k).alias("sketch"))


def count_sketches(sketches: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, n): estimated members of all days of ``sketches``."""
    return sketches.groupBy(*scope).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def stage_members(funnel: DataFrame) -> DataFrame:
    """(day, stage, user_pseudo_id, session_id) of every stage that a row reaches; each row reaches ``session``."""
    reached = [F.lit("session"), *[F.when(F.col(f"qty_{q}") > 0, F.lit(s)) for s, q in STAGES.items()]]
    stages = F.explode(F.array_compact(F.array(*reached))).alias("stage")
    return funnel.select(F.col("attempt_date").cast("string").alias(DAY), stages, "user_pseudo_id", "session_id")


def rates_of(counts: DataFrame) -> DataFrame:
    """Session conversion between stages, from (stage, n)."""
    n = {s: F.coalesce(F.max(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)) for s in ("session", *STAGES)}

    def ratio(part: str, whole: str) -> Column:
        return F.try_divide(n[part].cast("double"), n[whole])

    return counts.agg(
        n["session"].alias("total_sesiones"),
        ratio("checkout", "cart").alias("cart_to_checkout"),
        ratio("purchase", "checkout").alias("checkout_to_purchase"),
        ratio("purchase", "session").alias("overall"),
    )


class DistinctStore:
    """States by day of the members of each scope.

    Days come in any order and may come again; a day replaces what it brought and leaves the files of the others. Numbers
    of members that no day holds any more stay taken. ``broadcast_rows`` bounds the number table that is sent to tasks.
    ``sketched=False`` keeps the exact states alone; such a store gives no estimates. That suits scopes with few members
    each, where a sketch costs more than the words.
    """

    def __init__(self, spark: SparkSession, path: str, scope: Iterable[str], member: Iterable[str], lg_k: int = LG_K, broadcast_rows: int = 200_000, sketched: bool = True):
        self.scope, self.member, self.lg_k, self.broadcast_rows = list(scope), list(member), lg_k, broadcast_rows
        self.sketched = sketched
        self._numbers = VersionedTable(spark, f"{path.rstrip('/')}/numbers")
        self._words = VersionedTable(spark, f"{path.rstrip('/')}/words")
        self._sketches = VersionedTable(spark, f"{path.rstrip('/')}/sketches")

    def put(self, days: Iterable[str], rows: DataFrame) -> None:
        """Add or replace ``days`` (dates as text) by ``rows``, whose column ``day`` holds them as text; a day without rows
        loses what it had. ``rows`` is read up to four times, so it should be a stored table.

        Numbers are committed before the words that use them, so an update that stops is finished by repeating it.
        """
        days = sorted(set(days))
        rows = rows.select(DAY, *dict.fromkeys([*self.scope, *self.member])).where(F.col(DAY).isin(days))
        known = self._numbers.read().drop(BATCH) if self._numbers.versions() else None
        new = number_members(rows, known, self.member)
        batch = uuid.uuid4().hex
        self._numbers.replace_partitions(new.withColumn(BATCH, F.lit(batch)), BATCH, [batch], tuple(self.member))
        numbers = self._numbers.read().drop(BATCH)
        bounded = fits(numbers, self.broadcast_rows)
        # Where rows move for the join, one per day, scope and member does; else the words are combined in place.
        seen = rows.dropna(subset=self.member)
        seen = seen if bounded else seen.distinct()
        numbered = lookup_join(seen, numbers, self.member, "inner", bounded, [DAY, *self.scope, *self.member])
        self._words.replace_partitions(member_words(numbered, self.scope), DAY, days, tuple(self.scope))
        if self.sketched:
            self._sketches.replace_partitions(member_sketches(rows, self.scope, self.member, self.lg_k), DAY, days, tuple(self.scope))

    def counts(self, days: Iterable[str] | None = None) -> DataFrame:
        """(scope, n) over ``days``, or all; exact. A scope whose members are all NULL has no row."""
        return count_words(self._words.read(partitions=days), self.scope)

    def estimates(self, days: Iterable[str] | None = None) -> DataFrame:
        """(scope, n) over ``days``, or all; estimated."""
        if not self.sketched:
            raise ValueError("this store keeps no sketches")
        return count_sketches(self._sketches.read(partitions=days), self.scope)

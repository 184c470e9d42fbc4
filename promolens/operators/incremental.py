"""Attempts that follow changed days: mergeable day states, and the groups that a change can touch.

The state of a day holds, per user, session and product, the attempts numbered within that day: purchases, the last
checkout, first and last times, quantities. States of days merge in any order: an attempt's final number is its number
in the day plus the purchases of the group on earlier days, and parts with one final number are one attempt. So a day that
arrives late shifts the numbers of later days without their events being read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.operators.attempts import _NO_SESSION, _NO_USER, GROUP, SESSION, TS, USER, canonical, merge_partials, slice_partials
from promolens.session import stage

DAY_US = 86_400_000_000


def event_day() -> Column:
    """UTC day of an event as a number of days; events without a time come on the day before 1970."""
    return F.coalesce(F.floor(F.col(TS) / DAY_US).cast("int"), F.lit(-1))


def _running(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Purchases of a group before each value of ``order``, one row per value that has any before it."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    closed = rows.groupBy(*keys, order).agg(F.sum("purchases").alias("_closed"))
    return closed.select(*keys, order, F.sum("_closed").over(w).alias("_before")).where("_before > 0")


def day_states(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """States of the days of ``events``, which must be whole: group, day, number in the day, and the parts' columns."""
    if 1440 % cfg.chunk_minutes:
        raise ValueError("chunk_minutes must divide a day")
    per_day = 1440 // cfg.chunk_minutes
    nobody = (F.col(USER) == _NO_USER) & (F.col(SESSION) == _NO_SESSION)
    parts = stage(slice_partials(events, cfg), "slice_states")
    # Slices of rows with neither user nor session are sixty times narrower.
    parts = parts.withColumn("day", F.floor(F.col("slice") / F.when(nobody, per_day * 60).otherwise(per_day)).cast("int"))
    # Both sides of the join are grouped by (group, day, slice), a finer key than (group, day), of bounded size per day.
    earlier = _running(parts, [*GROUP, "day"], "slice")
    numbered = parts.join(earlier, [*GROUP, "day", "slice"], "left")
    numbered = numbered.withColumn("number", F.col("_local") + F.coalesce("_before", F.lit(0)))
    return merge_partials(numbered, "day", "number")


def attempts_of_states(states: DataFrame) -> DataFrame:
    """The attempt table of day states: the running total runs over one row per group and day."""
    earlier = _running(states, GROUP, "day")
    numbered = states.join(earlier, [*GROUP, "day"], "left")
    numbered = numbered.withColumn("attempt_id", F.col("number") + F.coalesce("_before", F.lit(0)))
    return canonical(merge_partials(numbered, "attempt_id"))


def changed_groups(before: DataFrame, after: DataFrame) -> DataFrame:
    """Groups whose states differ between two sets of day states. Equal rows cancel before anything is compared."""
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    row = F.xxhash64(*[F.col(c) for c in after.columns if c not in GROUP])
    other = F.crc32(F.to_json(F.struct(*[F.col(c) for c in after.columns if c not in GROUP])).cast("binary"))
    kept = signed.groupBy(*GROUP, row.alias("_row"), other.alias("_other")).agg(F.sum("_sign").alias("_sign"))
    return kept.where("_sign <> 0").select(*GROUP).distinct()


def of_groups(rows: DataFrame, groups: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of the groups, or with ``left_anti`` all others. Groups grow with the events, so they are merged: packed in
    their files they look small enough to be broadcast, which passes them through the driver."""
    return rows.join(groups.hint("merge"), GROUP, how)

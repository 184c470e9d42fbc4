"""Session funnel: markers, login timing, discount after login."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import FUNNEL_STEPS, MARKERS, RunConfig
from promolens.functions.labels import login_category, login_vs_step, ordered_steps
from promolens.functions.times import local_wall
from promolens.operators.attempts import BUNDLE, OFFSET, SESSION, TS, USER

KEY = [USER, SESSION]


def dedup_events(events: DataFrame) -> DataFrame:
    """Latest copy of an event within (user, session, event, timestamp). Copies collapse before the shuffle."""
    w = Window.partitionBy(*KEY, "event_name", TS).orderBy(
        F.desc_nulls_last(OFFSET), F.desc_nulls_last(BUNDLE), F.desc_nulls_last("discount")
    )
    return events.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def session_markers(events: DataFrame) -> DataFrame:
    """First time of each marker event, session bounds and counts, all as numbers (hash aggregation, combined
    before the shuffle)."""
    rows = dedup_events(events.select(*KEY, "event_name", TS, "discount", OFFSET, BUNDLE))
    name, ts = F.col("event_name"), F.col(TS)
    return rows.groupBy(*KEY).agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.count("*").alias("event_count"),
        F.count_if(name == "purchase").alias("purchase_events"),
        *[F.min(F.when(name == m, ts)).alias(f"{m}_time") for m in MARKERS],
        F.max(F.when(F.col("discount").isNotNull(), ts)).alias("last_discount"),
    )


def discount_seen() -> Column:
    """A discount event at or after the first login: the latest discount decides. FALSE without login; NULL for
    rows without user or session, which no event can be matched to."""
    seen = F.coalesce(F.col("last_discount") >= F.col("login_time"), F.lit(False))
    return F.when(F.col(USER).isNotNull() & F.col(SESSION).isNotNull(), seen)


def step_times(markers: DataFrame) -> Column:
    return ordered_steps({s.upper(): F.col(f"{s}_time") for s in FUNNEL_STEPS})


def sessions(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per user and session (22 columns)."""
    m = session_markers(events)
    m = m.withColumn("_steps", step_times(m))

    def local(c: str) -> Column:
        return local_wall(F.col(c), cfg.timezone)

    login = F.col("login_time")
    return m.select(
        *KEY,
        local("session_start").alias("session_start_mx"),
        local("session_end").alias("session_end_mx"),
        *[local(f"{x}_time").alias(f"{x}_time_mx") for x in MARKERS],
        F.to_date(local("session_start")).alias("session_date"),
        "event_count",
        (F.col("purchase_events") > 0).alias("has_purchase"),
        F.col("sign_up_time").isNotNull().alias("has_sign_up"),
        discount_seen().alias("discount_seen_after_login"),
        *[login_vs_step(login, F.col(f"{s}_time")).alias(f"login_vs_{s}") for s in FUNNEL_STEPS],
        login_category(login, F.col("_steps")).alias("categoria_login"),
    )

"""Web-event source: date shards, daily-over-intraday choice, narrow event rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import SESSION_EVENTS, RunConfig
from promolens.functions.params import has_param, param_value

_DAY = r"^\d{8}$"


def _in_window(cfg: RunConfig) -> Column:
    """Shard suffix is a day inside the run window. On a partitioned table this prunes partitions."""
    keep = F.col("ds").rlike(_DAY)
    if cfg.date_start is not None:
        keep = keep & (F.col("ds") >= cfg.date_start.strftime("%Y%m%d"))
    if cfg.date_end is not None:
        keep = keep & (F.col("ds") <= cfg.date_end.strftime("%Y%m%d"))
    return keep


def read_shards(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """Event table partitioned by ``ds``. ``ds`` stays a string: pass the schema, or it is read from the files."""
    reader = spark.read
    if ddl is not None:
        return reader.schema(ddl).parquet(path)
    df = reader.parquet(path)
    return df.withColumn("ds", F.col("ds").cast("string"))


def scan_events(shards: DataFrame, cfg: RunConfig) -> DataFrame:
    """Shards of the run window."""
    return shards.where(_in_window(cfg))


def event_days(daily: DataFrame, cfg: RunConfig) -> DataFrame:
    """Days that have daily rows."""
    return scan_events(daily, cfg).select("ds").distinct()


def event_days_from_catalog(spark: SparkSession, table: str, cfg: RunConfig) -> DataFrame:
    """The same list from partition metadata of a catalogued table, without reading any file."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    return parts.select(F.regexp_extract("partition", r"ds=(\d{8})(?:/|$)", 1).alias("ds")).where(_in_window(cfg)).distinct()


def unified_events(
    daily: DataFrame,
    intraday: DataFrame,
    cfg: RunConfig,
    event_names: tuple[str, ...] = SESSION_EVENTS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Daily shards, plus intraday shards of the days that have no daily one; web events with a session only."""
    wanted = (
        (F.col("platform") == cfg.platform)
        & F.col("event_name").isin(*event_names)
        & has_param(cfg.session_param)
    )
    days = event_days(daily, cfg) if days is None else days
    span = cfg.window_days
    if span is not None and span <= cfg.broadcast_rows:
        # At most one row per calendar day of the window.
        days = F.broadcast(days)
    late = scan_events(intraday, cfg).where(wanted).join(days, "ds", "left_anti")
    return scan_events(daily, cfg).where(wanted).unionByName(late.select(*daily.columns))


def narrow_events(events: DataFrame, cfg: RunConfig, *kept: str) -> DataFrame:
    """Flat event rows: parameters and nested fields that later steps use, and the columns ``kept``; everything else is
    pruned at the scan."""
    return events.select(
        *kept,
        "user_pseudo_id",
        param_value(cfg.session_param, "int_value").alias("session_id"),
        "event_name",
        "event_timestamp",
        F.coalesce(
            param_value("transaction_id", "string_value"), F.col("ecommerce.transaction_id")
        ).alias("transaction_id"),
        param_value("discount", "int_value").alias("discount"),
        "event_bundle_sequence_id",
        "event_server_timestamp_offset",
        "items",
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("geo_country"),
        F.col("geo.region").alias("geo_region"),
        F.col("geo.city").alias("geo_city"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
    )


def days_of(start: dt.date, end: dt.date) -> list[str]:
    """Shard suffixes of an inclusive date range."""
    return [(start + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((end - start).days + 1)]

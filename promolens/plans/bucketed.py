"""The wide table from bucketed tables: results written once by (user, session), joined without moving them again.

Rows and session contexts are stored in equally many buckets of the join key, so the joins of the wide table, and the
count of products per session, read bucket by bucket with no exchange. A session with more than ``hot_rows`` rows would
fill one bucket, which no later step can split; such sessions are kept aside in a table of their own and take a join that
sends their few contexts to every task, or spreads each session over salts where they are too many for that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.operators.funnel import _derived, _join_keys, _products_in_session, _wide, funnel_rows, session_context, traffic_density
from promolens.operators.lookup import lookup_join
from promolens.session import stage
from promolens.sinks.tables import delete_tables, save_bucketed

JOIN = ("_user", "_session")


@dataclass(frozen=True)
class FunnelBuckets:
    """Names of the stored tables, and the number of hot sessions."""

    rows: str
    contexts: str
    hot_rows: str
    hot_contexts: str
    n_hot: int

    def drop(self, spark: SparkSession) -> None:
        delete_tables(spark, [self.rows, self.contexts, self.hot_rows, self.hot_contexts])


def write_funnel_buckets(
    patterns: DataFrame, sessions: DataFrame, cfg: RunConfig, prefix: str, buckets: int, hot_rows: int = 100_000
) -> FunnelBuckets:
    """Store the funnel's rows and its session contexts in ``buckets`` buckets of (user, session), below tables that begin
    with ``prefix``. Sessions of more than ``hot_rows`` rows, and rows without user or session, which share one key,
    are set apart when there are that many of them."""
    spark = patterns.sparkSession
    keyed = stage(_join_keys(traffic_density(funnel_rows(patterns, cfg), cfg)), "funnel_rows")
    hot = stage(keyed.groupBy(*JOIN).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select(*JOIN), "hot")
    # Each hot session has over hot_rows rows, so their number is bounded by the table's size over hot_rows.
    n_hot = hot.count()
    few = F.broadcast(hot) if n_hot <= cfg.broadcast_rows else hot
    contexts = session_context(sessions, cfg)
    names = FunnelBuckets(*[f"{prefix}_{t}" for t in ("rows", "contexts", "hot_rows", "hot_contexts")], n_hot)
    # Dealt out as the buckets are, so that each bucket is one file.
    save_bucketed(keyed.join(few, [*JOIN], "left_anti").repartition(buckets, *JOIN), names.rows, JOIN, buckets)
    save_bucketed(contexts.join(few, [*JOIN], "left_anti").repartition(buckets, *JOIN), names.contexts, JOIN, buckets)
    keyed.join(few, [*JOIN]).write.mode("overwrite").saveAsTable(names.hot_rows)
    contexts.join(few, [*JOIN]).write.mode("overwrite").saveAsTable(names.hot_contexts)
    return names


def cold_funnel(spark: SparkSession, names: FunnelBuckets) -> DataFrame:
    """The wide rows of all sessions that are not hot, with no exchange."""
    rows = spark.table(names.rows)
    return _wide(rows, _products_in_session(rows), spark.table(names.contexts))


def hot_funnel(spark: SparkSession, names: FunnelBuckets, cfg: RunConfig) -> DataFrame:
    """The wide rows of hot sessions. Products are counted in two steps, so a session is combined before it moves."""
    rows, contexts = spark.table(names.hot_rows), spark.table(names.hot_contexts)
    context = _products_in_session(rows).join(contexts, [*JOIN], "left")
    joined = lookup_join(rows, context, [*JOIN], "left", names.n_hot <= cfg.broadcast_rows, ["ITEM", "intento", "datetime_str"])
    return _derived(joined)


def funnel_from_buckets(spark: SparkSession, names: FunnelBuckets, cfg: RunConfig) -> DataFrame:
    """Equal to ``funnel`` of the tables that were stored."""
    cold = cold_funnel(spark, names)
    return cold.unionByName(hot_funnel(spark, names, cfg).select(*cold.columns)) if names.n_hot else cold

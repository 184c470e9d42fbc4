"""Fingerprints of date shards: which days changed, came or went, told from file listings before any row is read.

A shard's listing (names, sizes and times of its files) costs no read. Only a shard whose listing differs from the one on
record is read, for the number and a hash of its rows; one that was merely written again with the same rows does not count
as changed. Of a day that has a daily and an intraday shard the daily one counts, as in ``unified_events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.session import stage
from promolens.sinks.versions import Files, VersionedTable
from promolens.sources.events import _in_window, read_shards

LISTING = "ds string, kind string, files bigint, bytes bigint, listing bigint"
LEDGER = f"{LISTING}, rows bigint, digest bigint, sums decimal(38,0)"


def shard_listing(spark: SparkSession, path: str, kind: str, cfg: RunConfig) -> DataFrame:
    """Per shard below ``path`` the number and size of its Parquet files and a hash of the listing; no file is opened. A
    path without shards gives no row."""
    files = Files(spark, path)
    if not any(n.startswith("ds=") for n in files.names(path)):
        return spark.createDataFrame([], LISTING)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    listed = listed.select(F.regexp_extract("path", r"/ds=([^/]+)/", 1).alias("ds"), "path", "length", "modificationTime").where(_in_window(cfg))
    entry = F.xxhash64(F.regexp_extract("path", r"([^/]+)$", 1), "length", F.unix_millis("modificationTime"))
    return listed.groupBy("ds").agg(
        F.lit(kind).alias("kind"), F.count("*").alias("files"), F.sum("length").alias("bytes"), F.bit_xor(entry).alias("listing")
    )


def shard_content(shards: DataFrame) -> DataFrame:
    """Per shard its number of rows and two hashes of them, in any order; rows that come twice do not cancel."""
    row: Column = F.xxhash64(*[F.col(c) for c in sorted(shards.columns) if c != "ds"])
    return shards.groupBy("ds").agg(
        F.count("*").alias("rows"), F.bit_xor(row).alias("digest"), F.sum(row.cast("decimal(38,0)")).alias("sums")
    )


def effective(daily: DataFrame, intraday: DataFrame) -> DataFrame:
    """The shard that counts for each day: the daily one where there is one."""
    return daily.unionByName(intraday.join(daily.select("ds"), "ds", "left_anti").select(*daily.columns))


def differing(before: DataFrame, after: DataFrame, *columns: str) -> DataFrame:
    """(ds, change) of days that were added, removed, or differ in ``columns``."""
    a, b = before.select("ds", F.struct(*columns).alias("_a")), after.select("ds", F.struct(*columns).alias("_b"))
    both = a.join(b, "ds", "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    return both.select("ds", change.alias("change"))


class ShardLedger:
    """The fingerprints of the shards that were last worked on, kept below ``path``."""

    def __init__(self, spark: SparkSession, path: str, cfg: RunConfig):
        self.spark, self.cfg = spark, cfg
        self.table = VersionedTable(spark, path)
        self._seen: DataFrame | None = None

    def known(self) -> DataFrame:
        return self.table.read() if self.table.versions() else self.spark.createDataFrame([], LEDGER)

    def changes(self, daily_path: str, intraday_path: str, ddl: str | None = None) -> DataFrame:
        """(ds, change) of the days whose shard was added, removed or changed since the last ``commit``.

        Only shards with a new listing are read. A daily shard in place of an intraday one with the same rows is not a
        change. ``commit`` puts on record what this call saw.
        """
        listings = [stage(shard_listing(self.spark, p, k, self.cfg), k) for p, k in ((daily_path, "daily"), (intraday_path, "intraday"))]
        now, before = effective(*listings), self.known()
        # One row per day that moved: bounded by the number of shards in the window.
        suspects = [r["ds"] for r in differing(before, now, "kind", "listing").collect()]
        kinds = {r["ds"]: r["kind"] for r in now.where(F.col("ds").isin(suspects)).select("ds", "kind").collect()}
        found = None
        for kind, path in (("daily", daily_path), ("intraday", intraday_path)):
            days = [d for d in suspects if kinds.get(d) == kind]
            if days:
                part = shard_content(read_shards(self.spark, path, ddl).where(F.col("ds").isin(days)))
                found = part if found is None else found.unionByName(part)
        if found is None:
            found = self.spark.createDataFrame([], LEDGER).select("ds", "rows", "digest", "sums")
        old = before.where(~F.col("ds").isin(suspects)).select("ds", "rows", "digest", "sums")
        self._seen = stage(now.join(found.unionByName(old), "ds", "left"), "seen")
        return differing(before, self._seen, "rows", "digest", "sums")

    def commit(self) -> int:
        """Record what the last ``changes`` saw, once its days have been worked on."""
        if self._seen is None:
            raise ValueError("nothing was seen yet")
        return self.table.replace(self._seen.coalesce(1))

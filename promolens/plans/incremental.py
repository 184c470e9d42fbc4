"""The attempt table kept up to date by days: only changed days are read, only touched partitions are written.

Below one path lie three versioned tables:

* ``state``: day states of attempts, by UTC day of the events;
* ``shards``: which days the events of each shard fall on, so that a shard which changes or goes takes its rows along;
* ``attempts``: the result, by attempt date. Its versions note the state they were made from.

An update commits them in that order. One that stops in between is finished by the next: states are made again from the
same shards, and the result is brought from the state it notes to the latest one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.operators.attempts import _NO_SESSION, _NO_USER, GROUP, SESSION, USER
from promolens.operators.incremental import attempts_of_states, changed_groups, day_states, event_day, of_groups
from promolens.schemas import ATTEMPTS_DDL, conform
from promolens.session import stage
from promolens.sinks.tables import LAYOUT
from promolens.sinks.versions import NULL_PARTITION, Files, VersionedTable
from promolens.sources.events import narrow_events, read_shards, unified_events
from promolens.sources.fingerprints import ShardLedger


@dataclass(frozen=True)
class Update:
    """What an update did: days of the state and dates of the result that it wrote, and the result's version."""

    days: list[str]
    dates: list[str]
    version: int


class AttemptStore:
    def __init__(self, spark: SparkSession, path: str, cfg: RunConfig):
        self.spark, self.cfg = spark, cfg
        path = path.rstrip("/")
        self.state, self.shards, self.result = (VersionedTable(spark, f"{path}/{t}") for t in ("state", "shards", "attempts"))

    def read(self, version: int | None = None) -> DataFrame:
        return self.result.read(version)

    def update(self, events: DataFrame, changed: Iterable[str]) -> Update:
        """Bring the table up to date after the shards ``changed`` came, changed or went.

        ``events`` are the narrow events of all shards there now, with their ``ds`` (see ``narrow_events``); of them only
        shards that share a day with a changed one are read. Days may come in any order, several at once, or again.
        """
        changed = sorted(set(changed))
        days = self._update_state(events, changed)
        return self._update_result(days)

    def _update_state(self, events: DataFrame, changed: list[str]) -> list[str]:
        found = events.where(F.col("ds").isin(changed)).select("ds", event_day().alias("day")).distinct()
        # One row per shard and day: bounded by the number of shards.
        now = found.collect()
        known = self.shards.read().collect() if self.shards.versions() else []
        days = sorted({r["day"] for r in known if r["ds"] in changed} | {r["day"] for r in now})
        spread = [(r["ds"], r["day"]) for r in known if r["ds"] not in changed] + [(r["ds"], r["day"]) for r in now]
        sources = sorted({ds for ds, day in spread if day in days})
        if days:
            touched = events.where(F.col("ds").isin(sources) & event_day().isin(days)).drop("ds")
            self.state.replace_partitions(day_states(touched, self.cfg), "day", map(str, days), (USER, SESSION))
            self.shards.replace(self.spark.createDataFrame(spread, "ds string, day int").coalesce(1))
        return [str(d) for d in days]

    def _update_result(self, days: list[str]) -> Update:
        last = self.result.manifest()
        based, latest = (last.info["state"] if last else None), self.state.manifest()
        if latest is None:
            version = last.version if last else self.result.replace(conform(self.spark.createDataFrame([], ATTEMPTS_DDL), ATTEMPTS_DDL), *LAYOUT["attempts"], info={"state": None})
            return Update(days, [], version)
        parts = self.state.changed_partitions(based, latest.version)
        after = self.state.read(latest.version, parts)
        before = self.state.read(based, parts) if based is not None else after.limit(0)
        groups = stage(changed_groups(before, after), "groups")
        fresh = stage(conform(attempts_of_states(self._states(latest.version, groups)), ATTEMPTS_DDL), "fresh")
        stale = attempts_of_states(self._states(based, groups)) if based is not None else fresh.limit(0)
        date = F.coalesce(F.col("attempt_date").cast("string"), F.lit(NULL_PARTITION))
        dates = fresh.select(date.alias("d")).union(stale.select(date.alias("d"))).distinct()
        dates = sorted(r["d"] for r in dates.collect())
        rows = fresh
        if last is not None:
            keyed = self.result.read(last.version, dates)
            names = {USER: F.coalesce("USER", F.lit(_NO_USER)), SESSION: F.coalesce("SESION", F.lit(_NO_SESSION).cast("bigint")), "product_key": F.col("ITEM")}
            rows = of_groups(keyed.withColumns(names), groups, "left_anti").drop(*GROUP).unionByName(fresh)
        partition, cluster = LAYOUT["attempts"]
        version = self.result.replace_partitions(rows, partition, dates, cluster, {"state": latest.version})
        return Update(days, dates, version)

    def _states(self, version: int, groups: DataFrame) -> DataFrame:
        """All states of the groups. Their days are found from the key columns alone; other days are not read further."""
        days = of_groups(self.state.read(version).select(*GROUP, "day"), groups).select("day").distinct().collect()
        return of_groups(self.state.read(version, [str(r["day"]) for r in days]), groups)


def follow(store: AttemptStore, ledger: ShardLedger, daily_path: str, intraday_path: str, ddl: str | None = None) -> Update:
    """Bring the attempts up to date with two folders of shards: the ledger tells the days, the store works on them. The
    ledger is committed last, so a run that stops is repeated for the same days."""
    changed = [r["ds"] for r in ledger.changes(daily_path, intraday_path, ddl).collect()]
    daily, intraday = (_shards(store.spark, p, ddl) for p in (daily_path, intraday_path))
    events = narrow_events(unified_events(daily, intraday, store.cfg), store.cfg, "ds")
    done = store.update(events, changed)
    ledger.commit()
    return done


def _shards(spark: SparkSession, path: str, ddl: str | None) -> DataFrame:
    """The shards of a folder, which may have none yet."""
    if ddl is not None and not any(n.startswith("ds=") for n in Files(spark, path).names(path)):
        return spark.createDataFrame([], ddl)
    return read_shards(spark, path, ddl)

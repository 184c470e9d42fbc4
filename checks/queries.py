"""One query per operator, each over the whole given tables of a scale factor."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import CFG, Fixture
from promolens import schemas
from promolens.config import FUNNEL_STEPS
from promolens.functions.labels import login_category, login_vs_step
from promolens.functions.rules import meets, one_short, rule_bounds
from promolens.functions.text import clean_item, override_item
from promolens.functions.times import local_wall, parse_time_text, time_text, utc_wall
from promolens.operators import attempts as att
from promolens.operators import catalog as cat
from promolens.operators import funnel as fun
from promolens.operators import distinct, division, kpis, quality
from promolens.operators import patterns as pat
from promolens.operators import force_index as force
from promolens.operators import sessions as ses
from promolens.plans.bucketed import funnel_from_buckets, write_funnel_buckets
from promolens.plans.incremental import AttemptStore, follow
from promolens.plans.pipeline import combos_of, prepare_catalog, write_funnel_checked
from promolens.session import stage, work_dir
from promolens.sinks.checked import read_every, read_quarantine
from promolens.sinks.interleaved import write_interleaved
from promolens.sinks.tables import LAYOUT, delete_tables, export_csv, load_from_csv, write_clustered
from promolens.sinks.versions import Files, VersionedTable
from promolens.sources import events as src
from promolens.sources.dates import standardize_dates
from promolens.sources.fingerprints import ShardLedger
from promolens.sources.rescued import load_csv_rescued, read_rejects
from promolens.sources.tables import read_result

Query = Callable[[SparkSession, str], DataFrame]


def _moment(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _flat(df: DataFrame) -> DataFrame:
    """Comparable columns: moments and dates as text, id arrays as comma text, amounts rounded to cents."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            c = _moment(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = _moment(utc_wall(F.unix_micros(c)))
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 2)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def _fine(df: DataFrame) -> DataFrame:
    """As ``_flat`` for reports, with ratios kept to six digits."""
    keep = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.round(c, 6).alias(c) if c in keep else F.col(c) for c in df.columns])


def _plain(df: DataFrame) -> DataFrame:
    """Without the columns that only detection reads."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


class Chain:
    """The stages of one run. Stages that several later steps read are written once, as the pipeline does."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.fx = Fixture(spark, sf_dir)

    @cached_property
    def unified(self) -> DataFrame:
        return src.unified_events(self.fx.daily, self.fx.intraday, CFG)

    @cached_property
    def events(self) -> DataFrame:
        return src.narrow_events(self.unified, CFG)

    @cached_property
    def lines(self) -> DataFrame:
        return att.flatten_items(self.events.where(F.col("event_name").isin(*att.ATTEMPT_EVENTS)))

    @cached_property
    def numbered(self) -> DataFrame:
        return att.attempt_ids(self.events, CFG)

    @cached_property
    def attempts(self) -> DataFrame:
        return att.attempts(self.events, CFG)

    @cached_property
    def window(self) -> DataFrame:
        return att.attempts_window(self.attempts, CFG)

    @cached_property
    def sessions(self) -> DataFrame:
        return ses.sessions(self.events, CFG)

    @cached_property
    def markers(self) -> DataFrame:
        return ses.session_markers(self.events)

    @cached_property
    def catalog(self) -> cat.Catalog:
        return prepare_catalog(self.fx.catalog, CFG)

    @cached_property
    def large_catalog(self) -> cat.Catalog:
        """The same catalogue as if it had failed every size check."""
        return prepare_catalog(self.fx.catalog, replace(CFG, broadcast_rows=0))

    @cached_property
    def enriched(self) -> DataFrame:
        return pat.enrich_attempts(self.window, self.catalog, CFG)

    @cached_property
    def detection_input(self) -> DataFrame:
        """Read twice: by the session totals and by the rows themselves."""
        return stage(self.enriched, "enriched")

    @cached_property
    def patterns(self) -> DataFrame:
        return pat.patterns(self.detection_input, self.catalog)

    @cached_property
    def pattern_table(self) -> DataFrame:
        return stage(schemas.conform(self.patterns, schemas.PATTERNS_DDL), "patterns")

    @cached_property
    def wide(self) -> DataFrame:
        return fun.funnel(self.pattern_table, self.sessions, CFG)

    @cached_property
    def priced(self) -> DataFrame:
        return schemas.conform(fun.price_inference(self.wide, self.fx.sorteo, CFG), schemas.FUNNEL_DDL)

    @cached_property
    def combos(self) -> DataFrame:
        return cat.combo_ids(self.catalog.requirements_all)

    @cached_property
    def flags(self) -> DataFrame:
        """The rows and their different id lists read the priced table, so it is written first."""
        return kpis.promo_row_flags(stage(self.priced, "priced"), self.combos)


QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Chain], DataFrame]) -> Callable[[Chain], DataFrame]:
    """Register under the function name; a trailing underscore only avoids a clash with an imported function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Chain(spark, sf_dir))

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


_EVENT = ["user_pseudo_id", "session_id", "event_name", "event_timestamp"]
_ROW = ["USER", "SESION", "ITEM", "INTENTO"]
_FUNNEL_ROW = ["user_pseudo_id", "session_id", "ITEM", "intento"]
_SETS = [f"PROMOS_{s}_{k}" for _, _, s, _ in pat.STAGES for k in ("COMPLETAS", "INCOMPLETAS", "TODAS")]
_TEXTS = [f"DESC_{s}_COMPLETAS" for _, _, s, _ in pat.STAGES]
_PATRON = [f"PATRON_{f}" for _, f, _, _ in pat.STAGES]


# ---- sources -------------------------------------------------------------------------------------------------


@query
def scan_events(c: Chain) -> DataFrame:
    return (
        src.scan_events(c.fx.daily, CFG)
        .groupBy("ds", "event_name")
        .agg(F.count("*").alias("n"), F.min("event_timestamp").alias("first_us"))
    )


@query
def event_days(c: Chain) -> DataFrame:
    return src.event_days(c.fx.daily, CFG)


@query
def event_days_catalog(c: Chain) -> DataFrame:
    """Days from the partitions of a catalogued event table; none of its files is read."""
    name = f"promolens_{uuid.uuid4().hex}"
    c.fx.daily.write.partitionBy("ds").saveAsTable(name)
    out = stage(src.event_days_from_catalog(c.spark, name, CFG), "days")
    delete_tables(c.spark, name)
    return out


@query
def unified_events(c: Chain) -> DataFrame:
    return c.unified.select(
        "ds", "user_pseudo_id", "event_name", "event_timestamp", "event_bundle_sequence_id",
        "event_server_timestamp_offset", "platform",
    )


@query
def event_params(c: Chain) -> DataFrame:
    return c.events.drop("items")


@query
def event_times(c: Chain) -> DataFrame:
    us = F.col("event_timestamp")
    local = local_wall(us, CFG.timezone)
    return c.events.select(
        "event_bundle_sequence_id", "event_server_timestamp_offset",
        _moment(utc_wall(us)).alias("utc"), _moment(local).alias("local_time"),
        F.to_date(local).cast("string").alias("local_date"),
    )


@query
def csv_ingest(c: Chain) -> DataFrame:
    """Orders as CSV text, loaded into a typed table and read back: whole numbers with a fraction or none, days in two
    layouts with unreadable ones, moments with ``T`` and fractions, as our own export writes them."""
    root = work_dir(c.spark)
    orders, key, d = c.fx.table("orders"), F.col("o_orderkey"), F.col("o_orderdate")
    orders.select(
        "o_orderkey", "o_totalprice",
        F.when(key % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).when(key % 3 == 1, F.col("o_custkey").cast("string")).alias("customer"),
        F.when(key % 5 == 0, "31/02/2024").when(key % 5 == 1, F.date_format(d, "yyyy/MM/dd")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("day"),
        F.when(key % 2 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("moment"),
    ).write.option("header", True).csv(f"{root}/in")
    ddl = "o_orderkey bigint, customer bigint, day date, moment timestamp_ntz, o_totalprice double"
    load_from_csv(c.spark, f"{root}/in", f"{root}/out", ddl)
    return _flat(read_result(c.spark, f"{root}/out", ddl))


@query
def csv_rejects(c: Chain) -> DataFrame:
    """Orders as CSV lines, some with unreadable values, some with a field too few or too many: the rejected rows."""
    root = work_dir(c.spark)
    key, d = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    customer = F.when(key % 7 == 0, F.concat(F.lit("c"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    day = F.when(key % 5 == 0, F.lit("31/02/2024")).when(key % 5 == 1, F.lit("")).otherwise(d)
    fields = F.concat_ws(",", key, customer, day)
    line = F.when(key % 11 == 0, F.concat(fields, F.lit(",more"))).when(key % 13 == 0, F.concat_ws(",", key, customer)).otherwise(fields)
    whole = {"sep": "\u0001", "quote": "", "header": "true"}
    c.fx.table("orders").select(line.alias("o_orderkey,customer,day")).write.options(**whole).csv(f"{root}/in")
    load_csv_rescued(c.spark, f"{root}/in", f"{root}/out", "o_orderkey bigint, customer bigint, day date", f"{root}/rejects")
    raw = [F.col("raw")[n].alias(n) for n in ("o_orderkey", "customer", "day")]
    return read_rejects(c.spark, f"{root}/rejects").select(*raw, F.array_join("reasons", ",").alias("reasons"), "line")


@query
def standardize_dates_(c: Chain) -> DataFrame:
    d = F.col("o_orderdate")
    key = F.col("o_orderkey")
    rows = c.fx.table("orders").select(
        "o_orderkey",
        F.date_format(d, "yyyy-MM-dd").alias("iso_day"),
        F.date_format(d, "dd/MM/yyyy").alias("slash_day"),
        F.date_format(d, "yyyy-MM-dd HH:mm:ss").alias("iso_time"),
        F.date_format(d, "dd/MM/yyyy HH:mm").alias("slash_time"),
        F.when(key % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy HH:mm")).alias("mixed"),
        F.when(key % 7 == 0, F.lit("?")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("bad"),
    )
    return _flat(standardize_dates(rows, ["iso_day", "slash_day", "iso_time", "slash_time", "mixed", "bad", "absent"]))



@query
def roundtrip_partitioned(c: Chain) -> DataFrame:
    path = f"{work_dir(c.spark)}/attempts"
    write_clustered(schemas.conform(c.attempts, schemas.ATTEMPTS_DDL), path, *LAYOUT["attempts"])
    return _flat(read_result(c.spark, path, schemas.ATTEMPTS_DDL))


@query
def funnel_interleaved(c: Chain) -> DataFrame:
    """The wide table stored by interleaved ranks, read back."""
    path, rows = f"{work_dir(c.spark)}/funnel", stage(c.priced, "funnel")
    write_interleaved(rows, path, *LAYOUT["funnel"], bloom=("user_pseudo_id", "session_id"))
    return _flat(read_result(c.spark, path, schemas.FUNNEL_DDL))


@query
def rerun_replaces(c: Chain) -> DataFrame:
    """A wide result, then a narrow one to the same place: nothing of the first is left."""
    path = f"{work_dir(c.spark)}/attempts"
    every = stage(schemas.conform(c.attempts, schemas.ATTEMPTS_DDL), "every")
    write_clustered(every, path, *LAYOUT["attempts"])
    write_clustered(every.where("attempt_date <= date'2024-01-10'"), path, *LAYOUT["attempts"])
    return _flat(read_result(c.spark, path, schemas.ATTEMPTS_DDL))


def _add_shards(df: DataFrame, path: str, mode: str = "append") -> None:
    """Put shards below ``path``; ``overwrite`` replaces those that occur in ``df`` and leaves the others."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(path)


@query
def incremental_attempts(c: Chain) -> DataFrame:
    """Shards that come in three deliveries, each between the days of the earlier ones, followed by the attempt table."""
    root = work_dir(c.spark)
    daily, intraday = f"{root}/daily", f"{root}/intraday"
    store, ledger = AttemptStore(c.spark, f"{root}/store", CFG), ShardLedger(c.spark, f"{root}/ledger", CFG)
    for rest in (0, 2, 1):
        part = F.col("ds").cast("int") % 3 == rest
        _add_shards(c.fx.daily.where(part), daily)
        _add_shards(c.fx.intraday.where(part), intraday)
        follow(store, ledger, daily, intraday, schemas.EVENT_DDL)
    return _flat(store.read())


@query
def versioned_replace(c: Chain) -> DataFrame:
    """A table, then a version with two dates replaced; both versions are read after the second commit."""
    table = VersionedTable(c.spark, f"{work_dir(c.spark)}/attempts")
    every = stage(schemas.conform(c.attempts, schemas.ATTEMPTS_DDL), "every").where("attempt_date <= date'2024-01-10'")
    table.replace(every.where("attempt_date <= date'2024-01-03'"), *LAYOUT["attempts"])
    table.replace(every, *LAYOUT["attempts"])
    dates = ["2024-01-05", "2024-01-06"]
    bought = every.where(F.col("attempt_date").cast("string").isin(dates) & (F.col("STATUS") == "PURCHASED"))
    table.replace_partitions(bought, "attempt_date", dates, LAYOUT["attempts"][1])
    table.expire(keep=2)
    both = [table.read(v).withColumn("version", F.lit(v).cast("bigint")) for v in table.versions()]
    return _flat(both[0].unionByName(both[1]))


@query
def shard_changes(c: Chain) -> DataFrame:
    """Days that changed between two states of the shard folders: one loses its purchases, one goes, one is written again
    as it was, two pass from intraday to daily (one with other rows), one comes."""
    root, day, bought = work_dir(c.spark), F.substring("ds", 7, 2).cast("int"), F.col("event_name") == "purchase"
    daily, intraday, ledger = f"{root}/daily", f"{root}/intraday", ShardLedger(c.spark, f"{root}/ledger", CFG)
    _add_shards(c.fx.daily.where(day <= 23), daily)
    _add_shards(c.fx.intraday.where(day != 27), intraday)
    ledger.changes(daily, intraday, schemas.EVENT_DDL)
    ledger.commit()
    again = c.fx.daily.where(day.isin(9, 25) | (day.isin(5, 24) & ~bought))
    _add_shards(again, daily, "overwrite")
    _add_shards(c.fx.intraday.where(day == 27), intraday)
    for ds in [r["ds"] for r in c.fx.daily.where(day == 7).select("ds").distinct().collect()]:
        Files(c.spark, daily).remove(f"{daily}/ds={ds}")
    return ledger.changes(daily, intraday, schemas.EVENT_DDL)


@query
def funnel_bucketed(c: Chain) -> DataFrame:
    """The wide table from stored buckets; sessions of more than four rows count as hot, so both ways have rows."""
    prefix = f"promolens_{uuid.uuid4().hex}"
    names = write_funnel_buckets(c.pattern_table, c.sessions, CFG, prefix, buckets=16, hot_rows=4)
    out = stage(funnel_from_buckets(c.spark, names, CFG), "funnel")
    names.drop(c.spark)
    return _flat(out)


@query
def delete_tables_(c: Chain) -> DataFrame:
    """Orders dealt into four tables by status and key, some tables dropped: the rows of those that are left."""
    prefix = f"promolens_drop_{uuid.uuid4().hex}"
    names = [f"{prefix}_{i}" for i in range(4)]
    for i, name in enumerate(names):
        c.fx.table("orders").where(F.col("o_orderkey") % 4 == i).write.saveAsTable(name)
    delete_tables(c.spark, [names[1], names[3], f"{prefix}_never_made"])
    left = [r["tableName"] for r in c.spark.sql(f"SHOW TABLES LIKE '{prefix}_*'").collect()]
    parts = [c.spark.table(t).select(F.lit(int(t[-1])).cast("bigint").alias("part"), "o_orderkey", "o_orderstatus") for t in sorted(left)]
    out = stage(parts[0].unionByName(parts[1]), "left")
    delete_tables(c.spark, left)
    return out


@query
def csv_export(c: Chain) -> DataFrame:
    path = f"{work_dir(c.spark)}/patterns_csv"
    export_csv(c.pattern_table.select(*_ROW, *_SETS), path)
    text = c.spark.read.option("header", True).csv(path)
    return text.select(
        "USER", F.col("SESION").cast("bigint").alias("SESION"), "ITEM", F.col("INTENTO").cast("bigint").alias("INTENTO"),
        *_SETS,
    )


@query
def conform_schema(c: Chain) -> DataFrame:
    """Reordered, typed and with absent arrays made empty."""
    holes = c.patterns.withColumn(
        "PROMOS_ADD_CART_TODAS", F.when(F.col("STATUS") == "PURCHASED", F.col("PROMOS_ADD_CART_TODAS"))
    ).withColumn("extra", F.lit(1))
    return _flat(schemas.conform(holes, schemas.PATTERNS_DDL))


# ---- attempts ------------------------------------------------------------------------------------------------


@query
def flatten_items(c: Chain) -> DataFrame:
    return c.lines.select(
        "event_bundle_sequence_id", "event_server_timestamp_offset", "event_name", "item_name", "raw_item_qty"
    )


@query
def dedup_items(c: Chain) -> DataFrame:
    return att.dedup_items(c.lines).select(
        *_EVENT, "item_name", "raw_item_qty", "transaction_id", "event_server_timestamp_offset"
    )


@query
def event_item_qty(c: Chain) -> DataFrame:
    return att.event_item_qty(att.dedup_items(c.lines))


@query
def dedup_event_items(c: Chain) -> DataFrame:
    return att.dedup_event_items(att.event_item_qty(att.dedup_items(c.lines)))


@query
def attempt_ids(c: Chain) -> DataFrame:
    return c.numbered.select(*_EVENT, "product_key", "item_qty", "is_purchase", "attempt_id")


@query
def checkout_qty(c: Chain) -> DataFrame:
    return att.checkout_qty(c.numbered)


@query
def attempts(c: Chain) -> DataFrame:
    return _flat(c.attempts)


@query
def attempts_window(c: Chain) -> DataFrame:
    return _plain(c.window)


# ---- sessions ------------------------------------------------------------------------------------------------


@query
def dedup_events(c: Chain) -> DataFrame:
    return ses.dedup_events(c.events).select(*_EVENT, "event_server_timestamp_offset", "discount")


@query
def session_markers(c: Chain) -> DataFrame:
    return c.markers


@query
def session_steps(c: Chain) -> DataFrame:
    steps = ses.step_times(c.markers)
    return c.markers.select(
        "user_pseudo_id", "session_id", F.array_join(F.transform(steps, lambda s: s["step"]), ">").alias("steps")
    )


@query
def login_vs_steps(c: Chain) -> DataFrame:
    login = F.col("login_time")
    return c.markers.select(
        "user_pseudo_id", "session_id",
        *[login_vs_step(login, F.col(f"{s}_time")).alias(f"login_vs_{s}") for s in FUNNEL_STEPS],
    )


@query
def login_category_(c: Chain) -> DataFrame:
    label = login_category(F.col("login_time"), ses.step_times(c.markers))
    return c.markers.groupBy(label.alias("categoria_login")).agg(F.count("*").alias("sesiones"))



@query
def discount_after_login(c: Chain) -> DataFrame:
    return c.markers.select("user_pseudo_id", "session_id", ses.discount_seen().alias("discount_seen_after_login"))


@query
def sessions(c: Chain) -> DataFrame:
    return _flat(c.sessions)


# ---- catalogue -----------------------------------------------------------------------------------------------


@query
def catalog_items(c: Chain) -> DataFrame:
    return _flat(cat.catalog_items(c.fx.sorteo))


@query
def promo_validity(c: Chain) -> DataFrame:
    return _flat(c.catalog.source_validity)


@query
def combo_catalog(c: Chain) -> DataFrame:
    return _flat(combos_of(c.fx.catalog))


@query
def combo_requirements(c: Chain) -> DataFrame:
    upper = combos_of(c.fx.catalog).withColumnsRenamed(
        {x: x.upper() for x in ("clave_promocion", "clave_edicion_producto", "cantidad_inicial")}
    )
    return cat.combo_requirements(cat.combo_requirements_all(upper))


@query
def requirement_lists(c: Chain) -> DataFrame:
    lists = cat.requirement_lists(cat.combo_requirements(c.catalog.requirements_all))
    text = F.transform(
        "requisitos",
        lambda r: F.concat(r["clave_edicion_producto"].cast("string"), F.lit("x"), r["cantidad_requerida"].cast("string")),
    )
    return lists.select("clave_promocion", F.array_join(text, ",").alias("requisitos"))


@query
def promo_conditions(c: Chain) -> DataFrame:
    return _flat(c.catalog.conditions)


@query
def condition_coverage(c: Chain) -> DataFrame:
    return kpis.condition_coverage(c.catalog.conditions)


# ---- cleaning and enrichment ---------------------------------------------------------------------------------


@query
def clean_item_(c: Chain) -> DataFrame:
    names = c.lines.groupBy("item_name").agg(F.count("*").alias("n"))
    clean = clean_item(F.col("item_name"), CFG.name_rewrites)
    return names.select("item_name", "n", override_item(clean, CFG.item_overrides).alias("clean"))



@query
def datetime_text(c: Chain) -> DataFrame:
    local = local_wall(F.col("event_timestamp"), CFG.timezone)
    text = c.events.select("event_bundle_sequence_id", "event_server_timestamp_offset", time_text(local).alias("texto"))
    return text.select("*", _moment(parse_time_text(F.col("texto"))).alias("parsed"))


@query
def enrich_attempts(c: Chain) -> DataFrame:
    return _flat(_plain(c.enriched))


@query
def days_to_draw(c: Chain) -> DataFrame:
    return c.enriched.groupBy("dias_para_sorteo").agg(F.count("*").alias("intentos"))


@query
def stage_amounts(c: Chain) -> DataFrame:
    cols = [a for _, _, _, a in pat.STAGES]
    return _flat(c.enriched.groupBy("ITEM").agg(*[F.sum(a).alias(a) for a in cols], F.count("*").alias("intentos")))


# ---- promotion rules -----------------------------------------------------------------------------------------


def _rule_rows(c: Chain) -> DataFrame:
    """Rule inputs from order lines: every type, zero and missing numbers included."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    n = F.when(part % 11 == 0, F.lit(None)).otherwise(part % 6)
    return c.fx.table("lineitem").select(
        F.when(part % 13 == 0, F.lit(8)).otherwise(F.col("l_linenumber")).cast("bigint").alias("tipo"),
        n.cast("bigint").alias("n"),
        F.when(supp % 3 == 0, F.lit(None)).when(supp % 3 == 1, F.lit(0)).otherwise(n + 2).cast("bigint").alias("m"),
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(None)).otherwise(F.col("l_quantity") % 13).cast("bigint").alias("qty"),
    )


@query
def quantity_rule_(c: Chain) -> DataFrame:
    rows = _rule_rows(c).withColumn("b", rule_bounds(F.col("tipo"), F.col("n"), F.col("m")))
    met = meets(F.col("qty"), F.col("b.lo"), F.col("b.hi"), F.col("b.step")).alias("cumple")
    return rows.groupBy("tipo", "n", "m", "qty", met).agg(F.count("*").alias("filas"))



@query
def near_miss_(c: Chain) -> DataFrame:
    return (
        _rule_rows(c)
        .groupBy("n", "qty", one_short(F.col("qty"), F.col("n") - 1).alias("casi"))
        .agg(F.count("*").alias("filas"))
    )



@query
def simple_promos(c: Chain) -> DataFrame:
    return _flat(pat.simple_promos(c.enriched, c.catalog).select(*_ROW, *_SETS, *_TEXTS))


@query
def combo_session_complete(c: Chain) -> DataFrame:
    return pat.combo_session_complete(c.enriched, c.catalog)


@query
def combo_promos(c: Chain) -> DataFrame:
    return _flat(pat.combo_promos(c.detection_input, c.catalog).select(*_ROW, *_SETS))


@query
def patterns(c: Chain) -> DataFrame:
    return _flat(schemas.conform(c.patterns, schemas.PATTERNS_DDL))


@query
def simple_promos_joined(c: Chain) -> DataFrame:
    return _flat(pat.simple_promos(c.detection_input, c.large_catalog).select(*_ROW, *_SETS, *_TEXTS))


@query
def combo_promos_joined(c: Chain) -> DataFrame:
    return _flat(pat.combo_promos(c.detection_input, c.large_catalog).select(*_ROW, *_SETS))


@query
def patterns_joined(c: Chain) -> DataFrame:
    return _flat(schemas.conform(pat.patterns(c.detection_input, c.large_catalog), schemas.PATTERNS_DDL))


@query
def patterns_by_day(c: Chain) -> DataFrame:
    return _flat(schemas.conform(force.patterns_by_day(c.detection_input, c.catalog), schemas.PATTERNS_DDL))


@query
def patterns_by_day_joined(c: Chain) -> DataFrame:
    return _flat(schemas.conform(force.patterns_by_day(c.detection_input, c.large_catalog), schemas.PATTERNS_DDL))


@query
def rules_tested(c: Chain) -> DataFrame:
    return force.rules_tested(c.detection_input, c.catalog)


@query
def combo_session_bits(c: Chain) -> DataFrame:
    """Session totals of three deliveries, out of order; one of them comes twice, first without its purchases."""
    store = division.DivisionStore(c.spark, f"{work_dir(c.spark)}/division")
    rows = c.detection_input
    part = F.substring("DATETIME", 1, 2).cast("int") % 3
    for number in (2, 0, 1):
        store.put(f"part{number}", rows.where((part == number) & ((F.col("STATUS") != "PURCHASED") | F.lit(number != 2))))
    store.put("part2", rows.where(part == 2))
    return store.complete(c.catalog)


@query
def pattern_flags(c: Chain) -> DataFrame:
    return c.patterns.select(*_ROW, *_PATRON, "TIENE_PATRON_COMPLETO", "TIENE_PATRON_INCOMPLETO")


@query
def pattern_summary(c: Chain) -> DataFrame:
    return kpis.pattern_summary(c.patterns)


@query
def promos_seen(c: Chain) -> DataFrame:
    return kpis.promos_seen(c.patterns, "PROMOS_ADD_CART_TODAS")


# ---- funnel --------------------------------------------------------------------------------------------------


def _attempt_rows(c: Chain) -> DataFrame:
    return c.window.select(
        F.col("USER").alias("user_pseudo_id"), F.col("SESION").alias("session_id"), "ITEM",
        F.col("INTENTO").alias("intento"), parse_time_text(F.col("DATETIME")).alias("attempt_dt_mx"),
    )


@query
def traffic_density(c: Chain) -> DataFrame:
    return _flat(fun.traffic_density(stage(_attempt_rows(c), "rows"), CFG))


@query
def products_in_session(c: Chain) -> DataFrame:
    return _flat(fun.products_in_session(stage(_attempt_rows(c), "rows")))


def _by_days(store: distinct.DistinctStore, rows: DataFrame) -> distinct.DistinctStore:
    """Three deliveries of days in turn; the first days come again whole after a part of them."""
    days = sorted(r[0] for r in rows.select(distinct.DAY).distinct().collect())  # at most the days of the window
    store.put(days[::3], rows.where(F.xxhash64(*rows.columns) % 3 == 0))
    for first in (2, 0, 1):
        store.put(days[first::3], rows)
    return store


@query
def products_merged(c: Chain) -> DataFrame:
    """Distinct items per session over all days and over the first ten, from states by day."""
    day = F.to_date(parse_time_text(F.col("DATETIME"))).cast("string").alias(distinct.DAY)
    rows = stage(c.window.select(day, F.col("USER").alias("user_pseudo_id"), F.col("SESION").alias("session_id"), "ITEM"), "items")
    scope = ["user_pseudo_id", "session_id"]
    store = _by_days(distinct.DistinctStore(c.spark, f"{work_dir(c.spark)}/products", scope, ["ITEM"], sketched=False), rows)
    early = [f"2024-01-{d:02d}" for d in range(1, 11)]
    both = [n.withColumn("days", F.lit(label)) for label, n in (("all", store.counts()), ("early", store.counts(early)))]
    return both[0].unionByName(both[1])


def _stage_store(c: Chain) -> distinct.DistinctStore:
    rows = stage(distinct.stage_members(c.priced), "members")
    return _by_days(distinct.DistinctStore(c.spark, f"{work_dir(c.spark)}/stages", ["stage"], ["user_pseudo_id", "session_id"]), rows)


@query
def conversion_merged(c: Chain) -> DataFrame:
    return _fine(distinct.rates_of(_stage_store(c).counts()))


@query
def conversion_sketched(c: Chain) -> DataFrame:
    """Sessions per stage, and whether the estimate from sketches is within four standard errors."""
    store = _stage_store(c)
    error = 4 * 1.04 / 2 ** (store.lg_k / 2)
    both = store.counts().join(store.estimates().withColumnRenamed("n", "estimate"), "stage")
    return both.select("stage", "n", (F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * error).alias("near"))


@query
def funnel(c: Chain) -> DataFrame:
    return _flat(c.wide)


@query
def login_bucket(c: Chain) -> DataFrame:
    return c.sessions.groupBy(fun.bucket_of_session()).agg(F.count("*").alias("sesiones"))


@query
def price_inference(c: Chain) -> DataFrame:
    return _flat(c.priced)


# ---- KPIs ----------------------------------------------------------------------------------------------------


@query
def session_rollup(c: Chain) -> DataFrame:
    return _flat(kpis.session_rollup(c.priced))


@query
def session_kpis(c: Chain) -> DataFrame:
    return _flat(kpis.session_kpis(kpis.session_rollup(c.priced)))


@query
def kpi_summary(c: Chain) -> DataFrame:
    return _flat(kpis.kpi_summary(kpis.session_kpis(kpis.session_rollup(c.priced))))


@query
def promo_row_flags(c: Chain) -> DataFrame:
    return c.flags.select(*_FUNNEL_ROW, *kpis.ROW_FLAGS)


@query
def row_flag_summary(c: Chain) -> DataFrame:
    return kpis.row_flag_summary(c.flags)


@query
def session_promo_flags(c: Chain) -> DataFrame:
    return kpis.session_promo_flags(c.flags)


@query
def promo_incidence(c: Chain) -> DataFrame:
    return _fine(kpis.promo_incidence(kpis.session_promo_flags(c.flags)))


@query
def conversion_rates(c: Chain) -> DataFrame:
    return _fine(quality.conversion_rates(c.priced))


@query
def promo_impact(c: Chain) -> DataFrame:
    return _fine(quality.promo_impact(c.priced))


@query
def lost_opportunity(c: Chain) -> DataFrame:
    return _flat(quality.lost_opportunity(c.priced))


@query
def integrity_checks(c: Chain) -> DataFrame:
    return _flat(quality.integrity_checks(c.priced))


def _written_funnel(c: Chain) -> tuple[str, dict]:
    path = f"{work_dir(c.spark)}/funnel"
    return path, write_funnel_checked(c.priced, path)


@query
def observed_checks(c: Chain) -> DataFrame:
    """Integrity counts and pattern summary as the write of the wide table measured them."""
    _, seen = _written_funnel(c)
    ddl = ", ".join(f"{n} {'double' if n.endswith('_total') else 'bigint'}" for n in sorted(seen))
    return _flat(c.spark.createDataFrame([tuple(seen[n] for n in sorted(seen))], ddl))


@query
def quarantine(c: Chain) -> DataFrame:
    """Rows of the quarantine folder, counted by attempt and broken check."""
    path, _ = _written_funnel(c)
    bad = read_quarantine(c.spark, path, c.priced)
    told = bad.select(*_FUNNEL_ROW, F.explode("violations").alias("violation"))
    return told.groupBy(*told.columns).agg(F.count("*").alias("filas"))


@query
def checked_funnel(c: Chain) -> DataFrame:
    """All rows of the checked table: those in quarantine too."""
    path, _ = _written_funnel(c)
    return _flat(read_every(c.spark, path, c.priced))


@query
def validity_checks(c: Chain) -> DataFrame:
    return quality.validity_checks(stage(c.priced, "priced"), c.catalog.validity)


@query
def event_checks(c: Chain) -> DataFrame:
    return quality.event_checks(c.lines)

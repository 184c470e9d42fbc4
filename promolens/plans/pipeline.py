"""The two runs: the full pipeline and the re-analysis of an existing funnel table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from promolens.config import RunConfig
from promolens.operators import kpis, quality
from promolens.operators.attempts import attempts, attempts_window
from promolens.operators.catalog import Catalog, combo_catalog, combo_ids, combo_requirements_all, promo_validity
from promolens.operators.funnel import funnel, price_inference
from promolens.operators.patterns import enrich_attempts, patterns
from promolens.operators.sessions import sessions
from promolens.schemas import ATTEMPTS_DDL, FUNNEL_DDL, PATTERNS_DDL, SESSIONS_DDL, conform
from promolens.session import apply_recommended, stage
from promolens.sinks.checked import write_checked
from promolens.sinks.tables import LAYOUT, export_csv, load_table, write_clustered
from promolens.sources.events import narrow_events, unified_events
from promolens.sources.tables import CatalogTables, read_result


@dataclass
class Report:
    """Result frames of one run; all small ones have one row."""

    funnel: DataFrame
    kpis: DataFrame
    headline: DataFrame
    row_flags: DataFrame
    incidence: DataFrame


def combos_of(t: CatalogTables) -> DataFrame:
    return combo_catalog(
        t.promocion,
        t.grupo_condiciones_promocion,
        t.condicion_promocion,
        t.sorteo,
        t.beneficio_promocion,
        t.tipo_beneficio,
        t.tipo_cantidad_promocion,
        t.tipo_criterio_condicion,
        t.categoria_promocion,
    )


def prepare_catalog(t: CatalogTables, cfg: RunConfig) -> Catalog:
    return Catalog(
        products=t.sorteo,
        source_conditions=t.condicion_promocion,
        groups=t.grupo_condiciones_promocion,
        quantity_types=t.tipo_cantidad_promocion,
        source_validity=promo_validity(t.compras, t.detalle_compra),
        combos=combos_of(t),
        max_rows=cfg.broadcast_rows,
    )


def stage_events(
    daily: DataFrame, intraday: DataFrame, cfg: RunConfig, path: str, days: DataFrame | None = None
) -> DataFrame:
    """Write the narrow unified events once, partitioned by event name. Attempts then read 3 of its 9 partitions and
    sessions read only a few narrow columns of it, instead of both scanning the nested export.

    The rebalance keeps files well sized: a frequent event is split over many tasks, and no task writes a small file
    for each of the nine names. ``days`` (column ``ds``) lists the days that have daily rows, for instance from
    partition metadata; without it the daily side is asked."""
    events = narrow_events(unified_events(daily, intraday, cfg, days=days), cfg)
    writer = events.hint("rebalance", "event_name").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("event_name").parquet(path)
    return daily.sparkSession.read.schema(events.schema).parquet(path)


def enriched_table(window: DataFrame, catalog: Catalog, cfg: RunConfig, path: str) -> DataFrame:
    """Enriched attempts, written once: the session totals and the rows themselves read them."""
    rows = enrich_attempts(window, catalog, cfg)
    rows.write.mode("overwrite").parquet(path)
    return window.sparkSession.read.schema(rows.schema).parquet(path)


def write_funnel_checked(priced: DataFrame, path: str) -> dict[str, int | float | None]:
    """Write the priced wide table with its bad rows apart. Returns the integrity counts and the pattern summary, measured
    by the write itself; ``read_every`` gives the whole table back."""
    measures = {**kpis.pattern_counts(), **quality.control_totals()}
    return write_checked(
        priced, path, *LAYOUT["funnel"], quality.row_checks(), measures, quality.ATTEMPT_KEY, "duplicate_attempts"
    )


def analyze(priced: DataFrame, combos: DataFrame) -> Report:
    """KPIs and promotion incidence of a priced funnel table."""
    report = kpis.session_kpis(kpis.session_rollup(priced))
    flags = kpis.promo_row_flags(priced, combos)
    return Report(
        funnel=priced,
        kpis=report,
        headline=kpis.kpi_summary(report),
        row_flags=kpis.row_flag_summary(flags),
        incidence=kpis.promo_incidence(kpis.session_promo_flags(flags)),
    )


def run_full(
    spark: SparkSession,
    daily: DataFrame,
    intraday: DataFrame,
    tables: CatalogTables,
    cfg: RunConfig,
    out: str,
    csv: bool = False,
    days: DataFrame | None = None,
) -> Report:
    """Events and catalogue to the four result tables below ``out``, then the reports.

    Each stage is a written table: it is the deliverable and it cuts the lineage for the next stage. A run replaces what an earlier run left below ``out``.
    """
    apply_recommended(spark)
    out = out.rstrip("/")
    events = stage_events(daily, intraday, cfg, f"{out}/events", days)
    write_clustered(conform(attempts(events, cfg), ATTEMPTS_DDL), f"{out}/attempts", *LAYOUT["attempts"])
    write_clustered(conform(sessions(events, cfg), SESSIONS_DDL), f"{out}/sessions", *LAYOUT["sessions"])

    catalog = prepare_catalog(tables, cfg)
    window = attempts_window(read_result(spark, f"{out}/attempts", ATTEMPTS_DDL), cfg)
    load_table(patterns(enriched_table(window, catalog, cfg, f"{out}/enriched"), catalog), f"{out}/patterns", PATTERNS_DDL)
    found = read_result(spark, f"{out}/patterns", PATTERNS_DDL)
    if csv:
        export_csv(found, f"{out}/patterns_csv")

    wide = funnel(found, read_result(spark, f"{out}/sessions", SESSIONS_DDL), cfg)
    priced = conform(price_inference(wide, tables.sorteo, cfg), FUNNEL_DDL)
    write_clustered(priced, f"{out}/funnel", *LAYOUT["funnel"])
    final = read_result(spark, f"{out}/funnel", FUNNEL_DDL)
    return analyze(final, combo_ids(catalog.requirements_all))


def run_short(
    spark: SparkSession, funnel_table: DataFrame, products: DataFrame, combos: DataFrame, cfg: RunConfig, csv_path: str | None = None
) -> Report:
    """Re-analysis: price an existing funnel table again, export it if asked, and report."""
    apply_recommended(spark)
    # Read by the export and by every report, so it is written once.
    priced = stage(price_inference(funnel_table, products, cfg), "priced")
    if csv_path is not None:
        export_csv(priced, csv_path)
    return analyze(priced, combo_ids(combo_requirements_all(combos)))

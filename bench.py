"""Headline timings on one machine. Prints one JSON line.

``run_*`` entries are the consecutive steps of one full run over a stored nested event export; the others are
self-contained queries, each from the given tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from checks.fixtures import CFG, Fixture
from checks.queries import QUERIES
from promolens.operators.attempts import attempts, attempts_window
from promolens.operators.catalog import combo_ids
from promolens.operators.funnel import funnel, price_inference
from promolens.operators.patterns import patterns
from promolens.operators.sessions import sessions
from promolens.plans.pipeline import analyze, enriched_table, prepare_catalog, stage_events
from promolens.schemas import ATTEMPTS_DDL, FUNNEL_DDL, PATTERNS_DDL, SESSIONS_DDL, conform
from promolens.session import local_session
from promolens.sinks.tables import LAYOUT, load_table, write_clustered
from promolens.sources.tables import read_result

SELF_CONTAINED = ("attempts", "sessions", "combo_catalog", "promo_conditions", "patterns", "funnel", "session_kpis")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    fx = Fixture(spark, sf_dir)
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    daily, intraday = fx.write_events(f"{out}/export")
    times: dict[str, float] = {}

    def timed(name, fn):
        start = time.time()
        result = fn()
        times[name] = round(time.time() - start, 3)
        return result

    def table(name: str, ddl: str):
        return read_result(spark, f"{out}/{name}", ddl)

    events = timed("run_events", lambda: stage_events(daily, intraday, CFG, f"{out}/events"))
    timed(
        "run_attempts",
        lambda: write_clustered(conform(attempts(events, CFG), ATTEMPTS_DDL), f"{out}/attempts", *LAYOUT["attempts"]),
    )
    timed(
        "run_sessions",
        lambda: write_clustered(conform(sessions(events, CFG), SESSIONS_DDL), f"{out}/sessions", *LAYOUT["sessions"]),
    )

    def prepared():
        c = prepare_catalog(fx.catalog, CFG)
        # Frames and size checks are made on first use; touched here, so that their time is the catalogue's.
        for part in ("validity", "conditions", "requirements_all", "requirements", "products_bounded", "rules_bounded"):
            getattr(c, part)
        return c

    catalog = timed("run_catalog", prepared)
    window = attempts_window(table("attempts", ATTEMPTS_DDL), CFG)
    timed(
        "run_patterns",
        lambda: load_table(
            patterns(enriched_table(window, catalog, CFG, f"{out}/enriched"), catalog), f"{out}/patterns", PATTERNS_DDL
        ),
    )

    def wide():
        raw = funnel(table("patterns", PATTERNS_DDL), table("sessions", SESSIONS_DDL), CFG)
        priced = conform(price_inference(raw, fx.sorteo, CFG), FUNNEL_DDL)
        write_clustered(priced, f"{out}/funnel", *LAYOUT["funnel"])

    timed("run_funnel", wide)

    def reports():
        report = analyze(table("funnel", FUNNEL_DDL), combo_ids(catalog.requirements_all))
        for frame in (report.kpis, report.headline, report.row_flags, report.incidence):
            frame.collect()

    timed("run_reports", reports)
    for name in SELF_CONTAINED:
        timed(name, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    rows = table("patterns", PATTERNS_DDL).count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "full_run_seconds": round(sum(v for k, v in times.items() if k.startswith("run_")), 3),
                "pattern_rows": rows,
                "pattern_rows_per_second": round(rows / times["run_patterns"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

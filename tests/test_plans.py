"""Plan shapes, the end-to-end run, and queries against their SQL."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from checks.fixtures import CFG, Fixture
from checks.oracles import ORACLES
from checks.queries import QUERIES, Chain
from promolens.operators import attempts as att
from promolens.operators import sessions as ses
from promolens.operators.funnel import bucket_of_session
from promolens.plans.pipeline import combos_of, prepare_catalog, run_full, run_short
from promolens.schemas import FUNNEL_DDL
from promolens.sources.events import event_days
from promolens.sources.tables import CATALOG_TABLES, read_catalog, read_result


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def run(spark, sf, tmp_path_factory):
    """One full run over a stored export."""
    root = str(tmp_path_factory.mktemp("run"))
    fx = Fixture(spark, sf)
    daily, intraday = fx.write_events(root)
    report = run_full(spark, daily, intraday, fx.catalog, CFG, f"{root}/out", csv=True)
    return fx, root, report


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize(
    "name",
    ["unified_events", "attempt_ids", "attempts", "sessions", "combo_catalog", "promo_conditions", "quantity_rule", "patterns", "patterns_joined", "csv_ingest",
     "rerun_replaces", "price_inference", "validity_checks"],
)
def test_query_matches_sql(spark, sf, name):
    result, _ = compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf)
    assert result.startswith("ok"), result


def test_results_do_not_depend_on_partitioning(spark, sf):
    def rows(parts, shuffle):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        c = Chain(spark, sf)
        events = c.events.repartition(parts) if parts else c.events
        return sorted(map(str, att.attempts(events, CFG).collect())), sorted(map(str, ses.sessions(events, CFG).collect()))

    try:
        assert rows(None, "4") == rows(13, "7")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_full_run_agrees_with_the_queries(spark, sf, run):
    _, root, report = run
    con = connect(sf)
    kpis = report.kpis.select([F.round(c, 2).alias(c) if c.endswith(("checkout", "purchase")) else c for c in report.kpis.columns])
    want = con.execute(ORACLES["session_kpis"])
    names = [d[0] for d in want.description]
    assert kpis.first().asDict() == pytest.approx(dict(zip(names, want.fetchone())))
    want = con.execute(ORACLES["row_flag_summary"])
    assert report.row_flags.first().asDict() == dict(zip([d[0] for d in want.description], want.fetchone()))
    want = con.execute(ORACLES["promo_incidence"]).fetchone()
    assert report.incidence.first()[0] == want[0]
    assert spark.read.option("header", True).csv(f"{root}/out/patterns_csv").count() == spark.read.parquet(f"{root}/out/patterns").count()
    stored = spark.read.parquet(f"{root}/out/funnel")
    assert len(stored.columns) == 58 and stored.select("login_bucket_bc").distinct().count() > 5


def test_a_rerun_replaces_the_earlier_one(spark, sf, tmp_path):
    """A narrower window without one event, into the folder of a wider run, gives what a fresh folder gives."""
    fx = Fixture(spark, sf)
    daily, intraday = fx.write_events(str(tmp_path / "export"))
    narrow = replace(CFG, date_end=dt.date(2024, 1, 10))
    some = [e.where("event_name <> 'sign_up'") for e in (daily, intraday)]
    days = event_days(daily, narrow)
    run_full(spark, daily, intraday, fx.catalog, CFG, str(tmp_path / "used"))
    again = run_full(spark, *some, fx.catalog, narrow, str(tmp_path / "used"), days=days)
    fresh = run_full(spark, *some, fx.catalog, narrow, str(tmp_path / "fresh"))
    assert again.kpis.first().asDict() == pytest.approx(fresh.kpis.first().asDict())
    assert again.kpis.first()["total_sesiones_count"] > 0
    for name in ("events", "attempts", "sessions", "patterns", "funnel"):
        used, new = (spark.read.parquet(str(tmp_path / x / name)) for x in ("used", "fresh"))
        assert used.count() == new.count()


def test_short_run_reproduces_the_full_run(spark, run, tmp_path):
    fx, root, report = run
    table = read_result(spark, f"{root}/out/funnel", FUNNEL_DDL)
    again = run_short(spark, table, fx.sorteo, combos_of(fx.catalog), CFG, str(tmp_path / "csv"))
    assert again.kpis.first().asDict() == pytest.approx(report.kpis.first().asDict())
    assert again.incidence.first() == report.incidence.first()
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == table.count()


def test_catalog_reads_from_folders(spark, run):
    fx, root, _ = run
    for name in CATALOG_TABLES:
        getattr(fx.catalog, name).write.mode("overwrite").parquet(f"{root}/catalog/{name}")
    tables = read_catalog(spark, f"{root}/catalog")
    assert prepare_catalog(tables, CFG).requirements.count() == prepare_catalog(fx.catalog, CFG).requirements.count()


def test_no_python_workers_and_no_cross_joins(spark, sf):
    c = Chain(spark, sf)
    for df in (c.attempts, c.sessions, c.patterns, c.priced, c.flags):
        text = plan(df)
        for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text


def test_copies_collapse_before_the_shuffle(spark, sf):
    c = Chain(spark, sf)
    for df in (att.dedup_items(c.lines), ses.dedup_events(c.events)):
        lines = [x for x in plan(df).split("\n") if "Exchange" in x or "WindowGroupLimit" in x]
        kinds = ["Partial" if "Partial" in x else "Final" if "Final" in x else "Exchange" for x in lines if "REPARTITION" not in x]
        i = kinds.index("Exchange")
        assert kinds[i - 1] == "Final" and kinds[i + 1] == "Partial"


def test_event_steps_share_one_exchange_after_the_item_dedup(spark, sf):
    c = Chain(spark, sf)
    steps = plan(att._rollup(att._local_attempts(att.event_items(c.events, CFG)), CFG))
    hashes = [x for x in steps.split("\n") if "Exchange hashpartitioning" in x]
    # item key, then (user, session, product, slice); the third is the list of daily shards
    assert len(hashes) == 3


def test_bucket_expression_reads_session_columns_only(spark, sf):
    c = Chain(spark, sf)
    assert c.sessions.select(bucket_of_session()).columns == ["login_bucket_bc"]

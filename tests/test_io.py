import datetime as dt

import pytest
from pyspark.sql import functions as F

from promolens.config import RunConfig
from promolens.schemas import EVENT_DDL, FUNNEL_DDL, PATTERNS_DDL, ATTEMPTS_DDL, SESSIONS_DDL, conform, schema_of
from promolens.sinks import tables as sinks
from promolens.sources import events as src
from promolens.sources.dates import standardize_dates
from promolens.sources.tables import read_csv, read_result, unread_values

CFG = RunConfig(date_start=dt.date(2024, 1, 1), date_end=dt.date(2024, 1, 31))


def test_declared_schema_sizes(spark):
    assert [len(schema_of(d)) for d in (ATTEMPTS_DDL, SESSIONS_DDL, PATTERNS_DDL, FUNNEL_DDL)] == [19, 22, 41, 58]


def test_conform(spark):
    df = spark.createDataFrame([(1, None, "x")], "b int, a array<bigint>, extra string")
    out = conform(df, "a array<bigint>, b bigint")
    assert out.dtypes == [("a", "array<bigint>"), ("b", "bigint")] and out.first().a == []
    with pytest.raises(ValueError, match="missing"):
        conform(df, "c bigint")


def shard(ds, name="add_to_cart", key="ga_session_id", platform="WEB"):
    return ("u", name, 1, 1, 1, platform, [(key, (None, 5))], (None,), [], ("m",), ("MX", "NL", "MTY"), ("g", "cpc"), ds)


def test_daily_wins_over_intraday(spark):
    daily = spark.createDataFrame([shard("20240101"), shard("20240103", platform="APP"), shard("2024010x"), shard("20240201")], EVENT_DDL)
    intraday = spark.createDataFrame(
        [shard("20240101"), shard("20240102"), shard("20240103"), shard("20240104", name="scroll"), shard("20240105", key="other")], EVENT_DDL
    )
    got = sorted(r.ds for r in src.unified_events(daily, intraday, CFG).collect())
    # 20240103 has a daily row, if only of another platform, so its intraday rows stay out.
    assert got == ["20240101", "20240102"]
    assert sorted(r.ds for r in src.event_days(daily, CFG).collect()) == ["20240101", "20240103"]
    assert src.days_of(dt.date(2024, 1, 30), dt.date(2024, 2, 1)) == ["20240130", "20240131", "20240201"]


def test_days_from_partition_metadata_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([shard("20240101"), shard("20240102"), shard("20250101")], EVENT_DDL)
    df.write.partitionBy("ds").mode("overwrite").saveAsTable("shards_tmp")
    try:
        got = sorted(r.ds for r in src.event_days_from_catalog(spark, "shards_tmp", CFG).collect())
        assert got == ["20240101", "20240102"]
    finally:
        sinks.delete_tables(spark, ["shards_tmp", "never_there"])
    assert not spark.catalog.tableExists("shards_tmp")
    df.write.partitionBy("ds").parquet(str(tmp_path / "e"))
    scan = src.scan_events(src.read_shards(spark, str(tmp_path / "e"), EVENT_DDL), CFG)
    assert scan.count() == 2
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan
    assert src.read_shards(spark, str(tmp_path / "e")).schema["ds"].dataType.simpleString() == "string"


def dates(spark, *values):
    df = standardize_dates(spark.createDataFrame([(v,) for v in values], "d string"), ["d", "absent"])
    return [None if r[0] is None else str(r[0]) for r in df.collect()]


def test_date_layouts(spark):
    assert dates(spark, "2024-12-01", "2024-01-31", None) == ["2024-12-01 00:00:00", "2024-01-31 00:00:00", None]
    assert dates(spark, "01/12/2024", "31/01/2024") == ["2024-12-01 00:00:00", "2024-01-31 00:00:00"]
    assert dates(spark, "2024-12-01 15:30:45") == ["2024-12-01 15:30:45"]
    assert dates(spark, "11/05/2023 09:45") == ["2023-05-11 09:45:00"]


def test_dates_mixed_bad_and_blank(spark):
    assert dates(spark, "2024-12-01", "12/31/2024", "31/12/2024", "02/03/2024") == [
        "2024-12-01 00:00:00", "2024-12-31 00:00:00", "2024-12-31 00:00:00", "2024-02-03 00:00:00"
    ]
    assert dates(spark, "2024-12-01", "31/02/2024") == ["2024-12-01", "31/02/2024"]
    assert dates(spark, "2024-12-01", "?") == ["2024-12-01", "?"]
    assert dates(spark, "2024-12-01", "NaT") == ["2024-12-01 00:00:00", None]
    assert dates(spark, "2024-12-01", "NaT", "") == ["2024-12-01", "NaT", ""]


def test_csv_ingest_and_export(spark, tmp_path):
    src_path = tmp_path / "in.csv"
    src_path.write_text("id,day,moment,note\n1,01/12/2024,2024-12-01 15:30:45,a\n2,15/01/2024,,b\n", encoding="utf-8")
    ddl = "moment timestamp_ntz, id bigint, day date"
    sinks.load_from_csv(spark, str(src_path), str(tmp_path / "t"), ddl)
    got = read_result(spark, str(tmp_path / "t")).orderBy("id").collect()
    assert [(r.id, str(r.day), str(r.moment)) for r in got] == [(1, "2024-12-01", "2024-12-01 15:30:45"), (2, "2024-01-15", "None")]
    sep = tmp_path / "semi.csv"
    sep.write_text("id;day\n1;2024-02-03\n", encoding="utf-8")
    assert str(read_csv(spark, str(sep), "id bigint, day date", sep=";").first().day) == "2024-02-03 00:00:00"
    sinks.export_csv(spark.createDataFrame([(1, [3, 4]), (2, [])], "id bigint, ids array<bigint>"), str(tmp_path / "csv"))
    text = spark.read.option("header", True).csv(str(tmp_path / "csv")).orderBy("id").collect()
    assert [tuple(r) for r in text] == [("1", "[3, 4]"), ("2", "[]")]


def test_clustered_write_splits_a_hot_value_and_prunes(spark, tmp_path):
    df = spark.range(4000).select(
        F.lit(dt.date(2024, 1, 1)).alias("day"), F.when(F.col("id") < 3900, "hot").otherwise("cold").alias("ITEM"),
        F.col("id").cast("string").alias("USER"),
    )
    path = str(tmp_path / "t")
    # Adaptive execution splits above the advisory size, so a small one stands for a large hot value.
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        sinks.write_clustered(df, path, "day", ("ITEM",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    back = spark.read.parquet(path)
    assert back.count() == 4000
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 3900


def test_load_table_replaces_only_the_partitions_it_brings(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k bigint, day date"

    def rows(*pairs):
        return spark.createDataFrame([(k, dt.date(2024, 1, d)) for k, d in pairs], ddl)

    sinks.load_table(rows((1, 1), (2, 2)), path, ddl, partition="day")
    sinks.load_table(rows((3, 2)), path, ddl, partition="day", only_present=True)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 3]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.load_table(rows((4, 3)), path, ddl, partition="day")
        assert [r.k for r in spark.read.parquet(path).collect()] == [4]
        sinks.write_clustered(rows((5, 4)), path, "day", ("k",))
        assert [r.k for r in spark.read.parquet(path).collect()] == [5]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_csv_values_that_do_not_fit_become_null(spark, tmp_path):
    text = "id,day,moment,x\n12.0,2024/01/05,2024-01-05T10:11:12.500,1e2\n,31/02/2024,2024-01-05 10:11:12,y\nz,05/01/2024,2024-01-05T10:11:12+02:00,2\n7,,2024-01-05T23:30:00-0130,\n"
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    ddl = "id bigint, day date, moment timestamp_ntz, x double"
    sinks.load_from_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "t"), ddl)
    got = [tuple(None if v is None else str(v) for v in r) for r in read_result(spark, str(tmp_path / "t"), ddl).collect()]
    assert got == [
        ("12", "2024-01-05", "2024-01-05 10:11:12.500000", "100.0"), (None, None, "2024-01-05 10:11:12", None),
        (None, "2024-05-01", "2024-01-05 08:11:12", "2.0"), ("7", None, "2024-01-06 01:00:00", None),
    ]
    assert unread_values(spark, str(tmp_path / "in.csv"), ddl).first().asDict() == {"id": 1, "day": 1, "moment": 0, "x": 1}


def test_an_exported_table_loads_back(spark, tmp_path):
    df = spark.sql("select 1L a, date'2024-01-05' d, timestamp_ntz'2024-01-05 10:11:12.5' t, 2.5D x, 'n' s union all select null, null, null, null, null")
    ddl = "a bigint, d date, t timestamp_ntz, x double, s string"
    sinks.export_csv(df, str(tmp_path / "csv"))
    sinks.load_from_csv(spark, str(tmp_path / "csv"), str(tmp_path / "t"), ddl)
    assert sorted(map(str, read_result(spark, str(tmp_path / "t"), ddl).collect())) == sorted(map(str, df.collect()))


def test_bucketed_tables_join_without_a_shuffle(spark):
    keys = ("user_pseudo_id", "session_id")
    df = spark.range(1000).select(F.col("id").cast("string").alias(keys[0]), (F.col("id") % 5).alias(keys[1]), "id")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.save_bucketed(df, "left_b", keys, 4)
        sinks.save_bucketed(df.withColumnRenamed("id", "other"), "right_b", keys, 4)
        joined = spark.table("left_b").join(spark.table("right_b"), list(keys), "left")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        sinks.delete_tables(spark, "left_b")
        sinks.delete_tables(spark, ["right_b"])


def test_mixed_dates_work_each_step_out_once(spark):
    from promolens.sources.dates import mixed_moment

    df = spark.createDataFrame([("2024-01-02T03:04:05+01:30",)], "d string")
    text = df.select(mixed_moment(df.d).alias("m"))._jdf.queryExecution().analyzed().toString()
    assert text.count("trim(") == 1 and text.count("regexp_extract(") == 1 and text.count("regexp_replace(") < 20

"""Interleaved clustering: the same rows, fewer files per filter, bloom filters, no pile-up."""

import duckdb
import pytest
from pyspark.sql import functions as F

from promolens.sinks.interleaved import interleave, rank_of, rank_steps, write_interleaved
from promolens.sinks.tables import write_clustered

CLUSTER = ("item", "status", "bucket")


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("z") / "rows")
    h = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(16))
    spark.range(16_000).select(
        F.lit("2024-01-01").cast("date").alias("day"), *[F.concat(F.lit("v"), F.lpad(h(n).cast("string"), 2, "0")).alias(c) for n, c in enumerate(CLUSTER)],
        F.concat(F.lit("u"), F.col("id")).alias("user"), F.array("id").alias("ids"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def chunks(path):
    return duckdb.sql(f"SELECT * FROM parquet_metadata('{path}/*/*.parquet')").df()


def files_read(path, column, value):
    """Files that statistics cannot exclude."""
    m = chunks(path)
    m = m[m.path_in_schema == column]
    return m[(m.stats_min_value <= value) & (m.stats_max_value >= value)].file_name.nunique(), m.file_name.nunique()


def test_third_column_alone_reads_fewer_files(spark, rows, tmp_path):
    plain, z = str(tmp_path / "plain"), str(tmp_path / "z")
    rows.repartitionByRange(64, *CLUSTER).sortWithinPartitions(*CLUSTER).write.partitionBy("day").parquet(plain)
    write_interleaved(rows, z, "day", CLUSTER, files=64)
    read = {p: {c: files_read(p, c, "v05") for c in CLUSTER} for p in (plain, z)}
    assert read[plain]["bucket"][0] >= 0.9 * read[plain]["bucket"][1]
    assert all(read[z][c][0] <= 0.5 * read[z][c][1] for c in CLUSTER)
    key = lambda df: sorted(df.select(*CLUSTER, "user", F.col("ids").cast("string")).collect())
    assert key(spark.read.parquet(z)) == key(rows)


def test_bloom_filters_only_where_asked(rows, tmp_path):
    z = str(tmp_path / "z")
    write_interleaved(rows, z, "day", CLUSTER, bloom=("user",), files=4, distinct_per_file=5000)
    m = chunks(z)
    made = m[m.bloom_filter_offset.notna()].path_in_schema.unique()
    assert list(made) == ["user"]


def test_ranks_follow_the_share_of_rows(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",)] * 4 + [("c",)] * 4 + [(None,)], "x string")
    steps = rank_steps(df, "x", bits=4)
    assert steps == [("a", 0), ("b", 8), ("c", 12)]
    probe = spark.createDataFrame([(None,), ("A",), ("a",), ("bb",), ("z",)], "x string")
    assert [r[0] for r in probe.select(rank_of("x", steps)).collect()] == [0, 0, 0, 8, 12]
    assert rank_steps(df.where("x IS NULL"), "x") == [] and len(rank_steps(spark.range(1000), "id", bits=4)) == 16
    assert len(rank_steps(spark.range(1000), "id", bits=4, sample=10)) == 10


def test_bits_are_interleaved(spark):
    z = spark.range(1).select(interleave([F.lit(0b101), F.lit(0b010)], bits=3)).first()[0]
    assert z == 0b100110
    with pytest.raises(ValueError, match="bits"):
        interleave([F.lit(0)] * 11, bits=6)


def test_copies_and_empty_tables(spark, rows, tmp_path):
    same = spark.read.parquet(_copies(spark, rows, str(tmp_path / "same")))
    z = str(tmp_path / "z")
    write_interleaved(same, z, "day", CLUSTER, files=8)
    sizes = [r["count"] for r in spark.read.parquet(z).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 8000 and len(sizes) > 1
    write_interleaved(rows.where("false"), str(tmp_path / "none"), "day", CLUSTER)
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "none")).count() == 0
    write_clustered(rows, z, "day", CLUSTER)
    assert spark.read.parquet(z).count() == 16_000


def _copies(spark, rows, path):
    rows.limit(1).crossJoin(spark.range(0, 8000, 1, 8)).drop("id").repartition(8).write.parquet(path)
    return path

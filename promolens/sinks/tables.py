"""Result writers."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.schemas import conform
from promolens.sources.tables import read_csv

log = logging.getLogger(__name__)

# Partition and cluster columns of each result table.
LAYOUT = {
    "attempts": ("attempt_date", ("ITEM", "STATUS")),
    "sessions": ("session_date", ("user_pseudo_id", "session_id")),
    "funnel": ("attempt_date", ("ITEM", "STATUS", "login_bucket_bc")),
}


def write_clustered(df: DataFrame, path: str, partition: str, cluster: tuple[str, ...], mode: str = "overwrite") -> None:
    """Create or replace a table partitioned by date with rows clustered inside each partition.

    Rows are rebalanced on date and first cluster column and sorted, so a file covers few keys and row groups can be
    skipped by statistics. Adaptive execution splits a date or product with a large share of the rows and joins small
    ones, without a sample of the input. An overwrite replaces the whole table, also the partitions that ``df`` lacks,
    whatever the session says about partition overwrites.
    """
    ordered = (partition, *cluster)
    (
        df.hint("rebalance", *ordered[:2])
        .sortWithinPartitions(*ordered)
        .write.partitionBy(partition)
        .mode(mode)
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )


def load_table(
    df: DataFrame, path: str, ddl: str, mode: str = "overwrite", partition: str | None = None, only_present: bool = False
) -> None:
    """Conform to the declared schema and write. An overwrite replaces the whole table; with ``partition`` and
    ``only_present`` it replaces the partitions that occur in ``df`` and leaves the others."""
    writer = conform(df, ddl).write.mode(mode)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.option("partitionOverwriteMode", "dynamic" if only_present else "static").parquet(path)


def load_from_csv(spark: SparkSession, csv_path: str, path: str, ddl: str, **options: str) -> None:
    """CSV to table: standardise dates, conform, write."""
    load_table(read_csv(spark, csv_path, ddl, **options), path, ddl)


def save_bucketed(df: DataFrame, table: str, keys: tuple[str, ...], buckets: int) -> None:
    """Catalogued table bucketed and sorted on ``keys``; two such tables with equal bucket counts join without a
    shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def delete_tables(spark: SparkSession, tables: str | list[str]) -> None:
    """Drop catalogued tables; one that does not exist or cannot be dropped is only logged."""
    for table in [tables] if isinstance(tables, str) else tables:
        try:
            spark.sql(f"DROP TABLE {table}")
            log.info("dropped %s", table)
        except Exception as error:  # noqa: BLE001 - the job goes on
            log.warning("could not drop %s: %s", table, error)


def csv_ready(df: DataFrame) -> DataFrame:
    """CSV has no arrays: id arrays become ``[1, 2]`` text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            text = F.concat(F.lit("["), F.array_join(F.col(f.name).cast("array<string>"), ", "), F.lit("]"))
            out.append(text.alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def export_csv(df: DataFrame, path: str) -> None:
    """Parallel CSV export with a header per file."""
    csv_ready(df).write.mode("overwrite").option("header", True).csv(path)

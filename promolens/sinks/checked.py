"""Writes that measure and sort out rows on the way: no second scan for summaries and checks.

Measures are observed in the last step before the files, behind the last exchange. Spark counts the tasks of that step
once each, however often a lost executor makes it repeat them; before an exchange a repeated task would count twice.

Rows that break a check go to the same write, below a folder of their own, with the names of the checks. Together the two
folders hold every row.

    <path>/quarantined=false/<partition folders>
    <path>/quarantined=true/<partition folders>
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARANTINED, VIOLATIONS = "quarantined", "violations"
_NTH = "_nth"


def write_checked(
    df: DataFrame,
    path: str,
    partition: str,
    cluster: tuple[str, ...],
    checks: dict[str, Column],
    measures: dict[str, Column],
    key: tuple[str, ...] = (),
    repeated: str = "duplicates",
) -> dict[str, int | float | None]:
    """Replace the table at ``path`` and return its measures, the violations of each check among them.

    A check is a condition that a bad row fulfils. With ``key``, all rows of one key but the first (by all columns of
    ``cluster``) break the check ``repeated``; its count is the number of keys that occur more than once. Rows of one key
    meet in one task, which sorts them and may spill, but holds none. A measure is any aggregate without DISTINCT.
    """
    rules = {name: F.coalesce(test, F.lit(False)) for name, test in checks.items()}
    counts = {name: F.count_if(test) for name, test in rules.items()}
    rows = df
    if key:
        order = Window.partitionBy(*key).orderBy(*(cluster or key))
        rows = df.withColumn(_NTH, F.row_number().over(order))
        rules[repeated] = F.col(_NTH) > 1
        counts[repeated] = F.count_if(F.col(_NTH) == 2)
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()])).cast("array<string>")
    told = rows.withColumn(VIOLATIONS, broken).withColumn(QUARANTINED, F.size(VIOLATIONS) > 0)
    ordered = (QUARANTINED, partition, *cluster)
    placed = told.hint("rebalance", *ordered[:3]).sortWithinPartitions(*ordered)
    seen = Observation()
    observed = placed.observe(seen, *[c.alias(n) for n, c in {**measures, **counts}.items()])
    writer = observed.drop(_NTH).write.partitionBy(QUARANTINED, partition).mode("overwrite")
    writer.option("partitionOverwriteMode", "static").parquet(path)
    return dict(seen.get)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    told = [T.StructField(VIOLATIONS, T.ArrayType(T.StringType())), T.StructField(QUARANTINED, T.BooleanType())]
    return spark.read.schema(T.StructType([*schema.fields, *told])).parquet(path)


def read_every(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """All rows of a checked table, in the columns of ``like``."""
    return _read(spark, path, like.schema).select(*[f"`{c}`" for c in like.columns])


def read_clean(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that break no check; the folder of the others is not read."""
    return _read(spark, path, like.schema).where(~F.col(QUARANTINED)).select(*[f"`{c}`" for c in like.columns])


def read_quarantine(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that break a check, with the names of the checks in ``violations``."""
    return _read(spark, path, like.schema).where(F.col(QUARANTINED)).drop(QUARANTINED)

"""Tables clustered by several columns at once.

A lexicographic sort gathers the values of its first column only; a filter on the third touches every file. Here each
column's values are replaced by their rank among the rows, and the bits of the ranks are interleaved (Z-order), so a file
holds a small range of every column. Identifiers that no order serves get Parquet bloom filters.

Ranks come from at most ``SAMPLE`` different values per column, those with the smallest hashes, with their row counts.
They decide where a row is stored, never whether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
SAMPLE = 4096


def rank_steps(df: DataFrame, column: str, bits: int = BITS, sample: int = SAMPLE) -> list[tuple[object, int]]:
    """At most ``2**bits`` steps (least value, rank), both rising. A value's rank is the share of rows below it.

    One aggregation, combined before its shuffle; ``sample`` pairs reach the driver. NULLs have no step.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    rows = sorted(counts.orderBy(F.xxhash64("value"), "value").limit(sample).collect(), key=lambda r: r["value"])
    total, below, steps = sum(r["n"] for r in rows), 0, []
    for r in rows:
        rank = (below << bits) // total
        if not steps or steps[-1][1] < rank:
            steps.append((r["value"], rank))
        below += r["n"]
    return steps


def rank_of(column: str, steps: list[tuple[object, int]]) -> Column:
    """The rank of the last step at or below the value; 0 below the first one and for NULL."""
    if not steps:
        return F.lit(0)
    least, ranks = F.array(*[F.lit(v) for v, _ in steps]), F.array(*[F.lit(r) for _, r in steps])
    reached = F.size(F.filter(least, lambda v: v <= F.col(column)))
    return F.when(reached > 0, F.element_at(ranks, reached)).otherwise(F.lit(0))


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """One number of the bits of all ranks, the highest bit of the first rank first. ``len(ranks) * bits`` is at most 62."""
    if len(ranks) * bits > 62:
        raise ValueError("too many bits for one number")
    z, place = F.lit(0).cast("bigint"), len(ranks) * bits
    for bit in reversed(range(bits)):
        for rank in ranks:
            place -= 1
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, place))
    return z


def write_interleaved(
    df: DataFrame,
    path: str,
    partition: str,
    cluster: tuple[str, ...],
    bloom: tuple[str, ...] = (),
    files: int | None = None,
    bits: int = BITS,
    distinct_per_file: int = 100_000,
) -> None:
    """Create or replace a table partitioned by date whose files hold small ranges of every column of ``cluster``.

    ``df`` is read once per cluster column, once for the bounds of the ranges and once for the write, so it should be a
    stored table. Rows move once, in ranges of (date, Z value, hash); the hash takes in the place a row is read at, so
    neither a value with a large share of the rows nor a group of copies stays in one task. Without ``files`` adaptive
    execution sizes the ranges. ``bloom`` names columns looked up by value, ``distinct_per_file`` what one file may hold.
    """
    z = interleave([rank_of(c, rank_steps(df, c, bits)) for c in cluster], bits)
    simple = [f"`{f.name}`" for f in df.schema.fields if f.dataType.simpleString() in ("string", "bigint", "timestamp_ntz", "date")]
    placed = df.withColumns({"_z": z, "_spread": F.xxhash64(F.spark_partition_id(), *simple)})
    order = (partition, "_z", "_spread")
    ranged = placed.repartitionByRange(*order) if files is None else placed.repartitionByRange(files, *order)
    writer = ranged.sortWithinPartitions(partition, "_z", *cluster).drop("_z", "_spread").write.partitionBy(partition)
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct_per_file))
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

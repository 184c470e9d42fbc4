"""CSV loads that keep what they cannot read.

The text is parsed once and kept as it was, in a stored copy. The typed table and the rejected rows both come from that
copy: a value that cannot be read is NULL in the table, as ``read_csv`` gives it, and its row is listed with the file, the
names of the unread columns and the raw values. A line with too few or too many fields is listed with its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.schemas import conform, schema_of
from promolens.session import stage
from promolens.sources.dates import standardize_dates
from promolens.sources.tables import lenient

LINE, FILE = "_rescued_line", "_rescued_file"
FIELDS = "fields"
REJECTS_DDL = "file string, reasons array<string>, line string, raw map<string,string>"


def parse_once(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All columns as text, with the file of each row and the line where its number of fields differs from the header's.
    Only the header is read before the parse itself."""
    header = spark.read.options(header=True, inferSchema=False, **options).csv(path).columns
    fields = [T.StructField(c, T.StringType()) for c in [*header, LINE]]
    raw = spark.read.schema(T.StructType(fields)).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, **options).csv(path)
    return stage(raw.withColumn(FILE, F.col("_metadata.file_name")), "rescued")


def load_csv_rescued(spark: SparkSession, csv_path: str, path: str, ddl: str, rejects: str, **options: str) -> dict[str, int]:
    """CSV to the table ``path``, as ``load_from_csv`` writes it, and its rejected rows to ``rejects`` (``REJECTS_DDL``).

    Returns, as counted while writing: ``rows``, ``fields`` (lines with another number of fields) and, per column, the
    values that became NULL. Both tables are replaced. An empty value is not a rejected one; a text that stands for a
    missing date is.
    """
    text = parse_once(spark, csv_path, **options)
    names = [f.name for f in schema_of(ddl).fields if f.name in text.columns]
    types = {f.name: f.dataType for f in schema_of(ddl).fields}
    raw = {n: f"_raw_{i}" for i, n in enumerate(names)}
    kept = text.withColumns({raw[n]: F.col(f"`{n}`") for n in names})
    dated = standardize_dates(kept, [n for n in names if isinstance(types[n], (T.DateType, T.TimestampNTZType))])
    typed = dated.withColumns({n: lenient(n, types[n], dated.schema[n].dataType) for n in names})
    unread = {n: F.col(raw[n]).isNotNull() & F.col(f"`{n}`").isNull() for n in names}
    seen = Observation()
    counts = [F.count("*").alias("rows"), F.count(LINE).alias(FIELDS), *[F.count_if(unread[n]).alias(n) for n in names if n not in ("rows", FIELDS)]]
    observed = typed.observe(seen, *counts)
    conform(observed, ddl).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    reasons = F.array_compact(F.array(F.when(F.col(LINE).isNotNull(), F.lit(FIELDS)), *[F.when(unread[n], F.lit(n)) for n in names]))
    values = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(raw[n]) for n in names]))
    bad = typed.select(F.col(FILE).alias("file"), reasons.alias("reasons"), F.col(LINE).alias("line"), values.alias("raw"))
    bad.where(F.size("reasons") > 0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(rejects)
    return dict(seen.get)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows of a load."""
    return spark.read.schema(REJECTS_DDL).parquet(path)

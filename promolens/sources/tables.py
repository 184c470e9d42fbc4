"""Catalogue and result readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.schemas import schema_of
from promolens.sources.dates import mixed_moment, standardize_dates

# Names of the catalogue tables.
CATALOG_TABLES = (
    "sorteo",
    "promocion",
    "grupo_condiciones_promocion",
    "condicion_promocion",
    "tipo_cantidad_promocion",
    "tipo_criterio_condicion",
    "beneficio_promocion",
    "tipo_beneficio",
    "categoria_promocion",
    "compras",
    "detalle_compra",
)


@dataclass
class CatalogTables:
    """Raw catalogue frames under their table names."""

    sorteo: DataFrame
    promocion: DataFrame
    grupo_condiciones_promocion: DataFrame
    condicion_promocion: DataFrame
    tipo_cantidad_promocion: DataFrame
    tipo_criterio_condicion: DataFrame
    beneficio_promocion: DataFrame
    tipo_beneficio: DataFrame
    categoria_promocion: DataFrame
    compras: DataFrame
    detalle_compra: DataFrame


def read_catalog(spark: SparkSession, root: str) -> CatalogTables:
    """Catalogue tables stored as parquet folders below ``root``."""
    return CatalogTables(**{t: spark.read.parquet(f"{root.rstrip('/')}/{t}") for t in CATALOG_TABLES})


def catalog_from_tables(spark: SparkSession, database: str) -> CatalogTables:
    """The same from catalogued tables of one database."""
    return CatalogTables(**{t: spark.table(f"{database}.{t}") for t in CATALOG_TABLES})


def read_result(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """A result table written earlier."""
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


def lenient(name: str, kind: T.DataType, source: T.DataType) -> Column:
    """A text column as ``kind``; what cannot be read is NULL. Whole numbers may be written as ``12.0``."""
    value = F.col(f"`{name}`")
    if not isinstance(source, T.StringType) or isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return mixed_moment(value).cast(kind)
    if isinstance(kind, T.IntegralType):
        return F.coalesce(value.try_cast(kind), value.try_cast("decimal(38,6)").try_cast(kind))
    return value.try_cast(kind)


def read_csv(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """CSV with header. DATE and DATETIME columns of the target schema are standardised by column; where no layout reads
    the whole column, value by value. Everything is read as text first, so no inference pass is needed, and values that
    cannot be read become NULL; ``unread_values`` counts them. Columns outside the schema stay text."""
    raw = spark.read.options(header=True, inferSchema=False, **options).csv(path)
    fields = {f.name: f.dataType for f in schema_of(ddl).fields}
    dates = [n for n, t in fields.items() if isinstance(t, (T.DateType, T.TimestampNTZType))]
    dated = standardize_dates(raw, dates)
    typed = {n: lenient(n, t, dated.schema[n].dataType) for n, t in fields.items() if n in dated.columns}
    return dated.withColumns(typed) if typed else dated


def unread_values(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """One row: per column of the target schema, how many non-empty values of the CSV become NULL when it is read."""
    raw = spark.read.options(header=True, inferSchema=False, **options).csv(path)
    fields = [f for f in schema_of(ddl).fields if f.name in raw.columns]
    lost = [F.count_if(F.col(f.name).isNotNull() & lenient(f.name, f.dataType, T.StringType()).isNull()).alias(f.name) for f in fields]
    return raw.agg(*lost)

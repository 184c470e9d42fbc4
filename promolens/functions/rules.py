"""Promotion rules as column expressions. They work on plain columns and on lambda variables alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_bounds(kind: Column, n: Column, m: Column) -> Column:
    """A condition of type ``kind`` (1 exact, 2 at least, 3 at most, 4 between, 5 accumulate, 6 for each, 7 multiple) as
    ``struct<lo, hi, step>``: a non-zero quantity meets it when ``lo <= qty <= hi`` and ``qty`` is a multiple of
    ``step``. Worked out once per condition, so that the test on each row is three cheap comparisons without NULLs. A
    condition that nothing meets, like one of another type or without ``n``, gets an empty interval."""
    least, most = F.lit(-(2**63)).cast("bigint"), F.lit(2**63 - 1).cast("bigint")
    upper = F.when(m.isNull() | (m == 0), n).otherwise(m)
    lo = F.when(kind.isin(1, 2, 4, 5, 6), n).when(kind.isin(3, 7), least)
    hi = F.when(kind.isin(1, 3), n).when(kind == 4, upper).when(kind.isin(2, 5, 6, 7), most)
    dead = lo.isNull() | hi.isNull() | n.isNull() | ((kind == 6) & (n == 0)) | ((kind == 7) & (n <= 0))
    usable = F.coalesce(~dead, F.lit(False))
    return F.struct(
        F.when(usable, lo).otherwise(1).cast("bigint").alias("lo"),
        F.when(usable, hi).otherwise(0).cast("bigint").alias("hi"),
        F.when(usable & kind.isin(6, 7), F.abs(n)).otherwise(1).cast("bigint").alias("step"),
    )


def meets(qty: Column, lo: Column, hi: Column, step: Column) -> Column:
    """The row test for ``rule_bounds``; FALSE for a missing or zero quantity."""
    return F.coalesce((qty != 0) & (qty >= lo) & (qty <= hi) & (qty % step == 0), F.lit(False))


def one_short(qty: Column, short: Column) -> Column:
    """Exactly one unit short: ``short`` is the asked quantity less one."""
    return F.coalesce((qty > 0) & (qty == short), F.lit(False))


def active(at: Column, start: Column, end: Column) -> Column:
    """Inside the validity window, both ends included; FALSE when either end is unknown."""
    return F.coalesce((start <= at) & (at <= end), F.lit(False))


def quantity_text(kind: Column, n: Column, m: Column) -> Column:
    """Readable form of a quantity condition."""
    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("<NA>"))

    # One phrase per condition type.
    return (
        F.when(kind == 1, F.concat(F.lit("Exactamente "), shown(n), F.lit(" unidades")))
        .when(kind == 2, F.concat(F.lit("Mínimo "), shown(n), F.lit(" unidades")))
        .when(kind == 3, F.concat(F.lit("Máximo "), shown(n), F.lit(" unidades")))
        .when(kind == 4, F.concat(F.lit("Entre "), shown(n), F.lit(" y "), shown(m), F.lit(" unidades")))
        .when(kind == 5, F.concat(F.lit("Acumula "), shown(n), F.lit(" unidades")))
        .when(kind == 6, F.concat(F.lit("Por cada "), shown(n), F.lit(" unidades")))
        .when(kind == 7, F.concat(F.lit("Múltiplo de "), shown(n)))
        .otherwise(F.concat(F.lit("Tipo "), shown(kind), F.lit(": "), shown(n)))
    )

"""Time expressions. All wall-clock values are TIMESTAMP_NTZ, so no result depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.config import TEXT_TIME_FORMAT

_EPOCH = "1970-01-01 00:00:00"


def utc_wall(micros: Column) -> Column:
    """UTC wall clock of a microsecond epoch."""
    return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH).cast("timestamp_ntz"))


def local_wall(micros: Column, tz: str) -> Column:
    """Wall clock of a microsecond epoch in ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall(micros))


def time_text(wall: Column) -> Column:
    """``dd/mm/yyyy hh:mm:ss`` text."""
    return F.date_format(wall, TEXT_TIME_FORMAT)


def parse_time_text(text: Column) -> Column:
    """Wall clock of ``dd/mm/yyyy hh:mm:ss[.ffffff]`` text; NULL for anything else."""
    layout = r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)$"
    iso = F.regexp_replace(text, layout, "$3-$2-$1 $4")
    return F.when(text.rlike(layout), iso.try_cast("timestamp_ntz"))


def whole_seconds(wall: Column) -> Column:
    """The wall clock cut to its second, as its text has it."""
    zero = F.lit(0)
    return wall - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECOND"), wall) % 1)


def minute_of(wall: Column) -> Column:
    """The wall clock cut to its minute."""
    return F.date_trunc("minute", wall).cast("timestamp_ntz")


def utc_wall_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as UTC wall clock, whether it is stored as an instant or already zone-less."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return utc_wall(F.unix_micros(F.col(name)))
    if isinstance(kind, T.StringType):
        return F.col(name).try_cast("timestamp_ntz")
    return F.col(name).cast("timestamp_ntz")


def days_between_dates(later_utc: Column, earlier_local: Column) -> Column:
    """Whole days from the local event date to the UTC draw date (each date in its own zone)."""
    return F.datediff(F.to_date(later_utc), F.to_date(earlier_local)).cast("double")

"""Date columns stored as text: find the layout of a whole column, then parse it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted layouts in order of preference. Slash dates are day first.
LAYOUTS = (
    r"^\d{4}-\d{1,2}-\d{1,2}$",
    r"^\d{1,2}/\d{1,2}/\d{4}$",
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$",
)
# Text that stands for a missing date.
NULL_TEXT = ("", "NaT", "nat", "NaN", "nan", "NULL", "null", "None", "N/A", "NA", "<NA>")

_SLASH = r"^(\d{1,2})/(\d{1,2})/(\d{4})(| .*)$"
_CLOCK = r"\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?"
_ANY = rf"^(?:\d{{4}}-\d{{1,2}}-\d{{1,2}}|\d{{1,2}}/\d{{1,2}}/\d{{4}})(?: {_CLOCK})?$"
_OFFSET = r"(?<=\d)\s*(Z|[+-]\d{2}:?\d{2})$"


def _wall(text: Column, slash_order: str) -> Column:
    """Wall clock of an ISO or slash date. The text is turned into ISO form and cast, so the session time zone plays
    no part; impossible dates are NULL."""
    iso = F.regexp_replace(text, _SLASH, slash_order)
    timed = F.regexp_replace(iso, r"^(\S+ \d{1,2}:\d{1,2})$", "$1:00")
    short = F.regexp_replace(timed, r"(\.\d{6})\d+$", "$1")
    return F.when(text.rlike(_ANY), short.try_cast("timestamp_ntz"))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, however often ``then`` names it."""
    return F.transform(F.array(value), then)[0]


def _day_first(text: Column) -> Column:
    return _wall(text, "$3-$2-$1$4")


def _mixed(text: Column) -> Column:
    """Value by value; an ambiguous slash date is month first."""
    return F.coalesce(_wall(text, "$3-$1-$2$4"), _day_first(text))


def mixed_moment(text: Column) -> Column:
    """Value by value, with further ISO forms: ``T`` before the time, year-first slashes, fractions of a second, and an
    offset, which makes the value a UTC wall clock. NULL for anything else."""
    return _once(F.trim(text), _plain_moment)


def _plain_moment(plain: Column) -> Column:
    zone = F.when(plain.contains(":"), F.regexp_extract(plain, _OFFSET, 1)).otherwise(F.lit(""))
    return _once(zone, lambda z: _once(_bare(plain, z), lambda bare: _once(_mixed(bare), lambda wall: _utc(wall, z))))


def _bare(plain: Column, zone: Column) -> Column:
    """The text in ISO form, without its offset."""
    bare = F.when(zone != "", F.regexp_replace(plain, _OFFSET, "")).otherwise(plain)
    bare = F.regexp_replace(bare, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    return F.regexp_replace(bare, r"^(\d{4}-\d{1,2}-\d{1,2})T", "$1 ")


def _utc(wall: Column, zone: Column) -> Column:
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.coalesce(F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    zero = F.lit(0)
    return F.when(zone == "", wall).otherwise(wall - F.make_dt_interval(zero, zero, sign * minutes, zero.cast("decimal(18,6)")))


def date_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One aggregate row: per column, how many values each layout leaves unread, and how many are null-like text."""
    facts = []
    for i, c in enumerate(columns):
        text = F.col(c)
        layout = F.lit(None)
        for j in reversed(range(len(LAYOUTS))):
            layout = F.when(text.rlike(LAYOUTS[j]), F.lit(j)).otherwise(layout)
        facts += [
            F.when(_day_first(text).isNotNull(), layout).alias(f"layout{i}"),
            text.isin(*NULL_TEXT).alias(f"blank{i}"),
        ]
    out = []
    for i in range(len(columns)):
        present = F.col(f"blank{i}") == F.lit(False)
        out.append(F.count_if(F.col(f"blank{i}")).alias(f"blank{i}"))
        for j in range(len(LAYOUTS)):
            out.append(F.count_if(present & ~F.col(f"layout{i}").eqNullSafe(j)).alias(f"unread{i}_{j}"))
    return df.select(*facts).agg(*out)


def mixed_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One aggregate row: per column, how many values but null-like text the mixed reading leaves unread."""
    unread = [(~F.col(c).isin(*NULL_TEXT) & mixed_moment(F.col(c)).isNull()).alias(c) for c in columns]
    return df.select(*unread).agg(*[F.count_if(F.col(c)).alias(c) for c in columns])


def standardize_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse each text date column with the first layout that reads every value (then value by value).

    At most one null-like text value is tolerated, as it turns into a new NULL. A column that no layout reads stays
    as it is, and so do columns that are absent or already dates. One profiling pass over the data, and a second over the
    columns that no layout reads; a single row of each reaches the driver.
    """
    types = dict(df.dtypes)
    texts = [c for c in columns if types.get(c) == "string"]
    if not texts:
        return df
    found = date_profile(df, texts).first()
    out, rest = {}, []
    for i, c in enumerate(texts):
        if found[f"blank{i}"] > 1:
            continue
        if any(found[f"unread{i}_{j}"] == 0 for j in range(len(LAYOUTS))):
            out[c] = _day_first(F.col(c))
        else:
            rest.append(c)
    if rest:
        unread = mixed_profile(df, rest).first()
        out.update({c: mixed_moment(F.col(c)) for i, c in enumerate(rest) if unread[i] == 0})
    return df.withColumns(out) if out else df

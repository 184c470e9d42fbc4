"""Product-name cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_to_end(text: Column) -> Column:
    """``12° Name`` -> ``Name 12``; text without a leading number is unchanged."""
    return F.regexp_replace(text, r"(?U)^(\d+)\s*°?\s*(.*?)\s*$", "$2 $1")


def rewrite_name(text: Column, rewrites: tuple[tuple[str, str], ...]) -> Column:
    """First matching rule wins: a prefix followed by digits, else any occurrence of the key."""
    out = None
    for key, new in rewrites:
        quoted, literal = re.escape(key), new.replace("\\", r"\\").replace("$", r"\$")
        at_start = text.rlike(rf"(?U)^{quoted}\s*\d+")
        head = F.regexp_replace(text, rf"^{quoted}", literal)
        anywhere = F.replace(text, F.lit(key), F.lit(new))
        out = F.when(at_start, head) if out is None else out.when(at_start, head)
        out = out.when(text.contains(key), anywhere)
    return text if out is None else out.otherwise(text)


def drop_repeated_number(text: Column) -> Column:
    """``Name 7 7`` -> ``Name 7``."""
    return F.regexp_replace(text, r"(?U)(\b\d+)\s+\1$", "$1")


def clean_item(text: Column, rewrites: tuple[tuple[str, str], ...]) -> Column:
    """The three steps above, in order."""
    return drop_repeated_number(rewrite_name(number_to_end(text), rewrites))


def override_item(text: Column, overrides: tuple[tuple[str, str], ...]) -> Column:
    """Exact-name replacements."""
    out = text
    for old, new in overrides:
        out = F.when(text == old, F.lit(new)).otherwise(out)
    return out


def catalog_name(description: Column, number: Column) -> Column:
    """Catalogue display name: description and number, 0 when the number is missing."""
    return F.concat(description, F.lit(" "), F.coalesce(number.cast("bigint"), F.lit(0)).cast("string"))

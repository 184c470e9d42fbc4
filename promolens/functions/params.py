"""Access to key/value parameter arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_param(key: str, params: str = "event_params") -> Column:
    """True where the array holds an entry for ``key``."""
    return F.coalesce(F.exists(params, lambda p: p["key"] == key), F.lit(False))


def param_value(key: str, field: str, params: str = "event_params") -> Column:
    """``field`` of the first entry for ``key``; NULL when there is none."""
    return F.get(F.filter(params, lambda p: p["key"] == key), 0)["value"][field]

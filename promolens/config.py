"""Settings of one analysis run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Event names, labels, text rewrites and separators that results must carry verbatim.
ATTEMPT_EVENTS = ("add_to_cart", "begin_checkout", "purchase")
SESSION_EVENTS = (
    "login",
    "logout",
    "view_item_list",
    "select_item",
    "add_to_cart",
    "remove_from_cart",
    "begin_checkout",
    "purchase",
    "sign_up",
)
FUNNEL_STEPS = ("view_item_list", "select_item", "add_to_cart", "begin_checkout")
MARKERS = (
    "login",
    "logout",
    "view_item_list",
    "select_item",
    "add_to_cart",
    "begin_checkout",
    "purchase",
    "sign_up",
)
DIMENSIONS = (
    "device_category",
    "geo_country",
    "geo_region",
    "geo_city",
    "traffic_source",
    "traffic_medium",
)
NO_ITEM = "__NO_ITEM__"
NO_LOGIN = "SIN LOGIN EN SESIÓN"
NAME_REWRITES = (("LQ", "Sorteo Lo Quiero"), ("Sorteo Efectivo", "Efectivo"))
ITEM_OVERRIDES = (("Gana Ya", "Gana Ya 5"),)
TEXT_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
DESC_SEPARATOR = " | "


@dataclass(frozen=True)
class RunConfig:
    """One run: date window, time zone, source filters and size bounds.

    ``chunk_minutes`` is the width of the time slices that split a long or hot group; results do not depend on
    it. ``broadcast_rows`` is the row bound below which a lookup side may be broadcast; ``calendar_rows`` is the one
    for minute counts (two numbers per row), whose size follows from the date window.
    """

    date_start: dt.date | None = None
    date_end: dt.date | None = None
    timezone: str = "America/Mexico_City"
    platform: str = "WEB"
    session_param: str = "ga_session_id"
    name_rewrites: tuple[tuple[str, str], ...] = NAME_REWRITES
    item_overrides: tuple[tuple[str, str], ...] = ITEM_OVERRIDES
    chunk_minutes: int = 60
    broadcast_rows: int = 200_000
    calendar_rows: int = 1_000_000

    @property
    def window_days(self) -> int | None:
        if self.date_start is None or self.date_end is None:
            return None
        return (self.date_end - self.date_start).days + 1

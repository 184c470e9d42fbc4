"""Login-timing labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.config import NO_LOGIN


def login_vs_step(login: Column, step: Column) -> Column:
    """Login time against the time of one funnel step."""
    return (
        F.when(login.isNull(), "SIN LOGIN")
        .when(step.isNull(), "SIN EVENTO")
        .when(login < step, "ANTES")
        .when(login > step, "DESPUÉS")
        .otherwise("EMPATE")
    )


def ordered_steps(times: dict[str, Column]) -> Column:
    """Present steps as ``array<struct<t, step>>`` sorted by (time, name)."""
    entries = [F.struct(t.alias("t"), F.lit(name).alias("step")) for name, t in times.items()]
    return F.array_sort(F.filter(F.array(*entries), lambda s: s["t"].isNotNull()))


def login_category(login: Column, steps: Column) -> Column:
    """Place of the login among the ordered steps. ``k`` counts the steps at or before the login."""
    n = F.size(steps)
    k = F.size(F.filter(steps, lambda s: s["t"] <= login))
    before, after = F.get(steps, k - 1)["step"], F.get(steps, k)["step"]
    return (
        F.when(login.isNull(), NO_LOGIN)
        .when(n == 0, "CON LOGIN SIN EVENTOS DE FUNNEL")
        .when(k == 0, F.concat(F.lit("LOGIN ANTES DE "), after))
        .when(k == n, F.concat(F.lit("LOGIN DESPUÉS DE "), before))
        .otherwise(F.concat(F.lit("LOGIN ENTRE "), before, F.lit(" Y "), after))
    )


def login_bucket(
    has_purchase: Column,
    login: Column,
    logout: Column,
    view_list: Column,
    select: Column,
    cart: Column,
    checkout: Column,
    purchase: Column,
) -> Column:
    """Coarse login bucket; the first true branch wins and NULL comparisons fall through."""
    late_logout = logout.isNotNull() & purchase.isNotNull() & (logout > purchase)
    nothing = F.coalesce(view_list, select, cart, checkout, purchase).isNull()
    return (
        F.when(has_purchase & login.isNull() & late_logout, "LOGIN YA INICIADO")
        .when(has_purchase & login.isNull(), "PROBABLE LOGIN YA INICIADO")
        .when(~has_purchase & login.isNull() & logout.isNotNull(), "LOGIN INICIADO SIN COMPRA")
        .when(login.isNull(), NO_LOGIN)
        .when(login > checkout, "LOGIN DESPUÉS DE BEGIN_CHECKOUT")
        .when(login < checkout, "LOGIN ANTES DE BEGIN_CHECKOUT")
        .when(login < cart, "LOGIN ANTES DE ADD_TO_CART")
        .when(login < select, "LOGIN TEMPRANO - ANTES DE SELECT_ITEM")
        .when(login < view_list, "LOGIN TEMPRANO - ANTES DE VIEW_ITEM_LIST")
        .when(nothing, "CON LOGIN SIN EVENTOS DE FUNNEL")
        .otherwise("OTROS")
    )

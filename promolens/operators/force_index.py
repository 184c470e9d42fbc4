"""Promotion detection with rules found by the days on which they are in force.

Two kinds of tests need different rules. Complete promotions, near misses and owned combined promotions ask for force:
the days of a rule's validity are cut into blocks of fixed lengths (a rule of years is a few long blocks and some short
ones at its ends), and a row looks up the one block of each length that its day lies in. So the interval join is a few
equi-joins, and a row only tests the rules that are in force on its day. Conditions that are met whether in force or not
depend on product and quantity alone: they are worked out once for each pair that occurs, not once per row.

Results equal those of ``patterns``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.catalog import Catalog
from promolens.operators.lookup import fits, lookup_join, widest
from promolens.operators.patterns import (
    AT,
    RAW_ITEM,
    STAGES,
    combined_rules,
    combo_session_complete,
    in_force,
    met,
    near,
    owned,
    pattern_table,
    simple_rules,
    timed_rows,
    with_sessions,
)
from promolens.session import stage

#: Block lengths in days. Each divides the next one, so that whole blocks nest.
LENGTHS = (1, 16, 256, 4096)
PRODUCT = "clave_edicion_producto"
_WHERE = [PRODUCT, "_level", "_block"]
_EMPTY = "array<bigint>"


def day_number(moment: Column) -> Column:
    return F.unix_date(moment.cast("date")).cast("bigint")


def block_of(day: Column, length: int) -> Column:
    return F.floor(day / length)


def day_blocks(first: Column, last: Column) -> Column:
    """The days ``first`` to ``last`` as ``array<struct<level, block>>`` without overlap: of each length the whole blocks
    that no longer whole block covers. At most 2 * 15 blocks per length but the longest; none if ``last`` lies before
    ``first``."""
    none = F.array().cast(_EMPTY)

    def span(a: Column, b: Column) -> Column:
        return F.when(a < b, F.sequence(a, b - 1)).otherwise(none)

    whole = [(F.ceil(first / n), F.floor((last + 1) / n)) for n in LENGTHS]
    parts = []
    for level, (a, b) in enumerate(whole):
        blocks = span(a, b)
        if level + 1 < len(LENGTHS):
            ratio = LENGTHS[level + 1] // LENGTHS[level]
            up_a, up_b = (x * ratio for x in whole[level + 1])
            split = F.concat(span(a, up_a), span(up_b, b))
            blocks = F.when(up_a < up_b, split).otherwise(blocks)
        parts.append(_at_level(blocks, level))
    return F.concat(*parts)


def _at_level(blocks: Column, level: int) -> Column:
    return F.transform(blocks, lambda x: F.struct(F.lit(level).alias("_level"), x.alias("_block")))


def by_day(rules: DataFrame) -> DataFrame:
    """Rules repeated for the day blocks of their validity; a rule that is never in force has none."""
    known = rules.where("start <= end")
    blocks = day_blocks(day_number(F.col("start")), day_number(F.col("end")))
    return known.select("*", F.explode(blocks).alias("_b")).select(*rules.columns, "_b._level", "_b._block")


def day_rules(catalog: Catalog) -> DataFrame:
    """Simple conditions and combined requirements in one frame, by the blocks in which they are in force."""
    simple = simple_rules(catalog).withColumns({"combined": F.lit(False), "need": F.lit(None).cast("bigint")})
    none = {c: F.lit(None).cast(t) for c, t in (("lo", "bigint"), ("hi", "bigint"), ("step", "bigint"), ("short", "bigint"), ("text", "string"))}
    combined = combined_rules(catalog).withColumns({"combined": F.lit(True), **none})
    return by_day(simple.unionByName(combined))


def _hits(c, qty: Column) -> tuple[Column, Column, Column]:
    """Whether a rule in force is met, one unit short of, or owned; a rule is either simple or combined."""
    simple = ~c["combined"]
    return simple & in_force(c) & met(c, qty), simple & near(c, qty), c["combined"] & owned(c, qty)


def _found(qty: Column, kind: int) -> Column:
    return F.filter("_candidates", lambda c: _hits(c, qty)[kind])


def _packed(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Arrays of rules come to the rows, one broadcast per block length. No row is multiplied or moved."""
    fields = [c for c in index.columns if c not in _WHERE]
    arrays = index.groupBy(*_WHERE).agg(F.collect_list(F.struct(*fields)).alias("_rules"))
    out, names = rows, []
    for level, length in enumerate(LENGTHS):
        names.append(f"_rules{level}")
        mine = arrays.where(F.col("_level") == level).select(PRODUCT, F.col("_block").alias("_day_block"), F.col("_rules").alias(names[-1]))
        placed = out.withColumn("_day_block", block_of(day_number(F.col(AT)), length))
        out = placed.join(F.broadcast(mine), [PRODUCT, "_day_block"], "left").drop("_day_block")
    none = F.array().cast(arrays.schema["_rules"].dataType)
    out = out.withColumn("_candidates", F.concat(*[F.coalesce(n, none) for n in names])).drop(*names)
    cols = {}
    for name, _, stage_name, _ in STAGES:
        live, close, own = (_found(F.col(name), k) for k in range(3))
        cols[f"_live_{stage_name}"] = F.transform(live, lambda c: F.struct(c["promo"].alias("promo"), c["text"].alias("text")))
        cols[f"_near_{stage_name}"] = F.transform(close, lambda c: c["promo"])
        cols[f"_own_{stage_name}"] = F.transform(own, lambda c: c["promo"])
    return out.withColumns(cols).drop("_candidates")


def _joined(rows: DataFrame, index: DataFrame, stored: DataFrame) -> DataFrame:
    """The same for a catalogue of any size: each row meets its blocks in a salted join, and its hits come back by the key
    of the row."""
    keys = ["USER", "SESION", "ITEM", "INTENTO", *[c for c in (RAW_ITEM,) if c in rows.columns], PRODUCT]
    day = day_number(F.col(AT))
    places = F.array(*[F.struct(F.lit(i).alias("_level"), block_of(day, n).alias("_block")) for i, n in enumerate(LENGTHS)])
    timed = F.col(AT).isNotNull()
    narrow = rows.where(timed).select(*keys, AT, *[q for q, _, _, _ in STAGES], F.explode(places).alias("_b"))
    narrow = narrow.select("*", "_b._level", "_b._block").drop("_b")
    counted = stored.where(timed).select(PRODUCT, F.explode(places).alias("_b")).select(PRODUCT, "_b._level", "_b._block")
    found = lookup_join(narrow, index, _WHERE, "inner", False, keys[:4], counted=counted)
    rule = {c: F.col(c) for c in index.columns}
    cols = {}
    for name, _, stage_name, _ in STAGES:
        live, close, own = _hits(rule, F.col(name))
        cols[f"_live_{stage_name}"] = F.when(live, F.struct("promo", "text"))
        cols[f"_near_{stage_name}"] = F.when(close, F.col("promo"))
        cols[f"_own_{stage_name}"] = F.when(own, F.col("promo"))
    hit = found.select(*keys, *[c.alias(n) for n, c in cols.items()]).where(" or ".join(f"{n} is not null" for n in cols))
    return rows.join(hit.groupBy(*keys).agg(*[F.collect_set(n).alias(n) for n in cols]), keys, "left")


def quantities(rows: DataFrame) -> DataFrame:
    """The pairs of product and quantity that occur at any stage, each once."""
    units = F.explode(F.array(*[F.col(q) for q, _, _, _ in STAGES])).alias("_units")
    return rows.where(F.col(AT).isNotNull()).select(PRODUCT, units).where("_units != 0").distinct()


def met_by_quantity(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """Per product and quantity that occurs, the simple promotions with a condition that it meets, in force or not."""
    rules = simple_rules(catalog).select(PRODUCT, "promo", "lo", "hi", "step").distinct()
    tested = lookup_join(quantities(rows), rules, [PRODUCT], "inner", catalog.rules_bounded, ["_units"])
    return (
        tested.where(met({c: F.col(c) for c in rules.columns}, F.col("_units")))
        .groupBy(PRODUCT, "_units")
        .agg(F.collect_set(F.struct("promo")).alias("_met"))
    )


def _with_met(ruled: DataFrame, rows: DataFrame, catalog: Catalog) -> DataFrame:
    """``ruled`` with the promotions that each quantity meets; ``rows`` are the same rows before they met any rule."""
    table = stage(met_by_quantity(rows, catalog), "met")
    bounded = fits(table.select(F.explode("_met")), catalog.max_rows)
    out = ruled
    for name, _, stage_name, _ in STAGES:
        units = F.when(F.col(AT).isNotNull() & (F.col(name) != 0), F.col(name))
        mine = table.withColumnRenamed("_met", f"_met_{stage_name}")
        out = lookup_join(
            out.withColumn("_units", units), mine, [PRODUCT, "_units"], "left", bounded, ["USER", "SESION", "INTENTO"],
            counted=rows.select(PRODUCT, units.alias("_units")),
        ).drop("_units")
    return out


def patterns_by_day(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """The table of ``patterns``. The day blocks and the met conditions are written on the way; ``rows`` are read for the
    session totals, the pairs of product and quantity, and themselves, so they should be a stored table."""
    timed = timed_rows(with_sessions(rows, combo_session_complete(rows, catalog)))
    index = stage(day_rules(catalog), "day_rules")
    few = fits(index, catalog.max_rows) and widest(index.withColumn("_at_once", F.struct(*_WHERE)), key="_at_once") <= catalog.max_per_product
    ruled = _packed(timed, index) if few else _joined(timed, index, timed_rows(rows))
    return pattern_table(_with_met(ruled, timed_rows(rows), catalog))


def rules_tested(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """One row: how many rules the attempts test if each tests all rules of its product, how many if it tests those of
    its day blocks, and how many tests the pairs of product and quantity take. Rows are counted per product and day
    before they meet rules."""
    timed = timed_rows(rows).where(F.col(AT).isNotNull())
    days = timed.groupBy(PRODUCT, day_number(F.col(AT)).alias("_day")).agg(F.count("*").alias("_n"))
    places = F.array(*[F.struct(F.lit(i).alias("_level"), block_of(F.col("_day"), n).alias("_block")) for i, n in enumerate(LENGTHS)])
    blocks = days.select(PRODUCT, "_n", F.explode(places).alias("_b")).select(PRODUCT, "_n", "_b._level", "_b._block")
    per_block = day_rules(catalog).groupBy(*_WHERE).agg(F.count("*").alias("_rules"))
    simple = simple_rules(catalog).groupBy(PRODUCT).agg(F.count("*").alias("_simple"))
    combined = combined_rules(catalog).groupBy(PRODUCT).agg(F.count("*").alias("_combined"))
    every = simple.join(combined, PRODUCT, "full").select(PRODUCT, (F.coalesce("_simple", F.lit(0)) + F.coalesce("_combined", F.lit(0))).alias("_rules"))

    def total(counted: DataFrame, name: str) -> DataFrame:
        return counted.agg(F.coalesce(F.sum(F.col("_n") * F.col("_rules")), F.lit(0)).alias(name))

    pairs = quantities(timed).groupBy(PRODUCT).agg(F.count("*").alias("_n"))
    counts = [
        days.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")),
        total(days.groupBy(PRODUCT).agg(F.sum("_n").alias("_n")).join(every, PRODUCT), "by_product"),
        total(blocks.join(per_block, _WHERE), "by_day"),
        total(pairs.join(simple.withColumnRenamed("_simple", "_rules"), PRODUCT), "by_quantity"),
    ]
    named = [c.select(F.lit(c.columns[0]).alias("_name"), F.col(c.columns[0]).alias("_value")) for c in counts]
    one = named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])
    return one.agg(*[F.max(F.when(F.col("_name") == c.columns[0], F.col("_value"))).alias(c.columns[0]) for c in counts])

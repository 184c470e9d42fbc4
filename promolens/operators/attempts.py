"""Purchase attempts per user, session and product.

Shuffles, in order: one on the full item key (copies collapse before it, through the window group limit), one on
(user, session, product, time slice) that serves every per-event step, then two narrow ones on already aggregated
rows. A group of any size is spread over its time slices, so no task ever holds a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import ATTEMPT_EVENTS, DIMENSIONS, NO_ITEM, RunConfig
from promolens.functions.times import local_wall, time_text, whole_seconds
from promolens.session import stage

USER, SESSION = "user_pseudo_id", "session_id"
OFFSET, BUNDLE, TS = "event_server_timestamp_offset", "event_bundle_sequence_id", "event_timestamp"
GROUP = [USER, SESSION, "product_key"]

# Stand-ins that keep rows without a user or session joinable by plain equality.
_NO_USER, _NO_SESSION = "\u0000", -(2**63)


def _latest_first(*extra: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in (OFFSET, BUNDLE, *extra)]


def flatten_items(events: DataFrame) -> DataFrame:
    """One row per item line. An event without items keeps one row with NULL item fields and quantity 1."""
    kept = [c for c in events.columns if c != "items"]
    lines = events.select(*kept, F.explode_outer("items").alias("_i"))
    return lines.select(
        *kept,
        F.col("_i.item_name").alias("item_name"),
        F.col("_i.item_id").alias("item_id"),
        F.coalesce(F.col("_i.quantity").try_cast("bigint"), F.lit(1)).alias("raw_item_qty"),
    )


def dedup_items(lines: DataFrame) -> DataFrame:
    """Latest copy of an item line within (user, timestamp, event, item)."""
    w = Window.partitionBy(USER, TS, "event_name", "item_name", "item_id").orderBy(
        *_latest_first("raw_item_qty", SESSION, "transaction_id", *DIMENSIONS)
    )
    return lines.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _slice(cfg: RunConfig) -> Column:
    """Time slice of an event. Rows with neither user nor session share one group per product whatever their number, so
    their slices are sixty times narrower; results do not depend on the width."""
    width = cfg.chunk_minutes * 60_000_000
    nobody = F.col(USER).isNull() & F.col(SESSION).isNull()
    return F.coalesce(F.floor(F.col(TS) / F.when(nobody, width / 60).otherwise(width)).cast("bigint"), F.lit(-1))


def event_item_qty(items: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Units per event and item; each context column keeps one of its values (the smallest)."""
    keys = [USER, SESSION, *extra_keys, "event_name", TS, "item_name", "transaction_id", BUNDLE, OFFSET]
    return items.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in DIMENSIONS], F.sum("raw_item_qty").alias("item_qty")
    )


def dedup_event_items(rows: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Latest copy of an event-item within (user, session, event, timestamp, item)."""
    w = Window.partitionBy(USER, SESSION, *extra_keys, "event_name", TS, "item_name").orderBy(
        *_latest_first("transaction_id")
    )
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def event_items(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """Deduplicated event-item rows of the three attempt events, spread by (user, session, product, slice)."""
    lines = flatten_items(events.where(F.col("event_name").isin(*ATTEMPT_EVENTS)).drop("discount"))
    items = dedup_items(lines).withColumn("slice", _slice(cfg)).withColumns(
        {
            USER: F.coalesce(USER, F.lit(_NO_USER)),
            SESSION: F.coalesce(SESSION, F.lit(_NO_SESSION).cast("bigint")),
            "product_key": F.coalesce("item_name", F.lit(NO_ITEM)),
        }
    )
    spread = items.repartition(*GROUP, "slice")
    return dedup_event_items(event_item_qty(spread, ("product_key", "slice")), ("product_key", "slice"))


def _local_attempts(rows: DataFrame) -> DataFrame:
    """Attempt number inside the slice: purchases so far, plus one unless this row is a purchase."""
    w = (
        Window.partitionBy(*GROUP, "slice")
        .orderBy(TS, OFFSET, BUNDLE, "event_name", "item_name")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("is_purchase", F.when(F.col("event_name") == "purchase", 1).otherwise(0).cast("bigint"))
    return rows.withColumn("_local", F.sum("is_purchase").over(w) + 1 - F.col("is_purchase"))


def _number(rows: DataFrame, closed: str) -> DataFrame:
    """Add the purchases of earlier slices to the in-slice attempt number.

    ``closed`` counts purchases per row. The running total runs over one row per slice, so its groups are bounded
    by the number of slices in the period; slices with nothing before them need no correction and are left out.
    """
    rows = stage(rows, "slice_rows")
    w = Window.partitionBy(*GROUP).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        rows.groupBy(*GROUP, "slice")
        .agg(F.sum(closed).alias("_closed"))
        .select(*GROUP, "slice", F.sum("_closed").over(w).alias("_before"))
        .where("_before > 0")
    )
    return rows.join(earlier, [*GROUP, "slice"], "left").withColumn(
        "attempt_id", F.col("_local") + F.coalesce("_before", F.lit(0))
    )


def _restore_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {USER: F.nullif(F.col(USER), F.lit(_NO_USER)), SESSION: F.nullif(F.col(SESSION), F.lit(_NO_SESSION))}
    )


def attempt_ids(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """Every event-item row with its attempt number; a purchase closes its attempt."""
    numbered = _number(_local_attempts(event_items(events, cfg)), "is_purchase")
    return _restore_keys(numbered.drop("_local", "_before", "slice"))


def checkout_qty(rows: DataFrame) -> DataFrame:
    """Units in the last checkout event of each attempt."""
    keys = [*GROUP, "attempt_id"]
    per_event = (
        rows.where(F.col("event_name") == "begin_checkout")
        .groupBy(*keys, TS, OFFSET, BUNDLE)
        .agg(F.sum("item_qty").alias("qty"))
    )
    return per_event.groupBy(*keys).agg(F.max_by("qty", F.struct(TS, OFFSET, BUNDLE)).alias("qty_begin_checkout"))


def _rollup(rows: DataFrame, cfg: RunConfig) -> DataFrame:
    """First half of the attempt rollup, inside one slice. Item rows of one checkout event add up before the last
    event is chosen; the slice key is part of the partitioning, so nothing moves."""
    name, when = F.col("event_name"), F.struct(TS, OFFSET, BUNDLE)
    is_checkout = name == "begin_checkout"
    keys = [*GROUP, "slice", "_local"]
    # Several item rows of one checkout event can share a product key only through the no-item marker.
    w = Window.partitionBy(*keys, "event_name", TS, OFFSET, BUNDLE)
    rows = rows.withColumn("_event_qty", F.sum("item_qty").over(w))
    local = local_wall(F.col(TS), cfg.timezone)
    return rows.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in DIMENSIONS],
        F.min(F.when(name == "purchase", local)).alias("purchase_dt_mx"),
        F.max(local).alias("last_dt_mx"),
        F.sum("is_purchase").alias("purchases"),
        F.sum(F.when(name == "add_to_cart", F.col("item_qty")).otherwise(0)).alias("cart"),
        F.sum(F.when(name == "purchase", F.col("item_qty")).otherwise(0)).alias("bought"),
        F.max(F.when(name == "purchase", F.col("transaction_id"))).alias("transaction_id"),
        F.max(F.when(is_checkout, F.struct(when.alias("at"), F.col("_event_qty").alias("qty")))).alias("last_checkout"),
    )


def slice_partials(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """Parts of attempts: one row per user, session, product, time slice and attempt number inside the slice. Users and
    sessions that are missing carry stand-ins."""
    return _rollup(_local_attempts(event_items(events, cfg)), cfg)


def merge_partials(rows: DataFrame, *keys: str) -> DataFrame:
    """Parts with equal keys as one; merging may go in steps, in any order."""
    return rows.groupBy(*GROUP, *keys).agg(
        *[F.min(c).alias(c) for c in DIMENSIONS],
        F.min("purchase_dt_mx").alias("purchase_dt_mx"),
        F.max("last_dt_mx").alias("last_dt_mx"),
        F.sum("purchases").alias("purchases"),
        F.sum("cart").alias("cart"),
        F.sum("bought").alias("bought"),
        F.max("transaction_id").alias("transaction_id"),
        F.max("last_checkout").alias("last_checkout"),
    )


def attempts(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """Canonical attempts: one row per user, session, product and attempt number (19 columns). The parts of attempts are
    written to the work folder while the frame is built, so building it runs a job."""
    numbered = _number(slice_partials(events, cfg), "purchases")
    return canonical(merge_partials(numbered, "attempt_id"))


def canonical(merged: DataFrame) -> DataFrame:
    """The attempt table of merged parts with their final ``attempt_id``."""
    merged = _restore_keys(merged).withColumn("HAS_PURCHASE_INT", F.when(F.col("purchases") > 0, 1).otherwise(0).cast("bigint"))
    at = F.coalesce("purchase_dt_mx", "last_dt_mx")
    # The checkout quantity is matched by user and session, so rows without either keep 0.
    matched = F.col(USER).isNotNull() & F.col(SESSION).isNotNull()
    checkout = F.coalesce(F.when(matched, F.col("last_checkout.qty")), F.lit(0))
    return merged.select(
        F.col(USER).alias("USER"),
        F.col(SESSION).alias("SESION"),
        F.col("product_key").alias("ITEM"),
        F.col("attempt_id").alias("INTENTO"),
        at.alias("attempt_dt_mx"),
        time_text(at).alias("DATETIME"),
        F.to_date(at).alias("attempt_date"),
        "HAS_PURCHASE_INT",
        status_label(F.col("HAS_PURCHASE_INT")).alias("STATUS"),
        *DIMENSIONS,
        F.greatest("bought", "cart").alias("qty_add_to_cart"),
        F.greatest(F.col("bought"), checkout).alias("qty_begin_checkout"),
        F.col("bought").alias("qty_purchase"),
        "transaction_id",
    )


def status_label(has_purchase: Column) -> Column:
    return F.when(has_purchase == 1, "PURCHASED").otherwise("NO_PURCHASE")


def attempts_window(table: DataFrame, cfg: RunConfig) -> DataFrame:
    """Attempts of the date window under the names that promotion detection uses. ``_at`` is the time of DATETIME, so
    that detection need not read it back from text; it is not part of any result table."""
    keep = F.col("attempt_date").isNotNull()
    if cfg.date_start is not None:
        keep = keep & (F.col("attempt_date") >= F.lit(cfg.date_start))
    if cfg.date_end is not None:
        keep = keep & (F.col("attempt_date") <= F.lit(cfg.date_end))
    return table.where(keep).select(
        "USER",
        "SESION",
        "DATETIME",
        "ITEM",
        "INTENTO",
        *DIMENSIONS,
        status_label(F.col("HAS_PURCHASE_INT")).alias("STATUS"),
        F.col("qty_add_to_cart").alias("CANTIDAD_ADD_TO_CART"),
        F.col("qty_begin_checkout").alias("CANTIDAD_BEGIN_CHECKOUT"),
        F.col("qty_purchase").alias("CANTIDAD_PURCHASE"),
        F.col("transaction_id").alias("TRANSACTION_ID"),
        F.lit(None).cast("string").alias("item_id"),
        whole_seconds(F.col("attempt_dt_mx")).alias("_at"),
    )

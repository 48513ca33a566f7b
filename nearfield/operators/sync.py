"""Change-log driven index upkeep.

The service polls the oldest unprocessed events, applies them one by one (each re-reads the
current business row) and marks them processed. Because every event re-reads the current row,
the net effect of a batch per business is decided by its last event alone, so the batch is a
set operation: take the latest event per business, join the current rows, split into deletes
and upserts, merge into the index, flag the batch processed. Re-running a batch gives the same
index (at-least-once delivery is safe).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.operators.validate import unprocessed


def poll_batch(log: DataFrame, n: int | None = None) -> DataFrame:
    """all unprocessed events, or with n the n oldest by id (a distributed take-ordered)."""
    pending = unprocessed(log)
    return pending if n is None else pending.orderBy("id").limit(n)


def latest_event(events: DataFrame) -> DataFrame:
    """last event per business by event id (partial aggregation with max_by, no window)."""
    return events.groupBy("business_id").agg(
        F.max("id").alias("event_id"),
        F.max_by("change_type", "id").alias("change_type"),
    )


def apply_changes(latest: DataFrame, business: DataFrame, config: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(ids to delete, index rows to upsert). A DELETED event, a missing business or a
    non-active one deletes; otherwise the current row is indexed."""
    cur = business.select(F.col("id").alias("business_id"), "status", "latitude", "longitude")
    j = latest.join(cur, "business_id", "left")
    upsert_cond = (F.col("change_type") != "DELETED") & (F.col("status") == "ACTIVE")
    deletes = j.filter(~upsert_cond | F.col("status").isNull()).select("business_id")
    ups = j.filter(upsert_cond).select(F.col("business_id").alias("id"), "latitude", "longitude")
    return deletes, ix.index_rows(ups, config)


def sync_index(index: DataFrame, log: DataFrame, business: DataFrame, max_events: int | None = None,
               config: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One sync batch. Returns (new index, new log with the batch marked processed, batch).

    An empty batch leaves both unchanged."""
    batch = poll_batch(log, max_events).select("id", "business_id", "change_type")
    deletes, upserts = apply_changes(latest_event(batch), business, config)
    new_index = ix.zone_move(ix.delete_ids(index, deletes), upserts)
    return new_index, mark_processed(log, batch), batch


def sync_store(store, log: DataFrame, business: DataFrame, max_events: int | None = None, config: DataFrame | None = None) -> tuple[list[str], DataFrame]:
    """I2 over a stored index (``nearfield.sources.index_store``): the batch is merged into the geohash prefixes that it touches.

    Returns the prefixes renewed and the log with the batch marked processed. A batch that is merged but not marked, as after
    a crash, may be merged again: the index stays the same."""
    batch = poll_batch(log, max_events).select("id", "business_id", "change_type")
    deletes, upserts = apply_changes(latest_event(batch), business, config)
    return store.merge(deletes, upserts), mark_processed(log, batch)


def mark_processed(log: DataFrame, batch: DataFrame) -> DataFrame:
    """The log with the events of a batch marked processed."""
    done = batch.select("id", F.lit(True).alias("_done"))
    return (log.join(done, "id", "left")
            .withColumn("processed", F.col("processed") | F.coalesce(F.col("_done"), F.lit(False)))
            .drop("_done"))


def sync_backlog(log: DataFrame, now) -> DataFrame:
    """Unprocessed count and age in whole seconds of the oldest unprocessed event (0 if none)."""
    pending = log.filter(~F.col("processed"))
    agg = pending.agg(F.count(F.lit(1)).alias("unprocessed"), F.min("created_at").alias("oldest"))
    age = F.coalesce(
        F.floor(F.unix_micros(F.lit(now).cast("timestamp_ntz").cast("timestamp_ltz"))
                / 1e6 - F.unix_micros(F.col("oldest").cast("timestamp_ltz")) / 1e6).cast("long"), F.lit(0).cast("long"))
    return agg.select("unprocessed", age.alias("oldest_age_s"))

"""Structured Streaming index sync (I3) with hot-zone refresh per micro-batch (I8).

The change log arrives as a stream. Each micro-batch runs the batch sync decision (latest event per business, the
business rows as they are now, delete or upsert) and writes its decisions to ``<root>/decisions/batch_id=<n>`` with
overwrite, so a replayed batch rewrites itself (at-least-once delivery, idempotent output). The index is the base index
with one decision per business applied: the change of the highest event id, as in the batch sync, with the row of the newest batch, so
events may come in any order and more than once. (A watermark that drops repeated events would drop late ones too.) ``fold`` sums the decisions up to a batch into one folder, so that reading
does not grow with the number of batches. An empty micro-batch writes nothing.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.operators.sync import latest_event
from nearfield.session import work_dir
from nearfield.streaming.files import numbered_folders

log = logging.getLogger(__name__)


class HotZoneRefresher:
    """I8: re-reads the hot-zone config for every micro-batch and keeps the last good one when that fails.

    The config is read in full before it is trusted (it has at most one row per 4-character prefix). A failing first
    read raises: there is no good config to go on with."""

    def __init__(self, load: Callable[[], DataFrame]):
        self.load = load
        self.last_good: DataFrame | None = None

    def current(self) -> DataFrame:
        try:
            config = self.load().persist()
            config.count()
        except Exception:
            if self.last_good is None:
                raise
            log.warning("hot-zone config could not be read, the last good one stays", exc_info=True)
            return self.last_good
        if self.last_good is not None:
            self.last_good.unpersist()
        self.last_good = config
        return config


@dataclass
class SyncStream:
    """A running sync: the streaming query and a reader of the index as far as it has come."""

    spark: SparkSession
    query: object
    base_index: DataFrame
    root: str

    def index(self) -> DataFrame:
        """The index after all batches written so far."""
        latest = _latest(self.spark, self.root)
        return self.base_index if latest is None else merge_decisions(self.base_index, latest)

    def fold(self) -> None:
        """Sums all decisions so far into ``folded/upto=<last batch>``; later reads start from there."""
        done = numbered_folders(self.spark, f"{self.root}/decisions", "batch_id")
        if done:
            _latest(self.spark, self.root).write.mode("overwrite").parquet(f"{self.root}/folded/upto={done[-1]}")


def _latest(spark: SparkSession, root: str) -> DataFrame | None:
    """Per business the change of its last event by event id, whatever the order of the batches, and its row as the newest batch
    saw it; None before the first batch."""
    folded = numbered_folders(spark, f"{root}/folded", "upto")
    start = folded[-1] if folded else -1
    paths = [f"{root}/folded/upto={start}"] if folded else []
    paths += [f"{root}/decisions/batch_id={n}" for n in numbered_folders(spark, f"{root}/decisions", "batch_id") if n > start]
    if not paths:
        return None
    decisions = spark.read.parquet(*paths)
    seen = [c for c in decisions.columns if c not in ("business_id", "event_id", "change_type")]
    return (decisions.groupBy("business_id").agg(F.max("event_id").alias("event_id"), F.max_by("change_type", "event_id").alias("change_type"),
                                                 F.max_by(F.struct(*seen), "batch").alias("d")).select("business_id", "event_id", "change_type", "d.*"))


def merge_decisions(base_index: DataFrame, latest: DataFrame) -> DataFrame:
    """Base index with the latest decision per business applied."""
    keep = base_index.join(latest.select("business_id"), "business_id", "left_anti")
    return keep.unionByName(latest.filter((F.col("change_type") != "DELETED") & F.col("active")).select(*ix.INDEX_COLUMNS))


def start_sync_stream(spark: SparkSession, events: DataFrame, business_loader: Callable[[], DataFrame], base_index: DataFrame,
                      config_loader: Callable[[], DataFrame], trigger: dict | None = None, root: str | None = None) -> SyncStream:
    """Starts the sync over ``events``, a streaming DataFrame of change events, and returns at once.

    ``business_loader`` is called for every batch, so that a batch sees the rows as they are then. ``trigger`` as for
    writeStream (default: available now). ``root`` is a folder that driver and executors share; a restart with the same
    root goes on where the last run ended."""
    root = root or work_dir(spark, f"sync-stream-{uuid.uuid4().hex}")
    refresher = HotZoneRefresher(config_loader)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        pending = batch.filter(~F.col("processed"))
        if pending.isEmpty():
            return
        cur = business_loader().select(F.col("id").alias("business_id"), "status", "latitude", "longitude")
        j = latest_event(pending).join(cur, "business_id", "left")
        active = F.coalesce(F.col("status") == "ACTIVE", F.lit(False))
        rows = ix.index_rows(j.select(F.col("business_id").alias("id"), "latitude", "longitude"), refresher.current())
        out = (j.select("business_id", "event_id", "change_type", active.alias("active")).join(rows, "business_id", "left")
               .withColumn("batch", F.lit(batch_id).cast("long")))
        out.write.mode("overwrite").parquet(f"{root}/decisions/batch_id={batch_id}")

    query = (events.writeStream.foreachBatch(apply_batch).option("checkpointLocation", f"{root}/checkpoint")
             .trigger(**(trigger or {"availableNow": True})).start())
    return SyncStream(spark, query, base_index, root)


def run_sync_stream(spark: SparkSession, events: DataFrame, business_loader: Callable[[], DataFrame], base_index: DataFrame,
                    config_loader: Callable[[], DataFrame], root: str | None = None) -> DataFrame:
    """Runs the sync over what is available now, to its end, and returns the resulting index."""
    stream = start_sync_stream(spark, events, business_loader, base_index, config_loader, None, root)
    stream.query.awaitTermination()
    return stream.index()

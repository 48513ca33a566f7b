"""Structured Streaming telemetry (I4): per-minute request rates and 5-minute p95 latency, in one pass.

Every micro-batch writes its counts per (minute, endpoint, latency) under its batch id (a replay rewrites the same folder).
Counts add up, so the stream keeps no state and needs no watermark: no request is too late, in whatever order the files
come. Rates and exact percentiles follow from the sums as in the batch twins.

``start_telemetry_stream`` goes on for as long as requests come and emits minutes as they close: a minute closes when the latest
minute seen is more than ``delay`` minutes after it, and is emitted once, by the batch that closes it. Requests of a closed minute that
come later emit it again, with all its requests, and the row of the newest batch counts. Counts of every ``fold_every`` batches are summed
into one folder, so that a batch reads at most as many folders. What a batch emits follows from the batches up to it alone, so a replay
emits the same.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.operators.telemetry import minute_counts, p95_from_counts, rates_from_counts
from nearfield.session import work_dir
from nearfield.streaming.files import numbered_folders

_KEYS = ["minute", "endpoint", "latency_ms"]


def run_telemetry_stream(spark: SparkSession, requests: DataFrame, root: str | None = None) -> DataFrame:
    """Runs the aggregation over a streaming request log to its end; returns (metric, window_start, endpoint, requests, value)
    rows: requests per second of a minute (rps_1m), p95 latency of five minutes (p95_5m), zero when idle."""
    root = root or work_dir(spark, f"telemetry-stream-{uuid.uuid4().hex}")

    def write(batch: DataFrame, batch_id: int) -> None:
        minute_counts(batch, ["endpoint"]).write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    query = requests.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    paths = [f"{root}/out/batch_id={n}" for n in numbered_folders(spark, f"{root}/out", "batch_id")]
    if paths:
        done = spark.read.parquet(*paths)
    else:  # no input at all
        done = spark.createDataFrame([], "minute timestamp_ntz, endpoint string, latency_ms double, c long, e long")
    base = done.groupBy(*_KEYS).agg(F.sum("c").alias("c"), F.sum("e").alias("e"))
    rate = rates_from_counts(base, ["endpoint"]).select(
        F.lit("rps_1m").alias("metric"), "window_start", "endpoint", "requests", F.col("rps").alias("value"))
    p95 = p95_from_counts(base, ["endpoint"]).select(
        F.lit("p95_5m").alias("metric"), "window_start", "endpoint", "requests", F.col("p95_ms").alias("value"))
    return rate.unionByName(p95)


def _counts_until(spark: SparkSession, root: str, last: int) -> DataFrame | None:
    """The counts of all batches up to ``last``, from the newest sum before it and the batches since; None if there is none."""
    folded = max((n for n in numbered_folders(spark, f"{root}/folded", "upto") if n <= last), default=-1)
    paths = [f"{root}/folded/upto={folded}"] if folded >= 0 else []
    paths += [f"{root}/out/batch_id={n}" for n in numbered_folders(spark, f"{root}/out", "batch_id") if folded < n <= last]
    return spark.read.parquet(*paths) if paths else None


@dataclass
class TelemetryStream:
    """A running telemetry stream: the streaming query and a reader of the minutes closed so far."""

    spark: SparkSession
    query: object
    root: str

    def emitted(self) -> DataFrame | None:
        """All rows emitted so far with the batch that did: (window_start, endpoint, requests, rps, batch); None before the first."""
        paths = [f"{self.root}/closed/batch_id={n}" for n in numbered_folders(self.spark, f"{self.root}/closed", "batch_id")]
        return self.spark.read.parquet(*paths) if paths else None

    def closed(self) -> DataFrame | None:
        """One row per closed minute and endpoint, as the newest batch has it."""
        rows = self.emitted()
        return rows if rows is None else rows.groupBy("window_start", "endpoint").agg(
            F.max_by("requests", "batch").alias("requests"), F.max_by("rps", "batch").alias("rps"))


def start_telemetry_stream(spark: SparkSession, requests: DataFrame, root: str | None = None, trigger: dict | None = None,
                           delay: int = 10, fold_every: int = 50) -> TelemetryStream:
    """Starts the continuous rates over a streaming request log and returns at once. ``trigger`` as for writeStream (default: every
    ten seconds); a restart with the same ``root``, a folder that driver and executors share, goes on where the last run ended."""
    root = root or work_dir(spark, f"telemetry-stream-{uuid.uuid4().hex}")
    limit = F.expr(f"INTERVAL {int(delay)} MINUTES")

    def write(batch: DataFrame, batch_id: int) -> None:
        out = f"{root}/out/batch_id={batch_id}"
        minute_counts(batch, ["endpoint"]).write.mode("overwrite").parquet(out)
        before, now = _counts_until(spark, root, batch_id - 1), _counts_until(spark, root, batch_id)
        edge = lambda counts: counts.agg((F.max("minute") - limit).alias("edge")).first()["edge"] if counts is not None else None
        old, new = edge(before), edge(now)
        if new is None:
            return
        closing = F.col("minute") < F.lit(str(new)).cast("timestamp_ntz")
        if old is not None:  # closed by this batch, or closed before and met again
            first = F.col("minute") >= F.lit(str(old)).cast("timestamp_ntz")
            late = spark.read.parquet(out).filter(~first).select("minute").distinct()
            rows = now.filter(closing & first).unionByName(now.join(late, "minute", "left_semi"))
        else:
            rows = now.filter(closing)
        (rows.groupBy(F.col("minute").alias("window_start"), "endpoint").agg(F.sum("c").alias("requests"))
         .select("window_start", "endpoint", "requests", (F.col("requests") / 60).alias("rps"), F.lit(batch_id).cast("long").alias("batch"))
         .write.mode("overwrite").parquet(f"{root}/closed/batch_id={batch_id}"))
        if batch_id % fold_every == fold_every - 1:
            (now.groupBy(*_KEYS).agg(F.sum("c").alias("c"), F.sum("e").alias("e"))
             .write.mode("overwrite").parquet(f"{root}/folded/upto={batch_id}"))

    query = (requests.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint")
             .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
    return TelemetryStream(spark, query, root)

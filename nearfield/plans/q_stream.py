"""Streaming queries (I3, I4, I8): the given tables read as file streams, held against the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.plans.catalog import REGISTRY, register
from nearfield.plans.q_telemetry import SLIDING_SQL, every_minute
from nearfield.plans.sqlgen import with_fixtures
from nearfield.sources.fixtures import FIXTURE_SQL, Fixtures
from nearfield.sources.tables import read_table
from nearfield.streaming.sync_stream import run_sync_stream
from nearfield.streaming.telemetry_stream import run_telemetry_stream


def _stream_of(spark, sf_dir, table: str):
    """A given table as a stream of its files, one a batch."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    source = spark.readStream.schema(read_table(spark, sf_dir, table).schema).option("maxFilesPerTrigger", 1)
    return source.parquet(f"{path[:-1]}[{path[-1]}]")  # a pattern that only the path matches: a stream takes no single file by its name


@register("sync_index_stream", REGISTRY["sync_index"].oracle)
def sync_index_stream(spark, sf_dir):
    """I3 + I8: the change log as a file stream drained into the index by micro-batches; the result is that of sync_index."""
    fx = Fixtures(spark, sf_dir)
    events = spark.sql(FIXTURE_SQL["change_log"], orders=_stream_of(spark, sf_dir, "orders"))
    return run_sync_stream(spark, events, lambda: fx.business, ix.full_reindex(fx.business, fx.hot_zone_config), lambda: fx.hot_zone_config)


@register("telemetry_stream", with_fixtures(["request_log"], SLIDING_SQL + f""",
mins AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, endpoint, count(*) AS requests FROM request_log GROUP BY ALL)
SELECT 'rps_1m' AS metric, window_start, endpoint, coalesce(requests, 0) AS requests, round(coalesce(requests, 0) / 60.0, 6) AS value
FROM {every_minute('mins')} LEFT JOIN mins USING (window_start, endpoint)
UNION ALL SELECT 'p95_5m', window_start, endpoint, requests, round(p95_ms, 6) FROM p95
"""))
def telemetry_stream(spark, sf_dir):
    """I4: per-minute rates and exact 5-minute p95 from the request log as a stream."""
    req = spark.sql(FIXTURE_SQL["request_log"], events=_stream_of(spark, sf_dir, "events"))
    return run_telemetry_stream(spark, req).withColumn("value", F.round("value", 6))

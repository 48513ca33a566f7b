"""Telemetry queries over the request log (E3-E5, E9, I4 batch twin, I5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.operators import sync as Y
from nearfield.operators import telemetry as T
from nearfield.operators.sketch import RELATIVE_ERROR
from nearfield.plans.catalog import register
from nearfield.plans.sqlgen import with_fixtures
from nearfield.sources.fixtures import Fixtures

# Load-test stage targets, offered rate (requests/s) and p95 target per stage.
STAGE_TARGETS = (("low", 200.0, 300.0), ("mid", 500.0, 300.0), ("high", 1000.0, 300.0))
NOW = "2024-06-01 00:00:00"


def _r6(c):
    return F.round(c, 6)


@register("latency_summary", with_fixtures(["request_log"], """
SELECT endpoint, stage, count(*) AS requests, round(avg(latency_ms), 6) AS avg_ms, min(latency_ms) AS min_ms, max(latency_ms) AS max_ms,
  round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms, round(quantile_cont(latency_ms, 0.9), 6) AS p90_ms,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms
FROM request_log GROUP BY endpoint, stage
"""))
def latency_summary(spark, sf_dir):
    """Latency distribution per endpoint and load stage (exact, distributed percentiles)."""
    s = T.latency_summary(Fixtures(spark, sf_dir).request_log, ["endpoint", "stage"])
    return s.select("endpoint", "stage", "requests", _r6(F.col("avg_ms")).alias("avg_ms"), "min_ms", "max_ms",
                    *[_r6(F.col(c)).alias(c) for c in ("p50_ms", "p90_ms", "p95_ms", "p99_ms")])


def bucket_sql(v: str) -> str:
    """The sketch's bucket of a positive value: the octave and its 64th part, by the exact powers of two on both sides."""
    e = f"CAST(floor(log2(nullif({v}, 0))) AS BIGINT)"
    e = f"(CASE WHEN {v} < pow(CAST(2 AS DOUBLE), {e}) THEN {e} - 1 WHEN {v} >= pow(CAST(2 AS DOUBLE), {e} + 1) THEN {e} + 1 ELSE {e} END)"
    return f"(CASE WHEN {v} = 0 THEN -100000 ELSE {e} * 64 + CAST(floor(({v} / pow(CAST(2 AS DOUBLE), {e}) - 1) * 64) AS BIGINT) END)"


def middle_sql(b: str) -> str:
    return (f"(CASE WHEN {b} = -100000 THEN 0 ELSE pow(CAST(2 AS DOUBLE), floor({b} / CAST(64 AS DOUBLE))) * "
            f"(1 + ({b} - 64 * floor({b} / CAST(64 AS DOUBLE)) + 0.5) / CAST(64 AS DOUBLE)) END)")


def sketched_sql(src: str, groups: str, probs: dict[str, float]) -> str:
    """The estimates from ordered lists of buckets: the middle of the bucket at each position, interpolated as the exact percentile. Nine
    decimals: middles are binary fractions, so that at six some lie half-way, where engines round differently."""
    at = lambda pos: middle_sql(f"list_extract(bs, CAST({pos} AS BIGINT) + 1)")
    cols = ", ".join(f"round({at(f'floor((n - 1) * {p}::DOUBLE)')} + ({at(f'least(floor((n - 1) * {p}::DOUBLE) + 1, n - 1)')} - {at(f'floor((n - 1) * {p}::DOUBLE)')}) "
                     f"* ((n - 1) * {p}::DOUBLE - floor((n - 1) * {p}::DOUBLE)), 9) AS {name}" for name, p in probs.items())
    return f"""SELECT {groups}, n, {cols} FROM (SELECT {groups}, count(*) AS n, list(b ORDER BY b) AS bs
  FROM (SELECT *, {bucket_sql('latency_ms')} AS b FROM {src} WHERE latency_ms IS NOT NULL) GROUP BY {groups})"""


_PROBS = {"p50_ms": 0.5, "p90_ms": 0.9, "p95_ms": 0.95, "p99_ms": 0.99}


@register("latency_sketch", with_fixtures(["request_log"], f"""
est AS ({sketched_sql('request_log', 'endpoint, stage', _PROBS)})
SELECT endpoint, stage, n, p50_ms, p90_ms, p95_ms, p99_ms, true AS within_bound, true AS ranks_within FROM est
"""))
def latency_sketch(spark, sf_dir):
    """E3 for scale: percentiles from mergeable sketches; each within 1/128 of the exact one, and its rank within 2 % of its own."""
    req = Fixtures(spark, sf_dir).request_log
    keys = ["endpoint", "stage"]
    est = T.latency_sketch(req, keys)
    exact = T.exact_percentiles(req, keys, "latency_ms", _PROBS).withColumnsRenamed({c: f"x_{c}" for c in _PROBS})
    ranks = T.rank_error(req, est, keys, _PROBS).select(*keys, F.greatest(*_PROBS).alias("rank_error"))
    within = F.lit(True)
    for c in _PROBS:
        within = within & (F.abs(F.col(c) - F.col(f"x_{c}")) <= F.abs(F.col(f"x_{c}")) * RELATIVE_ERROR + 1e-9)
    out = est.join(exact, keys).join(ranks, keys)
    return out.select(*keys, "n", *[F.round(c, 9).alias(c) for c in _PROBS], within.alias("within_bound"),
                      (F.col("rank_error") <= 0.02).alias("ranks_within"))


@register("p95_5m_sketch", with_fixtures(["request_log"], f"""
win AS (SELECT w.window_start, r.endpoint, r.latency_ms FROM request_log r, (SELECT unnest(generate_series(0, 4)) AS k) s,
  LATERAL (SELECT time_bucket(INTERVAL 1 MINUTE, r.ts) - s.k * INTERVAL 1 MINUTE AS window_start) w)
{sketched_sql('win', 'window_start, endpoint', {'p95_ms': 0.95})}
"""))
def p95_5m_sketch(spark, sf_dir):
    """I4 for scale: p95 of sliding 5-minute windows, merged from the sketches of their minutes."""
    states = T.minute_sketches(Fixtures(spark, sf_dir).request_log, ["endpoint"])
    w = T.p95_from_sketches(states, ["endpoint"])
    return w.select("window_start", "endpoint", "n", F.round("p95_ms", 9).alias("p95_ms"))


_RATES_SQL = """
rates AS (
  SELECT stage, count(*) AS requests, epoch(max(ts)) - epoch(min(ts)) AS duration_s,
    count(*) FILTER (WHERE status_code >= 400) AS failed, count(*) FILTER (WHERE check_passed) AS passed
  FROM request_log GROUP BY stage)
"""


@register("request_rates", with_fixtures(["request_log"], _RATES_SQL + """
SELECT stage, requests, round(duration_s, 6) AS duration_s, round(coalesce(requests / nullif(duration_s, 0), 0), 6) AS rps,
  round(coalesce(failed / nullif(requests, 0), 0), 6) AS fail_rate, round(coalesce(passed / nullif(requests, 0), 0), 6) AS check_rate
FROM rates
"""))
def request_rates(spark, sf_dir):
    """Requests, rate, failure rate and check pass rate per load stage."""
    r = T.request_rates(Fixtures(spark, sf_dir).request_log, ["stage"])
    return r.select("stage", "requests", *[_r6(F.col(c)).alias(c) for c in ("duration_s", "rps", "fail_rate", "check_rate")])


def _targets_sql() -> str:
    rows = ", ".join(f"('{s}', {r}, {p})" for s, r, p in STAGE_TARGETS)
    return f"(VALUES {rows}) AS t(stage, target_rps, p95_target_ms)"


# The iterations a stage dropped and whether its run ended well, from all its requests (FIXTURES.md): a signup stands for a dropped
# iteration, a stage is well while less than 1 % of its answers are 5xx.
@register("stage_verdict", with_fixtures(["request_log"], _RATES_SQL + f""",
p AS (SELECT stage, quantile_cont(latency_ms, 0.95) AS p95_ms, count(*) FILTER (WHERE endpoint <> '/v1/search/nearby') AS dropped,
        count(*) FILTER (WHERE status_code >= 500) / count(*) < 0.01 AS stage_ok FROM request_log GROUP BY stage)
SELECT stage, round(p95_ms, 6) AS p95_ms, round(coalesce(requests / nullif(duration_s, 0), 0), 6) AS rps, dropped, stage_ok,
  CASE WHEN p95_ms <= p95_target_ms AND coalesce(failed / nullif(requests, 0), 0) < 0.01 AND coalesce(passed / nullif(requests, 0), 0) >= 0.99
        AND coalesce(requests / nullif(duration_s, 0), 0) >= target_rps * 0.95 AND dropped = 0 AND stage_ok THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM rates JOIN p USING (stage) JOIN {_targets_sql()} USING (stage)
"""))
def stage_verdict(spark, sf_dir):
    """E5: PASS / FAIL per load stage against the stage targets."""
    req = Fixtures(spark, sf_dir).request_log
    ran = req.groupBy("stage").agg(F.count_if(F.col("endpoint") != "/v1/search/nearby").alias("dropped"),
                                   T.stage_ended_well().alias("stage_ok"))
    stats = T.request_rates(req, ["stage"]).join(
        T.exact_percentiles(req, ["stage"], "latency_ms", {"p95_ms": 0.95}), "stage").join(ran, "stage")
    targets = spark.createDataFrame(list(STAGE_TARGETS), "stage string, target_rps double, p95_target_ms double")
    v = T.stage_verdict(stats, F.broadcast(targets))
    return v.select("stage", _r6(F.col("p95_ms")).alias("p95_ms"), _r6(F.col("rps")).alias("rps"), "dropped", "stage_ok", "verdict")


def every_minute(src: str) -> str:
    """The minutes from each endpoint's first to its last window."""
    return (f"(SELECT endpoint, unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 MINUTE)) AS window_start "
            f"FROM {src} GROUP BY endpoint)")


@register("qps_1m", with_fixtures(["request_log"], f"""
seen AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, endpoint, count(*) AS requests FROM request_log GROUP BY ALL)
SELECT window_start, endpoint, coalesce(requests, 0) AS requests, round(coalesce(requests, 0) / 60.0, 6) AS rps
FROM {every_minute('seen')} LEFT JOIN seen USING (window_start, endpoint)
"""))
def qps_1m(spark, sf_dir):
    """I4 batch twin: requests per second per endpoint over 1-minute windows, zero when idle."""
    r = T.per_minute_rate(Fixtures(spark, sf_dir).request_log, ["endpoint"])
    return r.select("window_start", "endpoint", "requests", _r6(F.col("rps")).alias("rps"))


SLIDING_SQL = f"""
win AS (
  SELECT w.window_start, r.endpoint, r.latency_ms, r.status_code
  FROM request_log r, (SELECT unnest(generate_series(0, 4)) AS k) s,
  LATERAL (SELECT time_bucket(INTERVAL 1 MINUTE, r.ts) - s.k * INTERVAL 1 MINUTE AS window_start) w),
seen AS (
  SELECT window_start, endpoint, count(*) AS requests, count(*) FILTER (WHERE status_code >= 500) AS errors_5xx,
    quantile_cont(latency_ms, 0.95) AS p95_ms
  FROM win GROUP BY window_start, endpoint),
p95 AS (
  SELECT window_start, endpoint, coalesce(requests, 0) AS requests, coalesce(errors_5xx, 0) AS errors_5xx, coalesce(p95_ms, 0) AS p95_ms,
    coalesce(errors_5xx / nullif(requests, 0), 0) AS error_rate_5xx
  FROM {every_minute('seen')} LEFT JOIN seen USING (window_start, endpoint))
"""


@register("p95_5m", with_fixtures(["request_log"], SLIDING_SQL + """
SELECT window_start, endpoint, requests, errors_5xx, round(p95_ms, 6) AS p95_ms, round(error_rate_5xx, 6) AS error_rate_5xx FROM p95
"""))
def p95_5m(spark, sf_dir):
    """I4 batch twin: p95 latency and 5xx rate over 5-minute windows sliding by 1 minute, zero when idle."""
    w = T.sliding_p95(Fixtures(spark, sf_dir).request_log, ["endpoint"])
    return w.select("window_start", "endpoint", "requests", "errors_5xx", _r6(F.col("p95_ms")).alias("p95_ms"),
                    _r6(F.col("error_rate_5xx")).alias("error_rate_5xx"))


def _held(value: str, limit: str) -> str:
    return f"""SELECT window_start, v FROM (SELECT window_start, {value} AS v,
    count(*) OVER (PARTITION BY endpoint ORDER BY window_start RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW) AS held
  FROM p95 WHERE endpoint = '/v1/search/nearby' AND {value} > {limit}) WHERE held >= 5"""


@register("alerts", with_fixtures(["request_log", "change_log"], SLIDING_SQL + f""",
bl AS (SELECT count(*) AS unprocessed, coalesce(CAST(floor(epoch(TIMESTAMP '{NOW}') - epoch(min(created_at))) AS BIGINT), 0) AS age
       FROM change_log WHERE NOT processed)
SELECT 'search_p95_high' AS alert, window_start, round(v, 6) AS value FROM ({_held('p95_ms', '300')})
UNION ALL SELECT 'error_rate_5xx_high', window_start, round(v, 6) FROM ({_held('error_rate_5xx', '0.01')})
UNION ALL SELECT 'sync_backlog_high', NULL, CAST(unprocessed AS DOUBLE) FROM bl WHERE unprocessed > 100000
UNION ALL SELECT 'sync_lag_high', NULL, CAST(age AS DOUBLE) FROM bl WHERE age > 3600
"""))
def alerts(spark, sf_dir):
    """Breaches of the search endpoint's 5-minute windows that have held for five minutes, and the sync backlog."""
    fx = Fixtures(spark, sf_dir)
    req = fx.request_log.filter(F.col("endpoint") == "/v1/search/nearby")
    a = T.alerts(T.sliding_p95(req, ["endpoint"]), Y.sync_backlog(fx.change_log, NOW), ["endpoint"])
    return a.select("alert", "window_start", _r6(F.col("value")).alias("value"))


@register("traffic_profile", with_fixtures(["search_query"], f"""
SELECT hour(requested_at) AS hour, tier, radius_m, count(*) AS searches,
  round(sum(count(*)) OVER (PARTITION BY hour(requested_at)) / (SELECT count(*) FROM search_query), 6) AS share,
  round(list_extract([{', '.join(repr(w) for w in T.HOUR_WEIGHTS)}], hour(requested_at) + 1) / {sum(T.HOUR_WEIGHTS)!r}, 6) AS expected_share
FROM search_query GROUP BY hour(requested_at), tier, radius_m
"""))
def traffic_profile(spark, sf_dir):
    """Searches per hour of day, tier and radius, observed share of the hour against the expected hourly weights."""
    p = T.traffic_profile(Fixtures(spark, sf_dir).search_query)
    return p.select(F.col("hour").cast("bigint").alias("hour"), "tier", "radius_m", "searches", _r6(F.col("share")).alias("share"),
                    _r6(F.col("expected_share")).alias("expected_share"))

"""Request-log analytics: latency percentiles, rates, stage verdicts, windows, alerts.

Exact percentiles never gather or sort a group's values in one task. Rows are first counted per (group, value), which
takes ties away before the shuffle; the counts of logarithmic buckets show in which each wanted position lies, those of ``BINS`` equal
bins of such a bucket in which part of it; only the values of those parts are ordered. Heavy tails and outliers do not change how
finely the rest is divided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfield.operators.sketch import merge, sketch, sketch_quantiles, with_bucket

BINS = 4096

# Fixed thresholds of the service's SLA and load-test verdicts.
P95_TARGET_MS = 300.0
FAIL_RATE_MAX = 0.01
CHECK_RATE_MIN = 0.99
ACHIEVED_RATE_MIN = 0.95
BACKLOG_MAX = 100_000
LAG_MAX_S = 60 * 60
# Relative search traffic by hour of day (0..23).
HOUR_WEIGHTS = (
    0.2, 0.15, 0.10, 0.10, 0.10, 0.15,
    0.25, 0.45, 0.70, 0.90, 1.10, 1.50,
    1.80, 1.70, 1.20, 1.00, 1.10, 1.25,
    1.55, 1.65, 1.35, 0.95, 0.60, 0.35,
)


def exact_percentiles(df: DataFrame, group_cols: list[str], value_col: str, probs: dict[str, float], weight_col: str | None = None) -> DataFrame:
    """Linear-interpolation percentiles (as ``percentile`` / ``quantile_cont``) per group; a row counts ``weight_col`` times.

    Returns group columns plus one column per entry of ``probs`` (name -> probability). Null groups are groups.
    """
    weight = F.col(weight_col) if weight_col else F.lit(1)
    counts = (df.filter(F.col(value_col).isNotNull()).groupBy(*group_cols, F.col(value_col).cast("double").alias("_v"))
              .agg(F.sum(weight).cast("long").alias("_c")))

    def joined(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
        """Inner join on the group columns, null-safe, and ``more``; those of ``left`` stay."""
        keys = [*group_cols, *more]
        right = right.withColumnsRenamed({c: f"_g_{c}" for c in keys})
        on = F.lit(True)
        for c in keys:
            on = on & (F.col(c).eqNullSafe(F.col(f"_g_{c}")) if c in group_cols else F.col(c) == F.col(f"_g_{c}"))
        return left.join(right, on).drop(*[f"_g_{c}" for c in keys])

    def before(*keys: str, order: str, n: str) -> Column:
        rows = Window.partitionBy(*group_cols, *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(rows), F.lit(0))

    # Logarithmic buckets first, so that no outlier widens them; a group has at most 64 an octave.
    binned = with_bucket(counts, "_v", "_b")
    bins = binned.groupBy(*group_cols, "_b").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    bins = bins.select("*", before(order="_b", n="_n").alias("_before"), F.sum("_n").over(Window.partitionBy(*group_cols)).alias("_total"))
    wanted = []
    for name, p in probs.items():
        h = (F.col("_total") - 1) * F.lit(p)
        lo = F.floor(h).cast("long")
        for side, pos in ((0, lo), (1, F.least(lo + 1, F.col("_total") - 1))):
            wanted.append(F.struct(F.lit(name).alias("name"), pos.alias("pos"), (h - lo).alias("frac"), F.lit(side).alias("side")))
    inside_bin = F.filter(F.array(*wanted), lambda w: (w["pos"] >= F.col("_before")) & (w["pos"] < F.col("_before") + F.col("_n")))
    # Two positions per probability: the picks stay few per group.
    picks = bins.withColumn("w", F.explode(inside_bin)).select(*group_cols, "_b", "_before", "_low", "_high", "w.*")
    # Then ``BINS`` equal bins between the least and the greatest value of each bucket that holds a wanted position.
    chosen = picks.select(*group_cols, "_b", "_before", "_low", "_high").distinct()
    part = F.when(F.col("_high") > F.col("_low"), F.least(F.lit(BINS - 1), F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * BINS))).otherwise(0)
    inside = joined(binned, chosen, "_b").withColumn("_p", part.cast("int")).select(*group_cols, "_b", "_p", "_v", "_c", "_before")
    parts = inside.groupBy(*group_cols, "_b", "_p").agg(F.sum("_c").alias("_n"), F.max("_before").alias("_before"))
    parts = parts.withColumn("_from", F.col("_before") + before("_b", order="_p", n="_n")).drop("_before")
    placed = joined(picks.drop("_before", "_low", "_high"), parts, "_b").filter(
        (F.col("pos") >= F.col("_from")) & (F.col("pos") < F.col("_from") + F.col("_n")))
    chosen = placed.select(*group_cols, "_b", "_p", "_from").distinct()
    ranked = joined(inside.drop("_before"), chosen, "_b", "_p")
    ranked = ranked.select(*group_cols, "_b", "_p", "_v", "_c", (F.col("_from") + before("_b", "_p", order="_v", n="_c")).alias("_at"))
    hit = joined(placed.drop("_from", "_n"), ranked, "_b", "_p").filter((F.col("pos") >= F.col("_at")) & (F.col("pos") < F.col("_at") + F.col("_c")))
    per = hit.groupBy(*group_cols, "name").agg(
        F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("_hi"),
        F.max("frac").alias("_f"))
    per = per.withColumn("v", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f"))
    return per.groupBy(*group_cols).pivot("name", list(probs)).agg(F.first("v"))


def latency_summary(requests: DataFrame, group_cols: list[str]) -> DataFrame:
    """Count, avg, min, median, p90, p95, p99, max of latency_ms per group."""
    basic = requests.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("latency_ms").alias("avg_ms"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"))
    pct = exact_percentiles(requests, group_cols, "latency_ms",
                            {"p50_ms": 0.5, "p90_ms": 0.9, "p95_ms": 0.95, "p99_ms": 0.99})
    return basic.join(pct, group_cols, "left")


def latency_sketch(requests: DataFrame, group_cols: list[str]) -> DataFrame:
    """E3 for scale: as ``latency_summary``'s percentiles, estimated from mergeable sketches."""
    return sketch_quantiles(sketch(requests, group_cols, "latency_ms"), group_cols, {"p50_ms": 0.5, "p90_ms": 0.9, "p95_ms": 0.95, "p99_ms": 0.99})


def minute_sketches(requests: DataFrame, group_cols: list[str]) -> DataFrame:
    """(minute, groups, bucket, c): a sketch per minute, which any window of minutes merges; its size does not grow with the traffic."""
    return sketch(requests.withColumn("minute", _minute("ts")), ["minute", *group_cols], "latency_ms")


def p95_from_sketches(states: DataFrame, group_cols: list[str], minutes: int = 5) -> DataFrame:
    """(window_start, groups, n, p95_ms) over sliding windows of ``minutes`` minutes that hold a request, from sketches per minute."""
    rows = states.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(minutes - 1))))
    rows = rows.withColumn("window_start", F.expr("minute - make_dt_interval(0, 0, _k, 0)")).drop("_k", "minute")
    keys = ["window_start", *group_cols]
    return sketch_quantiles(merge(rows, keys), keys, {"p95_ms": 0.95})


def rank_error(requests: DataFrame, estimates: DataFrame, group_cols: list[str], probs: dict[str, float]) -> DataFrame:
    """Per group and estimate: how far the share of values below it, or up to it, is from the probability (0 where it lies between)."""
    groups = estimates.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], *probs)
    on = F.lit(True)
    for c in group_cols:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    v = F.col("latency_ms")
    shares = requests.filter(v.isNotNull()).join(groups, on).groupBy(*group_cols).agg(
        *[F.avg((v < F.col(n)).cast("double")).alias(f"_{n}_a") for n in probs],
        *[F.avg((v <= F.col(n)).cast("double")).alias(f"_{n}_z") for n in probs])
    error = [F.greatest(F.lit(0.0), F.col(f"_{n}_a") - p, F.lit(p) - F.col(f"_{n}_z")).alias(n) for n, p in probs.items()]
    return shares.select(*group_cols, *error)


def request_rates(requests: DataFrame, group_cols: list[str]) -> DataFrame:
    """Requests, duration, requests/s, failure rate (status >= 400) and check pass rate; 0 when idle."""
    agg = requests.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status_code") >= 400).alias("failed"),
        F.count_if(F.col("check_passed")).alias("checks_passed"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    dur = (F.unix_micros(F.col("last_ts").cast("timestamp_ltz")) - F.unix_micros(F.col("first_ts").cast("timestamp_ltz"))) / 1e6
    return agg.select(
        *group_cols, "requests",
        dur.alias("duration_s"),
        F.coalesce(F.try_divide(F.col("requests").cast("double"), dur), F.lit(0.0)).alias("rps"),
        F.coalesce(F.try_divide(F.col("failed").cast("double"), F.col("requests")), F.lit(0.0)).alias("fail_rate"),
        F.coalesce(F.try_divide(F.col("checks_passed").cast("double"), F.col("requests")), F.lit(0.0)).alias("check_rate"))


def stage_ended_well() -> Column:
    """An aggregate over all requests of a stage: the share of 5xx answers stays under the failure limit."""
    return F.count_if(F.col("status_code") >= 500) / F.count(F.lit(1)) < FAIL_RATE_MAX


def stage_verdict(stats: DataFrame, targets: DataFrame) -> DataFrame:
    """E5: PASS iff p95 <= target, fail rate < 1 %, checks >= 99 %, achieved >= 95 % of the target
    rate, no dropped iterations and the stage itself succeeded."""
    j = stats.join(targets, "stage", "inner")
    ok = ((F.col("p95_ms") <= F.col("p95_target_ms")) & (F.col("fail_rate") < FAIL_RATE_MAX)
          & (F.col("check_rate") >= CHECK_RATE_MIN) & (F.col("rps") >= F.col("target_rps") * ACHIEVED_RATE_MIN)
          & (F.coalesce(F.col("dropped"), F.lit(0)) == 0) & F.coalesce(F.col("stage_ok"), F.lit(True)))
    return j.withColumn("verdict", F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")))


def _minute(ts: str):
    return F.date_trunc("minute", F.col(ts).cast("timestamp_ltz")).cast("timestamp_ntz")


def _every_window(seen: DataFrame, group_cols: list[str]) -> DataFrame:
    """All minutes from a group's first to its last window_start: as many rows as minutes pass."""
    span = seen.groupBy(*group_cols).agg(F.min("window_start").alias("_a"), F.max("window_start").alias("_z"))
    return span.select(*group_cols, F.explode(F.sequence("_a", "_z", F.expr("INTERVAL 1 MINUTE"))).alias("window_start"))


def minute_counts(requests: DataFrame, group_cols: list[str]) -> DataFrame:
    """(minute, groups, latency_ms, c, e): requests and 5xx answers per minute and latency, the base of the windows below."""
    return requests.groupBy(_minute("ts").alias("minute"), *group_cols, "latency_ms").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(F.col("status_code") >= 500).alias("e"))


def rates_from_counts(base: DataFrame, group_cols: list[str]) -> DataFrame:
    """Requests per second over 1-minute windows; zero in idle minutes between a group's first and last."""
    keys = ["window_start", *group_cols]
    seen = base.groupBy(F.col("minute").alias("window_start"), *group_cols).agg(F.sum("c").alias("requests"))
    return (_every_window(seen, group_cols).join(seen, keys, "left").fillna(0, ["requests"])
            .select(*keys, "requests", (F.col("requests") / 60.0).alias("rps")))


def p95_from_counts(base: DataFrame, group_cols: list[str], minutes: int = 5) -> DataFrame:
    """Exact p95 and 5xx rate over ``minutes``-minute windows sliding by one; zero in idle windows between a group's first and
    last. The windows combine the counts of their minutes."""
    rows = base.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(minutes - 1))))
    rows = rows.withColumn("window_start", F.expr("minute - make_dt_interval(0, 0, _k, 0)")).drop("_k", "minute")
    keys = ["window_start", *group_cols]
    basic = rows.groupBy(*keys).agg(F.sum("c").alias("requests"), F.sum("e").alias("errors_5xx"))
    pct = exact_percentiles(rows, keys, "latency_ms", {"p95_ms": 0.95}, "c")
    out = _every_window(basic, group_cols).join(basic, keys, "left").join(pct, keys, "left").fillna(0, ["requests", "errors_5xx"]).fillna(0.0, ["p95_ms"])
    return out.withColumn("error_rate_5xx", F.coalesce(F.try_divide(F.col("errors_5xx").cast("double"), F.col("requests")), F.lit(0.0)))


def per_minute_rate(requests: DataFrame, group_cols: list[str]) -> DataFrame:
    """I4 batch twin: requests per second over tumbling 1-minute windows."""
    return rates_from_counts(minute_counts(requests, group_cols), group_cols)


def sliding_p95(requests: DataFrame, group_cols: list[str], minutes: int = 5) -> DataFrame:
    """I4 batch twin: exact p95 and 5xx rate over sliding windows."""
    return p95_from_counts(minute_counts(requests, group_cols), group_cols, minutes)


def _sustained(windows: DataFrame, breach, group_cols: list[str], minutes: int) -> DataFrame:
    """The windows at whose end a breach has held for ``minutes`` minutes: it shows in each of the last so many windows."""
    minute = F.floor(F.unix_seconds(F.col("window_start").cast("timestamp_ltz")) / 60)
    w = Window.partitionBy(*group_cols).orderBy("_m").rangeBetween(-(minutes - 1), 0)  # as many rows as minutes pass
    bad = windows.filter(breach).withColumn("_m", minute).withColumn("_held", F.count(F.lit(1)).over(w))
    return bad.filter(F.col("_held") >= minutes).drop("_m", "_held")


def alerts(windows: DataFrame, backlog: DataFrame, group_cols: list[str], minutes: int = 5) -> DataFrame:
    """Alert rows (alert, window_start, value): p95 > 300 ms and 5xx > 1 % held for ``minutes`` minutes, backlog > 100,000 and
    sync lag > 60 minutes."""
    p95 = _sustained(windows, F.col("p95_ms") > P95_TARGET_MS, group_cols, minutes).select(
        F.lit("search_p95_high").alias("alert"), "window_start", F.col("p95_ms").alias("value"))
    err = _sustained(windows, F.col("error_rate_5xx") > FAIL_RATE_MAX, group_cols, minutes).select(
        F.lit("error_rate_5xx_high").alias("alert"), "window_start", F.col("error_rate_5xx").alias("value"))
    bl = backlog.filter(F.col("unprocessed") > BACKLOG_MAX).select(
        F.lit("sync_backlog_high").alias("alert"), F.lit(None).cast("timestamp_ntz").alias("window_start"),
        F.col("unprocessed").cast("double").alias("value"))
    lag = backlog.filter(F.col("oldest_age_s") > LAG_MAX_S).select(
        F.lit("sync_lag_high").alias("alert"), F.lit(None).cast("timestamp_ntz").alias("window_start"),
        F.col("oldest_age_s").cast("double").alias("value"))
    return p95.unionByName(err).unionByName(bl).unionByName(lag)


def traffic_profile(queries: DataFrame) -> DataFrame:
    """Searches per hour of day, tier and radius, with the hour's share of all searches next to the expected share."""
    total = sum(HOUR_WEIGHTS)
    expected = F.element_at(F.array(*[F.lit(w / total) for w in HOUR_WEIGHTS]), F.col("hour") + 1)
    per = queries.groupBy(F.hour("requested_at").alias("hour"), "tier", "radius_m").agg(F.count(F.lit(1)).alias("searches"))
    hours = Window.partitionBy("hour")  # rows are tiers x radii
    every = per.agg(F.sum("searches")).scalar()
    return (per.withColumn("share", F.sum("searches").over(hours) / every).withColumn("expected_share", expected))

"""SQL functions, the stored request log, imports by file order, zones of any prefix length, quantile sketches, business views."""

import datetime as dt
import math
import os
import random

import numpy as np
from pyspark.sql import functions as F

from nearfield.functions import cursor, geo
from nearfield.functions.sql import register_functions
from nearfield.operators import business as B
from nearfield.operators import index as ix
from nearfield.operators import load as L
from nearfield.operators import sketch as K
from nearfield.operators import telemetry as T
from nearfield.sources.request_log_store import RequestLogStore


def test_sql_functions_equal_the_column_functions(spark):
    pick = random.Random(3)
    rows = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (89.9999, 179.9999), (-89.9999, -179.9999), (37.4991, 127.0313)]
    rows += [(pick.uniform(-90, 90), pick.uniform(-180, 180)) for _ in range(60)]
    texts = ["MjA", "", None, " ", "!!", "LTE", "YWJj", "MjA=", "MjA==", "OTk5OTk5OTk5OTk"]
    df = spark.createDataFrame([(a, o, texts[n % len(texts)], n) for n, (a, o) in enumerate(rows)], "lat double, lon double, cur string, n int")
    assert len(register_functions(spark)) == 14
    moved, dec = geo.move_point("lat", "lon", F.lit(500.0), F.radians("n")), cursor.decode_cursor(F.col("cur"))
    both = {
        **{f"nf_geohash_encode(lat, lon, {p})": geo.geohash_encode("lat", "lon", p) for p in (1, 5, 8, 12)},
        "nf_haversine_m(lat, lon, 10D, 20D)": geo.haversine_m("lat", "lon", F.lit(10.0), F.lit(20.0)),
        "nf_clamp_lat(lat)": geo.clamp_lat("lat"), "nf_wrap_lon(lon * 3)": geo.wrap_lon(F.col("lon") * 3),
        "nf_precision_for_radius(n * 700D)": geo.precision_for_radius(F.col("n") * 700.0),
        "nf_round_half_up(lat)": geo.round_half_up_long("lat"), "nf_encode_cursor(n)": cursor.encode_cursor("n"),
        "nf_move_point(lat, lon, 500D, radians(n))": moved, "nf_decode_cursor(cur)": dec["offset"],
    }
    wide = geo.with_neighbor_cells(df, "lat", "lon", 6, "nb").select(
        "nb", F.expr("nf_neighbor_cells(lat, lon, 6)").alias("nb_sql"), *[x for n, (sql, col) in enumerate(both.items()) for x in (F.expr(sql).alias(f"s{n}"), col.alias(f"c{n}"))])
    for r in wide.collect():
        assert sorted(r.nb) == sorted(r.nb_sql)
        for n, sql in enumerate(both):
            assert r[f"s{n}"] == r[f"c{n}"], sql
    assert (geo.cell_size_deg(6)) == tuple(spark.sql("SELECT nf_cell_width_deg(6), nf_cell_height_deg(6)").first())


def _files(root):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_sql_functions_have_no_interpreted_lambdas(spark):
    from nearfield.functions.sql import register_functions

    register_functions(spark)
    out = spark.range(3).selectExpr("nf_geohash_encode(id, id, 8)", "nf_neighbor_cells(id, id, 6)", "nf_haversine_m(id, id, 1D, 2D)", "nf_decode_cursor('MjA')")
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_retention_drops_days_by_their_folders(spark, tmp_path):
    rows = [(n, dt.datetime(2024, 1, 1 + n % 4, n % 24) if n else None) for n in range(400)]
    log = spark.createDataFrame(rows, "request_id int, ts timestamp_ntz")
    store = RequestLogStore(spark, f"{tmp_path}/log", log.schema)
    assert store.rows().count() == 0 and store.retain(dt.datetime(2024, 1, 1)) == []
    store.append(log.filter("request_id < 300 or request_id is null"), 0)
    for _ in range(2):  # a replayed batch
        store.append(log.filter("request_id >= 300"), 1)
    assert store.rows().count() == 400 and store.days() == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    before = _files(f"{tmp_path}/log")
    cutoff = dt.datetime(2024, 1, 3, 10)
    assert store.retain(cutoff) == ["2024-01-01", "2024-01-02"]
    kept = [(r.request_id, r.ts) for r in store.rows().collect()]
    assert sorted(kept) == sorted((i, t) for i, t in rows if t and t >= cutoff)
    after = _files(f"{tmp_path}/log")
    last = {f: m for f, m in before.items() if "day=2024-01-04" in f}
    assert last and {f: m for f, m in after.items() if "day=2024-01-04" in f} == last  # a kept day's files are as they were
    again = _files(f"{tmp_path}/log")
    assert store.retain(cutoff) == [] and _files(f"{tmp_path}/log") == again  # nothing is left to do
    assert store.retain(dt.datetime(2025, 1, 1)) == ["2024-01-03", "2024-01-04"] and store.rows().count() == 0


def test_a_day_of_which_a_batch_is_wholly_too_old(spark, tmp_path):
    rows = [(n, dt.datetime(2024, 1, 1, 2 if n < 5 else 20)) for n in range(10)]
    log = spark.createDataFrame(rows, "request_id int, ts timestamp_ntz")
    store = RequestLogStore(spark, f"{tmp_path}/log", log.schema)
    store.append(log.filter("request_id < 5"), 0)
    store.append(log.filter("request_id >= 5"), 1)
    assert store.retain(dt.datetime(2024, 1, 1, 12)) == []
    assert sorted((r.request_id, r.batch) for r in store.rows().collect()) == [(n, 1) for n in range(5, 10)]
    store.retain(dt.datetime(2024, 1, 1, 23))
    assert store.days() == []


def test_import_limit_takes_the_first_lines_of_the_files(spark, tmp_path):
    head = ",".join(L.BUSINESS_CSV_COLUMNS)
    lines, n = [], 0
    for f in range(3):
        with open(f"{tmp_path}/part-{f}.csv", "w") as out:
            out.write(head + "\n")
            for _ in range(400):
                n += 1
                bad = n % 10 == 0
                blank = n % 7 == 0
                out.write(f"{1000 - n},{'x' if bad else 5},{' ' if blank else 'shop'},food,,road,37.5,127.0,,ACTIVE,,\n")
                lines.append((1000 - n, bad, blank))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", before):  # many blocks a file, and one
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for limit in (9, 355, 500, 10_000) if size == "2k" else (10, 0):
                taken, seen = [], 0
                for i, bad, blank in lines:
                    if limit and seen == limit:
                        break
                    seen += not bad
                    taken.append((i, bad, blank))
                good, rejects = L.import_csv(spark, str(tmp_path), limit)
                assert sorted(r.source_id for r in good.collect()) == sorted(i for i, bad, blank in taken if not bad and not blank), (size, limit)
                assert sorted(int(r.raw_id) for r in rejects.collect()) == sorted(i for i, bad, blank in taken if bad or blank)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_zone_proposals_count_what_no_dense_child_explains(spark):
    cells = {"wydm6bb": 30, "wydm6bc": 8, "wydm6c0": 9, "wydm700": 4, "u000000": 3, None: 5}
    rows = [(n, c and c + "x") for n, c in enumerate(c for c, k in cells.items() for _ in range(k))]
    index = spark.createDataFrame(rows, "business_id int, geohash string")
    got = {(r.cell, r.precision, r.own) for r in ix.zone_proposals(index, 10).collect()}
    assert got == {("wydm6bb", 7, 30), ("wydm6", 5, 17)}
    config = ix.proposed_config(ix.zone_proposals(index, 10))
    zones = {r.geohash: (r.hz_prefix, r.hz_radius_limit, r.is_hot) for r in ix.attach_longest_zone(index, config).collect()}
    assert zones == {"wydm6bbx": ("wydm6bb", 300, True), "wydm6bcx": ("wydm6", 5000, True), "wydm6c0x": ("wydm6", 5000, True),
                     "wydm700x": (None, None, False), "u000000x": (None, None, False), None: (None, None, False)}
    assert ix.attach_longest_zone(index, config.limit(0)).filter("is_hot").count() == 0


def test_zones_of_two_limits_and_beyond_the_broadcast(spark, monkeypatch):
    config = spark.createDataFrame([("wydm", "a", 500, True), ("wydm", "b", 300, True), ("w", "c", 900, True), ("wydm6", "d", 100, False), ("ail", "e", 1, True)],
                                   "geohash_prefix string, description string, radius_limit int, is_active boolean")
    rows = spark.createDataFrame([("wydm6bcc",), ("wy000000",), ("w",), ("",), ("ail00000",)], "geohash string")
    want = {"wydm6bcc": ("wydm", 300), "wy000000": ("w", 900), "w": ("w", 900), "": (None, None), "ail00000": (None, None)}
    for bound in (ix.BROADCAST_ZONES, 1):
        monkeypatch.setattr(ix, "BROADCAST_ZONES", bound)
        assert {r.geohash: (r.hz_prefix, r.hz_radius_limit) for r in ix.attach_longest_zone(rows, config).collect()} == want


VALUES = [0.0, -0.0, 1.0, 2.0, 4.0, 0.5, 1.0000000001, 0.9999999999999999, 1023.9999999999999, 1024.0, 1e-300, 1e300, 5e-324, -3.7, -1e9, float("inf"), float("-inf")]


def test_buckets_are_ordered_and_near_their_values(spark):
    df = K.with_bucket(spark.createDataFrame([(v,) for v in [*VALUES, float("nan"), None]], "v double"), "v")
    rows = df.select("v", "bucket", K.bucket_value(F.col("bucket")).alias("m")).collect()
    known = [r for r in rows if r.v is not None and not math.isnan(r.v)]
    by_value = sorted(known, key=lambda r: r.v)
    assert [r.bucket for r in by_value] == sorted(r.bucket for r in known)
    for r in known:
        assert r.m == r.v if math.isinf(r.v) or r.v == 0 else abs(r.m - r.v) <= abs(r.v) * K.RELATIVE_ERROR * (1 + 1e-12) or abs(r.v) < 1e-307
    nan = [r for r in rows if r.v is not None and math.isnan(r.v)][0]
    assert nan.bucket > max(r.bucket for r in known) and math.isnan(nan.m) and [r.bucket for r in rows if r.v is None] == [None]


def test_sketches_merge_and_keep_their_error(spark):
    pick = np.random.default_rng(5)
    values = np.concatenate([pick.lognormal(4, 2, 6000), pick.uniform(0, 1, 500), [1e12]]).tolist()
    df = spark.createDataFrame([(n % 7, v) for n, v in enumerate(values)] + [(0, None)], "part int, latency_ms double")
    probs = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99, "p100_ms": 1.0}
    whole = K.sketch_quantiles(K.sketch(df, [], "latency_ms"), [], probs).first()
    merged = K.sketch_quantiles(K.sketch(df, ["part"], "latency_ms").repartition(5), [], probs).first()
    assert whole == merged and whole.n == len(values)
    for name, p in probs.items():
        exact = float(np.quantile(values, p))
        assert abs(whole[name] - exact) <= exact * K.RELATIVE_ERROR * (1 + 1e-9)
    errors = T.rank_error(df, spark.createDataFrame([whole]), [], probs).first()
    assert max(errors) < 0.01


def test_percentiles_with_outliers_order_few_values(spark):
    """One timeout far off, and most values within a thousandth of each other: exact results, and no part that is ordered in one
    task holds more than a small share of the values."""
    pick = np.random.default_rng(8)
    values = np.concatenate([pick.uniform(1000, 1001, 60_000), pick.uniform(1, 5000, 5000), [1e12, -1e12]]).tolist()
    df = spark.createDataFrame([("a" if n % 2 else None, v) for n, v in enumerate(values)], "g string, latency_ms double")
    got = {r.g: r for r in T.exact_percentiles(df, ["g"], "latency_ms", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}).collect()}
    for g, part in (("a", values[1::2]), (None, values[0::2])):
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p0", 0.0), ("p100", 1.0)):
            assert got[g][name] == float(np.quantile(part, p)) or abs(got[g][name] - float(np.quantile(part, p))) < 1e-9
    in_bucket = K.with_bucket(df, "latency_ms").groupBy("g", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("latency_ms").alias("a"), F.max("latency_ms").alias("z"))
    most = in_bucket.orderBy(F.desc("n")).first()
    assert most.n > 20_000  # the bucket alone would be one large task
    inside = df.filter(F.col("latency_ms").between(most.a, most.z) & F.col("g").eqNullSafe(F.lit(most.g)))
    part = F.floor((F.col("latency_ms") - most.a) / (most.z - most.a) * T.BINS)
    assert inside.groupBy(part).count().agg(F.max("count")).first()[0] < most.n / 100


def test_business_views(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 5, "a", "c", None, "x", 1.0, 2.0, "ACTIVE", t, t, "wydm"), (2, 5, "b", "c", "p", "x", 1.0, 2.0, "DELETED", t, t, "wydm")]
    business = spark.createDataFrame(rows, "id long, owner_id long, name string, category string, phone string, address string, latitude double, longitude double, "
                                           "status string, created_at timestamp_ntz, updated_at timestamp_ntz, geohash string")
    assert B.business_view(business).columns == B.VIEW_COLUMNS and not {"geohash", "created_at"} & set(B.VIEW_COLUMNS)
    asked = spark.createDataFrame([(1,)] * 50 + [(2,), (3,), (None,)], "wanted long")
    assert [r.id for r in B.get_many(business, asked, "wanted").collect()] == [1]
    got = {r.id: (r.name, r.error) for r in B.get_one(business, asked, "wanted").collect()}
    assert got == {1: ("a", None), 2: (None, "business not found: 2"), 3: (None, "business not found: 3"), None: (None, "business not found: null")}
    assert B.get_one(business, asked.limit(0), "wanted").count() == 0

"""Stored index, exact percentiles, CSV load path, streams: several batches, replays, failing refreshes."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.operators import load as L
from nearfield.operators import quadtree as Q
from nearfield.operators import search as S
from nearfield.operators import sync as Y
from nearfield.operators import telemetry as T
from nearfield.session import work_dir
from nearfield.sources.fixtures import Fixtures
from nearfield.sources.index_store import IndexStore, bootstrap_index, read_index, write_index
from nearfield.streaming.sync_stream import HotZoneRefresher, start_sync_stream
from nearfield.streaming.telemetry_stream import run_telemetry_stream, start_telemetry_stream

from conftest import SF_SMALL
from test_flow import BIZ, LOG


def _rows(index):
    return sorted(tuple(r) for r in index.select(*ix.INDEX_COLUMNS).collect())


def test_prefix_lookup_prunes_the_stored_index(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)
    path = f"{tmp_path}/index"
    first = bootstrap_index(spark, path, fx.business, fx.hot_zone_config).rows()
    assert _rows(first) == _rows(ix.full_reindex(fx.business, fx.hot_zone_config))
    assert _rows(bootstrap_index(spark, path, fx.business.limit(0)).rows()) == _rows(first)
    plan = ix.prefix_lookup(read_index(spark, path), "wydm6")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gh4" in plan and "PushedFilters: [IsNotNull(geohash), StringStartsWith(geohash,wydm6)]" in plan
    write_index(first.limit(0), f"{tmp_path}/empty")
    assert bootstrap_index(spark, f"{tmp_path}/empty", fx.business).rows().count() == first.count()


def test_every_point_has_one_leaf(spark):
    fx = Fixtures(spark, SF_SMALL)
    index = ix.full_reindex(fx.business).unionByName(ix.index_rows(fx.business.limit(1), None).crossJoin(spark.range(200)).drop("id"))
    tree = Q.tree_of(index)
    cells = {(r.level, r.x, r.y): (r.n, r.leaf) for r in tree.cells.collect()}
    points = tree.points.groupBy(*Q.CELL).count().collect()
    assert sum(r["count"] for r in points) == index.count() == tree.points.count()
    assert {(r.level, r.x, r.y): r["count"] for r in points} == {k: n for k, (n, leaf) in cells.items() if leaf}
    for (level, x, y), (n, leaf) in cells.items():
        assert leaf == (n <= Q.LEAF_POINTS or level == Q.DEEPEST)
        assert level == Q.ROOT or not cells[level - 2, x >> 2, y >> 2][1]


def test_a_writer_that_dies_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    fx = Fixtures(spark, SF_SMALL)
    store = bootstrap_index(spark, f"{tmp_path}/index", fx.business, fx.hot_zone_config)
    before, moved = _rows(store.rows()), ix.index_rows(fx.business.limit(20).withColumn("latitude", F.lit(37.6)), fx.hot_zone_config)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # all rows are written, the manifest is not
        m.setattr(IndexStore, "_publish", dies)
        for work in (lambda: store.merge(moved.limit(0), moved), lambda: store.rebuild(moved)):
            with pytest.raises(RuntimeError):
                work()
    assert _rows(IndexStore(spark, store.path).rows()) == before
    store.merge(moved.limit(0), moved)  # goes on beside what the dead writer left
    ids = {r.business_id for r in moved.collect()}
    assert _rows(store.rows()) == sorted([r for r in before if r[0] not in ids] + _rows(moved))


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_merge_touches_only_its_prefixes(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)
    store = bootstrap_index(spark, f"{tmp_path}/index", fx.business, fx.hot_zone_config)
    index, files, live = _rows(store.rows()), _files(store.path), store.snapshot()
    one = next(r for r in index if r[5] == "wydm")
    gone = next(r for r in index if r[5] == "wydm" and r[0] != one[0])
    # One business moves from Gangnam to Busan, one is deleted: two prefixes of many.
    new = ix.index_rows(spark.createDataFrame([(one[0], 35.15768, 129.05938)], "id long, latitude double, longitude double"), fx.hot_zone_config)
    touched = store.merge(spark.createDataFrame([(gone[0],)], "business_id long"), new)
    assert touched == ["wy7b", "wydm"] and len({r[5] for r in index}) > 3
    after = _files(store.path)
    assert files.items() <= after.items()  # nothing is overwritten
    assert {f.split("gh4=")[1][:4] for f in after.keys() - files.keys()} == set(touched)
    now = store.snapshot()
    assert {k: v for k, v in now.points.items() if k[1] not in touched} == {k: v for k, v in live.points.items() if k[1] not in touched}
    want = sorted([r for r in index if r[0] not in (one[0], gone[0])] + _rows(new))
    assert _rows(store.rows()) == want
    # Counts and leaves are those of an index built anew.
    fresh = Q.tree_of(store.rows())
    assert sorted(map(tuple, store.tree().cells.select(*Q.CELL, "n", "leaf").collect())) == sorted(map(tuple, fresh.cells.select(*Q.CELL, "n", "leaf").collect()))
    assert store.vacuum() > 0 and _rows(store.rows()) == want
    assert store.merge(new.select("business_id").limit(0), new.limit(0)) == [] and store.snapshot().version == now.version


def test_a_prefix_whose_last_row_goes_is_gone(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, 1, "n", "c", None, "a", lat, 127.0, "ACTIVE", t, t) for i, lat in ((1, 37.5), (2, 10.0))]
    store = bootstrap_index(spark, f"{tmp_path}/index", spark.createDataFrame(rows, BIZ))
    store.merge(spark.createDataFrame([(2,), (99,)], "business_id long"), store.rows().limit(0))
    assert [r.business_id for r in store.rows().collect()] == [1] and len(store.snapshot().points) == 1


def test_search_over_a_stale_stored_index(spark, tmp_path):
    """Businesses deleted after the index was written count in 'candidates' and not in 'active' mode."""
    fx = Fixtures(spark, SF_SMALL)
    store = IndexStore(spark, f"{tmp_path}/index")
    store.rebuild(ix.index_rows(fx.business, fx.hot_zone_config))
    q = fx.search_query.filter(F.col("query_id") % 25 == 0)
    for mode in ("active", "candidates"):
        plain = [d.collect() for d in S.nearby_search(q, ix.index_rows(fx.business, None), fx.business, limit=20, offset=20, count_mode=mode)]
        kept = [d.collect() for d in S.nearby_search(q, store.tree(), fx.business, limit=20, offset=20, count_mode=mode)]
        assert [sorted(map(str, x)) for x in plain] == [sorted(map(str, x)) for x in kept] and plain[0]


def test_percentiles_of_one_value_in_most_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("g")).alias("g"),
                                  F.when(F.col("id") % 10 < 9, F.lit(300.0)).otherwise(F.col("id") / 3).alias("v"))
    got = {r.g: (r.a, r.b) for r in T.exact_percentiles(df, ["g"], "v", {"a": 0.5, "b": 0.97}).collect()}
    want = {r.g: (r.p[0], r.p[1]) for r in df.groupBy("g").agg(F.expr("percentile(v, array(0.5, 0.97))").alias("p")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-9 for k in want for x, y in zip(got[k], want[k]))


def test_csv_load_path(spark, tmp_path):
    path = f"{tmp_path}/b.csv"
    with open(path, "w", newline="") as f:
        f.write("id,owner_id,name,category,phone,address,latitude,longitude,geohash,status,created_at,updated_at\n")
        f.write("1,2,Cafe,CAFE,,Seoul,37.5,127.0,wydm6dt2\r,DELETED\r,2024-01-02T03:04:05+00:00,2024-01-03 03:04:05\n")
        f.write("2,2,Bar,BAR,02-1,Seoul,37.5,127.0,wydm6dt3,odd,bad,2024-01-03 03:04:05.123\n")
    rows = L.clean_staged(L.read_business_csv(spark, path)).orderBy("id").collect()
    assert [(r.phone, r.geohash, r.status, r.created_at, r.updated_at) for r in rows] == [
        (None, "wydm6dt2", "DELETED", dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 3, 3, 4, 5)),
        ("02-1", "wydm6dt3", "ACTIVE", None, dt.datetime(2024, 1, 3, 3, 4, 5))]
    staged = L.clean_staged(L.read_business_csv(spark, path)).withColumn("id", F.col("id").cast("long"))
    merged = L.upsert_business(staged, staged.withColumn("geohash", F.lit("new")).withColumn("created_at", F.lit(None).cast("timestamp_ntz")))
    assert {r.geohash for r in merged.collect()} == {"new"} and merged.filter("id = 1").first().created_at is not None


def _log_files(spark, folder, batches):
    t = dt.datetime(2024, 1, 1)
    for n, rows in enumerate(batches):
        spark.createDataFrame([(i, b, kind, done, t) for i, b, kind, done in rows], LOG).coalesce(1).write.mode("append").parquet(folder)
        for k, name in enumerate(sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))):
            os.utime(f"{folder}/{name}", (1_700_000_000 + n, 1_700_000_000 + n)) if k == n else None


def test_sync_stream_batches_replay_and_current_rows(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    row = lambda i, lat, status: (i, 1, "n", "c", None, "a", lat, 127.0, status, t, t)
    state = {"rows": [row(1, 37.5, "ACTIVE"), row(2, 37.5, "ACTIVE")]}
    loader = lambda: spark.createDataFrame(state["rows"], BIZ)
    cfg = Fixtures(spark, SF_SMALL).hot_zone_config
    folder, root = f"{tmp_path}/log", f"{tmp_path}/sync"
    events = lambda: spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder)
    base = ix.full_reindex(spark.createDataFrame([], BIZ), cfg)
    _log_files(spark, folder, [[(1, 1, "CREATED", False)], [(2, 2, "CREATED", False), (3, 1, "UPDATED", False)]])
    stream = start_sync_stream(spark, events(), loader, base, lambda: cfg, root=root)
    stream.query.awaitTermination()
    assert {r.business_id for r in stream.index().collect()} == {1, 2}
    stream.fold()
    folded = sorted(stream.index().collect())
    # The rows change; a restart with one more file sees them as they are now and goes on from the checkpoint.
    state["rows"] = [row(1, 37.6, "ACTIVE"), row(2, 37.5, "DELETED")]
    spark.createDataFrame([(4, 1, "UPDATED", False, t), (5, 2, "UPDATED", False, t)], LOG).coalesce(1).write.mode("append").parquet(folder)
    again = start_sync_stream(spark, events(), loader, base, lambda: cfg, root=root)
    again.query.awaitTermination()
    assert folded != sorted(again.index().collect())
    assert sorted(again.index().collect()) == sorted(ix.full_reindex(loader(), cfg).collect())


def test_sync_stream_files_in_any_order_give_the_batch_result(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    business = spark.createDataFrame([(i, 1, "n", "c", None, "a", 37.5, 127.0, "DELETED" if i == 4 else "ACTIVE", t, t) for i in (1, 2, 3, 4)], BIZ)
    files = [[(10, 1, "UPDATED", False), (7, 3, "DELETED", False)], [(5, 1, "DELETED", False), (9, 2, "DELETED", False)],
             [(6, 3, "CREATED", False), (8, 2, "CREATED", False), (10, 1, "UPDATED", False), (3, 4, "CREATED", False)]]
    log = spark.createDataFrame([(*r, t) for f in files for r in f], LOG).dropDuplicates(["id"])
    cfg = Fixtures(spark, SF_SMALL).hot_zone_config
    base = ix.full_reindex(business, cfg)
    want = _rows(Y.sync_index(base, log, business, None, cfg)[0])
    assert [r[0] for r in want] == [1]
    for n, order in enumerate(([0, 1, 2], [2, 1, 0])):
        folder = f"{tmp_path}/log{n}"
        _log_files(spark, folder, [files[k] for k in order])
        events = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder)
        stream = start_sync_stream(spark, events, lambda: business, base, lambda: cfg, root=f"{tmp_path}/sync{n}")
        stream.query.awaitTermination()
        assert _rows(stream.index()) == want
        stream.fold()
        assert _rows(stream.index()) == want


def test_no_batch_yet_leaves_the_base_index(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)
    base = ix.full_reindex(fx.business, fx.hot_zone_config)
    folder = f"{tmp_path}/log"
    _log_files(spark, folder, [[(1, 1, "CREATED", True)]])  # processed already
    stream = start_sync_stream(spark, spark.readStream.schema(LOG).parquet(folder), lambda: fx.business, base, lambda: fx.hot_zone_config, root=f"{tmp_path}/s")
    stream.query.awaitTermination()
    assert stream.index().count() == base.count()


def test_failing_config_refresh_keeps_the_last_good_one(spark, tmp_path):
    good = Fixtures(spark, SF_SMALL).hot_zone_config
    broken = lambda: spark.read.schema(good.schema).parquet(f"{tmp_path}/missing")
    loads = [lambda: good, broken]
    refresher = HotZoneRefresher(lambda: loads.pop(0)())
    assert refresher.current().count() == refresher.current().count() == good.count()
    with pytest.raises(Exception):
        HotZoneRefresher(broken).current()


def test_work_dir_lies_in_the_checkpoint_folder(spark):
    assert work_dir(spark, "x").startswith(spark.sparkContext.getCheckpointDir())


def test_telemetry_stream_counts_files_in_reverse_time_order(spark, tmp_path):
    req = Fixtures(spark, SF_SMALL).request_log
    at = F.unix_micros(F.col("ts").cast("timestamp_ltz"))
    one, two = req.agg(F.percentile_approx(at, [0.33, 0.66])).first()[0]
    folder, known = f"{tmp_path}/log", set()
    # Three files: the engine filters a batch by the watermark of the batch before, which knows the times of those still earlier.
    for n, part in enumerate((at > two, (at > one) & (at <= two), at <= one)):
        req.filter(part).coalesce(1).write.mode("append").parquet(folder)
        new = {f for f in os.listdir(folder) if f.endswith(".parquet")} - known
        for f in new:
            os.utime(f"{folder}/{f}", (1_700_000_000 + 100 * n,) * 2)
        known |= new
    stream = spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = run_telemetry_stream(spark, stream, f"{tmp_path}/s").cache()
    assert len([d for d in os.listdir(f"{tmp_path}/s/out") if d.startswith("batch_id=")]) >= 3
    for metric, twin, value in (("rps_1m", T.per_minute_rate(req, ["endpoint"]), "rps"), ("p95_5m", T.sliding_p95(req, ["endpoint"]), "p95_ms")):
        want = sorted((r.window_start, r.endpoint, r.requests, round(r[value], 6)) for r in twin.collect())
        assert sorted((r.window_start, r.endpoint, r.requests, round(r.value, 6)) for r in got.filter(F.col("metric") == metric).collect()) == want
    assert got.filter("metric = 'rps_1m'").agg(F.sum("requests")).first()[0] == req.count()


def test_telemetry_emits_closed_minutes_while_it_runs(spark, tmp_path):
    schema = Fixtures(spark, SF_SMALL).request_log.select("ts", "endpoint", "latency_ms", "status_code").schema
    folder = f"{tmp_path}/log"
    os.makedirs(folder)

    def arrive(minutes):
        rows = spark.createDataFrame([(f"2024-01-01 00:{m:02d}:30", "search", 5.0, 200) for m in minutes], "ts string, endpoint string, latency_ms double, status_code int")
        rows.select(*(F.col(f.name).cast(f.dataType) for f in schema)).coalesce(1).write.mode("append").parquet(folder)
        stream.query.processAllAvailable()

    stream = start_telemetry_stream(spark, spark.readStream.schema(schema).parquet(folder), f"{tmp_path}/s", {"processingTime": "1 second"}, delay=10, fold_every=2)
    counts = lambda rows: sorted((r.window_start.minute, r.requests) for r in rows.collect())
    try:
        arrive([0, 0, 1, 3])
        assert stream.closed().count() == 0 and stream.query.isActive  # the latest minute is 3: nothing is ten minutes old
        arrive([12])
        assert counts(stream.closed()) == [(0, 2), (1, 1)]
        arrive([20, 14])
        assert counts(stream.closed()) == counts(stream.emitted()) == [(0, 2), (1, 1), (3, 1)]  # each minute once
        arrive([1, 15])  # late: minute 1 is emitted again, whole; minutes still open are not
        assert counts(stream.closed()) == [(0, 2), (1, 2), (3, 1)] and counts(stream.emitted()) == [(0, 2), (1, 1), (1, 2), (3, 1)]
        arrive([40])
        assert counts(stream.closed()) == [(0, 2), (1, 2), (3, 1), (12, 1), (14, 1), (15, 1), (20, 1)]
    finally:
        stream.query.stop()
    assert [d for d in os.listdir(f"{tmp_path}/s/folded") if d.startswith("upto=")]


def test_a_session_without_a_checkpoint_folder_gets_one(spark, tmp_path):
    """In a process of its own: the setting is fixed once a session runs, and a defaults file may hold it."""
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from nearfield.session import build_session, ensure_checkpoint_dir\n"
            "s = build_session('local[1]', 1); assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "print(ensure_checkpoint_dir(s)); assert s.range(3).checkpoint().count() == 3\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"SPARK_CONF_DIR": str(tmp_path), "NEARFIELD_DRIVER_MEMORY": "1g"}
    done = subprocess.run([sys.executable, "-c", code, root], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "nearfield-ckpt-" in done.stdout, done.stderr[-2000:]


def test_late_server_errors_fail_a_stage(spark):
    rows = [(n, 500 if n >= 9_800 else 200, s) for s in ("low", "mid") for n in range(10_000 if s == "low" else 9_800)]
    got = spark.createDataFrame(rows, "request_id int, status_code int, stage string").groupBy("stage").agg(T.stage_ended_well().alias("ok")).collect()
    assert {r.stage: r.ok for r in got} == {"low": False, "mid": True}

"""The reference's end-to-end flow as batch jobs: create, search (not yet synced), sync, search,
replace, delete, sync, search; plus replay safety of a sync batch."""

import datetime as dt

from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.operators import mutate as M
from nearfield.operators import search as S
from nearfield.operators import sync as Y

MUT = ("mutation_id long, op string, business_id long, owner_id long, name string, category string, "
       "phone string, address string, latitude double, longitude double, requested_at timestamp_ntz")
LOG = "id long, business_id long, change_type string, processed boolean, created_at timestamp_ntz"
BIZ = ("id long, owner_id long, name string, category string, phone string, address string, latitude double, "
       "longitude double, status string, created_at timestamp_ntz, updated_at timestamp_ntz")


def _cut(*dfs):
    """Each step of a real job writes its tables; checkpoints stand in for that between steps."""
    return [d.checkpoint() for d in dfs]


def _search(spark, index, business):
    q = spark.createDataFrame([(1, 37.4991, 127.0313, 500)], "query_id long, latitude double, longitude double, radius_m int")
    page, _ = S.nearby_search(q, index, business)
    return [r.id for r in page.collect()]


def test_create_sync_search_delete(spark):
    t = dt.datetime(2024, 1, 1)
    business = spark.createDataFrame([], BIZ)
    log = spark.createDataFrame([], LOG)
    index = ix.full_reindex(business)
    create = spark.createDataFrame([(1, "CREATE", 1, 12, "Cafe Alpha", "CAFE", "02-1234-5678", "Seoul", 37.4991, 127.0313, t)], MUT)
    business, acc, rej = _cut(*M.apply_mutations(business, create))
    log, = _cut(log.unionByName(M.mutation_log(acc, log).drop("mutation_id")))
    assert rej.count() == 0
    assert _search(spark, index, business) == []          # not synced yet
    index, log, _ = _cut(*Y.sync_index(index, log, business))
    assert _search(spark, index, business) == [1]
    t2 = t + dt.timedelta(minutes=1)
    more = spark.createDataFrame([
        (2, "UPDATE", 1, 12, "Cafe Alpha 2", "CAFE", None, "Seoul", 37.4991, 127.0313, t2),
        (3, "DELETE", 1, None, None, None, None, None, None, None, t2),
        (4, "UPDATE", 1, 12, "again", "CAFE", None, "Seoul", 37.4991, 127.0313, t2),
    ], MUT)
    business, acc, rej = _cut(*M.apply_mutations(business, more))
    assert [r.reason for r in rej.collect()] == ["NOT_FOUND"]
    row = business.filter(F.col("id") == 1).first()
    assert (row.name, row.status, row.phone) == ("Cafe Alpha 2", "DELETED", None)  # an update replaces nulls too
    log, = _cut(log.unionByName(M.mutation_log(acc, log).drop("mutation_id")))
    index, log, _ = _cut(*Y.sync_index(index, log, business))
    assert _search(spark, index, business) == []
    assert log.filter(~F.col("processed")).count() == 0


def test_sync_replay_is_idempotent(spark):
    from nearfield.sources.fixtures import Fixtures
    from conftest import SF_SMALL
    fx = Fixtures(spark, SF_SMALL)
    index0 = ix.full_reindex(fx.business, fx.hot_zone_config)
    once, _, _ = Y.sync_index(index0, fx.change_log, fx.business, None, fx.hot_zone_config)
    twice, _, _ = Y.sync_index(once, fx.change_log, fx.business, None, fx.hot_zone_config)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_empty_backlog(spark):
    log = spark.createDataFrame([], LOG)
    row = Y.sync_backlog(log, "2024-01-01 00:00:00").first()
    assert (row.unprocessed, row.oldest_age_s) == (0, 0)


def test_bad_payloads_are_rejected_and_change_nothing(spark):
    t = dt.datetime(2024, 1, 1)
    business = spark.createDataFrame([(1, 1, "n", "c", "02-1", "a", 37.5, 127.0, "ACTIVE", t, t)], BIZ)
    rows = [(1, "UPDATE", 1, 1, "n", "c", None, "a", 95.0, 127.0, t), (2, "UPDATE", 1, 1, "\t\n", "c", None, "a", 37.0, 127.0, t),
            (3, "CREATE", 2, None, "n", "c", None, "a", 37.0, 127.0, t), (4, "UPDATE", 2, 1, "n", "c", None, "a", 37.0, 127.0, t)]
    snap, acc, rej = M.apply_mutations(business, spark.createDataFrame(rows, MUT))
    assert {r.mutation_id: r.reason for r in rej.collect()} == {
        1: "latitude out of range", 2: "name blank", 3: "owner_id required", 4: "NOT_FOUND"}
    assert acc.count() == 0 and snap.first().phone == "02-1" and snap.count() == 1


def test_missing_payload_columns_keep_their_value(spark):
    t = dt.datetime(2024, 1, 1)
    business = spark.createDataFrame([(1, 1, "n", "c", "02-1", "a", 37.5, 127.0, "ACTIVE", t, t)], BIZ)
    m = spark.createDataFrame([(1, "UPDATE", 1, 1, "new", "c", "a", 37.5, 127.0, t)], MUT.replace("phone string, ", ""))
    row = M.apply_mutations(business, m)[0].first()
    assert (row.name, row.phone) == ("new", "02-1")


def test_zone_move_and_reindex_after_draining(spark):
    """A stale index whose businesses moved within and between zones: draining gives the rebuilt index."""
    t = dt.datetime(2024, 1, 1)
    cfg = spark.createDataFrame([("wydm", "hot", 500, True)], "geohash_prefix string, description string, radius_limit int, is_active boolean")
    old = spark.createDataFrame([(i, 1, "n", "c", None, "a", 37.4991, 127.0313, "ACTIVE", t, t) for i in (1, 2, 3, 4)], BIZ)
    moved = spark.createDataFrame([(1, 1, "n", "c", None, "a", 35.15768, 129.05938, "ACTIVE", t, t), (2, 1, "n", "c", None, "a", 37.4995, 127.0319, "ACTIVE", t, t),
                                   (3, 1, "n", "c", None, "a", 37.4991, 127.0313, "DELETED", t, t), (4, 1, "n", "c", None, "a", 37.4991, 127.0313, "ACTIVE", t, t)], BIZ)
    log = spark.createDataFrame([(i, i, "UPDATED", False, t) for i in (1, 2, 3)], LOG)
    index, _, _ = Y.sync_index(ix.full_reindex(old, cfg), log, moved, None, cfg)
    assert sorted(index.collect()) == sorted(ix.full_reindex(moved, cfg).collect())
    assert {r.business_id: r.zone for r in index.collect()} == {1: "normal", 2: "hot", 4: "hot"}
    assert ix.audit_index(moved, index, cfg).count() == 0
    assert {r.problem for r in ix.audit_index(moved, ix.full_reindex(old, cfg), cfg).collect()} == {"wrong_geohash", "not_active"}

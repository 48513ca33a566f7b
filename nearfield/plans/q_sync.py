"""Index upkeep queries: poll, latest event, sync, reindex, audit, backlog, density."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.operators import sync as Y
from nearfield.plans.catalog import register
from nearfield.plans.sqlgen import geohash_select, with_fixtures
from nearfield.session import Scratch, work_dir
from nearfield.sources.fixtures import Fixtures, coord
from nearfield.sources.index_store import bootstrap_index

POLL_N = 2000
NOW = "2024-06-01 00:00:00"


def _idx_sql(src: str) -> str:
    """Index rows (business_id, geohash, latitude, longitude, zone) for rows of ``src`` (id, latitude, longitude)."""
    gh = geohash_select(f"(SELECT id AS business_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM {src})",
                        "latitude", "longitude", 8)
    return f"""SELECT g.business_id, g.geohash, g.latitude, g.longitude,
  CASE WHEN z.geohash_prefix IS NOT NULL THEN 'hot' ELSE 'normal' END AS zone, substr(g.geohash, 1, 4) AS gh4
FROM ({gh}) g LEFT JOIN (SELECT * FROM hot_zone_config WHERE is_active) z ON substr(g.geohash, 1, 4) = z.geohash_prefix"""


@register("poll_batch", with_fixtures(["change_log"], f"""
SELECT id, business_id, change_type, created_at FROM change_log WHERE NOT processed ORDER BY id LIMIT {POLL_N}
"""))
def poll_batch(spark, sf_dir):
    """the 2000 oldest unprocessed change events (batch size is the operator's parameter)."""
    return Y.poll_batch(Fixtures(spark, sf_dir).change_log, POLL_N).select("id", "business_id", "change_type", "created_at")


@register("latest_event", with_fixtures(["change_log"], """
SELECT business_id, max(id) AS event_id, arg_max(change_type, id) AS change_type FROM change_log WHERE NOT processed GROUP BY business_id
"""))
def latest_event(spark, sf_dir):
    """net event per business over the whole unprocessed backlog."""
    return Y.latest_event(Y.poll_batch(Fixtures(spark, sf_dir).change_log, None))


@register("full_reindex", with_fixtures(["business", "hot_zone_config"], _idx_sql("business WHERE status = 'ACTIVE'")))
def full_reindex(spark, sf_dir):
    """The index rebuilt from every active business, routed to hot / normal zones."""
    fx = Fixtures(spark, sf_dir)
    return ix.full_reindex(fx.business, fx.hot_zone_config)


def _synced_sql(idx0: str) -> str:
    """The index ``idx0`` after the whole backlog is applied."""
    return f"""idx0 AS ({idx0}),
lat AS (SELECT business_id, arg_max(change_type, id) AS change_type FROM change_log WHERE NOT processed GROUP BY business_id),
dec AS (SELECT l.business_id, l.change_type <> 'DELETED' AND b.status = 'ACTIVE' AS upsert FROM lat l LEFT JOIN business b ON b.id = l.business_id),
ups AS ({_idx_sql("business WHERE id IN (SELECT business_id FROM dec WHERE upsert)")})
SELECT * FROM idx0 WHERE business_id NOT IN (SELECT business_id FROM dec)
UNION ALL SELECT * FROM ups
"""


def _synced(spark, sf_dir, business):
    """A stored index of ``business`` after the backlog is merged into it."""
    fx = Fixtures(spark, sf_dir)
    store = bootstrap_index(spark, work_dir(spark, f"index-{uuid.uuid4().hex}"), business, fx.hot_zone_config)
    Y.sync_store(store, fx.change_log, fx.business, None, fx.hot_zone_config)
    return store.rows()


@register("sync_index", with_fixtures(["business", "hot_zone_config", "change_log"], _synced_sql(_idx_sql("business WHERE status = 'ACTIVE'"))))
def sync_index(spark, sf_dir):
    """Drain the whole unprocessed change log into the stored index built from the business table."""
    return _synced(spark, sf_dir, Fixtures(spark, sf_dir).business)


# Where each business was before: at the place of the customer six numbers on, so that most moved, many into another zone.
_OLD = {axis: coord("(id + 6)", axis) for axis in ("lat", "lon")}


@register("zone_moves", with_fixtures(["business", "hot_zone_config", "change_log"], f"""
old_business AS (SELECT * REPLACE ({_OLD['lat']} AS latitude, {_OLD['lon']} AS longitude) FROM business),
{_synced_sql(_idx_sql("old_business WHERE status = 'ACTIVE'"))}"""))
def zone_moves(spark, sf_dir):
    """A stored index of where the businesses were, with the backlog drained into it: rows move within and between zones,
    one row stays per business, and businesses without an event stay where they were."""
    business = Fixtures(spark, sf_dir).business
    return _synced(spark, sf_dir, business.withColumns({"latitude": F.expr(_OLD["lat"]), "longitude": F.expr(_OLD["lon"])}))


@register("sync_log", with_fixtures(["change_log"], f"""
SELECT id, business_id, change_type, true AS processed, created_at
FROM change_log
"""))
def sync_log(spark, sf_dir):
    """The change log after it is drained."""
    fx = Fixtures(spark, sf_dir)
    index0 = ix.full_reindex(fx.business, fx.hot_zone_config)
    _, new_log, _ = Y.sync_index(index0, fx.change_log, fx.business, None, fx.hot_zone_config)
    return new_log.select("id", "business_id", "change_type", "processed", "created_at")


@register("sync_backlog", with_fixtures(["change_log"], f"""
SELECT count(*) AS unprocessed, coalesce(CAST(floor(epoch(TIMESTAMP '{NOW}') - epoch(min(created_at))) AS BIGINT), 0) AS oldest_age_s
FROM change_log WHERE NOT processed
"""))
def sync_backlog(spark, sf_dir):
    """Backlog size and age of the oldest unprocessed event at a fixed 'now'."""
    return Y.sync_backlog(Fixtures(spark, sf_dir).change_log, NOW)


_AUDIT_INDEX = """
idx AS (
  SELECT * REPLACE (CASE WHEN business_id % 43 = 0 THEN CASE zone WHEN 'hot' THEN 'normal' ELSE 'hot' END ELSE zone END AS zone)
  FROM all_idx WHERE business_id % 37 <> 0
  UNION ALL
  SELECT business_id, substr(geohash, 1, 7) || 'z' AS geohash, latitude, longitude, zone, gh4 FROM all_idx WHERE business_id % 41 = 0
  UNION ALL
  SELECT business_id + 10000000, geohash, latitude, longitude, zone, gh4 FROM all_idx WHERE business_id % 47 = 0)
"""


@register("audit_index", with_fixtures(["business", "hot_zone_config"], f"""
all_idx AS ({_idx_sql("business")}),
{_AUDIT_INDEX.strip()},
exp AS ({_idx_sql("business WHERE status = 'ACTIVE'")}),
per AS (SELECT business_id, count(*) AS index_rows, min(geohash) AS idx_geohash, min(zone) AS idx_zone FROM idx GROUP BY business_id),
j AS (SELECT coalesce(p.business_id, b.id) AS business_id, p.index_rows, p.idx_geohash, p.idx_zone, b.status
      FROM per p FULL OUTER JOIN business b ON b.id = p.business_id)
SELECT business_id, problem, CAST(coalesce(index_rows, 0) AS BIGINT) AS index_rows FROM (
  SELECT j.*, CASE
    WHEN index_rows IS NULL AND status = 'ACTIVE' THEN 'missing'
    WHEN index_rows IS NOT NULL AND status IS NULL THEN 'unknown'
    WHEN index_rows IS NOT NULL AND status <> 'ACTIVE' THEN 'not_active'
    WHEN index_rows > 1 THEN 'duplicate'
    WHEN idx_geohash <> e.geohash THEN 'wrong_geohash'
    WHEN idx_zone <> e.zone THEN 'wrong_zone' END AS problem
  FROM j LEFT JOIN exp e USING (business_id)) WHERE problem IS NOT NULL
"""))
def audit_index(spark, sf_dir):
    """Audit an index loaded generator-style (deleted rows included) with rows missing for ids divisible by 37, stale extra
    rows for ids divisible by 41, the other zone for ids divisible by 43 and rows of unknown ids beside those divisible by 47."""
    fx = Fixtures(spark, sf_dir)
    all_idx = ix.index_rows(fx.business, fx.hot_zone_config)
    stale = all_idx.filter(F.col("business_id") % 41 == 0).withColumn(
        "geohash", F.concat(F.substring("geohash", 1, 7), F.lit("z")))
    other = F.when(F.col("zone") == "hot", F.lit("normal")).otherwise(F.lit("hot"))
    moved = all_idx.filter(F.col("business_id") % 37 != 0).withColumn("zone", F.when(F.col("business_id") % 43 == 0, other).otherwise(F.col("zone")))
    unknown = all_idx.filter(F.col("business_id") % 47 == 0).withColumn("business_id", F.col("business_id") + 10_000_000)
    idx = moved.unionByName(stale).unionByName(unknown)
    return ix.audit_index(fx.business, idx, fx.hot_zone_config)


@register("cell_density", with_fixtures(["business", "hot_zone_config"], f"""
SELECT substr(geohash, 1, 5) AS cell, count(*) AS businesses, count(*) >= 100 AS propose_hot
FROM ({_idx_sql("business WHERE status = 'ACTIVE'")}) GROUP BY substr(geohash, 1, 5)
"""))
def cell_density(spark, sf_dir):
    """Active businesses per precision-5 cell; cells with 100+ are proposed as hot zones."""
    fx = Fixtures(spark, sf_dir)
    return ix.cell_density(ix.full_reindex(fx.business, fx.hot_zone_config), 5, 100)


@register("densest_cells", with_fixtures(["business", "hot_zone_config"], f"""
SELECT substr(geohash, 1, 6) AS cell, count(*) AS businesses
FROM ({_idx_sql("business WHERE status = 'ACTIVE'")}) GROUP BY substr(geohash, 1, 6) ORDER BY businesses DESC, cell LIMIT 10
"""))
def densest_cells(spark, sf_dir):
    """E7 report: the ten densest precision-6 cells (a top-k report)."""
    fx = Fixtures(spark, sf_dir)
    return ix.densest_cells(ix.full_reindex(fx.business, fx.hot_zone_config), 6, 10)


DENSE = 20
_PROPOSED = f"""
i AS ({_idx_sql("business WHERE status = 'ACTIVE'")}),
c7 AS (SELECT substr(geohash, 1, 7) AS cell, count(*) AS own FROM i GROUP BY 1),
c6 AS (SELECT substr(cell, 1, 6) AS cell, CAST(sum(own) AS BIGINT) AS own FROM c7 WHERE own < {DENSE} GROUP BY 1),
c5 AS (SELECT substr(cell, 1, 5) AS cell, CAST(sum(own) AS BIGINT) AS own FROM c6 WHERE own < {DENSE} GROUP BY 1),
c4 AS (SELECT substr(cell, 1, 4) AS cell, CAST(sum(own) AS BIGINT) AS own FROM c5 WHERE own < {DENSE} GROUP BY 1),
dense AS (SELECT cell, length(cell) AS p, own FROM (SELECT * FROM c7 UNION ALL SELECT * FROM c6 UNION ALL SELECT * FROM c5 UNION ALL SELECT * FROM c4)
          WHERE own >= {DENSE})
"""


@register("zone_proposals", with_fixtures(["business", "hot_zone_config"], _PROPOSED + "SELECT cell, CAST(p AS INTEGER) AS precision, own FROM dense"))
def zone_proposals(spark, sf_dir):
    """E7 over precisions 7 to 4: cells with 20 or more active businesses that no denser cell below explains."""
    fx = Fixtures(spark, sf_dir)
    return ix.zone_proposals(ix.full_reindex(fx.business, fx.hot_zone_config), DENSE)


@register("longest_prefix_zones", with_fixtures(["business", "hot_zone_config"], _PROPOSED + """
SELECT i.business_id, i.geohash, max_by(d.cell, d.p) AS hz_prefix,
  CAST(CASE max(d.p) WHEN 7 THEN 300 WHEN 6 THEN 1000 WHEN 5 THEN 5000 WHEN 4 THEN 20000 END AS INTEGER) AS radius_limit, max(d.p) IS NOT NULL AS is_hot
FROM i LEFT JOIN dense d ON starts_with(i.geohash, d.cell) GROUP BY i.business_id, i.geohash
"""))
def longest_prefix_zones(spark, sf_dir):
    """S8 / D4 with longest prefixes: every active business under the zone of its longest proposed prefix."""
    fx = Fixtures(spark, sf_dir)
    index = ix.full_reindex(fx.business, fx.hot_zone_config)
    config = Scratch(spark, "zones").written(ix.proposed_config(ix.zone_proposals(index, DENSE)))
    out = ix.attach_longest_zone(index.select("business_id", "geohash"), config)
    return out.select("business_id", "geohash", "hz_prefix", F.col("hz_radius_limit").alias("radius_limit"), "is_hot")

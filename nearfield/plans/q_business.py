"""Bulk load and mutation queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from nearfield.operators import business as B
from nearfield.operators import index as ix
from nearfield.operators import load as L
from nearfield.operators import mutate as M
from nearfield.plans.catalog import register
from nearfield.plans.sqlgen import geohash_select, with_fixtures
from nearfield.session import work_dir
from nearfield.sources.fixtures import Fixtures

_CLEAN_SQL = """
SELECT id, owner_id, name, category, CASE WHEN length(phone) > 0 THEN phone END AS phone, address, latitude, longitude,
  coalesce(nullif(regexp_extract(status, '^(ACTIVE|DELETED)\\r*$', 1), ''), 'ACTIVE') AS status,
  TRY_CAST(nullif(regexp_extract(created_at_raw, '^(\\d{4}-\\d{2}-\\d{2})[T ](\\d{2}:\\d{2}:\\d{2})', 1) || ' ' || regexp_extract(created_at_raw, '^(\\d{4}-\\d{2}-\\d{2})[T ](\\d{2}:\\d{2}:\\d{2})', 2), ' ') AS TIMESTAMP) AS created_at
FROM raw_business"""

# The payload rules of C6 in SQL, over columns of the same names.
PAYLOAD_RULES = """nullif(concat_ws('; ',
      CASE WHEN owner_id IS NULL THEN 'owner_id required' END,
      CASE WHEN regexp_full_match(coalesce(name, ''), '[\\x09-\\x0D\\x20]*') THEN 'name blank' END,
      CASE WHEN regexp_full_match(coalesce(category, ''), '[\\x09-\\x0D\\x20]*') THEN 'category blank' END,
      CASE WHEN regexp_full_match(coalesce(address, ''), '[\\x09-\\x0D\\x20]*') THEN 'address blank' END,
      CASE WHEN latitude IS NULL OR latitude NOT BETWEEN -90 AND 90 THEN 'latitude out of range' END,
      CASE WHEN longitude IS NULL OR longitude NOT BETWEEN -180 AND 180 THEN 'longitude out of range' END,
      CASE WHEN length(name) > 120 THEN 'name too long' END, CASE WHEN length(category) > 40 THEN 'category too long' END,
      CASE WHEN length(phone) > 32 THEN 'phone too long' END, CASE WHEN length(address) > 255 THEN 'address too long' END), '')"""


@register("clean_staged", with_fixtures(["raw_business"], _CLEAN_SQL))
def clean_staged(spark, sf_dir):
    """A2 over the dirty staging rows."""
    raw = Fixtures(spark, sf_dir).raw_business
    out = L.clean_staged(raw, "created_at_raw", None)
    return out.select("id", "owner_id", "name", "category", "phone", "address", "latitude", "longitude", "status", "created_at")


_IMPORT_SQL = """
parsed AS (
  SELECT id AS raw_id,
    CASE WHEN regexp_full_match(trim(id, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[+-]?[0-9]+') THEN TRY_CAST(trim(id, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS BIGINT) END AS source_id,
    CASE WHEN regexp_full_match(trim(owner_id, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[+-]?[0-9]+') THEN TRY_CAST(trim(owner_id, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS BIGINT) END AS owner_id,
    trim(name, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS name, trim(category, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS category, NULLIF(trim(phone, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') AS phone, trim(address, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS address,
    CASE WHEN regexp_full_match(trim(latitude, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim(latitude, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS DOUBLE) END AS latitude,
    CASE WHEN regexp_full_match(trim(longitude, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim(longitude, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS DOUBLE) END AS longitude,
    latitude AS raw_latitude, longitude AS raw_longitude, owner_id AS raw_owner_id
  FROM raw_business),
checked AS (
  SELECT *, coalesce(
    NULLIF(concat_ws('; ',
      CASE WHEN source_id IS NULL THEN 'invalid id' END,
      CASE WHEN raw_owner_id IS NOT NULL AND owner_id IS NULL THEN 'invalid owner_id' END,
      CASE WHEN raw_latitude IS NOT NULL AND latitude IS NULL THEN 'invalid latitude' END,
      CASE WHEN raw_longitude IS NOT NULL AND longitude IS NULL THEN 'invalid longitude' END), ''),
    """ + PAYLOAD_RULES + """) AS reason
  FROM parsed)
"""


@register("import_businesses", with_fixtures(["raw_business"], _IMPORT_SQL + """
SELECT source_id, owner_id, name, category, phone, address, latitude, longitude FROM checked WHERE reason IS NULL
"""))
def import_businesses(spark, sf_dir):
    """A3 accepted rows (whole file, limit 0)."""
    acc, _ = L.import_businesses(Fixtures(spark, sf_dir).raw_business)
    return acc


@register("import_rejects", with_fixtures(["raw_business"], _IMPORT_SQL + """
SELECT raw_id, reason FROM checked WHERE reason IS NOT NULL
"""))
def import_rejects(spark, sf_dir):
    """A3 rejected rows with their reason (the service would abort on the first)."""
    _, rej = L.import_businesses(Fixtures(spark, sf_dir).raw_business)
    return rej


IMPORT_LIMIT = 100


@register("import_limit", with_fixtures(["raw_business"], _IMPORT_SQL + f""",
parsed_rows AS (
  SELECT * FROM checked WHERE source_id IS NOT NULL AND NOT coalesce(regexp_matches(reason, 'invalid (id|owner_id|latitude|longitude)'), false)
  ORDER BY CAST(raw_id AS BIGINT) LIMIT {IMPORT_LIMIT})
SELECT source_id, owner_id, name, category, phone, address, latitude, longitude FROM parsed_rows WHERE reason IS NULL
"""))
def import_limit(spark, sf_dir):
    """A3 with ``limit``: of the staging rows, exported to a folder of CSV files in id order, those accepted up to the 100th line that
    can be read, in file order."""
    raw = Fixtures(spark, sf_dir).raw_business.withColumn("created_at", F.col("created_at_raw"))
    for c in set(L.BUSINESS_CSV_COLUMNS) - set(raw.columns):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    path = work_dir(spark, f"csv-{uuid.uuid4().hex}")
    (raw.select(*L.BUSINESS_CSV_COLUMNS, F.col("id").cast("long").alias("_n")).repartitionByRange(8, "_n").sortWithinPartitions("_n").drop("_n")
     .write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    accepted, _ = L.import_csv(spark, path, IMPORT_LIMIT)
    return accepted


_VIEW = "id, owner_id, name, category, phone, address, latitude, longitude, status, updated_at"


@register("business_view", with_fixtures(["business"], f"SELECT {_VIEW} FROM business"))
def business_view(spark, sf_dir):
    """Every business as a client sees it."""
    return B.business_view(Fixtures(spark, sf_dir).business)


@register("get_business", with_fixtures(["business", "change_log"], f"""
asked AS (SELECT DISTINCT business_id AS id FROM change_log)
SELECT a.id, {', '.join('b.' + c for c in _VIEW.split(', ')[1:])}, CASE WHEN b.id IS NULL THEN 'business not found: ' || a.id END AS error
FROM asked a LEFT JOIN (SELECT * FROM business WHERE status = 'ACTIVE') b USING (id)
"""))
def get_business(spark, sf_dir):
    """The view of every business that the change log names, or why there is none."""
    fx = Fixtures(spark, sf_dir)
    return B.get_one(fx.business, fx.change_log, "business_id")


_INCOMING_SQL = """
incoming AS (
  SELECT CASE WHEN id % 2 = 0 THEN id ELSE id + 5000000 END AS id, owner_id, name, category, phone, address,
    latitude, longitude, status, created_at, created_at AS updated_at
  FROM (SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(owner_id AS BIGINT) AS owner_id, name, category, phone, address,
          TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude, status, CAST(created_at AS TIMESTAMP) AS created_at
        FROM (""" + _CLEAN_SQL + """)))
"""


def _incoming(fx):
    c = L.clean_staged(fx.raw_business, "created_at_raw", None)
    return c.select(
        F.when(F.col("id").cast("long") % 2 == 0, F.col("id").cast("long")).otherwise(F.col("id").cast("long") + 5000000).alias("id"),
        F.col("owner_id").try_cast("long").alias("owner_id"), "name", "category", "phone", "address",
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"),
        "status", "created_at", F.col("created_at").alias("updated_at"))


@register("upsert_business", with_fixtures(["business", "raw_business"], _INCOMING_SQL + """
SELECT coalesce(i.id, c.id) AS id,
  CASE WHEN i.id IS NOT NULL THEN i.owner_id ELSE c.owner_id END AS owner_id,
  CASE WHEN i.id IS NOT NULL THEN i.name ELSE c.name END AS name,
  CASE WHEN i.id IS NOT NULL THEN i.category ELSE c.category END AS category,
  CASE WHEN i.id IS NOT NULL THEN i.phone ELSE c.phone END AS phone,
  CASE WHEN i.id IS NOT NULL THEN i.address ELSE c.address END AS address,
  CASE WHEN i.id IS NOT NULL THEN i.latitude ELSE c.latitude END AS latitude,
  CASE WHEN i.id IS NOT NULL THEN i.longitude ELSE c.longitude END AS longitude,
  CASE WHEN i.id IS NOT NULL THEN i.status ELSE c.status END AS status,
  coalesce(c.created_at, i.created_at) AS created_at,
  CASE WHEN i.id IS NOT NULL THEN i.updated_at ELSE c.updated_at END AS updated_at
FROM business c FULL OUTER JOIN incoming i ON c.id = i.id
"""))
def upsert_business(spark, sf_dir):
    """A4: the cleaned staging rows merged into the business table (even ids update, odd ids insert)."""
    fx = Fixtures(spark, sf_dir)
    return L.upsert_business(fx.business, _incoming(fx))


_IDX_ACTIVE = geohash_select("(SELECT id AS business_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM business WHERE status = 'ACTIVE')",
                             "latitude", "longitude", 8)
_IDX_ALL = geohash_select("(SELECT id AS business_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM business)",
                          "latitude", "longitude", 8)


@register("load_index", with_fixtures(["business"], f"""
SELECT DISTINCT geohash, business_id FROM (
  SELECT geohash, business_id FROM ({_IDX_ACTIVE})
  UNION ALL
  SELECT geohash, business_id FROM ({_IDX_ALL}))
"""))
def load_index(spark, sf_dir):
    """A5: insert-ignore of the generator-style index (every business, deleted ones too) into the active index."""
    fx = Fixtures(spark, sf_dir)
    current = ix.full_reindex(fx.business, fx.hot_zone_config)
    incoming = ix.index_rows(fx.business, fx.hot_zone_config)
    return L.load_index(current, incoming)


@register("reconcile_counts", with_fixtures(["business", "change_log"], f"""
SELECT * FROM (
  SELECT 'business_count' AS metric, count(*) AS value FROM business
  UNION ALL SELECT 'geohash_index_count', count(*) FROM ({_IDX_ACTIVE})
  UNION ALL SELECT 'change_log_unprocessed', count(*) FROM change_log WHERE NOT processed) ORDER BY metric
"""))
def reconcile_counts(spark, sf_dir):
    """A6 after a full load: business rows, index rows, unprocessed change events."""
    fx = Fixtures(spark, sf_dir)
    return L.reconcile_counts(fx.business, ix.full_reindex(fx.business, fx.hot_zone_config), fx.change_log)


@register("assign_ids", with_fixtures(["business", "mutation"], """
SELECT mutation_id, (SELECT max(id) FROM business) + row_number() OVER (ORDER BY mutation_id) AS new_id
FROM mutation WHERE op = 'CREATE'
"""))
def assign_ids(spark, sf_dir):
    """Fresh business ids for every CREATE, continuing after the largest id, in mutation order."""
    fx = Fixtures(spark, sf_dir)
    creates = fx.mutation.filter(F.col("op") == "CREATE").select("mutation_id")
    return L.assign_ids(creates, fx.business, "mutation_id").select("mutation_id", "new_id")


_DECIDE_SQL = """
m0 AS (SELECT m.*, b.status AS cur_status FROM (SELECT *, CASE WHEN op <> 'DELETE' THEN """ + PAYLOAD_RULES + """ END AS bad FROM mutation) m
       LEFT JOIN business b ON b.id = m.business_id),
cr AS (SELECT business_id, min(mutation_id) AS create_at FROM m0 WHERE op = 'CREATE' AND cur_status IS NULL AND bad IS NULL GROUP BY business_id),
m1 AS (SELECT m0.*, cr.create_at, CASE WHEN cur_status = 'ACTIVE' THEN -1 ELSE cr.create_at END AS alive_from
       FROM m0 LEFT JOIN cr USING (business_id)),
dl AS (SELECT business_id, min(mutation_id) AS delete_at FROM m1 WHERE op = 'DELETE' AND mutation_id > alive_from GROUP BY business_id),
dec AS (
  SELECT m1.*, dl.delete_at, bad IS NULL AND coalesce(
    (op = 'CREATE' AND cur_status IS NULL AND mutation_id = create_at)
    OR (op IN ('UPDATE', 'DELETE') AND alive_from IS NOT NULL AND mutation_id > alive_from
        AND (dl.delete_at IS NULL OR mutation_id <= dl.delete_at)), false) AS accepted
  FROM m1 LEFT JOIN dl USING (business_id))
"""


@register("mutation_rejects", with_fixtures(["business", "mutation"], _DECIDE_SQL + """
SELECT mutation_id, business_id, op, CASE WHEN bad IS NOT NULL THEN bad WHEN op = 'CREATE' THEN 'ALREADY_EXISTS' ELSE 'NOT_FOUND' END AS reason
FROM dec WHERE NOT accepted
"""))
def mutation_rejects(spark, sf_dir):
    """I1 rejects: bad payloads, UPDATE/DELETE of unknown or deleted businesses, or after their delete."""
    fx = Fixtures(spark, sf_dir)
    _, _, rej = M.apply_mutations(fx.business, fx.mutation)
    return rej


@register("apply_mutations", with_fixtures(["business", "mutation"], _DECIDE_SQL + """,
acc AS (SELECT * FROM dec WHERE accepted),
fin AS (
  SELECT business_id,
    arg_max(CASE WHEN op <> 'DELETE' THEN {'owner_id': owner_id, 'name': name, 'category': category, 'phone': phone, 'address': address, 'latitude': latitude, 'longitude': longitude} END,
            CASE WHEN op <> 'DELETE' THEN mutation_id END) AS w,
    arg_max(op, mutation_id) AS last_op, arg_max(requested_at, mutation_id) AS last_at,
    arg_max(requested_at, CASE WHEN op = 'CREATE' THEN mutation_id END) AS created_req
  FROM acc GROUP BY business_id),
snap AS (
  SELECT id, owner_id, name, category, phone, address, latitude, longitude, status, created_at, updated_at
  FROM business WHERE id NOT IN (SELECT business_id FROM fin)
  UNION ALL
  SELECT f.business_id AS id,
    CASE WHEN f.w IS NOT NULL THEN f.w.owner_id ELSE c.owner_id END,
    CASE WHEN f.w IS NOT NULL THEN f.w.name ELSE c.name END,
    CASE WHEN f.w IS NOT NULL THEN f.w.category ELSE c.category END,
    CASE WHEN f.w IS NOT NULL THEN f.w.phone ELSE c.phone END, CASE WHEN f.w IS NOT NULL THEN f.w.address ELSE c.address END,
    CASE WHEN f.w IS NOT NULL THEN f.w.latitude ELSE c.latitude END,
    CASE WHEN f.w IS NOT NULL THEN f.w.longitude ELSE c.longitude END,
    CASE WHEN f.last_op = 'DELETE' THEN 'DELETED' ELSE 'ACTIVE' END,
    coalesce(c.created_at, f.created_req), f.last_at
  FROM fin f LEFT JOIN business c ON c.id = f.business_id)
SELECT id, owner_id, name, category, phone, address, latitude, longitude, status, created_at, updated_at, geohash
FROM (""" + geohash_select("(SELECT *, round(latitude, 6) AS glat, round(longitude, 6) AS glon FROM snap)", "glat", "glon", 8) + """)
"""))
def apply_mutations(spark, sf_dir):
    """The business table after every mutation, with geohash(8)."""
    fx = Fixtures(spark, sf_dir)
    snap, _, _ = M.apply_mutations(fx.business, fx.mutation)
    return snap


@register("mutation_log", with_fixtures(["business", "mutation", "change_log"], _DECIDE_SQL + """
SELECT (SELECT max(id) FROM change_log) + row_number() OVER (ORDER BY mutation_id) AS id, business_id,
  CASE op WHEN 'CREATE' THEN 'CREATED' WHEN 'UPDATE' THEN 'UPDATED' ELSE 'DELETED' END AS change_type,
  false AS processed, requested_at AS created_at, mutation_id
FROM dec WHERE accepted
"""))
def mutation_log(spark, sf_dir):
    """I1 change events: one per accepted mutation, appended after the existing log."""
    fx = Fixtures(spark, sf_dir)
    _, acc, _ = M.apply_mutations(fx.business, fx.mutation)
    return M.mutation_log(acc, fx.change_log)

"""Queries over the scalar functions and request validation."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from nearfield.functions import geo
from nearfield.functions.cursor import decode_cursor, encode_cursor
from nearfield.functions.sql import register_functions
from nearfield.operators import index as ix
from nearfield.operators import validate as V
from nearfield.plans.catalog import register
from nearfield.plans.sqlgen import axis_cell, clamp_lat, cursor, d, geohash_select, hav, wrap_lon, with_fixtures
from nearfield.session import work_dir
from nearfield.sources.fixtures import Fixtures
from nearfield.sources.index_store import IndexStore, bootstrap_index
from nearfield.sources.request_log_store import RequestLogStore

_BUSINESS_GH = geohash_select(
    geohash_select(geohash_select("(SELECT id, latitude, longitude FROM business)", "latitude", "longitude", 8, "gh8"),
                   "latitude", "longitude", 6, "gh6"), "latitude", "longitude", 3, "gh3")


@register("geohash_encode", with_fixtures(["business"], f"SELECT id, gh8, gh6, gh3 FROM ({_BUSINESS_GH})"))
def geohash_encode(spark, sf_dir):
    """B2 at precisions 8, 6 and 3 for every business."""
    b = Fixtures(spark, sf_dir).business.select("id", "latitude", "longitude")
    for p, name in ((8, "gh8"), (6, "gh6"), (3, "gh3")):
        b = geo.with_geohash(b, "latitude", "longitude", p, name)
    return b.select("id", "gh8", "gh6", "gh3")


def _neighbors_sql(p: int) -> str:
    lon_d, lat_d = geo.cell_size_deg(p)
    parts = []
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            lat = clamp_lat(f"(latitude + {d(dy * lat_d)})")
            lon = wrap_lon(f"(longitude + {d(dx * lon_d)})")
            parts.append(f"SELECT query_id, cell FROM ({geohash_select('search_query', lat, lon, p, 'cell')})")
    return "\nUNION\n".join(parts)


@register("neighbor_cells", with_fixtures(["search_query"], f"""
SELECT query_id, list_sort(list(cell)) AS cells, CAST(count(*) AS INTEGER) AS n_cells FROM ({_neighbors_sql(6)}) GROUP BY query_id
"""))
def neighbor_cells(spark, sf_dir):
    """B3 at precision 6 for every search point: sorted distinct cells and their number."""
    q = Fixtures(spark, sf_dir).search_query.select("query_id", "latitude", "longitude")
    q = geo.with_neighbor_cells(q, "latitude", "longitude", 6, "nb")
    return q.select("query_id", F.array_sort("nb").alias("cells"), F.size("nb").cast("int").alias("n_cells"))


def _covering_sql() -> str:
    R = geo.EARTH_RADIUS_M
    box = f"""
SELECT query_id, latitude AS lat, longitude AS lon, radius_m AS r,
  degrees(radius_m / {d(R)}) * {d(1.0001)} AS dlat,
  sin(radius_m / {d(R)}) / cos(radians(latitude)) AS ratio
FROM search_query"""
    box2 = f"""SELECT *, (lat + dlat >= 90 OR lat - dlat <= -90 OR ratio >= 1) AS pole,
  degrees(asin(least({d(1.0)}, ratio))) * {d(1.0001)} AS dlon FROM ({box})"""
    base = "CASE " + " ".join(f"WHEN r >= {d(geo._level_height_m(L))} THEN {L}" for L in range(1, 9)) + " ELSE 8 END"
    chosen = "1"
    for L in range(2, 9):
        w, h = geo.cell_size_deg(L)
        ny = f"(floor(dlat * 2 / {d(h)}) + 2)"
        nx = f"(CASE WHEN pole THEN {d(float(2 ** geo.lon_bits(L)))} ELSE floor(dlon * 2 / {d(w)}) + 2 END)"
        chosen = f"(CASE WHEN {L} <= ({base}) AND {nx} * {ny} <= {geo.MAX_CELLS_PER_QUERY} THEN {L} ELSE {chosen} END)"
    lvl = f"SELECT *, {chosen} AS level FROM ({box2})"
    rows = []
    for L in range(1, 9):
        nx = 2 ** geo.lon_bits(L)
        ylo = axis_cell(f"greatest({d(-90.0)}, lat - dlat)", -90.0, 180.0, geo.lat_bits(L))
        yhi = axis_cell(f"least({d(90.0)}, lat + dlat)", -90.0, 180.0, geo.lat_bits(L))
        xlo = f"CAST(floor((lon - dlon + 180) / 360 * {d(float(nx))}) AS BIGINT)"
        xhi = f"CAST(floor((lon + dlon + 180) / 360 * {d(float(nx))}) AS BIGINT)"
        xn = f"(CASE WHEN pole OR {xhi} - {xlo} + 1 >= {nx} THEN {nx} ELSE {xhi} - {xlo} + 1 END)"
        rows.append(f"SELECT query_id, level, {xn} AS x_cells, {yhi} - {ylo} + 1 AS y_cells FROM ({lvl}) WHERE level = {L}")
    return "\nUNION ALL\n".join(rows)


@register("covering_cells", with_fixtures(["search_query"], f"""
SELECT query_id, CAST(level AS INTEGER) AS level, CAST(x_cells * y_cells AS BIGINT) AS n_cells FROM ({_covering_sql()})
"""))
def covering_cells(spark, sf_dir):
    """Search level and number of covering cells per search point."""
    q = Fixtures(spark, sf_dir).search_query.select("query_id", "latitude", "longitude", "radius_m")
    cells = geo.with_covering_cells(q, "latitude", "longitude", "radius_m", "level", "x", "y")
    return cells.groupBy("query_id", "level").agg(F.count(F.lit(1)).alias("n_cells")).select(
        "query_id", F.col("level").cast("int").alias("level"), "n_cells")


@register("move_point", with_fixtures(["search_query"], f"""
SELECT query_id, round(lat, 6) AS moved_lat, round(lon, 6) AS moved_lon FROM (
  SELECT query_id, {clamp_lat('latitude + dlat')} AS lat, {wrap_lon('longitude + dlon')} AS lon FROM (
    SELECT query_id, latitude, longitude,
      radius_m * cos(radians(query_id % 360)) / {d(geo.METERS_PER_DEGREE_FLAT)} AS dlat,
      radius_m * sin(radians(query_id % 360)) / ({d(geo.METERS_PER_DEGREE_FLAT)} * greatest({d(geo.MIN_COS_LAT)}, cos(radians(latitude)))) AS dlon
    FROM search_query))
"""))
def move_point(spark, sf_dir):
    """Every search point moved by its radius at bearing (query_id mod 360) degrees."""
    q = Fixtures(spark, sf_dir).search_query
    m = geo.move_point("latitude", "longitude", F.col("radius_m"), F.radians(F.col("query_id") % 360))
    return q.select("query_id", F.round(m["latitude"], 6).alias("moved_lat"), F.round(m["longitude"], 6).alias("moved_lon"))


def _decode_sql(c: str) -> str:
    body = f"regexp_replace({c}, '=+$', '')"
    shape = (f"(regexp_full_match({c}, '[A-Za-z0-9_-]*={{0,2}}') AND length({body}) % 4 <> 1 "
             f"AND (NOT contains({c}, '=') OR length({c}) % 4 = 0))")
    padded = f"rpad({body}, CAST((length({body}) + 3) // 4 * 4 AS INTEGER), '=')"
    text = f"decode(from_base64(translate({padded}, '-_', '+/')))"
    val = f"(CASE WHEN {shape} AND regexp_full_match({text}, '[+-]?[0-9]+') THEN TRY_CAST({text} AS INTEGER) END)"
    blank = f"({c} IS NULL OR trim({c}) = '')"
    return (f"CASE WHEN {blank} THEN 0 WHEN {val} >= 0 THEN {val} END",
            f"CASE WHEN {blank} THEN NULL WHEN {val} >= 0 THEN NULL ELSE 'invalid cursor' END")


def _cursor_cols_sql():
    out = []
    for name, expr in (("good", "cursor"), ("bad", "cursor || '!'"), ("neg", "neg")):
        o, e = _decode_sql(expr)
        out.append(f"{o} AS {name}_offset, {e} AS {name}_error")
    return ", ".join(out)


@register("cursor_codec", with_fixtures(["search_query"], f"""
SELECT query_id, cursor, {_cursor_cols_sql()} FROM (
  SELECT query_id, {cursor('query_id % 250')} AS cursor, {cursor('-(query_id % 7)')} AS neg FROM search_query)
"""))
def cursor_codec(spark, sf_dir):
    """B9 round trip per search: encode an offset, decode it back, decode a corrupted and a negative cursor."""
    q = Fixtures(spark, sf_dir).search_query.select(
        "query_id", encode_cursor(F.col("query_id") % 250).alias("cursor"), encode_cursor(-(F.col("query_id") % 7)).alias("neg"))
    cols = []
    for name, c in (("good", F.col("cursor")), ("bad", F.concat(F.col("cursor"), F.lit("!"))), ("neg", F.col("neg"))):
        dec = decode_cursor(c)
        cols += [dec["offset"].alias(f"{name}_offset"), dec["error"].alias(f"{name}_error")]
    return q.select("query_id", "cursor", *cols)


@register("mask_coordinates", with_fixtures(["business"], f"""
SELECT id, round(latitude, 3) AS latitude, round(longitude, 3) AS longitude, gh5 FROM (
  {geohash_select('business', 'latitude', 'longitude', 5, 'gh5')})
"""))
def mask_coordinates(spark, sf_dir):
    """Coordinates kept to 3 decimals (about 100 m) and a precision-5 cell for logging."""
    b = Fixtures(spark, sf_dir).business.select("id", "latitude", "longitude")
    b = geo.with_geohash(b, "latitude", "longitude", 5, "gh5")
    return b.select("id", geo.mask_coordinate("latitude", 3).alias("latitude"),
                    geo.mask_coordinate("longitude", 3).alias("longitude"), "gh5")


# Every search with a latitude, limit and cursor partly spoiled by its id.
SEARCH_REQUESTS = f"""
SELECT query_id, CASE WHEN query_id % 31 = 0 THEN 95.0 ELSE latitude END AS latitude, longitude, CASE WHEN query_id % 29 = 0 THEN NULL ELSE radius_m END AS radius_m,
  CASE query_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 101 ELSE CAST(query_id % 100 + 1 AS INTEGER) END AS "limit",
  CASE query_id % 5 WHEN 0 THEN NULL WHEN 1 THEN {cursor('query_id % 150')} WHEN 2 THEN '!!' WHEN 3 THEN 'LTE' ELSE '' END AS cursor
FROM search_query"""


def requests(q):
    """SEARCH_REQUESTS in Spark."""
    n = F.col("query_id")
    return q.select(
        "query_id", F.when(n % 31 == 0, F.lit(95.0)).otherwise(F.col("latitude")).alias("latitude"), "longitude",
        F.when(n % 29 != 0, F.col("radius_m")).alias("radius_m"),
        F.when(n % 7 == 0, F.lit(None)).when(n % 7 == 1, F.lit(0)).when(n % 7 == 2, F.lit(101)).otherwise(n % 100 + 1).cast("int").alias("limit"),
        F.when(n % 5 == 0, F.lit(None).cast("string")).when(n % 5 == 1, encode_cursor(n % 150)).when(n % 5 == 2, F.lit("!!"))
         .when(n % 5 == 3, F.lit("LTE")).otherwise(F.lit("")).alias("cursor"))


def checked_sql(src: str) -> str:
    """The request rules of C1 over a SELECT of requests."""
    offset, error = _decode_sql("cursor")
    return f"""
  SELECT query_id, latitude, longitude, coalesce(radius_m, 5000) AS radius, coalesce("limit", 20) AS page_limit, "offset",
    nullif(concat_ws('; ',
      CASE WHEN latitude IS NULL OR latitude < -90 OR latitude > 90 THEN 'latitude out of range' END,
      CASE WHEN longitude IS NULL OR longitude < -180 OR longitude > 180 THEN 'longitude out of range' END,
      CASE WHEN coalesce(radius_m, 5000) < 100 OR coalesce(radius_m, 5000) > 50000 THEN 'radius out of range' END,
      CASE WHEN "limit" IS NOT NULL AND ("limit" < 1 OR "limit" > 100) THEN 'limit must be between 1 and 100' END,
      CASE WHEN cur_error IS NOT NULL THEN 'invalid cursor' END), '') AS reason
  FROM (SELECT *, {offset} AS "offset", {error} AS cur_error FROM ({src}))"""


@register("validate_search", with_fixtures(["search_query"], f"""
SELECT query_id, CAST(radius AS INTEGER) AS resolved_radius, CAST(page_limit AS INTEGER) AS resolved_limit, "offset", reason, reason IS NULL AS ok
FROM ({checked_sql(SEARCH_REQUESTS)})
"""))
def validate_search(spark, sf_dir):
    """C1 over every search with a latitude, limit and cursor derived from its id (defaults, bad limits, bad cursors)."""
    out = V.validate_search(requests(Fixtures(spark, sf_dir).search_query))
    return out.select("query_id", "resolved_radius", "resolved_limit", "offset", "reason", "ok")


@register("lookup_active", with_fixtures(["business", "mutation"], """
SELECT w.id, b.name, b.id IS NOT NULL AS found, CASE WHEN b.id IS NULL THEN 'not found' END AS reason
FROM (SELECT DISTINCT business_id AS id FROM mutation) w
LEFT JOIN (SELECT * FROM business WHERE status = 'ACTIVE') b ON b.id = w.id
"""))
def lookup_active(spark, sf_dir):
    """Look up every business id named by a mutation: active rows found, the rest not found."""
    fx = Fixtures(spark, sf_dir)
    found, missing = V.lookup(fx.business, fx.mutation, "business_id")
    return found.select("id", "name", F.lit(True).alias("found"), F.lit(None).cast("string").alias("reason")).unionByName(
        missing.select("id", F.lit(None).cast("string").alias("name"), F.lit(False).alias("found"), "reason"))


@register("validate_business", with_fixtures(["mutation"], """
SELECT mutation_id, nullif(concat_ws('; ',
    CASE WHEN owner_id IS NULL THEN 'owner_id required' END,
    CASE WHEN name IS NULL OR trim(name) = '' THEN 'name blank' END,
    CASE WHEN category IS NULL OR trim(category) = '' THEN 'category blank' END,
    CASE WHEN address IS NULL OR trim(address) = '' THEN 'address blank' END,
    CASE WHEN latitude IS NULL OR latitude < -90 OR latitude > 90 THEN 'latitude out of range' END,
    CASE WHEN longitude IS NULL OR longitude < -180 OR longitude > 180 THEN 'longitude out of range' END,
    CASE WHEN length(name) > 120 THEN 'name too long' END,
    CASE WHEN length(category) > 40 THEN 'category too long' END,
    CASE WHEN length(phone) > 32 THEN 'phone too long' END,
    CASE WHEN length(address) > 255 THEN 'address too long' END), '') AS reason
FROM (SELECT mutation_id, owner_id, name, category, CAST(NULL AS VARCHAR) AS phone,
        CASE WHEN mutation_id % 9 = 0 THEN ' ' ELSE 'block-' || CAST(business_id % 999 AS VARCHAR) END AS address,
        CASE WHEN mutation_id % 13 = 0 THEN latitude + 100 ELSE latitude END AS latitude, longitude
      FROM mutation WHERE op <> 'DELETE')
"""))
def validate_business(spark, sf_dir):
    """C6 over every create/replace payload (addresses and latitudes partly spoiled by id)."""
    m = Fixtures(spark, sf_dir).mutation.filter(F.col("op") != "DELETE")
    m = m.select(
        "mutation_id", "owner_id", "name", "category", F.lit(None).cast("string").alias("phone"),
        F.when(F.col("mutation_id") % 9 == 0, F.lit(" ")).otherwise(F.concat(F.lit("block-"), (F.col("business_id") % 999).cast("string"))).alias("address"),
        F.when(F.col("mutation_id") % 13 == 0, F.col("latitude") + 100).otherwise(F.col("latitude")).alias("latitude"), "longitude")
    return V.validate_business(m).select("mutation_id", "reason")


@register("prefix_lookup", with_fixtures(["business"], f"""
SELECT p.prefix, i.id AS business_id FROM (VALUES ('wydm'), ('wy7b'), ('wy7'), ('wydm6')) p(prefix)
JOIN ({geohash_select("(SELECT id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM business WHERE status = 'ACTIVE')", 'latitude', 'longitude', 8)}) i
  ON starts_with(i.geohash, p.prefix)
"""))
def prefix_lookup(spark, sf_dir):
    """Business ids under a hot-zone prefix, a normal prefix, a short prefix and a 5-letter prefix."""
    from nearfield.plans.q_search import stored

    index = stored(spark, sf_dir).points
    out = None
    for prefix in ("wydm", "wy7b", "wy7", "wydm6"):
        part = ix.prefix_lookup(index, prefix).select(F.lit(prefix).alias("prefix"), "business_id")
        out = part if out is None else out.unionByName(part)
    return out


@register("bootstrap_index", with_fixtures(["business", "hot_zone_config"], f"""
SELECT g.business_id, g.geohash, CASE WHEN z.geohash_prefix IS NOT NULL THEN 'hot' ELSE 'normal' END AS zone, substr(g.geohash, 1, 4) AS gh4
FROM ({geohash_select("(SELECT id AS business_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM business WHERE status = 'ACTIVE')", 'latitude', 'longitude', 8)}) g
LEFT JOIN (SELECT * FROM hot_zone_config WHERE is_active) z ON substr(g.geohash, 1, 4) = z.geohash_prefix
"""))
def bootstrap(spark, sf_dir):
    """A8 + I7: an absent index is built, stored by zone and gh4 and read back; a second start keeps what is stored."""
    fx = Fixtures(spark, sf_dir)
    path = work_dir(spark, f"index-{uuid.uuid4().hex}")
    bootstrap_index(spark, path, fx.business, fx.hot_zone_config)
    bootstrap_index(spark, path, fx.business.limit(0), fx.hot_zone_config)
    return IndexStore(spark, path).rows().select("business_id", "geohash", "zone", "gh4")


@register("retention", with_fixtures(["request_log"], """
SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS kept_rows FROM request_log
WHERE ts >= TIMESTAMP '2024-01-17 00:00:00' GROUP BY CAST(ts AS DATE)
"""))
def retention(spark, sf_dir):
    """Request rows kept after a 2024-01-17 cutoff, counted per day."""
    r = V.retention_delete(Fixtures(spark, sf_dir).request_log, "ts", "2024-01-17 00:00:00")
    return r.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("kept_rows"))


@register("retention_store", with_fixtures(["request_log"], """
SELECT CAST(ts AS DATE) AS day, count(*) AS kept_rows, min(ts) AS first_ts FROM request_log
WHERE ts >= TIMESTAMP '2024-01-17 06:30:00' GROUP BY CAST(ts AS DATE)
"""))
def retention_store(spark, sf_dir):
    """C8 over the stored log: written by day in two batches, the second twice, then cut at a time of day."""
    log = Fixtures(spark, sf_dir).request_log
    store = RequestLogStore(spark, work_dir(spark, f"log-{uuid.uuid4().hex}"), log.schema)
    for batch in (0, 1, 1):
        store.append(log.filter(F.col("request_id") % 2 == batch), batch)
    store.retain(dt.datetime(2024, 1, 17, 6, 30))
    return store.rows().groupBy("day").agg(F.count(F.lit(1)).alias("kept_rows"), F.min("ts").alias("first_ts"))


@register("sql_functions", with_fixtures(["search_query"], f"""
g AS ({geohash_select(geohash_select('search_query', 'latitude', 'longitude', 8, 'gh8'), 'latitude', 'longitude', 5, 'gh5')}),
nb AS (SELECT query_id, list_sort(list(cell)) AS cells FROM ({_neighbors_sql(6)}) GROUP BY query_id)
SELECT query_id, gh8, gh5, cells, CASE WHEN radius_m <= 300 THEN 7 WHEN radius_m <= 1000 THEN 6 WHEN radius_m <= 5000 THEN 5 WHEN radius_m <= 20000 THEN 4 ELSE 3 END AS policy,
  CAST(floor({hav('latitude', 'longitude', d(37.4991), d(127.0313))} + {d(0.5)}) AS BIGINT) AS distance_m,
  round({clamp_lat(f"latitude + radius_m * cos(radians(query_id % 360)) / {d(geo.METERS_PER_DEGREE_FLAT)}")}, 6) AS moved_lat,
  {cursor('query_id % 250')} AS cursor, CAST(query_id % 250 AS INTEGER) AS decoded, CAST(NULL AS INTEGER) AS bad
FROM g JOIN nb USING (query_id)
"""))
def sql_functions(spark, sf_dir):
    """B1-B9 as SQL functions: a query that is SQL text only."""
    register_functions(spark)
    # A row takes much longer than its few bytes to read: all cores share the rows, however the files are cut.
    searches = Fixtures(spark, sf_dir).search_query.repartition(4 * spark.sparkContext.defaultParallelism)
    return spark.sql("""
SELECT query_id, nf_geohash_encode(latitude, longitude, 8) AS gh8, nf_geohash_encode(latitude, longitude, 5) AS gh5,
  array_sort(nf_neighbor_cells(latitude, longitude, 6)) AS cells, nf_precision_for_radius(radius_m) AS policy,
  nf_round_half_up(nf_haversine_m(latitude, longitude, 37.4991D, 127.0313D)) AS distance_m,
  round(nf_move_point(latitude, longitude, radius_m, radians(query_id % 360)).latitude, 6) AS moved_lat,
  nf_encode_cursor(cast(query_id % 250 as int)) AS cursor, nf_decode_cursor(nf_encode_cursor(cast(query_id % 250 as int))) AS decoded,
  nf_decode_cursor(concat(nf_encode_cursor(cast(query_id % 250 as int)), '!')) AS bad
FROM {search_query}""", search_query=searches)

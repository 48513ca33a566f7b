"""Search queries: pages, totals, top-k, policy search, hot-zone cap, paging checks."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from nearfield.operators import index as ix
from nearfield.operators import search as S
from nearfield.operators.quadtree import staged
from nearfield.plans.catalog import register
from nearfield.functions import geo
from nearfield.functions.geo import cell_size_deg
from nearfield.plans.sqlgen import clamp_lat, cursor, d, geohash_select, hav, wrap_lon, with_fixtures
from nearfield.session import Scratch, work_dir
from nearfield.sources.fixtures import Fixtures
from nearfield.sources.index_store import bootstrap_index

FIRST_PAGE = 20
TOP_K = 10


def stored(spark, sf_dir):
    """The stored index of the businesses, as a search reads it: bootstrapped (I7) by the first query of the application that needs it."""
    fx = Fixtures(spark, sf_dir)
    name = hashlib.sha256(f"{spark.sparkContext.applicationId} {sf_dir}".encode()).hexdigest()[:16]
    return bootstrap_index(spark, work_dir(spark, f"index-{name}"), fx.business, fx.hot_zone_config).tree()


# Brute-force pairs over whole tables: every query against every active business.
_PAIRS = f"""
pairs AS (
  SELECT q.query_id, q.radius_m, b.id, b.name, b.category, b.latitude, b.longitude,
         {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} AS d
  FROM search_query q JOIN business b ON b.status = 'ACTIVE'
  WHERE {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} <= q.radius_m
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 6), id) AS rk FROM pairs),
totals AS (SELECT query_id, count(*) AS total FROM pairs GROUP BY query_id)
"""


def _search(spark, sf_dir, **kw):
    fx = Fixtures(spark, sf_dir)
    index = stored(spark, sf_dir)
    return S.nearby_search(fx.search_query, index, fx.business, config=fx.hot_zone_config, **kw)


@register("nearby_page", with_fixtures(["business", "search_query"], _PAIRS + f"""
SELECT r.query_id, CAST(r.rk AS INTEGER) AS rank, r.id, r.name, r.category, CAST(floor(r.d + 0.5) AS BIGINT) AS distance_m,
       r.latitude, r.longitude, CAST(t.total AS INTEGER) AS total, r.radius_m AS adjusted_radius,
       CASE WHEN {FIRST_PAGE} < t.total THEN {cursor(str(FIRST_PAGE))} END AS next_cursor
FROM ranked r JOIN totals t USING (query_id) WHERE r.rk <= {FIRST_PAGE}
"""))
def nearby_page(spark, sf_dir):
    """Flagship: first page of 20 for every search query."""
    page, _ = _search(spark, sf_dir, limit=FIRST_PAGE)
    return page


@register("nearby_second_page", with_fixtures(["business", "search_query"], _PAIRS + f"""
SELECT r.query_id, CAST(r.rk AS INTEGER) AS rank, r.id, r.name, r.category, CAST(floor(r.d + 0.5) AS BIGINT) AS distance_m,
       r.latitude, r.longitude, CAST(t.total AS INTEGER) AS total, r.radius_m AS adjusted_radius,
       CASE WHEN 40 < t.total THEN {cursor('40')} END AS next_cursor
FROM ranked r JOIN totals t USING (query_id) WHERE r.rk > 20 AND r.rk <= 40
"""))
def nearby_second_page(spark, sf_dir):
    """Second page (cursor offset 20, limit 20)."""
    page, _ = _search(spark, sf_dir, limit=20, offset=20)
    return page


@register("nearby_totals", with_fixtures(["business", "search_query"], _PAIRS + f"""
SELECT q.query_id, CAST(coalesce(t.total, 0) AS INTEGER) AS total, q.radius_m AS adjusted_radius,
       CASE WHEN {FIRST_PAGE} < coalesce(t.total, 0) THEN {cursor(str(FIRST_PAGE))} END AS next_cursor,
       {FIRST_PAGE} < coalesce(t.total, 0) AS has_more
FROM search_query q LEFT JOIN totals t USING (query_id)
"""))
def nearby_totals(spark, sf_dir):
    """One header row per query (total, next cursor, has_more)."""
    fx = Fixtures(spark, sf_dir)
    return S.nearby_header(fx.search_query, stored(spark, sf_dir), fx.business, config=fx.hot_zone_config, limit=FIRST_PAGE)


@register("nearest_k", with_fixtures(["business", "search_query"], _PAIRS + f"""
SELECT query_id, CAST(rk AS INTEGER) AS rank, id AS business_id, CAST(floor(d + 0.5) AS BIGINT) AS distance_m
FROM ranked WHERE rk <= {TOP_K}
"""))
def nearest_k(spark, sf_dir):
    """the 10 nearest active businesses within radius per query."""
    fx = Fixtures(spark, sf_dir)
    index = stored(spark, sf_dir)
    return S.nearest_k(fx.search_query, index, TOP_K)


# D2 oracle: the policy precision, centre + 8 neighbour geohashes, prefix match, radius filter.
def _nine_cell_oracle(select: str, extra: str = "") -> str:
    cells = []
    for p in (3, 4, 5, 6, 7):
        lon_d, lat_d = cell_size_deg(p)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                lat = clamp_lat(f"(latitude + {d(dy * lat_d)})")
                lon = wrap_lon(f"(longitude + {d(dx * lon_d)})")
                cells.append("SELECT query_id, latitude, longitude, radius_m, precision, cell FROM ("
                             + geohash_select("qp", lat, lon, p, "cell", f"WHERE precision = {p}") + ")")
    union = "\nUNION\n".join(cells)
    return with_fixtures(["business", "search_query"], f"""{extra}
qp AS (SELECT *, CASE WHEN radius_m <= 300 THEN 7 WHEN radius_m <= 1000 THEN 6 WHEN radius_m <= 5000 THEN 5
                      WHEN radius_m <= 20000 THEN 4 ELSE 3 END AS precision FROM search_query),
qc AS ({union}),
bi AS ({geohash_select("(SELECT id, latitude, longitude FROM business WHERE status = 'ACTIVE')", 'round(latitude, 6)', 'round(longitude, 6)', 8)}),
cand AS (SELECT qc.query_id, qc.latitude AS q_lat, qc.longitude AS q_lon, qc.radius_m, qc.precision, bi.id,
                bi.latitude AS b_lat, bi.longitude AS b_lon
         FROM qc JOIN bi ON substr(bi.geohash, 1, qc.precision) = qc.cell)
{select}
""")


_NINE = f"""
nine AS (SELECT query_id, precision, id, {hav('q_lat', 'q_lon', 'b_lat', 'b_lon')} AS d FROM cand WHERE {hav('q_lat', 'q_lon', 'b_lat', 'b_lon')} <= radius_m),
"""


@register("nine_cell_candidates", _nine_cell_oracle(f"""
, {_NINE.strip().rstrip(',')}
SELECT query_id, CAST(count(*) AS BIGINT) AS total FROM nine GROUP BY query_id
"""))
def nine_cell_candidates(spark, sf_dir):
    """How many businesses the lossy nine-cell policy finds per query, from cell counts."""
    fx = Fixtures(spark, sf_dir)
    return S.nine_cell_totals(fx.search_query, stored(spark, sf_dir))


@register("nine_cell_page", _nine_cell_oracle(f"""
, {_NINE.strip().rstrip(',')}
SELECT query_id, rank, id AS business_id, CAST(floor(d + 0.5) AS BIGINT) AS distance_m, precision
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(d, 6), id) AS INTEGER) AS rank FROM nine) WHERE rank <= {FIRST_PAGE}
"""))
def nine_cell_page(spark, sf_dir):
    """The first page of the nine-cell policy search."""
    fx = Fixtures(spark, sf_dir)
    return S.nine_cell_page(fx.search_query, stored(spark, sf_dir), FIRST_PAGE)


@register("nine_cell_recall", _nine_cell_oracle(f"""
, exact AS (SELECT query_id, count(*) AS n FROM pairs GROUP BY query_id),
found AS (SELECT query_id, count(*) AS n FROM cand WHERE {hav('q_lat', 'q_lon', 'b_lat', 'b_lon')} <= radius_m GROUP BY query_id)
SELECT q.tier, q.radius_m, CAST(coalesce(sum(e.n), 0) AS BIGINT) AS exact_pairs, CAST(coalesce(sum(f.n), 0) AS BIGINT) AS nine_cell_pairs
FROM search_query q LEFT JOIN exact e USING (query_id) LEFT JOIN found f USING (query_id)
GROUP BY q.tier, q.radius_m
""", extra=_PAIRS.strip() + ","))
def nine_cell_recall(spark, sf_dir):
    """S5 check: exact matches versus those the nine-cell policy finds, per tier and radius, both from cell counts."""
    fx = Fixtures(spark, sf_dir)
    idx = stored(spark, sf_dir)
    q = fx.search_query
    exact = Scratch(spark, "exact").written(S.search_totals(q, idx))
    nine = S.nine_cell_totals(q, idx, exact=exact).withColumnRenamed("total", "nine_cell_pairs")
    exact = exact.withColumnRenamed("total", "exact_pairs")
    j = q.select("query_id", "tier", "radius_m").join(exact, "query_id", "left").join(nine, "query_id", "left")
    return j.groupBy("tier", "radius_m").agg(
        F.coalesce(F.sum("exact_pairs"), F.lit(0)).cast("long").alias("exact_pairs"),
        F.coalesce(F.sum("nine_cell_pairs"), F.lit(0)).cast("long").alias("nine_cell_pairs"))


def _cap_pairs_sql(radius_expr: str) -> str:
    return f"""
pairs AS (
  SELECT q.query_id, q.radius_m, b.id, b.name, b.category, b.latitude, b.longitude,
         {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} AS d, q.adjusted_radius
  FROM qz q JOIN business b ON b.status = 'ACTIVE'
  WHERE {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} <= {radius_expr}
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 6), id) AS rk FROM pairs),
totals AS (SELECT query_id, count(*) AS total FROM pairs GROUP BY query_id)
"""


_QZ = f"""
qz AS (SELECT q.*, z.radius_limit AS hz_limit,
         CASE WHEN z.geohash_prefix IS NOT NULL THEN least(q.radius_m, z.radius_limit) ELSE q.radius_m END AS adjusted_radius
       FROM ({geohash_select('search_query', 'latitude', 'longitude', 4, 'gh4')}) q
       LEFT JOIN (SELECT * FROM hot_zone_config WHERE is_active) z ON z.geohash_prefix = q.gh4),
"""


@register("hot_zone_cap", with_fixtures(["business", "search_query", "hot_zone_config"], _QZ + _cap_pairs_sql("q.adjusted_radius").strip() + f"""
SELECT r.query_id, CAST(r.rk AS INTEGER) AS rank, r.id, r.name, r.category, CAST(floor(r.d + 0.5) AS BIGINT) AS distance_m,
       r.latitude, r.longitude, CAST(t.total AS INTEGER) AS total, r.adjusted_radius,
       CASE WHEN {FIRST_PAGE} < t.total THEN {cursor(str(FIRST_PAGE))} END AS next_cursor
FROM ranked r JOIN totals t USING (query_id) WHERE r.rk <= {FIRST_PAGE}
"""))
def hot_zone_cap(spark, sf_dir):
    """S2 'hot_zone_cap': first page where searches inside an active hot zone use its radius limit."""
    page, _ = _search(spark, sf_dir, limit=FIRST_PAGE, radius_policy="hot_zone_cap")
    return page


@register("radius_cap_effect", with_fixtures(["business", "search_query", "hot_zone_config"], _QZ + f"""
pairs AS (
  SELECT q.query_id, q.gh4, q.hz_limit, {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} AS d
  FROM qz q JOIN business b ON b.status = 'ACTIVE'
  WHERE q.hz_limit IS NOT NULL AND {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} <= q.radius_m)
SELECT q.gh4 AS hz_prefix, count(DISTINCT q.query_id) AS queries,
  CAST(count(p.d) AS BIGINT) AS candidates_before, CAST(count(p.d) FILTER (WHERE p.d <= q.hz_limit) AS BIGINT) AS candidates_after,
  round(100.0 * (1 - count(p.d) FILTER (WHERE p.d <= q.hz_limit) / nullif(count(p.d), 0)), 6) AS reduction_pct
FROM qz q LEFT JOIN pairs p USING (query_id) WHERE q.hz_limit IS NOT NULL GROUP BY q.gh4
"""))
def radius_cap_effect(spark, sf_dir):
    """Candidates per hot zone before and after capping the radius at the zone's limit."""
    fx = Fixtures(spark, sf_dir)
    idx = stored(spark, sf_dir)
    q = staged(fx.search_query, gh4=geo.geohash_encode("latitude", "longitude", 4))
    q = ix.attach_hot_zone(q, fx.hot_zone_config, "gh4").filter(F.col("is_hot")).withColumn("capped", F.least("radius_m", "hz_radius_limit"))
    before = Scratch(spark, "before").written(S.search_totals(q, idx))
    # Searches that the cap leaves as they are keep their count.
    after = S.totals_from(before, q, F.col("capped") == F.col("radius_m"), lambda rows: S.search_totals(rows, idx, "capped"))
    before, after = before.withColumnRenamed("total", "before"), after.withColumnRenamed("total", "after")
    out = (q.select("query_id", "hz_prefix").join(before, "query_id", "left").join(after, "query_id", "left")
           .groupBy("hz_prefix").agg(F.count(F.lit(1)).alias("queries"),
                                     F.coalesce(F.sum("before"), F.lit(0)).cast("long").alias("candidates_before"),
                                     F.coalesce(F.sum("after"), F.lit(0)).cast("long").alias("candidates_after")))
    red = F.round(F.lit(100.0) * (1 - F.try_divide(F.col("candidates_after").cast("double"), F.col("candidates_before"))), 6)
    return out.select("hz_prefix", "queries", "candidates_before", "candidates_after", red.alias("reduction_pct"))


@register("candidate_profile", with_fixtures(["business", "search_query"], _PAIRS + """
SELECT q.tier, q.radius_m, count(*) AS searches, CAST(sum(coalesce(t.total, 0)) AS BIGINT) AS candidates,
  round(avg(coalesce(t.total, 0)), 6) AS avg_candidates, CAST(max(coalesce(t.total, 0)) AS INTEGER) AS max_candidates,
  CAST(sum(least(coalesce(t.total, 0), 20)) AS BIGINT) AS results, round(avg(least(coalesce(t.total, 0), 20)), 6) AS avg_results,
  CAST(max(least(coalesce(t.total, 0), 20)) AS INTEGER) AS max_results
FROM search_query q LEFT JOIN totals t USING (query_id) GROUP BY q.tier, q.radius_m
"""))
def candidate_profile(spark, sf_dir):
    """Candidates and first-page results per search, summarised by tier and radius."""
    fx = Fixtures(spark, sf_dir)
    header = S.search_totals(fx.search_query, stored(spark, sf_dir))
    j = fx.search_query.select("query_id", "tier", "radius_m").join(header, "query_id", "left").fillna(0, ["total"])
    shown = F.least(F.col("total"), F.lit(FIRST_PAGE))
    return j.groupBy("tier", "radius_m").agg(
        F.count(F.lit(1)).alias("searches"), F.sum("total").cast("long").alias("candidates"),
        F.round(F.avg("total"), 6).alias("avg_candidates"), F.max("total").cast("int").alias("max_candidates"),
        F.sum(shown).cast("long").alias("results"), F.round(F.avg(shown), 6).alias("avg_results"), F.max(shown).cast("int").alias("max_results"))


PAGES = 3


@register("page_stability", with_fixtures(["business", "search_query"], _PAIRS + f"""
SELECT query_id, CAST(count(*) AS BIGINT) AS fetched, CAST(count(DISTINCT id) AS BIGINT) AS distinct_ids,
  CAST(max((rk - 1) // {FIRST_PAGE}) + 1 AS INTEGER) AS pages, true AS stable
FROM ranked WHERE rk <= {PAGES * FIRST_PAGE} GROUP BY query_id
"""))
def page_stability(spark, sf_dir):
    """the first three pages of every query, each fetched by a search of its own: no id comes twice, no rank is left out,
    distances never fall, and their sum is what the total promises."""
    parts = [_search(spark, sf_dir, limit=FIRST_PAGE, offset=n * FIRST_PAGE)[0].withColumn("page", F.lit(n)) for n in range(PAGES)]
    pages = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return S.page_stability(pages, FIRST_PAGE, PAGES)


# A stale index: every business as it was, deleted ones too.
@register("nearby_candidates_mode", with_fixtures(["business", "search_query"], f"""
pairs AS (
  SELECT q.query_id, b.id, b.status, {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} AS d
  FROM search_query q JOIN business b ON {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} <= q.radius_m),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 6), id) AS rk, count(*) OVER (PARTITION BY query_id) AS total FROM pairs)
SELECT query_id, CAST(rk AS INTEGER) AS rank, id, CAST(floor(d + 0.5) AS BIGINT) AS distance_m, CAST(total AS INTEGER) AS total
FROM ranked WHERE rk <= {FIRST_PAGE} AND status = 'ACTIVE'
"""))
def nearby_candidates_mode(spark, sf_dir):
    """S1 'candidates': totals count the index rows of a stale index, the page leaves out businesses deleted meanwhile."""
    fx = Fixtures(spark, sf_dir)
    stale = ix.index_rows(fx.business, fx.hot_zone_config)
    page, _ = S.nearby_search(fx.search_query, stale, fx.business, limit=FIRST_PAGE, count_mode="candidates")
    return page.select("query_id", "rank", "id", "distance_m", "total")


def _requests_sql() -> str:
    from nearfield.plans.q_geo import SEARCH_REQUESTS, checked_sql

    return with_fixtures(["business", "search_query"], f"""
req AS (SELECT *, reason IS NULL AS ok FROM ({checked_sql(SEARCH_REQUESTS)})),
pairs AS (
  SELECT q.query_id, b.id, {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} AS d
  FROM req q JOIN business b ON b.status = 'ACTIVE' AND q.ok
  WHERE {hav('q.latitude', 'q.longitude', 'b.latitude', 'b.longitude')} <= q.radius),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 6), id) AS rk FROM pairs),
totals AS (SELECT query_id, count(*) AS total FROM pairs GROUP BY query_id)
SELECT q.query_id, q.ok, q.reason, CAST(r.rk AS INTEGER) AS rank, r.id, CAST(floor(r.d + 0.5) AS BIGINT) AS distance_m,
  CASE WHEN q.ok THEN CAST(coalesce(t.total, 0) AS INTEGER) END AS total, CASE WHEN q.ok THEN CAST(q.radius AS INTEGER) END AS adjusted_radius,
  CASE WHEN q.ok AND q."offset" + q.page_limit < coalesce(t.total, 0) THEN {cursor('q."offset" + q.page_limit')} END AS next_cursor
FROM req q LEFT JOIN totals t USING (query_id)
LEFT JOIN ranked r ON r.query_id = q.query_id AND q.ok AND r.rk > q."offset" AND r.rk <= q."offset" + q.page_limit
""")


@register("search_requests", _requests_sql())
def search_requests(spark, sf_dir):
    """The whole request path: validate, search, page, with each request's own radius, limit and cursor; refused requests
    come with their reason, empty pages with their total."""
    from nearfield.plans.q_geo import requests

    fx = Fixtures(spark, sf_dir)
    index = stored(spark, sf_dir)
    return S.search_requests(requests(fx.search_query), index, fx.business)

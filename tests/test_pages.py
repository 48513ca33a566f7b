"""Pages found in the tile of their search, ranked and detailed there, and their checks."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from nearfield.functions import geo
from nearfield.operators import discs as D
from nearfield.operators import index as ix
from nearfield.operators import quadtree as Q
from nearfield.operators import search as S

PAGES = "query_id long, page int, rank int, id long, distance_m long, total int"


def test_page_stability_shuffles_a_page_as_one_row(spark):
    page = lambda q, n, total, size=2, **odd: [(q, n, *(odd.get(f"r{n * 2 + k + 1}") or (n * 2 + k + 1, 100 * q + n * 2 + k, 10 * (n * 2 + k))), total)
                                               for k in range(size)]
    rows = page(1, 0, 9) + page(1, 1, 9) + page(1, 2, 9)  # stable
    rows += page(2, 0, 3) + page(2, 1, 3, 1)  # stable, ends early
    rows += page(3, 0, 9) + page(3, 1, 9, r3=(3, 300, 20)) + page(3, 2, 9)  # an id twice
    rows += page(4, 0, 9) + page(4, 2, 9)  # a page is missing
    rows += page(5, 0, 9) + page(5, 1, 9, r3=(3, 502, 5)) + page(5, 2, 9)  # a distance falls
    rows += page(6, 0, 9) + page(6, 1, 8) + page(6, 2, 9)  # totals differ
    rows += page(7, 0, 9) + page(7, 1, 9, r3=(2, 702, 20)) + page(7, 2, 9)  # a rank twice
    rows += [(None, 0, 1, 1, 5, 1)]
    parts = [spark.createDataFrame([r for r in rows if r[1] == n], PAGES).repartition(3) for n in range(3)]
    out = S.page_stability(parts[0].unionByName(parts[1]).unionByName(parts[2]), 2, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = {r.query_id: (r.fetched, r.distinct_ids, r.pages, r.stable) for r in out.collect()}
    assert got == {1: (6, 6, 3, True), 2: (3, 3, 2, True), 3: (6, 5, 3, False), 4: (4, 4, 3, False), 5: (6, 6, 3, False), 6: (6, 6, 3, False),
                   7: (6, 6, 3, False), None: (1, 1, 1, True)}
    assert dict(out.dtypes) == {"query_id": "bigint", "fetched": "bigint", "distinct_ids": "bigint", "pages": "int", "stable": "boolean"}
    # The runs of a page are folded before they are shuffled.
    assert S._folded(spark.createDataFrame(page(1, 0, 9), PAGES).coalesce(1)).select(F.size("id")).collect()[0][0] == 2


def _points(spark, n, first=1):
    i = F.col("id").cast("double")
    return (spark.range(first, first + n).select("id", F.concat(F.lit("b"), F.col("id")).alias("name"), F.lit("CAFE").alias("category"),
            (F.lit(37.505) + F.sqrt(i / n) * F.sin(i * 2.399963) * 0.004).alias("latitude"),
            (F.lit(127.09) + F.sqrt(i / n) * F.cos(i * 2.399963) * 0.005).alias("longitude"), F.when(F.col("id") % 9 == 0, "DELETED").otherwise("ACTIVE").alias("status")))


def test_pages_of_one_tile_equal_brute_force_without_a_shuffle(spark):
    """Odd rows too: an id twice, a null id, a deleted business, one that stands twice, a search without a place, one with no match."""
    b = _points(spark, 900).localCheckpoint()
    twice = b.unionByName(b.filter("id = 7").withColumn("name", F.lit("again")))
    rows = [(i, 37.505 + i * 1e-4, 127.09 - i * 1e-4, 400) for i in range(12)]
    rows += [(3, 37.5049, 127.0901, 300), (None, 37.505, 127.09, 300), (50, None, 127.0, 300), (51, 10.0, 10.0, 300), (52, 37.505, 127.09, 1)]
    q = spark.createDataFrame(rows, "query_id long, latitude double, longitude double, radius_m int")
    index = ix.index_rows(b, None).localCheckpoint()
    page, header = S.nearby_search(q, index, twice, limit=5, offset=3, count_mode="candidates")
    d = geo.haversine_m("latitude", "longitude", "la", "lo")
    pairs = q.crossJoin(index.select("business_id", F.col("latitude").alias("la"), F.col("longitude").alias("lo"))).withColumn("d", d).filter("d <= radius_m")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("d", 6), "business_id"))).filter("rank between 4 and 8")
    shown = twice.filter("status = 'ACTIVE'").select(F.col("id").alias("business_id"), "name")
    # A page row of an id that stands twice goes with each of its headers.
    brute = ranked.join(header.select("query_id", "total"), "query_id").join(shown, "business_id").select("query_id", "rank", "business_id", "name", "total")
    got = sorted(map(tuple, page.select("query_id", "rank", "id", "name", "total").collect()))
    assert got == sorted(map(tuple, brute.collect())) and len(got) > 40
    asked = q.withColumns({"_from": F.lit(3).cast("long"), "_to": F.lit(8).cast("long")})
    sure, far = S._homed(asked, Q.tree_of(index), "radius_m", S._always, ())
    found = sorted(r.query_id for r in sure.collect())
    assert set(found) <= {*range(12), 52} - {3} and len(found) > 8 and far.count() + len(found) == len(rows)


def test_cells_of_circles_are_whole_or_cut_or_out(spark):
    """Cells taken down in vectors against all points: poles, the antimeridian, radii of any size."""
    rng = np.random.default_rng(5)
    lat = np.concatenate([37.5 + rng.normal(size=3000) * 0.01, [89.9999, -89.9999, 0.0, 0.0]])
    lon = np.concatenate([127 + rng.normal(size=3000) * 0.01, [10.0, -170.0, 179.9999, -179.9999]])
    at = {k: (np.floor((lon + 180) / 360 * 2 ** k).astype(int), np.floor((lat + 90) / 180 * 2 ** k).astype(int)) for k in (10, 12, 14)}
    rows = []
    for level, (x, y) in at.items():
        for cx, cy in sorted(set(zip(x.tolist(), y.tolist(), strict=True))):
            n = int(((x == cx) & (y == cy)).sum())
            if level == 10 or (level - 2, cx >> 2, cy >> 2) in {r[:3] for r in rows if r[4]}:
                rows.append((level, cx, cy, n, n > 50 and level < 14, 1))
    cells = D.Cells(*(np.array(c, bool if k == 4 else np.int64) for k, c in enumerate(zip(*rows, strict=True))))
    q_lat, q_lon = np.array([37.5, 37.51, 89.9999, 0.0, -89.99, 37.5, np.nan]), np.array([127.0, 127.013, -100.0, 180.0, 50.0, 127.0, 1.0])
    radius = np.array([500.0, 2500.0, 3000.0, 100.0, 5000.0, 5e6, 5.0])
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(7)), *map(pa.array, (q_lat, q_lon, radius))], ["query_id", "q_lat", "q_lon", "radius"])
    out = pa.Table.from_batches([*D.reached(iter([batch]), cells, ["query_id", "q_lat", "q_lon", "radius"], False, True)]).to_pylist()
    for k in range(6):
        a, o, r = np.radians(q_lat[k]), np.radians(q_lon[k]), radius[k]
        s = np.sin((np.radians(lat) - a) / 2) ** 2 + np.cos(a) * np.cos(np.radians(lat)) * np.sin((np.radians(lon) - o) / 2) ** 2
        inside = 2 * 6_371_000.0 * np.arcsin(np.sqrt(np.minimum(s, 1))) <= r
        mine = [x for x in out if x["query_id"] == k]
        total, cut = sum(x["n"] for x in mine if x["state"] == "whole"), np.zeros(len(lat), bool)
        for x in mine:
            if x["state"] == "check":
                cut |= (at[x["level"]][0] == x["x"]) & (at[x["level"]][1] == x["y"])
        assert total + int((inside & cut).sum()) == int(inside.sum()), k
    assert not [x for x in out if x["query_id"] == 6]

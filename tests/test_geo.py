"""Scalar functions: geohash, neighbours, distance, cursors (FIXTURES.md section 3 edge cases)."""

import random

from pyspark.sql import functions as F

from nearfield.functions import geo
from nearfield.functions.cursor import decode_cursor, encode_cursor


def bisect_geohash(lat, lon, p):
    alphabet = geo.GEOHASH_ALPHABET
    la, lo, out, even, bit, ch = [-90.0, 90.0], [-180.0, 180.0], [], True, 0, 0
    while len(out) < p:
        rng, v = (lo, lon) if even else (la, lat)
        mid = (rng[0] + rng[1]) / 2
        if v >= mid:
            ch |= 16 >> bit
            rng[0] = mid
        else:
            rng[1] = mid
        even = not even
        if bit < 4:
            bit += 1
        else:
            out.append(alphabet[ch])
            bit, ch = 0, 0
    return "".join(out)


def test_known_geohashes(spark):
    pts = [(37.4991, 127.0313, "wydm6dt2"), (0.0, 0.0, "s0000000"), (90.0, 180.0, "zzzzzzzz"),
           (-90.0, -180.0, "00000000"), (57.64911, 10.40744, "u4pruydq"), (35.15768, 129.05938, "wy7b0b60")]
    df = spark.createDataFrame([(a, b) for a, b, _ in pts], "lat double, lon double")
    got = [r.g for r in df.select(geo.geohash_encode("lat", "lon", 8).alias("g")).collect()]
    assert got == [g for _, _, g in pts]


def test_top_corner_all_z(spark):
    df = spark.createDataFrame([(90.0, 180.0)], "lat double, lon double")
    row = df.select(*[geo.geohash_encode("lat", "lon", p).alias(f"g{p}") for p in range(1, 9)]).first()
    assert all(row[f"g{p}"] == "z" * p for p in range(1, 9))


def test_geohash_equals_bisection_on_cell_edges(spark):
    random.seed(7)
    pts = []
    for _ in range(2000):
        pts.append((-90 + 180 * random.randint(0, 2 ** 15) / 2 ** 15, -180 + 360 * random.randint(0, 2 ** 20) / 2 ** 20))
        pts.append((random.uniform(-90, 90), random.uniform(-180, 180)))
    df = spark.createDataFrame(pts, "lat double, lon double")
    df = geo.with_geohash(df, "lat", "lon", 8, "g8")
    df = geo.with_geohash(df, "lat", "lon", 5, "g5")
    for r in df.collect():
        assert r.g8 == bisect_geohash(r.lat, r.lon, 8)
        assert r.g5 == bisect_geohash(r.lat, r.lon, 5)


def test_neighbors_at_pole_are_fewer(spark):
    df = spark.createDataFrame([(89.9999, 180.0), (37.4991, 127.0313)], "lat double, lon double")
    df = geo.with_neighbor_cells(df, "lat", "lon", 6, "nb")
    sizes = [len(r.nb) for r in df.collect()]
    assert sizes == [6, 9]


def test_haversine_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 179.999, 0.0, -179.999), (89.9999, 0.0, 89.9999, 180.0)],
                               "a double, b double, c double, d double")
    got = [r.m for r in df.select(geo.round_half_up_long(geo.haversine_m("a", "b", "c", "d")).alias("m")).collect()]
    assert got == [222, 22]


def test_precision_policy(spark):
    df = spark.createDataFrame([(300,), (301,), (1000,), (5000,), (20000,), (20001,)], "r int")
    got = [r.p for r in df.select(geo.precision_for_radius("r").alias("p")).collect()]
    assert got == [7, 6, 6, 5, 4, 3]


def test_cursor_codec(spark):
    df = spark.createDataFrame([("MjA",), ("",), (None,), ("!!",), ("LTE",), ("YWJj",)], "c string")
    rows = df.select(decode_cursor("c").alias("d")).collect()
    assert [r.d.offset for r in rows] == [20, 0, 0, None, None, None]
    assert [r.d.error for r in rows] == [None, None, None, "invalid cursor", "invalid cursor", "invalid cursor"]
    enc = spark.range(1).select(encode_cursor(F.lit(20)).alias("a"), encode_cursor(F.lit(40)).alias("b")).first()
    assert (enc.a, enc.b) == ("MjA", "NDA")

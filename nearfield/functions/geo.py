"""Geographic Column expressions: distance, geohash cells, covering cells, point moves.

Everything here returns a ``Column`` built from built-in functions, so it runs inside
whole-stage codegen on the executors; no Python UDF is involved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
EARTH_RADIUS_M = 6_371_000.0
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
LAT_CLAMP = 89.999999
METERS_PER_DEGREE_FLAT = 111_320.0  # flat-earth metres per degree used by move_point
MIN_COS_LAT = 0.1  # floor of cos(latitude) in move_point
# radius (m) -> geohash precision of the documented search policy: <=300 -> 7, <=1000 -> 6,
# <=5000 -> 5, <=20000 -> 4, else 3.
POLICY_PRECISION = ((300, 7), (1000, 6), (5000, 5), (20000, 4))
POLICY_PRECISION_ELSE = 3

# Circle bounding boxes are widened by this factor so floating error never loses an edge cell.
_WIDEN = 1.0001
# Most cells one query may cover before it falls back to a coarser level.
MAX_CELLS_PER_QUERY = 256
MAX_LEVEL = 8


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def lon_bits(precision: int) -> int:
    return (5 * precision + 1) // 2


def lat_bits(precision: int) -> int:
    return (5 * precision) // 2


# ---------------------------------------------------------------- B1 / B8 distance

def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres (atan2 form, R = 6,371,000 m)."""
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    lat1r = F.radians(lat1)
    lat2r = F.radians(lat2)
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    s_lat = F.sin(dlat / 2)
    s_lon = F.sin(dlon / 2)
    a = s_lat * s_lat + F.cos(lat1r) * F.cos(lat2r) * s_lon * s_lon
    c = F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
    return F.lit(EARTH_RADIUS_M) * c


def round_half_up_long(x) -> Column:
    """Distance shown to users, rounded half up to a whole metre."""
    return F.floor(_c(x) + F.lit(0.5)).cast("long")


def rank_distance(x) -> Column:
    """Distance used for ordering: 6 decimals, so both engines agree on ties."""
    return F.round(_c(x), 6)


# ---------------------------------------------------------------- B6 clamp / wrap

def clamp_lat(lat) -> Column:
    return F.greatest(F.lit(-LAT_CLAMP), F.least(F.lit(LAT_CLAMP), _c(lat)))


def wrap_lon(lon) -> Column:
    """Bring a longitude into [-180, 180) by whole turns; one in the range stays bit for bit."""
    v = _c(lon)
    return (F.when((v >= -180.0) & (v < 180.0), v).when((v >= -540.0) & (v < -180.0), v + 360.0)
            .when((v >= 180.0) & (v < 540.0), v - 360.0).otherwise(F.pmod(v + 180.0, F.lit(360.0)) - 180.0))


# ---------------------------------------------------------------- grid cells

def axis_cell(v, lo: float, span: float, nbits) -> Column:
    """Integer cell index of ``v`` on an axis [lo, lo+span) split into 2^nbits cells.

    Equals the bisection used by geohash: the largest k with lo + span*k/2^n <= v, clamped to
    [0, 2^n - 1] (so the upper bound lands in the last cell). The floor of the scaled value can
    be one off next to an edge; edges are dyadic and exact in double, so one comparison each way
    corrects it.
    """
    v = _c(v)
    n = _pow2(nbits)
    top = n.cast("long") - 1
    k0 = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(span) * n).cast("long"), F.lit(0).cast("long")), top)
    low_edge = F.lit(lo) + (F.lit(span) * k0) / n
    high_edge = F.lit(lo) + (F.lit(span) * (k0 + 1)) / n
    return (
        F.when((v < low_edge) & (k0 > 0), k0 - 1)
        .when((v >= high_edge) & (k0 < top), k0 + 1)
        .otherwise(k0)
    )


def _pow2(nbits) -> Column:
    """2^nbits as an exact double (an int gives a literal)."""
    if isinstance(nbits, int):
        return F.lit(float(2 ** nbits))
    return F.pow(F.lit(2.0), nbits)


def _lon_bits(level):
    return lon_bits(level) if isinstance(level, int) else F.floor((_c(level) * 5 + 1) / 2).cast("int")


def _lat_bits(level):
    return lat_bits(level) if isinstance(level, int) else F.floor((_c(level) * 5) / 2).cast("int")


def cell_x(lon, level) -> Column:
    return axis_cell(lon, -180.0, 360.0, _lon_bits(level))


def cell_y(lat, level) -> Column:
    return axis_cell(lat, -90.0, 180.0, _lat_bits(level))


def _char_table() -> str:
    """Geohash letter for each (3 bits of one axis, 2 bits of the other) index.

    A character covers five interleaved bits; starting with longitude they read x y x y x,
    starting with latitude y x y x y. Either way the axis with three bits leads, so one table
    serves both: the index is (three-bit value) * 4 + (two-bit value).
    """
    out = []
    for idx in range(32):
        a, b = idx >> 2, idx & 3
        v = ((a >> 2) & 1) << 4 | ((b >> 1) & 1) << 3 | ((a >> 1) & 1) << 2 | (b & 1) << 1 | (a & 1)
        out.append(GEOHASH_ALPHABET[v])
    return "".join(out)


_CHAR_TABLE = _char_table()


def geohash_from_cell(x, y, precision: int) -> Column:
    """Geohash string of integer cell (x, y) at ``precision``, one character per 5 bits."""
    x, y = _c(x).cast("long"), _c(y).cast("long")
    lonb, latb = lon_bits(precision), lat_bits(precision)
    chars = []
    for c in range(precision):
        x_before, y_before = (5 * c + 1) // 2, (5 * c) // 2
        if c % 2 == 0:  # x y x y x
            three = F.shiftright(x, lonb - x_before - 3).bitwiseAND(F.lit(7))
            two = F.shiftright(y, latb - y_before - 2).bitwiseAND(F.lit(3))
        else:  # y x y x y
            three = F.shiftright(y, latb - y_before - 3).bitwiseAND(F.lit(7))
            two = F.shiftright(x, lonb - x_before - 2).bitwiseAND(F.lit(3))
        chars.append(F.substring(F.lit(_CHAR_TABLE), (three * 4 + two + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)


def geohash_encode(lat, lon, precision: int = 8) -> Column:
    """B2: base-32 geohash, longitude bit first, values on a midpoint go up."""
    if not 1 <= precision <= 12:
        raise ValueError("precision must be within 1..12")
    # The cell pair is bound once through a lambda so the bit interleave refers to it by name
    # instead of repeating the cell expressions; ``with_geohash`` stages columns instead.
    cell = F.array(F.struct(cell_x(lon, precision).alias("x"), cell_y(lat, precision).alias("y")))
    return F.transform(cell, lambda c: geohash_from_cell(c["x"], c["y"], precision))[0]


def cell_size_deg(precision: int) -> tuple[float, float]:
    """(longitude width, latitude height) of one cell in degrees."""
    return 360.0 / 2 ** lon_bits(precision), 180.0 / 2 ** lat_bits(precision)


def with_neighbor_xy(df, lat: str, lon: str, precision, out: str = "neighbors"):
    """B3 as integer cells: array<struct<x, y>> of the centre and its 8 neighbours, distinct.

    A neighbour is the cell of the point shifted by one cell size (latitude clamped, longitude
    wrapped), so only three x and three y values are computed per row.
    """
    if isinstance(precision, int):
        lon_d, lat_d = (F.lit(v) for v in cell_size_deg(precision))
    else:  # a per-row precision column; sizes are exact powers of two
        precision = F.col(precision)
        lon_d = F.lit(360.0) / _pow2(_lon_bits(precision))
        lat_d = F.lit(180.0) / _pow2(_lat_bits(precision))
    for k, dx in enumerate((-1, 0, 1)):
        df = df.withColumn(f"_nbx{k}", cell_x(wrap_lon(F.col(lon) + lon_d * dx), precision))
    for k, dy in enumerate((-1, 0, 1)):
        df = df.withColumn(f"_nby{k}", cell_y(clamp_lat(F.col(lat) + lat_d * dy), precision))
    pairs = [F.struct(F.col(f"_nbx{a}").alias("x"), F.col(f"_nby{b}").alias("y")) for b in range(3) for a in range(3)]
    return df.withColumn(out, F.array_distinct(F.array(*pairs))).drop(*[f"_nbx{k}" for k in range(3)], *[f"_nby{k}" for k in range(3)])


def with_neighbor_cells(df, lat: str, lon: str, precision: int, out: str = "neighbors"):
    """B3 for many rows: distinct geohash strings of the centre and its 8 neighbours."""
    df = with_neighbor_xy(df, lat, lon, precision, "_nb_xy")
    return df.withColumn(out, F.array_distinct(F.transform(
        "_nb_xy", lambda c: geohash_from_cell(c["x"], c["y"], precision)))).drop("_nb_xy")


def precision_for_radius(radius_m) -> Column:
    """Geohash precision of the documented policy for a search radius."""
    r = _c(radius_m)
    expr = None
    for bound, p in POLICY_PRECISION:
        expr = F.when(r <= bound, F.lit(p)) if expr is None else expr.when(r <= bound, F.lit(p))
    return expr.otherwise(F.lit(POLICY_PRECISION_ELSE))


def move_point(lat, lon, dist_m, bearing_rad) -> Column:
    """Flat-earth offset of a point; returns struct(latitude, longitude)."""
    lat, lon, d, b = _c(lat), _c(lon), _c(dist_m), _c(bearing_rad)
    lat_delta = d * F.cos(b) / F.lit(METERS_PER_DEGREE_FLAT)
    lon_div = F.lit(METERS_PER_DEGREE_FLAT) * F.greatest(F.lit(MIN_COS_LAT), F.cos(F.radians(lat)))
    lon_delta = d * F.sin(b) / lon_div
    return F.struct(clamp_lat(lat + lat_delta).alias("latitude"), wrap_lon(lon + lon_delta).alias("longitude"))


# ---------------------------------------------------------------- B14 covering cells

def _level_height_m(level: int) -> float:
    return 180.0 / 2 ** lat_bits(level) * math.pi * EARTH_RADIUS_M / 180.0


def circle_box(lat, lon, radius_m):
    """(half height deg, half width deg, holds a pole) of a circle's bounding box, widened a little."""
    lat, lon, r = _c(lat), _c(lon), _c(radius_m)
    ang = r / F.lit(EARTH_RADIUS_M)
    dlat = F.degrees(ang) * F.lit(_WIDEN)
    ratio = F.sin(ang) / F.cos(F.radians(lat))
    pole = (lat + dlat >= 90.0) | (lat - dlat <= -90.0) | (ratio >= 1.0)
    dlon = F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * F.lit(_WIDEN)
    return dlat, dlon, pole


def search_level(radius_m, dlat, dlon, pole, max_cells: int = MAX_CELLS_PER_QUERY) -> Column:
    """Grid level used by the exact radius join for one query.

    The coarsest level whose cell height is at most the radius keeps the over-fetch of
    candidates near 2x while a query covers a few dozen cells; where the circle spans many
    longitude cells (near the poles) it falls back to coarser levels until an upper estimate
    of the cell count fits ``max_cells``. Only work depends on the level, never the result.
    """
    r, dlat, dlon, pole = _c(radius_m), _c(dlat), _c(dlon), _c(pole)
    base = None
    for level in range(1, MAX_LEVEL + 1):
        cond = r >= F.lit(_level_height_m(level))
        base = F.when(cond, F.lit(level)) if base is None else base.when(cond, F.lit(level))
    base = base.otherwise(F.lit(MAX_LEVEL))
    chosen = F.lit(1)
    for level in range(2, MAX_LEVEL + 1):
        w, h = cell_size_deg(level)
        ny = F.floor(dlat * 2 / h) + 2
        nx = F.when(pole, F.lit(float(2 ** lon_bits(level)))).otherwise(F.floor(dlon * 2 / w) + 2)
        chosen = F.when((F.lit(level) <= base) & (nx * ny <= max_cells), F.lit(level)).otherwise(chosen)
    return chosen


def _cell_ranges(lat, lon, dlat, dlon, pole, level):
    """(x_start, x_count, y_lo, y_hi, nx): the cells of a box at ``level``; x counted from x_start mod nx."""
    latb = _lat_bits(level)
    nx = _pow2(_lon_bits(level)).cast("long")
    y_lo = axis_cell(F.greatest(F.lit(-90.0), lat - dlat), -90.0, 180.0, latb)
    y_hi = axis_cell(F.least(F.lit(90.0), lat + dlat), -90.0, 180.0, latb)
    x_lo = F.floor((lon - dlon + 180.0) / 360.0 * nx.cast("double")).cast("long")
    x_hi = F.floor((lon + dlon + 180.0) / 360.0 * nx.cast("double")).cast("long")
    whole = pole | (x_hi - x_lo + 1 >= nx)
    x_start = F.when(whole, F.lit(0).cast("long")).otherwise(x_lo)
    x_count = F.when(whole, nx).otherwise(x_hi - x_lo + 1)
    return x_start, x_count, y_lo, y_hi, nx


def with_covering_cells(df, lat: str, lon: str, radius: str, level_out: str = "level", x_out: str = "x", y_out: str = "y"):
    """One row per (input row, covering cell): adds the search level and integer cell columns.

    Box values are staged as columns and the cells come from two plain ``explode(sequence)``
    generators, which keeps the plan small for Catalyst and the generated code.
    """
    dlat, dlon, pole = circle_box(lat, lon, radius)
    out = df.withColumn("_cb_dlat", dlat).withColumn("_cb_dlon", dlon).withColumn("_cb_pole", pole)
    out = out.withColumn(level_out, search_level(radius, "_cb_dlat", "_cb_dlon", "_cb_pole"))
    x_start, x_count, y_lo, y_hi, nx = _cell_ranges(F.col(lat), F.col(lon), F.col("_cb_dlat"), F.col("_cb_dlon"),
                                                     F.col("_cb_pole"), F.col(level_out))
    out = (out.withColumn("_cb_x0", x_start).withColumn("_cb_xn", x_count).withColumn("_cb_nx", nx)
           .withColumn("_cb_y0", y_lo).withColumn("_cb_y1", y_hi)
           .drop("_cb_dlat", "_cb_dlon", "_cb_pole"))
    out = out.withColumn(y_out, F.explode(F.sequence(F.col("_cb_y0"), F.col("_cb_y1"))))
    out = out.withColumn("_cb_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cb_xn") - 1)))
    out = out.withColumn(x_out, F.pmod(F.col("_cb_x0") + F.col("_cb_i"), F.col("_cb_nx")))
    return out.drop("_cb_x0", "_cb_xn", "_cb_nx", "_cb_y0", "_cb_y1", "_cb_i")


def with_cell(df, lat: str, lon: str, level, x_out: str = "x", y_out: str = "y"):
    """Add integer cell columns of a point at ``level`` (int or column name)."""
    lvl = level if isinstance(level, int) else F.col(level)
    return df.withColumn(x_out, cell_x(lon, lvl)).withColumn(y_out, cell_y(lat, lvl))


def with_geohash(df, lat: str, lon: str, precision: int, out: str = "geohash"):
    """Add a geohash column, computing the cells first so each is written once."""
    tx, ty = f"_{out}_x", f"_{out}_y"
    df = with_cell(df, lat, lon, precision, tx, ty)
    return df.withColumn(out, geohash_from_cell(F.col(tx), F.col(ty), precision)).drop(tx, ty)


def mask_coordinate(v, decimals: int) -> Column:
    """Keep ``decimals`` decimal places of a coordinate."""
    return F.round(_c(v), decimals)

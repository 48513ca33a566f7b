"""The scalar functions B1-B9 for SQL: temporary SQL functions of a session, all of built-in expressions.

``register_functions`` creates them under a prefix; they may then stand in any SQL text of that session. Their results equal
those of the Column functions of the same names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from nearfield.functions import geo

PREFIX = "nf_"
# Functions that only others call.
HELPERS = {"arc_m", "cell_at", "column_at", "row_at", "spread_bits", "geohash_of_bits", "block_of_cells", "offset_of"}

# Digits of base 32 as conv writes them.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _policy() -> str:
    return "case " + " ".join(f"when radius_m <= {r} then {p}" for r, p in geo.POLICY_PRECISION) + f" else {geo.POLICY_PRECISION_ELSE} end"


def definitions(p: str = PREFIX) -> list[tuple[str, str, str, str]]:
    """(name, parameters, result type, expression), each after those that it calls.

    A value that an expression needs more than once is a parameter of a helper function, so that Spark works it out once; lambdas
    would be interpreted row by row."""
    flat = f"{geo.METERS_PER_DEGREE_FLAT}D"
    return [
        ("clamp_lat", "lat DOUBLE", "DOUBLE", f"greatest(-{geo.LAT_CLAMP}D, least({geo.LAT_CLAMP}D, lat))"),
        ("wrap_lon", "lon DOUBLE", "DOUBLE",
         "case when lon >= -180D and lon < 180D then lon when lon >= -540D and lon < -180D then lon + 360D "
         "when lon >= 180D and lon < 540D then lon - 360D else pmod(lon + 180D, 360D) - 180D end"),
        ("arc_m", "a DOUBLE", "DOUBLE", f"{geo.EARTH_RADIUS_M}D * (2D * atan2(sqrt(a), sqrt(1D - a)))"),
        ("haversine_m", "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE",
         f"{p}arc_m(sin(radians(lat2 - lat1) / 2) * sin(radians(lat2 - lat1) / 2) + cos(radians(lat1)) * cos(radians(lat2)) "
         "* sin(radians(lon2 - lon1) / 2) * sin(radians(lon2 - lon1) / 2))"),
        ("round_half_up", "v DOUBLE", "BIGINT", "cast(floor(v + 0.5D) as bigint)"),
        ("cell_width_deg", "letters INT", "DOUBLE", "360D / pow(2D, floor((letters * 5 + 1) / 2))"),
        ("cell_height_deg", "letters INT", "DOUBLE", "180D / pow(2D, floor((letters * 5) / 2))"),
        ("precision_for_radius", "radius_m DOUBLE", "INT", _policy()),
        # A cell index on an axis: the scaled floor, moved by one where the cell's exact edges say so.
        ("cell_at", "v DOUBLE, lo DOUBLE, span DOUBLE, cells DOUBLE, k BIGINT", "BIGINT",
         "case when v < lo + (span * k) / cells and k > 0 then k - 1 "
         "when v >= lo + (span * (k + 1)) / cells and k < cast(cells as bigint) - 1 then k + 1 else k end"),
        ("axis_cell", "v DOUBLE, lo DOUBLE, span DOUBLE, cells DOUBLE", "BIGINT",
         f"{p}cell_at(v, lo, span, cells, least(greatest(cast(floor((v - lo) / span * cells) as bigint), 0L), cast(cells as bigint) - 1L))"),
        ("column_at", "lon DOUBLE, letters INT", "BIGINT", f"{p}axis_cell(lon, -180D, 360D, pow(2D, floor((letters * 5 + 1) / 2)))"),
        ("row_at", "lat DOUBLE, letters INT", "BIGINT", f"{p}axis_cell(lat, -90D, 180D, pow(2D, floor(letters * 5 / 2)))"),
        # The bits of a geohash alternate, longitude first, and end with a longitude bit if their number is odd: the binary digits of
        # an index read in base 4 stand at every other place, and the sum of both is the geohash in base 32.
        ("spread_bits", "k BIGINT", "BIGINT", "cast(conv(bin(k), 4, 10) as bigint)"),
        ("geohash_of_bits", "xs BIGINT, ys BIGINT, letters INT", "STRING",
         "translate(lpad(conv(cast(if(letters % 2 = 0, 2L * xs + ys, xs + 2L * ys) as string), 10, 32), letters, '0'), "
         f"'{_DIGITS}', '{geo.GEOHASH_ALPHABET}')"),
        ("geohash_of_cell", "x BIGINT, y BIGINT, letters INT", "STRING", f"{p}geohash_of_bits({p}spread_bits(x), {p}spread_bits(y), letters)"),
        ("geohash_encode", "lat DOUBLE, lon DOUBLE, letters INT", "STRING",
         f"{p}geohash_of_cell({p}column_at(lon, letters), {p}row_at(lat, letters), letters)"),
        ("block_of_cells", "x0 BIGINT, x1 BIGINT, x2 BIGINT, y0 BIGINT, y1 BIGINT, y2 BIGINT, letters INT", "ARRAY<STRING>",
         "array_distinct(array(" + ", ".join(f"{p}geohash_of_bits(x{x}, y{y}, letters)" for y in range(3) for x in range(3)) + "))"),
        ("neighbor_cells", "lat DOUBLE, lon DOUBLE, letters INT", "ARRAY<STRING>",
         f"{p}block_of_cells("
         + ", ".join(f"{p}spread_bits({p}column_at({p}wrap_lon(lon + {dx} * {p}cell_width_deg(letters)), letters))" for dx in (-1, 0, 1)) + ", "
         + ", ".join(f"{p}spread_bits({p}row_at({p}clamp_lat(lat + {dy} * {p}cell_height_deg(letters)), letters))" for dy in (-1, 0, 1)) + ", letters)"),
        ("move_point", "lat DOUBLE, lon DOUBLE, dist_m DOUBLE, bearing_rad DOUBLE", "STRUCT<latitude: DOUBLE, longitude: DOUBLE>",
         f"named_struct('latitude', {p}clamp_lat(lat + dist_m * cos(bearing_rad) / {flat}), 'longitude', {p}wrap_lon(lon + "
         f"dist_m * sin(bearing_rad) / ({flat} * greatest({geo.MIN_COS_LAT}D, cos(radians(lat))))))"),
        ("encode_cursor", "page_offset INT", "STRING",
         "translate(regexp_replace(base64(cast(cast(page_offset as string) as binary)), '=+$', ''), '+/', '-_')"),
        ("offset_of", "t STRING", "INT", "if(t rlike '^[+-]?[0-9]+$' and try_cast(t as int) >= 0, try_cast(t as int), null)"),
        # The offset of a valid cursor, 0 of a blank one, null of an invalid one.
        ("decode_cursor", "page_cursor STRING", "INT",
         r"""case when page_cursor is null or page_cursor rlike '^\\s*$' then 0
  when page_cursor rlike '^[A-Za-z0-9_-]*={0,2}$' and length(regexp_replace(page_cursor, '=+$', '')) % 4 <> 1
    and (not contains(page_cursor, '=') or length(page_cursor) % 4 = 0) then
  """ + p + r"""offset_of(cast(try_to_binary(translate(rpad(regexp_replace(page_cursor, '=+$', ''),
      cast(floor((length(regexp_replace(page_cursor, '=+$', '')) + 3) / 4) as int) * 4, '='), '-_', '+/'), 'base64') as string)) end"""),
    ]


def register_functions(spark: SparkSession, prefix: str = PREFIX) -> list[str]:
    """Creates the functions in the session, replacing those of the same names; returns the names of those to be called."""
    names = []
    for name, parameters, result, body in definitions(prefix):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
        if name not in HELPERS:
            names.append(prefix + name)
    return names

"""Small SQL text helpers for the DuckDB oracle queries (independent of the Spark code path).

Literals are cast to DOUBLE explicitly: DuckDB reads ``360.0`` as a DECIMAL, which would turn
the cell-edge arithmetic into decimal arithmetic.
"""

from __future__ import annotations

from nearfield.sources.fixtures import fixture_sql_duckdb

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def with_fixtures(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({fixture_sql_duckdb(n).strip()})" for n in names)
    return f"WITH {ctes},\n{body.strip()}" if names else body


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2) + "
         f"cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2)")
    return f"({d(6371000.0)} * (2 * atan2(sqrt({a}), sqrt(1 - ({a})))))"


def axis_cell(v: str, lo: float, span: float, nbits: int) -> str:
    n = float(2 ** nbits)
    top = 2 ** nbits - 1
    k0 = f"least(greatest(CAST(floor(({v} - {d(lo)}) / {d(span)} * {d(n)}) AS BIGINT), 0), {top})"
    lo_edge = f"({d(lo)} + ({d(span)} * {k0}) / {d(n)})"
    hi_edge = f"({d(lo)} + ({d(span)} * ({k0} + 1)) / {d(n)})"
    return (f"(CASE WHEN {v} < {lo_edge} AND {k0} > 0 THEN {k0} - 1 "
            f"WHEN {v} >= {hi_edge} AND {k0} < {top} THEN {k0} + 1 ELSE {k0} END)")


def geohash_chars(x: str, y: str, precision: int) -> str:
    """Geohash text from integer cell columns, one character at a time (bit by bit)."""
    lonb, latb = (5 * precision + 1) // 2, (5 * precision) // 2
    chars = []
    for c in range(precision):
        terms = []
        for t in range(5):
            j = 5 * c + t
            if j % 2 == 0:
                bit = f"(({x} >> {lonb - 1 - j // 2}) & 1)"
            else:
                bit = f"(({y} >> {latb - 1 - (j - 1) // 2}) & 1)"
            terms.append(f"{bit} * {2 ** (4 - t)}")
        chars.append(f"substr('{ALPHABET}', CAST({' + '.join(terms)} AS INTEGER) + 1, 1)")
    return " || ".join(chars)


def geohash_select(src: str, lat: str, lon: str, precision: int, out: str = "geohash", where: str = "") -> str:
    """``SELECT *, <geohash> AS out FROM src``: cells first, then characters, so the cell
    expressions are written once."""
    lonb, latb = (5 * precision + 1) // 2, (5 * precision) // 2
    if src.lstrip().upper().startswith("SELECT"):
        src = f"({src})"
    inner = (f"SELECT *, {axis_cell(lon, -180.0, 360.0, lonb)} AS _gx, {axis_cell(lat, -90.0, 180.0, latb)} AS _gy "
             f"FROM {src} {where}")
    return f"SELECT * EXCLUDE (_gx, _gy), {geohash_chars('_gx', '_gy', precision)} AS {out} FROM ({inner})"


def clamp_lat(v: str) -> str:
    return f"greatest({d(-89.999999)}, least({d(89.999999)}, {v}))"


def wrap_lon(v: str) -> str:
    return f"(CASE WHEN {v} < -180 THEN {v} + {d(360.0)} WHEN {v} >= 180 THEN {v} - {d(360.0)} ELSE {v} END)"


def cursor(offset_sql: str) -> str:
    """URL-safe unpadded base64 of the decimal offset."""
    b64 = f"to_base64(CAST(CAST({offset_sql} AS VARCHAR) AS BLOB))"
    return f"translate(rtrim({b64}, '='), '+/', '-_')"

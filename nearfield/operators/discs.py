"""Circles over the tree's upper cells, and counts and nearest points of many circles over the points of one tile, vectorised; used
inside tasks only.

A task reads sorted rows: the points of a tile, then the searches that reach it, tile after tile. A tile's points stand in strips
of latitude with equally many points, each cut into columns of longitude with the start of every column kept. So in each strip the
columns that surely lie inside a circle are counted by one subtraction, and only points in the columns on its edge are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

RADIUS_M = 6_371_000.0
# Searches of a tile that are answered together, strips and points compared at once (few enough for a core's cache).
SEARCHES, STRIPS, POINTS = 1 << 15, 1 << 15, 1 << 17
# Metres within which a comparison with a radius, or of two distances, is left to the caller's exact distance.
UNSURE_M, TIE_M = 1e-6, 1e-5
_PAD = 1e-9  # degrees
# Bits of a distance in millionths of a metre, half the globe at most; TIE_M in these, one more for what their floors drop.
_AWAY_BITS, _TIE = 45, round(TIE_M * 1e6) + 1


def _half_sine2(radius: np.ndarray) -> np.ndarray:
    """sin^2 of half the angle of a distance; -1 below zero."""
    s = np.sin(np.minimum(np.maximum(radius, 0.0) / (2 * RADIUS_M), np.pi / 2)) ** 2
    return np.where(radius < 0, -1.0, s)


def _units(lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = np.radians(lat), np.radians(lon)
    return np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)


def _runs(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of the runs first[i], first[i] + 1, ... of sizes[i] values."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) + np.repeat(first - before, sizes)


def _pieces(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of consecutive entries whose sizes add up to ``most`` or little more; one entry at least."""
    total, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + most, "right")))
        yield slice(low, high)
        low = high


class Searches:
    """The circles of one batch: centre, radius, rows wanted (``to``) and the box (south, north, west, width in degrees) that
    matches must lie in as well, or None."""

    def __init__(self, lat, lon, radius, to=None, box=None):
        self.lat, self.lon, self.radius, self.to, self.box = lat, lon, radius, to, box

    def part(self, at) -> Searches:
        return Searches(self.lat[at], self.lon[at], self.radius[at], None if self.to is None else self.to[at],
                        None if self.box is None else [b[at] for b in self.box])


class Cells:
    """The tree cut off at its tiles (level, x, y, n, open, parts), each level's cells after one another with the span of their children."""

    def __init__(self, level, x, y, n, open_, parts):
        self.first = int(level.min()) if len(level) else 0
        self.levels = []
        for at in range(self.first, int(level.max()) + 1 if len(level) else 0, 2):
            here = np.flatnonzero(level == at)
            # Children of one cell lie together: ordered by their parent, then by themselves.
            here = here[np.lexsort((y[here], x[here], y[here] >> 2, x[here] >> 2))]
            self.levels.append({"x": x[here], "y": y[here], "n": n[here], "open": open_[here], "parts": parts[here], "level": at})
        for above in self.levels:
            above["from"], above["number"] = np.zeros((2, len(above["x"])), np.int64)
        for above, here in zip(self.levels[:-1], self.levels[1:], strict=True):
            key = ((here["x"] >> 2) << 21) | (here["y"] >> 2)
            own = (above["x"] << 21) | above["y"]
            above["from"] = np.searchsorted(key, own)
            above["number"] = np.searchsorted(key, own, "right") - above["from"]
        if self.levels:
            root = self.levels[0]
            self.keys = (root["x"] << 21) | root["y"]
            self.order = np.argsort(self.keys)
            self.keys = self.keys[self.order]

    def roots(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Where each root stands, -1 for one that holds no point."""
        key = (x << 21) | y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


def _axis(v: np.ndarray, low: float, span: float, level: int) -> np.ndarray:
    """The cell of a coordinate, as far as rounding lets one tell."""
    return np.clip(np.floor((v - low) / span * 2.0 ** level), 0, 2 ** level - 1).astype(np.int64)


def _cell_bounds(level: int, x: np.ndarray, y: np.ndarray, lat: np.ndarray, lon: np.ndarray, cos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sin^2 of half the angle from a point within which no, and within which every point of a cell lies; but for rounding."""
    w, h = 360.0 / 2 ** level, 180.0 / 2 ** level
    mid = -90.0 + h * (y + 0.5)
    dx, dy = np.abs((-180.0 + w * (x + 0.5) - lon + 180.0) % 360.0 - 180.0), np.abs(mid - lat)
    near, far = np.cos(np.radians(np.maximum(np.abs(mid) - h / 2, 0.0))), np.maximum(np.cos(np.radians(np.abs(mid) + h / 2)), 0.0)
    sine2 = lambda v: np.sin(v * (np.pi / 360.0)) ** 2
    low = sine2(np.maximum(dy - h / 2, 0.0)) + cos * far * sine2(np.maximum(dx - w / 2, 0.0))
    high = sine2(np.minimum(dy + h / 2, 180.0)) + cos * near * sine2(np.minimum(dx + w / 2, 180.0))
    return low * (1 - 1e-9), np.minimum(high * (1 + 1e-9), 1.0)


def _in_box(level: int, x: np.ndarray, y: np.ndarray, box: list) -> tuple[np.ndarray, np.ndarray]:
    """(surely outside, surely inside) of cells and boxes (south, north, west, width)."""
    w, h = 360.0 / 2 ** level, 180.0 / 2 ** level
    south, west = -90.0 + h * y, (-180.0 + w * x - box[2]) % 360.0
    out = (south >= box[1]) | (south + h <= box[0]) | ((west >= box[3]) & (west + w <= 360.0))
    return out, (south >= box[0]) & (south + h <= box[1]) & (west + w <= box[3])


# Degrees by which the roots of a circle's box are widened, in parts of itself, as in ``geo.circle_box``.
_WIDEN = 1.0001


class _Batch:
    """A batch of searches: those with a place and a radius, and the rows they came from."""

    def __init__(self, batch, boxed: bool, most: str = "radius"):
        col = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
        lat, lon, radius = col("q_lat"), col("q_lon"), col(most)
        box = [col(c) for c in ("_south", "_north", "_west", "_width")] if boxed else None
        self.rows = np.flatnonzero(np.isfinite(lat) & np.isfinite(lon) & np.isfinite(radius))
        self.q = Searches(lat, lon, radius, None, box).part(self.rows)


def _rooted(cells: Cells, q: Searches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(search, root) of the roots in reach that hold a point; all of a search in one piece."""
    level, n = cells.first, 2 ** cells.first
    angle = q.radius / RADIUS_M
    dlat = np.degrees(angle) * _WIDEN
    ratio = np.sin(angle) / np.cos(np.radians(q.lat))
    pole = (q.lat + dlat >= 90.0) | (q.lat - dlat <= -90.0) | (ratio >= 1.0)
    dlon = np.where(pole, 180.0, np.degrees(np.arcsin(np.clip(ratio, -1.0, 1.0))) * _WIDEN)
    x0 = np.floor((q.lon - dlon + 180.0) / 360.0 * n).astype(np.int64)
    xn = np.maximum(np.minimum(np.floor((q.lon + dlon + 180.0) / 360.0 * n).astype(np.int64) - x0 + 1, n), 0)
    y0, y1 = _axis(q.lat - dlat, -90.0, 180.0, level), _axis(q.lat + dlat, -90.0, 180.0, level)
    each = np.where(q.radius < 0, 0, xn * np.maximum(y1 - y0 + 1, 0))
    for piece in _pieces(each, STRIPS):
        own, k = _runs(np.zeros(piece.stop - piece.start, np.int64), each[piece])
        own = own + piece.start
        at = cells.roots((x0[own] + k % np.maximum(xn[own], 1)) % n, y0[own] + k // np.maximum(xn[own], 1))
        yield own[at >= 0], at[at >= 0]


def reached(batches: Iterator, cells: Cells, carried: list[str], boxed: bool, whole: bool) -> Iterator:
    """The tiles that each circle cuts (state check, one row a part), and the number of points in the cells wholly inside it (state
    whole, n, one row a search); without ``whole`` all tiles in reach. Rows: carried, level, x, y, part, n, state."""
    import pyarrow as pa

    for batch in batches:
        if not cells.levels or not batch.num_rows:
            continue
        of = _Batch(batch, boxed)
        q, total = of.q, np.zeros(len(of.rows), np.int64)
        cos = np.cos(np.radians(q.lat))
        # A cell is left out only if it lies surely outside, and counted only if it lies surely inside.
        outer, inner = _half_sine2(q.radius + UNSURE_M), _half_sine2(q.radius - UNSURE_M)
        found = []
        for own, at in _rooted(cells, q):
            for here in cells.levels:
                x, y = here["x"][at], here["y"][at]
                low, high = _cell_bounds(here["level"], x, y, q.lat[own], q.lon[own], cos[own])
                keep, sure = low <= outer[own], high <= inner[own]
                if boxed:
                    out, inside = _in_box(here["level"], x, y, [b[own] for b in q.box])
                    keep, sure = keep & ~out, sure & inside
                sure &= keep & whole
                np.add.at(total, own[sure], here["n"][at[sure]])
                keep &= ~sure
                below = keep & here["open"][at]
                tile = np.flatnonzero(keep & ~below)
                if len(tile):
                    again, part = _runs(np.zeros(len(tile), np.int64), here["parts"][at[tile]])
                    found.append((own[tile][again], np.full(len(again), here["level"]), x[tile][again], y[tile][again], part))
                own, at = own[below], at[below]
                if not len(own):
                    break
                again, child = _runs(here["from"][at], here["number"][at])
                own, at = own[again], child
        some = np.flatnonzero(total)
        columns = [np.concatenate(c) if len(c) else np.zeros(0, np.int64) for c in (zip(*found, strict=True) if found else [[]] * 5)]
        for search, state, extra in ((columns[0], "check", columns[1:]), (some, "whole", None)):
            if not len(search):
                continue
            rows = batch.select(carried).take(pa.array(of.rows[search]))
            n, none = len(search), lambda kind: pa.nulls(n, kind)  # noqa: B023, E731
            tile = [none(k) for k in (pa.int32(), pa.int64(), pa.int64(), pa.int64())] if extra is None else [
                pa.array(extra[0].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in extra[1:])]
            yield pa.RecordBatch.from_arrays([*rows.columns, *tile, pa.array(total[some]) if extra is None else none(pa.int64()), pa.array([state] * n)],
                                             [*carried, "level", "x", "y", "part", "n", "state"])


def homes(batches: Iterator, cells: Cells, carried: list[str], boxed: bool) -> Iterator:
    """Every search once, with the tile it stands in (level, x, y; null where it has none, or one of several parts, or ``_apart``) and
    limit_m: the radius, or less if the smallest cell around it that holds _to points reaches less far."""
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        of, n = _Batch(batch, boxed, "_within"), batch.num_rows
        q = of.q
        limit, level, tx, ty = np.full(n, np.nan), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        limit[of.rows] = q.radius
        if cells.levels and len(of.rows):
            to = batch.column("_to").to_numpy(zero_copy_only=False)[of.rows]
            cos, own = np.cos(np.radians(q.lat)), np.arange(len(of.rows))
            at = cells.roots(_axis(q.lon, -180.0, 360.0, cells.first), _axis(q.lat, -90.0, 180.0, cells.first))
            own, at = own[at >= 0], at[at >= 0]
            for here in cells.levels:
                x, y = here["x"][at], here["y"][at]
                _, high = _cell_bounds(here["level"], x, y, q.lat[own], q.lon[own], cos[own])
                enough = here["n"][at] >= to[own]
                if boxed:
                    enough &= _in_box(here["level"], x, y, [b[own] for b in q.box])[1]
                limit[of.rows[own]] = np.where(enough, np.minimum(limit[of.rows[own]], _metres(high)), limit[of.rows[own]])
                tile = np.flatnonzero(~here["open"][at] & (here["parts"][at] == 1))
                row = of.rows[own[tile]]
                level[row], tx[row], ty[row] = here["level"], x[tile], y[tile]
                # Down to the child that the search stands in.
                cx, cy = (_axis(v[own], low, span, here["level"] + 2) for v, low, span in ((q.lon, -180.0, 360.0), (q.lat, -90.0, 180.0)))
                again, child = _runs(here["from"][at], here["number"][at] * here["open"][at])
                if not len(child):
                    break
                under = cells.levels[(here["level"] - cells.first) // 2 + 1]
                met = (under["x"][child] == cx[again]) & (under["y"][child] == cy[again])
                own, at = own[again[met]], child[met]
        gone = (level == 0) | batch.column("_apart").to_numpy(zero_copy_only=False).astype(bool)
        kept = batch.select(carried)
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(level.astype(np.int32), mask=gone), pa.array(tx, mask=gone), pa.array(ty, mask=gone), pa.array(limit, mask=np.isnan(limit))],
            [*carried, "level", "x", "y", "limit_m"])


def _metres(half_sine2: np.ndarray) -> np.ndarray:
    """Metres that surely hold what lies within sin^2 of half an angle."""
    return 2 * RADIUS_M * np.arcsin(np.sqrt(np.clip(half_sine2, 0.0, 1.0))) * (1 + 1e-9) + TIE_M


def _gap(level: np.ndarray, x: int, y: int, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """sin^2 of half the angle within which nothing lies outside the cell; -1 for searches not inside it."""
    w, h = 360.0 / 2.0 ** level, 180.0 / 2.0 ** level
    south, west = -90.0 + h * y, -180.0 + w * x
    up, side = np.minimum(lat - south, south + h - lat), np.minimum(lon - west, west + w - lon)
    # Half the angle to the nearer of the two meridians, from the sine of the whole.
    s = np.cos(np.radians(lat)) * np.sin(np.radians(np.clip(side, 0.0, 90.0)))
    half = s * s / (2 * (1 + np.sqrt(1 - s * s)))
    return np.where((up <= 0) | (side <= 0), -1.0, np.minimum(np.sin(np.radians(up) / 2) ** 2, half) * (1 - 1e-9))


class Tile:
    def __init__(self, ids: np.ndarray, lat: np.ndarray, lon: np.ndarray, coarse: int = 2):
        """``coarse``: how few strips; 2 suits the search for the nearest points, 3 counts, whose time goes by the strips that a circle meets."""
        n = len(ids)
        order = np.lexsort((ids, lon, lat))
        lat, lon = lat[order], lon[order]
        same = np.zeros(n, bool)
        same[1:] = (lat[1:] == lat[:-1]) & (lon[1:] == lon[:-1])
        place = np.arange(n)
        copy = place - np.maximum.accumulate(np.where(same, 0, place))  # how many smaller ids stand on the same spot
        self.ns = max(1, min(256, int(n ** 0.5 / coarse)))
        strip = place * self.ns // n
        self.south = np.full(self.ns, 0.0)
        self.north = np.full(self.ns, 0.0)
        edge = np.searchsorted(strip, np.arange(self.ns + 1))
        self.south, self.north = lat[edge[:-1]] - _PAD, lat[edge[1:] - 1] + _PAD
        ends = np.cos(np.radians(np.stack([self.south, self.north])))
        self.cos_low = np.maximum(ends.min(0), 0.0)
        self.cos_high = np.where((self.south <= 0) & (self.north >= 0), 1.0, ends.max(0))
        self.nx = max(1, min(1024, n // self.ns // 2))
        self.west, self.east = lon.min(), lon.max()
        self.scale = self.nx / max((self.east - self.west) * (1 + 1e-9), 1e-12)
        column = self._column(lon).astype(np.int64)
        again = np.argsort(strip * self.nx + column, kind="stable")
        self.start = np.zeros(self.ns * self.nx + 1, np.int64)
        held = np.bincount(strip * self.nx + column, minlength=self.ns * self.nx)
        np.cumsum(held, out=self.start[1:])
        self.sums = np.zeros((self.ns + 1, self.nx + 1), np.int64)
        self.sums[1:, 1:] = held.reshape(self.ns, self.nx).cumsum(0).cumsum(1)
        self.order, self.copy, self.lat, self.lon = order[again], copy[again], lat[again], lon[again]
        self.units = _units(self.lat, self.lon)
        # As cells see them: the upper bounds lie in the last cell.
        self.cell_lat = np.clip(self.lat, -90.0, np.nextafter(90.0, 0))
        self.cell_lon = np.clip(self.lon, -180.0, np.nextafter(180.0, 0))

    def _column(self, lon: np.ndarray) -> np.ndarray:
        return np.floor((lon - self.west) * self.scale)

    def _near(self, lon: np.ndarray) -> np.ndarray:
        """Longitudes moved by whole turns to the tile's."""
        return lon + 360.0 * np.round(((self.west + self.east) / 2 - lon) / 360.0)

    def _box(self, q: Searches) -> tuple | None:
        if q.box is None:
            return None
        south, north, west, width = q.box
        west = self._near(west + width / 2) - width / 2
        return south, north, west, west + width

    def _strips(self, q: Searches, outer: np.ndarray, box) -> tuple[np.ndarray, np.ndarray]:
        """First strip and number of strips that each circle may touch; ``outer`` is sin^2 of half its angle."""
        high = np.degrees(2 * np.arcsin(np.sqrt(np.clip(outer, 0, 1)))) * (1 + 1e-9) + _PAD
        low, up = q.lat - high, q.lat + high
        if box:
            low, up = np.maximum(low, box[0]), np.minimum(up, box[1])
        first = np.searchsorted(self.north, low)
        return first, np.where(outer < 0, 0, np.maximum(np.searchsorted(self.south, up, "right") - first, 0))

    def _columns(self, q: Searches, at, s, outer, inner, box):
        """Per circle and strip the columns [oa, ob) it may touch and those, [ia, ib), that surely lie inside."""
        lat, near = q.lat[at], self._near(q.lon)[at]
        south, north = self.south[s], self.north[s]
        cos = np.cos(np.radians(q.lat))[at]
        half = lambda num, den: np.degrees(2 * np.arcsin(np.sqrt(np.clip(num / np.maximum(den, 1e-300), 0, 1))))
        gap = np.maximum(np.maximum(south - lat, lat - north), 0.0)
        num = outer[at] - np.sin(np.radians(gap) / 2) ** 2
        wide = np.where(num < 0, -1.0, half(num, cos * self.cos_low[s]) * (1 + 1e-9) + _PAD)
        col = lambda v: np.clip(self._column(v), -1, self.nx)
        oa, ob = np.maximum(col(near - wide), 0), np.minimum(col(near + wide) + 1, self.nx)
        middle, spread = (self.west + self.east) / 2, (self.east - self.west) / 2
        around = wide + np.abs(near - middle) + spread >= 180.0 - 1e-6
        oa, ob = np.where(around, 0, oa), np.where(around, self.nx, ob)
        if box:
            oa, ob = np.maximum(oa, col(box[2][at])), np.minimum(ob, col(box[3][at]) + 1)
        ob = np.where(wide < 0, oa, np.maximum(ob, oa))
        if inner is None:
            return oa.astype(np.int64), ob.astype(np.int64), None, None
        far = np.maximum(np.abs(south - lat), np.abs(north - lat))
        num = inner[at] - np.sin(np.radians(far) / 2) ** 2
        sure = np.where(num < 0, -1.0, half(num, cos * self.cos_high[s]) * (1 - 1e-9) - _PAD)
        ia, ib = np.maximum(col(near - sure) + 1, 0), np.minimum(col(near + sure), self.nx)
        if box:
            ia, ib = np.maximum(ia, col(box[2][at]) + 1), np.minimum(ib, col(box[3][at]))
            sure = np.where((south >= box[0][at]) & (north < box[1][at]), sure, -1.0)
        ia, ib = np.maximum(ia, oa), np.minimum(ib, ob)
        none = (sure <= 0) | (ib <= ia)
        return oa.astype(np.int64), ob.astype(np.int64), np.where(none, oa, ia).astype(np.int64), np.where(none, oa, ib).astype(np.int64)

    def _compared(self, q: Searches, units, at: np.ndarray, first: np.ndarray, last: np.ndarray, box) -> Iterator[tuple]:
        """(search, point, squared chord) of the points [first, last) for the searches ``at``, piece by piece, as far as in the box."""
        for piece in _pieces(last - first, POINTS):
            owner, point = _runs(first[piece], (last - first)[piece])
            search = at[piece][owner]
            if box:
                ok = ((self.cell_lat[point] >= box[0][search]) & (self.cell_lat[point] < box[1][search])
                      & (self.cell_lon[point] >= box[2][search]) & (self.cell_lon[point] < box[3][search]))
                search, point = search[ok], point[ok]
            chord2 = np.zeros(len(point))
            for a, b in zip(self.units, units, strict=True):
                chord2 += (a[point] - b[search]) ** 2
            yield search, point, chord2

    def count(self, all_: Searches) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(searches, counts, search, point): points surely within each radius, and the pairs too close to it to tell."""
        sizes = self._strips(all_, _half_sine2(all_.radius + UNSURE_M), self._box(all_))[1]
        for part in _pieces(sizes, STRIPS):
            q = all_.part(part)
            outer, inner, box, units = _half_sine2(q.radius + UNSURE_M), _half_sine2(q.radius - UNSURE_M), self._box(q), _units(q.lat, q.lon)
            first, number = self._strips(q, outer, box)
            at, s = _runs(first, number)
            oa, ob, ia, ib = (s * self.nx + c for c in self._columns(q, at, s, outer, inner, box))
            found = np.bincount(at, self.start[ib] - self.start[ia], len(q.lat))
            unsure = []
            sides = np.concatenate([at, at]), np.concatenate([self.start[oa], self.start[ib]]), np.concatenate([self.start[ia], self.start[ob]])
            # Where nothing is sure, ia = ib = oa: the left side is empty and the right one holds all.
            for search, point, chord2 in self._compared(q, units, *sides, box):
                sure = chord2 < (4 * inner * (1 - 4e-15))[search]
                found += np.bincount(search[sure], minlength=len(q.lat))
                open_ = ~sure & (chord2 <= (4 * outer * (1 + 4e-15))[search])
                unsure.append((search[open_], point[open_]))
            yield part, found.astype(np.int64), np.concatenate([u[0] for u in unsure] or [at[:0]]), np.concatenate([u[1] for u in unsure] or [at[:0]])

    def _reach(self, q: Searches, box) -> np.ndarray:
        """sin^2 of half the angle within which the tile surely holds ``to`` points of a circle, or that of its radius: the
        farthest corner of the first block of columns and strips around the centre that holds as many."""
        reach = _half_sine2(q.radius + TIE_M)
        near, cos = self._near(q.lon), np.cos(np.radians(q.lat))
        i = np.minimum(np.searchsorted(self.north, q.lat), self.ns - 1)
        j = np.clip(self._column(near), 0, self.nx - 1).astype(np.int64)
        todo, w = np.arange(len(q.lat)), 0
        while len(todo) and w <= 2 * max(self.ns, self.nx):
            i0, i1 = np.maximum(i[todo] - w, 0), np.minimum(i[todo] + w + 1, self.ns)
            j0, j1 = np.maximum(j[todo] - w, 0), np.minimum(j[todo] + w + 1, self.nx)
            held = self.sums[i1, j1] - self.sums[i0, j1] - self.sums[i1, j0] + self.sums[i0, j0]
            ends, sides = (self.south[i0], self.north[i1 - 1]), (self.west + j0 / self.scale - _PAD, self.west + j1 / self.scale + _PAD)
            far = np.zeros(len(todo))
            for a in ends:
                for b in sides:
                    far = np.maximum(far, np.sin(np.radians(a - q.lat[todo]) / 2) ** 2
                                     + cos[todo] * np.cos(np.radians(a)) * np.sin(np.radians(b - near[todo]) / 2) ** 2)
            enough = held >= q.to[todo]
            fits = enough & (far < 0.5)
            if box:
                fits &= (ends[0] >= box[0][todo]) & (ends[1] < box[1][todo]) & (sides[0] >= box[2][todo]) & (sides[1] < box[3][todo])
            done = todo[fits]
            reach[done] = np.minimum(reach[done], (np.sqrt(far[fits]) * (1 + 1e-9) + TIE_M / RADIUS_M) ** 2)
            todo, w = todo[~enough], w + 1 + w // 4
        return reach

    def nearest(self, all_: Searches) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(searches, search, point): the ``to`` nearest points of each circle, all that are as far as the last of them, and, on one
        spot, those of the ``to`` smallest ids."""
        wide = self._reach(all_, self._box(all_))
        first, number = self._strips(all_, wide, self._box(all_))
        for part in _pieces(number, STRIPS):
            q, outer = all_.part(part), wide[part]
            box, units = self._box(q), _units(q.lat, q.lon)
            at, s = _runs(first[part], number[part])
            oa, ob, _, _ = self._columns(q, at, s, outer, None, box)
            low, high = self.start[s * self.nx + oa], self.start[s * self.nx + ob]
            # All strips of a search stay in one piece.
            each = np.bincount(at, high - low, len(q.lat)).astype(np.int64)
            for some in _pieces(each, POINTS):
                rows = slice(*np.searchsorted(at, [some.start, some.stop]))
                met = [*self._compared(q, units, at[rows], low[rows], high[rows], box)]
                if not met:
                    continue
                search, point, chord2 = (np.concatenate(x) for x in zip(*met, strict=True))
                ok = (chord2 <= (4 * outer * (1 + 4e-15))[search]) & (self.copy[point] < q.to[search])
                search, point, away = search[ok], point[ok], 2 * RADIUS_M * np.arcsin(np.minimum(np.sqrt(chord2[ok]) / 2, 1.0))
                # One number a pair, search before distance in millionths of a metre: numbers sort fast. ``search`` rises already.
                key = (search.astype(np.int64) << _AWAY_BITS) | (away * 1e6).astype(np.int64)
                begin = np.searchsorted(search, np.arange(len(q.lat) + 1))
                last = np.minimum(begin[:-1] + q.to - 1, begin[1:] - 1)[search]
                keep = key <= np.sort(key)[last] + _TIE
                yield part, search[keep], point[keep]


# Rows that a task reads are sorted by one number, ``at``: four times that of their block and their kind, in this order.
POINT, DETAIL, SEARCH = range(3)
DETAILS = ("name", "category", "h_lat", "h_lon")


def _floats(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64)


def _distance(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Metres, by the steps of ``geo.haversine_m``."""
    s_lat, s_lon = np.sin(np.radians(lat2 - lat1) / 2), np.sin(np.radians(lon2 - lon1) / 2)
    a = s_lat * s_lat + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * s_lon * s_lon
    return RADIUS_M * (2.0 * np.arctan2(np.sqrt(a), np.sqrt(1.0 - a)))


class _Loaded:
    """A tile with its points' ids and details: the business rows of a point, none or several."""

    def __init__(self, points: list, details: list, coarse: int):
        import pyarrow as pa

        p = pa.Table.from_batches(points).combine_chunks()
        self.ids = p["business_id"].combine_chunks()
        # A null id goes before all others, and has no details.
        number = self.ids.fill_null(np.iinfo(np.int64).min).to_numpy()
        self.tile = Tile(number, _floats(p["q_lat"].combine_chunks()), _floats(p["q_lon"].combine_chunks()), coarse)
        self.number, self.details = number[self.tile.order], None
        if details:
            self.details = pa.Table.from_batches(details).combine_chunks()
            self.details = self.details.take(pa.array(np.argsort(self.details["business_id"].to_numpy(), kind="stable")))
            own = self.details["business_id"].to_numpy()
            self.first = np.searchsorted(own, self.number)
            self.each = np.searchsorted(own, self.number, "right") - self.first

    def ranked(self, q: Searches, within: np.ndarray, from_: np.ndarray) -> Iterator[tuple]:
        """(search, point, rank, unsure) of the rows from_ + 1 .. to of each circle's order, by distance to 6 decimals, then by id. Rows
        that only an exact comparison with the radius can tell are unsure, and rank last."""
        t = self.tile
        for part, search, point in t.nearest(q):
            search = search + part.start
            away = _distance(q.lat[search], q.lon[search], t.lat[point], t.lon[point])
            ok = away <= within[search] + UNSURE_M
            search, point, away = search[ok], point[ok], away[ok]
            beyond = away > within[search]
            place = np.floor(away * 1e6 + 0.5).astype(np.int64)
            order = np.lexsort((self.number[point], place, beyond, search))
            search, point, away = search[order], point[order], away[order]
            rank = np.arange(len(search)) - np.searchsorted(search, search) + 1
            ok = (rank > from_[search]) & (rank <= q.to[search])
            search, point, rank, away = search[ok], point[ok], rank[ok], away[ok]
            yield search, point, rank, np.abs(away - within[search]) <= UNSURE_M


def answers(batches: Iterator, mode: str, carried: list[str], boxed: bool, detailed: bool = False, empty: bool = False) -> Iterator:
    """Rows sorted by tile, its points before the details of its points and these before its searches. Gives the carried columns and, in ``mode``

    * count: n, b_lat, b_lon, where a row without n is a pair to compare exactly;
    * nearest: business_id, b_lat, b_lon of candidates for the first _to rows;
    * limit: every search, with limit_m that holds its first _to rows, and whether the tile alone surely holds them (sure);
    * page: rank, business_id, b_lat, b_lon, unsure of the rows _from + 1 .. _to, if ``detailed`` each with its details, one row for each
      and none without; with ``empty`` a search without rows gives one row of nulls."""
    import pyarrow as pa

    held = {"block": None, "tile": None, "points": [], "details": [], "searches": [], "rows": 0}

    def flush() -> Iterator:
        if held["rows"] and held["points"]:
            if held["tile"] is None:
                held["tile"] = _Loaded(held["points"], held["details"], 3 if mode == "count" else 2)
            loaded = held["tile"]
            tile, ids = loaded.tile, loaded.ids
            t = pa.Table.from_batches(held["searches"]).combine_chunks()
            col = lambda c: _floats(t[c].combine_chunks())
            q = Searches(col("q_lat"), col("q_lon"), col("radius"), None if mode == "count" else col("_to").astype(np.int64),
                         [col(c) for c in ("_south", "_north", "_west", "_width")] if boxed else None)

            def rows(search, named):
                taken = t.select(carried).take(pa.array(search))
                return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in taken.columns), *named.values()], [*carried, *named])

            none = lambda n, kind: pa.nulls(n, kind)
            if mode == "count":
                met = [(found, search + part.start, point) for part, found, search, point in tile.count(q)]
                found, search, point = (np.concatenate(c) for c in zip(*met, strict=True))
                own = np.flatnonzero(found)
                yield rows(own, {"n": pa.array(found[own]), "b_lat": none(len(own), pa.float64()), "b_lon": none(len(own), pa.float64())})
                if len(search):
                    yield rows(search, {"n": none(len(search), pa.int64()), "b_lat": pa.array(tile.lat[point]), "b_lon": pa.array(tile.lon[point])})
            elif mode == "limit":
                reach = tile._reach(q, tile._box(q))
                sure = reach * (1 + 1e-9) <= _gap(*(t[c].to_numpy() for c in ("level", "x", "y")), q.lat, q.lon)
                yield rows(np.arange(len(reach)), {"limit_m": pa.array(np.minimum(q.radius, _metres(reach))), "sure": pa.array(sure)})
            elif mode == "page":
                found = np.zeros(len(q.lat), bool)
                for search, point, rank, unsure in loaded.ranked(q, col("_within"), col("_from")):
                    if empty:  # the search must be known to have rows or none
                        keep = ~unsure | (_distance(q.lat[search], q.lon[search], tile.lat[point], tile.lon[point]) <= col("_within")[search])
                        search, point, rank, unsure = search[keep], point[keep], rank[keep], np.zeros(int(keep.sum()), bool)
                    more = {}
                    if detailed:
                        if loaded.details is None:
                            continue
                        at, detail = _runs(loaded.first[point], loaded.each[point])
                        search, point, rank, unsure = search[at], point[at], rank[at], unsure[at]
                        shown = loaded.details.select(DETAILS).take(pa.array(detail))
                        more = {c: shown[c].combine_chunks() for c in DETAILS}
                    found[search] = True
                    if len(search):
                        yield rows(search, {"rank": pa.array(rank.astype(np.int32)), "business_id": ids.take(pa.array(tile.order[point])), "b_lat": pa.array(tile.lat[point]),
                                            "b_lon": pa.array(tile.lon[point]), "unsure": pa.array(unsure), **more})
                gone = np.flatnonzero(~found)
                if empty and len(gone):
                    text = {"name": pa.string(), "category": pa.string(), "h_lat": pa.float64(), "h_lon": pa.float64()} if detailed else {}
                    kinds = {"rank": pa.int32(), "business_id": ids.type, "b_lat": pa.float64(), "b_lon": pa.float64(), "unsure": pa.bool_(), **text}
                    yield rows(gone, {c: none(len(gone), kind) for c, kind in kinds.items()})
            else:
                for part, search, point in tile.nearest(q):
                    yield rows(search + part.start, {"business_id": ids.take(pa.array(tile.order[point])), "b_lat": pa.array(tile.lat[point]),
                                                     "b_lon": pa.array(tile.lon[point])})
        elif held["rows"] and mode == "limit":
            t = pa.Table.from_batches(held["searches"]).select([*carried, "radius"]).combine_chunks()
            yield from t.rename_columns([*carried, "limit_m"]).append_column("sure", pa.array(np.zeros(t.num_rows, bool))).to_batches()
        held["searches"], held["rows"] = [], 0

    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column("at").to_numpy()
        change = np.flatnonzero(at[1:] != at[:-1]) + 1
        for low, high in zip([0, *change], [*change, batch.num_rows], strict=True):
            block, kind = at[low] >> 2, at[low] & 3
            if block != held["block"]:
                yield from flush()
                held.update(block=block, tile=None, points=[], details=[])
            rows = batch.slice(low, high - low)
            if kind == SEARCH:
                held["searches"].append(rows)
                held["rows"] += high - low
                if held["rows"] >= SEARCHES:
                    yield from flush()
            elif kind == DETAIL:
                held["details"].append(rows.select(["business_id", *DETAILS]))
            else:
                held["points"].append(rows.select(["business_id", "q_lat", "q_lon"]))
    yield from flush()


def folded(batches: Iterator) -> Iterator:
    """Rows (query_id, page, rank, id, distance_m, total) of one query_id and page that follow each other in a batch as one row: lists of
    rank, id and distance_m, least and greatest total."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in ("query_id", "page"):
            column = batch.column(c)
            gone = column.is_null().to_numpy(zero_copy_only=False)
            value = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
            new[1:] |= (value[1:] != value[:-1]) | (gone[1:] != gone[:-1])
        first = np.flatnonzero(new)
        at, ends = pa.array(first), pa.array(np.append(first, batch.num_rows).astype(np.int32))
        run = pa.array(np.cumsum(new))
        total = pa.table({"run": run, "total": batch.column("total")}).group_by("run", use_threads=False).aggregate([("total", "min"), ("total", "max")])
        yield pa.RecordBatch.from_arrays(
            [batch.column("query_id").take(at), batch.column("page").take(at), *(pa.ListArray.from_arrays(ends, batch.column(c)) for c in ("rank", "id", "distance_m")),
             total["total_min"].combine_chunks(), total["total_max"].combine_chunks()], ["query_id", "page", "rank", "id", "distance_m", "low", "high"])

"""Circles over the points of one tile against brute force: poles, antimeridian, boxes, copies, radii of any size."""

import numpy as np
import pytest

from nearfield.operators import discs as D


def _metres(lat1, lon1, lat2, lon2):
    a, b, c, d = map(np.radians, (lat1, lon1, lat2, lon2))
    s = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * D.RADIUS_M * np.arctan2(np.sqrt(s), np.sqrt(1 - s))


@pytest.mark.parametrize("lat0, lon0, n, spread", [(37.5, 127.03, 3000, .01), (0, 179.9, 900, .1), (89.99, 10, 500, .01), (-89.99, -179.9, 700, .01), (10, 10, 1, .1)])
def test_counts_and_nearest_equal_brute_force(lat0, lon0, n, spread):
    rng = np.random.default_rng(n)
    lat, lon = np.clip(lat0 + rng.normal(size=n) * spread / 3, -90, 90), np.clip(lon0 + rng.uniform(-1, 1, n) * spread, -180, 180)
    lat[:n // 9], lon[:n // 9] = lat[0], lon[0]
    ids, m = rng.permutation(n).astype(np.int64), 200
    tile = D.Tile(ids, lat, lon)
    q_lat = np.clip(lat0 + rng.normal(size=m) * spread, -90, 90)
    q_lon = (lon0 + rng.uniform(-1, 1, m) * spread * 2 + 180) % 360 - 180
    q_lon[:20] = rng.uniform(-180, 180, 20)
    radius, to = rng.choice([0, 50, 500, 2000, 10_000, 5e6, 2.1e7], m), rng.choice([1, 10, 200], m)
    d = _metres(q_lat[:, None], q_lon[:, None], tile.lat[None], tile.lon[None])
    for box in (None, [np.full(m, v) for v in (lat0 - spread / 4, lat0 + spread / 5, lon0 - spread / 3, spread * .7)]):
        inside = d <= radius[:, None]
        if box:
            inside &= (tile.lat >= box[0][0]) & (tile.lat < box[1][0]) & (((tile.lon[None] - box[2][:, None]) % 360) < box[3][:, None])
        got = np.zeros(m, int)
        for part, found, search, point in tile.count(D.Searches(q_lat, q_lon, radius, None, box)):
            got[part] += found
            np.add.at(got, search + part.start, d[search + part.start, point] <= radius[search + part.start])
        assert (got == inside.sum(1)).all()
        near = [set() for _ in range(m)]
        for part, search, point in tile.nearest(D.Searches(q_lat, q_lon, radius, to, box)):
            for k, p in zip(search + part.start, point, strict=True):
                near[k].add(p)
        for k in range(m):
            ok = np.flatnonzero(inside[k])
            assert set(ok[np.lexsort((ids[tile.order[ok]], np.round(d[k, ok], 6)))][:to[k]]) <= near[k]

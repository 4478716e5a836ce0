"""The flagship computation in plain Python, for small tables."""

from __future__ import annotations

import math
from collections import defaultdict

from test_geometry import even_odd


def utm(lon, lat, zone):
    """Krueger series in scalar form."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    radius = 6378137 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    e = 2 * math.sqrt(n) / (1 + n)
    s = math.sin(math.radians(lat))
    t = math.sinh(math.atanh(s) - e * math.atanh(e * s))
    d = math.radians(lon - (6 * zone - 183))
    xi, eta = math.atan2(t, math.cos(d)), math.atanh(math.sin(d) / math.sqrt(1 + t * t))
    series = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    x, y = eta, xi
    for j, a in enumerate(series, 1):
        x += a * math.cos(2 * j * xi) * math.sinh(2 * j * eta)
        y += a * math.sin(2 * j * xi) * math.cosh(2 * j * eta)
    return 500000 + 0.9996 * radius * x, 0.9996 * radius * y


def ndvi_series(parcels, items, pixels, centre, coarse=None, coarse_centre=None):
    """{(parcel, solar day): (mean red, mean NDVI)}.

    parcels: key -> rings in grid coordinates; items: id -> (datetime, solar day, scale,
    offset), all of which cover every parcel; pixels: list of (item, y, x, red, nir, scl);
    coarse: dict (item, y, x) -> scl, on cells of twice the size.
    """
    order = sorted(items, key=lambda i: (items[i][0], i))
    out = {}
    for key, rings in parcels.items():
        def merged(rows):
            """First valid value per day and cell."""
            best = defaultdict(int)
            rank = {i: r for r, i in enumerate(order)}
            for item, y, x, value in sorted(rows, key=lambda r: rank[r[0]]):
                cell = (items[item][1], y, x)
                best[cell] = best[cell] or value
            return best

        inside = lambda y, x: even_odd(rings, *centre(y, x))
        if coarse is None:
            classes = merged([(i, y, x, s) for i, y, x, _, _, s in pixels if inside(y, x)])
        else:
            classes = merged(
                [(i, y, x, s) for (i, y, x), s in coarse.items()
                 if even_odd(rings, *coarse_centre(y, x))]
            )
        shares = defaultdict(list)
        for (day, _, _), s in classes.items():
            if s:
                shares[day].append(s in (4, 5))
        good = {d for d, v in shares.items() if sum(v) / len(v) > 0.5}
        kept = [i for i in order if items[i][1] in good]
        if not kept:
            continue
        scale, offset = items[kept[0]][2:]
        mine = [p for p in pixels if p[0] in kept and inside(p[1], p[2])]
        red = merged([(i, y, x, r) for i, y, x, r, _, _ in mine])
        nir = merged([(i, y, x, n) for i, y, x, _, n, _ in mine])
        scl = merged(
            [(i, y, x, s if coarse is None else coarse.get((i, y // 2, x // 2), 0))
             for i, y, x, _, _, s in mine]
        )
        groups = defaultdict(list)
        for cell in red:
            if scl[cell] in (4, 5):
                r, n = red[cell] * scale + offset, nir[cell] * scale + offset
                groups[cell[0]].append((r, (n - r) / (n + r)))
        for day, values in groups.items():
            out[key, day] = tuple(sum(v) / len(values) for v in zip(*values))
    return out

"""Marker clusters over zooms against a brute-force version."""

import math
import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.conftest import SF_SMALL
from tremor.operators import clusters
from tremor.plans.catalog import QUERIES, base

LIMIT = 85.0511287798066


def pixel(lat, lon, zoom):
    size = 256 * 2**zoom
    p = math.radians(max(min(lat, LIMIT), -LIMIT))
    x = (lon + 180) / 360 * size
    y = (1 - math.log(math.tan(p) + 1 / math.cos(p)) / math.pi) / 2 * size
    return tuple(max(0, min(size - 1, math.floor(c))) for c in (x, y))


def brute(events, finest, radius, grain):
    """zoom -> cluster -> (parent, events); centres in the order of their ranks."""
    markers = defaultdict(list)
    place = {}
    for e in events:
        x, y = (c // grain for c in pixel(e[0], e[1], finest))
        key = y * -(-256 * 2**finest // grain) + x
        markers[key].append(e)
        place[key] = (x * grain + grain // 2, y * grain + grain // 2)
    out, own = {}, dict(markers)
    for zoom in range(finest, -1, -1):
        size, at = 256 * 2**zoom, {k: tuple(c >> (finest - zoom) for c in place[k]) for k in own}

        def d2(a, b):
            dx = abs(at[a][0] - at[b][0])
            return min(dx, size - dx) ** 2 + (at[a][1] - at[b][1]) ** 2

        order, centres = sorted(own, key=lambda k: (-len(own[k]), k)), []
        for k in order:
            if not any(d2(k, c) <= radius * radius for c in centres):
                centres.append(k)
        rank = {k: i for i, k in enumerate(order)}
        parent = {k: k if k in centres else min(centres, key=lambda c: (d2(k, c), rank[c])) for k in own}
        if zoom < finest:
            out[zoom + 1] = {k: (parent[k], v[1]) for k, v in out[zoom + 1].items()}
        merged = defaultdict(list)
        for k, rows in own.items():
            merged[parent[k]] += rows
        own = dict(merged)
        out[zoom] = {k: (None, rows) for k, rows in own.items()}
    return out


def events_of(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = i % 5
        if kind == 0:
            out.append((rng.uniform(-90, 90), rng.uniform(-180, 180)))
        elif kind == 1:
            out.append((rng.gauss(10, 3), max(-180.0, min(180.0, 180 - abs(rng.gauss(0, 4))))))
        elif kind == 2:
            out.append((rng.gauss(10, 3), max(-180.0, min(180.0, -180 + abs(rng.gauss(0, 4))))))
        elif kind == 3:
            out.append((0.0, round(rng.uniform(-170, 170) / 22.5) * 22.5))  # tile edges
        else:
            out.append((rng.choice([89.0, -89.5, 45.0]), 12.5))
    return [(lat, lon, 5 + (i % 40) / 10) for i, (lat, lon) in enumerate(out)]


@pytest.mark.parametrize("radius,grain,finest", [(80, 8, 3), (25, 5, 2)])
def test_clusters_against_brute_force(spark, radius, grain, finest):
    events = events_of(5000, radius)
    holes = [(None, 1.0, 5.0), (1.0, float("nan"), 5.0), (float("inf"), 1.0, 5.0)]
    df = spark.createDataFrame(events + holes, "Latitude double, Longitude double, Magnitude double").repartition(3)
    rows = clusters.clusters_by_zoom(df, finest=finest, radius=radius, grain=grain).collect()
    want = brute(events, finest, radius, grain)
    assert {(r.zoom, r.cluster): (r.parent, r.Count) for r in rows} == {(z, k): (p, len(e)) for z, found in want.items() for k, (p, e) in found.items()}
    assert set(Counter(r.zoom for r in rows)) == set(range(finest + 1))
    for r in rows:
        mine = want[r.zoom][r.cluster][1]
        exact = sum(Decimal(str(e[0])).quantize(Decimal(10) ** -12, ROUND_HALF_UP) for e in mine) / len(mine)
        assert float(r.center_latitude) == pytest.approx(float(exact), abs=1e-9) and r.max_magnitude == max(e[2] for e in mine)


def test_counts_add_up_at_every_zoom(spark):
    rows = QUERIES["map_clusters_zoom"](spark, SF_SMALL).collect()
    total = base(spark, SF_SMALL).count()
    per_zoom = Counter()
    for r in rows:
        per_zoom[r.zoom] += r.Count
    assert per_zoom == {z: total for z in range(5)}
    found = {(r.zoom, r.cluster) for r in rows}
    assert all((r.parent is None) == (r.zoom == 0) for r in rows)
    assert all((r.zoom - 1, r.parent) in found for r in rows if r.zoom)


def test_empty_and_bad_parameters(spark):
    none = spark.createDataFrame([], "Latitude double, Longitude double, Magnitude double")
    assert clusters.clusters_by_zoom(none, finest=1).count() == 0
    for bad in ({"finest": 1, "coarsest": 2}, {"radius": 4, "grain": 8}):
        with pytest.raises(ValueError):
            clusters.clusters_by_zoom(none, **bad)

"""Nearest search against brute force, including the +-180 seam and the poles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tremor.functions import geo as G
from tremor.operators import cells, geo


def hav_km(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    dp, dl = math.radians(c - a), math.radians(d - b)
    h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * G.EARTH_RADIUS_KM * math.asin(math.sqrt(min(h, 1.0)))


def brute(points, events, dist):
    out = {}
    for pid, la, lo in points:
        best = min(events, key=lambda e: (round(dist(la, lo, e[1], e[2]), 6), e[0]))
        out[pid] = best[0]
    return out


def frames(spark, points, events):
    p = spark.createDataFrame(points, "point_id long, latitude double, longitude double")
    e = spark.createDataFrame(events, "ID string, Latitude double, Longitude double")
    return p, e


EDGE_POINTS = [(0, 0.0, 179.99), (1, 0.0, -179.99), (2, 89.99, 10.0), (3, -89.99, -170.0), (4, 90.0, 0.0), (5, 10.0, 20.0)]
EDGE_EVENTS = [
    ("e1", 0.5, -179.5),
    ("e2", 0.0, 170.0),
    ("e3", 89.5, -170.0),
    ("e4", -89.0, 10.0),
    ("e5", 10.0, 20.5),
    ("e6", -30.0, 60.0),
]


def test_haversine_edges_match_brute_force(spark):
    p, e = frames(spark, EDGE_POINTS, EDGE_EVENTS)
    got = {r.point_id: r.ID for r in geo.nearest(p, e).collect()}
    assert got == brute(EDGE_POINTS, EDGE_EVENTS, hav_km)
    assert got[0] == "e1" and got[1] == "e1" and got[2] == "e3" and got[3] == "e4"


def test_random_matches_brute_force(spark):
    rng = random.Random(7)
    events = [(f"e{i:03d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)]
    events += [("dup_b", 12.0, 34.0), ("dup_a", 12.0, 34.0)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)] + [(99, 12.0, 34.0)]
    p, e = frames(spark, points, events)
    got = {r.point_id: r.ID for r in geo.nearest(p, e).collect()}
    assert got == brute(points, events, hav_km)
    assert got[99] == "dup_a"


def test_geodesic_matches_brute_force(spark):
    rng = random.Random(11)
    events = [(f"e{i:03d}", rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(200)]
    points = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(25)]
    p, e = frames(spark, points, events)

    def vin(a, b, c, d):
        return float(G.vincenty_np([a], [b], [c], [d])[0])

    got = {r.point_id: (r.ID, r.km) for r in geo.nearest(p, e, metric="geodesic").collect()}
    want = brute(points, events, vin)
    assert {k: v[0] for k, v in got.items()} == want


def test_vincenty_known_distance():
    # Flinders Peak to Buninyong, the classic test pair: 54,972.271 m.
    lat1 = -(37 + 57 / 60 + 3.72030 / 3600)
    lon1 = 144 + 25 / 60 + 29.52440 / 3600
    lat2 = -(37 + 39 / 60 + 10.15610 / 3600)
    lon2 = 143 + 55 / 60 + 35.38390 / 3600
    km = G.vincenty_np([lat1], [lon1], [lat2], [lon2])[0]
    assert km == pytest.approx(54.972271, abs=1e-6)
    assert G.vincenty_np([0.0], [0.0], [0.0], [0.0])[0] == 0.0


def test_missing_coordinates_and_empty_catalogue(spark):
    p = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 1.0)], "point_id long, latitude double, longitude double")
    e = spark.createDataFrame([("a", 1.0, 1.5)], "ID string, Latitude double, Longitude double")
    got = {r.point_id: r.ID for r in geo.nearest(p, e).collect()}
    assert got == {1: None, 2: "a"}
    none = geo.nearest(p, e.where(F.lit(False))).collect()
    assert {r.point_id: r.ID for r in none} == {1: None, 2: None}


def test_hot_position(spark):
    """A third of the catalogue at one position reduces to one candidate row."""
    hot = spark.range(3000).select(F.format_string("h%05d", "id").alias("ID"), F.lit(5.0).alias("Latitude"), F.lit(5.0).alias("Longitude"))
    rest = spark.range(6000).select(
        F.format_string("r%05d", "id").alias("ID"),
        (F.col("id") % 170 - 85.0).alias("Latitude"),
        (F.col("id") % 359 - 179.0).alias("Longitude"),
    )
    ev = hot.unionByName(rest)
    p = spark.createDataFrame([(1, 5.01, 5.01)], "point_id long, latitude double, longitude double")
    assert geo.nearest(p, ev).first().ID == "h00000"
    assert geo.nearest(p, ev, metric="geodesic").first().ID == "h00000"


def test_place_label_rules(spark):
    coords = spark.createDataFrame([(0.0, 0.0), (10.0, 10.0), (20.0, 20.0), (0.0, 0.0)], "Latitude double, Longitude double")
    places = spark.createDataFrame(
        [
            (1, 0.1, 0.1, None, "Town", None, "A"),
            (2, 10.1, 10.1, None, None, None, "B"),
            (3, 20.1, 20.1, "City", "T", "V", None),
        ],
        "place_id long, latitude double, longitude double, city string, town string, village string, country string",
    )
    got = {(r.Latitude, r.Longitude): r.label for r in geo.place_labels(coords, places).collect()}
    assert got == {(0.0, 0.0): "Town, A", (10.0, 10.0): "B", (20.0, 20.0): "City, Unknown"}
    empty = geo.place_labels(coords, places.where(F.lit(False))).collect()
    assert {r.label for r in empty} == {"Unknown Location"}


def test_clusters_sum_to_all_rows(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 5.0), (89.0, 0.0, 6.0), (-10.0, 180.0, 7.0), (-10.0, -180.0, 7.5), (45.0, 90.0, 6.5)],
        "Latitude double, Longitude double, Magnitude double",
    )
    c = geo.map_clusters(df, zoom=2)
    assert c.agg(F.sum("Count")).first()[0] == 5
    # lon 180 clamps into the last column; lat -10 lies in row 2 of 4; lat 89 in row 0.
    assert c.agg(F.max("tile_x"), F.max("tile_y"), F.min("tile_y")).first() == (3, 2, 0)
    south = df.selectExpr("-90.0 as Latitude", "Longitude", "Magnitude")
    assert {r.tile_y for r in geo.map_clusters(south, zoom=2).collect()} == {3}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_both_join_strategies_agree(spark, threshold):
    rng = random.Random(5)
    events = [(f"e{i:03d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(200)]
    events += [(f"z{i:03d}", 1.0, 1.0) for i in range(50)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(30)] + [(77, 1.001, 1.001)]
    p, e = frames(spark, points, events)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {r.point_id: r.ID for r in geo.nearest(p, e).collect()}
        assert got == brute(points, events, hav_km)
        assert got[77] == "z000"
        geo_got = {r.point_id: r.ID for r in geo.nearest(p, e, metric="geodesic").collect()}
        assert geo_got[77] == "z000"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_point_gets_a_row_and_the_position_of_its_event(spark):
    big = 2**62 + 1
    points = [(1, 0.0, 0.0), (1, 50.0, 50.0), (2, float("nan"), 3.0), (3, 0.0, float("inf")), (1, 0.0, 0.0), (None, 1.0, 1.0), (big, 1.0, 1.0)]
    events = [("a", 1.0, 1.0), ("b", 49.0, 49.0), ("c", float("nan"), 0.0), (None, None, 0.0)]
    p, e = frames(spark, points, events)
    out = geo.nearest(p, e, carry=("Latitude",))
    assert out.columns == ["point_id", "ID", "Latitude", "Longitude", "km"]
    got = sorted((r.point_id or 0, r.ID or "", r.Latitude, r.Longitude) for r in out.coalesce(1).collect())
    assert got.pop() == (big, "a", 1.0, 1.0)
    assert got == [(0, "a", 1.0, 1.0), (1, "a", 1.0, 1.0), (1, "a", 1.0, 1.0), (1, "b", 49.0, 49.0), (2, "", None, None), (3, "", None, None)]
    with pytest.raises(ValueError):
        geo.nearest(p.withColumnRenamed("point_id", "ID"), e, point_keys=("ID",))


def test_geodesic_nearest_among_antipodal_events(spark):
    """Vincenty does not converge for the first two; the third is nearer than both."""
    p, e = frames(spark, [(1, 0.0, 0.0)], [("1", 0.5, 179.7), ("2", 0.3, 179.6), ("3", 1.0, 178.0)])
    row = geo.nearest(p, e, metric="geodesic").first()
    assert (row.ID, row.km) == ("3", pytest.approx(19780.597975, abs=1e-5))
    p, e = frames(spark, [(1, 0.0, 0.0)], [("1", 0.0, 180.0)])
    meridian = 20003.931458623  # half the ellipsoid's meridian
    assert geo.nearest(p, e, metric="geodesic").first().km == pytest.approx(meridian, abs=1e-5)


def test_waypoint_distance_equals_vincenty_where_that_converges():
    rng = random.Random(3)
    for _ in range(30):
        a, b = (rng.uniform(-70, 70), 0.0), (rng.uniform(-70, 70), rng.uniform(150, 175))
        want = float(G.vincenty_np([a[0]], [a[1]], [b[0]], [b[1]])[0])
        if 11_000 < want < 19_500:  # on the far half of the globe, but not nearly antipodal
            assert G.antipodal_km(*a, *b) == pytest.approx(want, abs=1e-6)


def swarm_events(n, rng):
    """Clustered: three dense swarms of distinct positions and a few lone events."""
    centres = [(10.0, 10.0, 0.02), (-33.0, 151.0, 0.5), (64.0, -18.0, 2.0)]
    out = []
    for i in range(n):
        lat, lon, s = centres[i % 3]
        out.append((f"e{i:05d}", lat + rng.gauss(0, s), lon + rng.gauss(0, s)))
    return out + [("far", -70.0, -120.0), ("pole", 90.0, 0.0)]


@pytest.mark.parametrize("shared", [0, 100_000])
@pytest.mark.parametrize("leaf", [3, 64])
def test_swarms_and_far_points(spark, shared, leaf, monkeypatch):
    """Grids in memory and as joins, base cells opened or not: always the brute-force answer."""
    monkeypatch.setattr(cells, "SHARED_CELLS", shared)
    monkeypatch.setattr(cells, "LEAF", leaf)
    rng = random.Random(13)
    events = swarm_events(6000, rng) + [(f"hot{i}", 10.0, 10.0) for i in range(500)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(20)] + [(90, 10.0, 10.0), (91, -33.1, 151.2), (92, -80.0, -100.0)]
    p, e = frames(spark, points, events)
    index = cells.build_index(e, "Latitude", "Longitude")
    assert bool(index.stored) == (shared == 0) and index.hot is not None
    assert index.levels == [*cells.LEVELS, *cells.DEEP]
    got = {r.point_id: (r.ID, r.Latitude) for r in geo.nearest(p, e).collect()}
    want = brute(points, events, hav_km)
    assert {k: v[0] for k, v in got.items()} == want and got[90][1] == 10.0
    some = geo.nearest(p.where("point_id >= 90"), e, metric="geodesic").collect()
    assert {r.point_id: r.ID for r in some} == {90: "hot0", 91: want[91], 92: "far"}


@pytest.mark.parametrize("leaf,times", [(1024, 2), (64, 3)])
def test_search_reads_the_events_twice_and_leaves_most_of_them(spark, tmp_path, monkeypatch, leaf, times):
    """Once for the cells, once for the pairs, and once more only where base cells are opened."""
    monkeypatch.setattr(cells, "LEAF", leaf)
    rng = random.Random(17)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(10)]
    p, e = frames(spark, points, swarm_events(20_000, rng))
    at = str(tmp_path / "events")
    e.repartition(4).write.parquet(at)
    ev = spark.read.parquet(at)
    reads = spark.sparkContext.accumulator(0)

    def seen(rows):
        for part in rows:
            reads.add(len(part))
            yield part

    counted = ev.mapInPandas(seen, ev.schema)
    geo.nearest(p, counted).collect()
    assert reads.value == times * ev.count()
    index = cells.build_index(ev, "Latitude", "Longitude")
    cand = cells.candidates(p.selectExpr("point_id", "latitude as _plat", "longitude as _plon"), index, 1.0)
    assert cand.selectExpr("sum(_n)").first()[0] < 0.01 * len(points) * ev.count()


@pytest.mark.parametrize("spread", [0.3, 60.0])
def test_pairs_per_point_do_not_grow_with_the_events(spark, spread):
    """A hundred times the events, as swarms or all over the globe: pairs per point stay below the same bound."""
    pairs = []
    for n in (20_000, 2_000_000):
        events = spark.range(n, numPartitions=4).selectExpr(
            "cast(id as string) as ID", f"10 + randn(1) * {spread} / 2 as Latitude", f"20 + randn(2) * {spread} as Longitude"
        ).where("Latitude between -90 and 90 and Longitude between -180 and 180")
        points = spark.range(300).selectExpr("id as point_id", f"10 + randn(3) * {spread} / 2 as _plat", f"20 + randn(4) * {spread} as _plon")
        index = cells.build_index(events, "Latitude", "Longitude")
        cand = cells.candidates(points.where("_plat between -90 and 90 and _plon between -180 and 180"), index, 1.0)
        pairs.append(cand.selectExpr("sum(_n) / count(distinct _rid)").first()[0])
    print("pairs per point", spread, pairs)
    assert max(pairs) < 2 * cells.LEAF


def test_dense_cells_are_opened(spark):
    """A swarm of distinct positions is cut down to leaves of bounded size, one for each position."""
    rng = random.Random(19)
    events = [(f"e{i:05d}", 10 + rng.gauss(0, 0.003), 10 + rng.gauss(0, 0.003)) for i in range(20_000)]
    _, e = frames(spark, [(1, 0.0, 0.0)], events)
    index = cells.build_index(e, "Latitude", "Longitude")
    placed = cells.leaves_of(cells.with_unit(e, "Latitude", "Longitude"), index)
    leaves = placed.groupBy("_level", "_cell").count().collect()
    assert sum(r["count"] for r in leaves) == len(events) and max(r["count"] for r in leaves) <= cells.LEAF
    assert {r._level for r in leaves} == {cells.LEVELS[-1], cells.DEEP[-1]}


def test_few_points_many_events(spark):
    """Points side smaller than the events: points are broadcast, events stream."""
    rng = random.Random(9)
    events = [(f"e{i:04d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(800)]
    points = [(1, 0.0, 0.0), (2, -45.0, 179.5), (3, 88.0, -30.0)]
    p, e = frames(spark, points, events)
    got = {r.point_id: r.ID for r in geo.nearest(p, e).collect()}
    assert got == brute(points, events, hav_km)


def test_missing_rows_keep_event_types(spark):
    p = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 1.0)], "point_id long, latitude double, longitude double")
    e = spark.createDataFrame([(7, 1.0, 1.5, "x")], "place_id long, lat double, lon double, label string")
    out = geo.nearest(p, e, event_key="place_id", event_lat="lat", event_lon="lon", carry=("label",))
    assert dict(out.dtypes) == {
        "point_id": "bigint", "place_id": "bigint", "label": "string", "lat": "double", "lon": "double", "km": "double"
    }
    assert {r.point_id: r.place_id for r in out.collect()} == {1: None, 2: 7}


def test_geodesic_udf_runs_without_package_on_executors(tmp_path):
    """The Vincenty UDF travels by value: a driver started elsewhere, with the
    package only on its own path, still runs geodesic search."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from tremor.session import build_session\n"
        "from tremor.operators import geo\n"
        "s = build_session('local[2]')\n"
        "p = s.createDataFrame([(1, 10.0, 20.0)], 'point_id long, latitude double, longitude double')\n"
        "e = s.createDataFrame([('a', 10.5, 20.5), ('b', -40.0, 100.0)], 'ID string, Latitude double, Longitude double')\n"
        "print('NEAREST', geo.nearest(p, e, metric='geodesic').first().ID)\n"
    ) % root
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=600)
    assert "NEAREST a" in out.stdout, out.stderr[-2000:]

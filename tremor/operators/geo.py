"""Spatial operators: nearest event, nearest place, map-tile clusters.

Nearest search reads the events twice: once for the cell index (see
``operators.cells``), once to join the events of the candidate leaves with the
points.  An event has one leaf and travels once; the planner broadcasts the
candidates if their true size is below its threshold and shuffles both sides
otherwise, splitting skewed leaves.  No step pairs a point with all events
unless they all lie within its bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.functions import display
from tremor.functions import geo as G
from tremor.functions.agg import mean
from tremor.operators import cells
from tremor.operators.cells import known as _known
from tremor.scratch import scratch_table

# The ratio of a path's length on the ellipsoid and on the sphere lies between
# b^2 / (a R) = 0.99442 and a^2 / (b R) = 1.00449, so the nearest event on the
# ellipsoid is at most their quotient farther on the sphere than the nearest there.
GEODESIC_MARGIN = 1.0102


def _round_km(km, places: int):
    """Distance rounded as ``round(km * 10^p) / 10^p`` (one binary value rounded
    at integer scale, which every engine resolves the same way)."""
    scale = float(10**places)
    return F.round(km * F.lit(scale), 0) / F.lit(scale)


def nearest(
    points: DataFrame,
    events: DataFrame,
    *,
    point_keys=("point_id",),
    point_lat: str = "latitude",
    point_lon: str = "longitude",
    event_key: str = "ID",
    event_lat: str = "Latitude",
    event_lon: str = "Longitude",
    carry=(),
    metric: str = "haversine",
    round_km: int | None = 6,
) -> DataFrame:
    """Nearest event to every point: ``point_keys..., event_key, carry..., event_lat, event_lon, km``.

    One row per row of ``points``, whether or not its keys are unique.
    ``metric="haversine"`` ranks on the mean sphere, ``"geodesic"`` on the
    WGS-84 ellipsoid.  Ties go to the smallest event key, then position;
    distances are compared after rounding to ``round_km`` places so that ties
    do not hinge on the last bit.  A coordinate that is null, NaN or infinite
    is missing: such events are left out, such points have null event columns,
    as all points have if there is no event.
    """
    if metric not in ("haversine", "geodesic"):
        raise ValueError(f"unknown metric {metric!r}")
    keys = list(point_keys)
    columns = list(dict.fromkeys([event_key, *carry, event_lat, event_lon]))
    clash = [c for c in keys if c in (*columns, "km")]
    if clash:
        raise ValueError(f"point keys named like event columns: {clash}")
    pts = points.select(*keys, F.col(point_lat).alias("_plat"), F.col(point_lon).alias("_plon"))
    ev = events.select(*columns).where(_known(event_lat, event_lon))
    kinds = {f.name: f.dataType for f in ev.schema.fields}
    nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in columns] + [F.lit(None).cast("double").alias("km")]
    index = cells.build_index(ev, event_lat, event_lon)
    if index.empty:
        return pts.select(*keys, *nothing)

    cand = cells.candidates(pts, index, GEODESIC_MARGIN if metric == "geodesic" else 1.0)
    pairs = candidate_pairs(cand, ev, index, columns, event_key, event_lat, event_lon)
    index.drop()
    km = F.col("_hkm")
    if metric == "geodesic":
        # Of events at one position only the first can be the answer.
        at = ["_rid", event_lat, event_lon]
        first = F.min_by(F.struct(*[c for c in pairs.columns if c not in at]), F.struct(event_key)).alias("_f")
        pairs = scratch_table(pairs.groupBy(*at).agg(first).select(*at, "_f.*"), "pairs")
        limit = pairs.groupBy("_rid").agg((F.min("_hkm") * GEODESIC_MARGIN + 1e-6).alias("_lim"))
        pairs = pairs.join(limit, "_rid").where("_hkm <= _lim")
        km = G.geodesic_km("_plat", "_plon", event_lat, event_lon)
    pairs = pairs.withColumn("km", km)
    if round_km is not None:
        pairs = pairs.withColumn("km", _round_km(F.col("km"), round_km))
    order = F.struct("km", event_key, event_lat, event_lon)
    best = F.min_by(F.struct(*columns, "km"), order).alias("_b")
    answered = pairs.groupBy("_rid").agg(*[F.first(k).alias(k) for k in keys], best).select(*keys, "_b.*")
    return answered.unionByName(cand.where("_cell is null").select(*keys, *nothing))


def candidate_pairs(cand: DataFrame, ev: DataFrame, index: cells.CellIndex, columns, event_key: str, event_lat: str, event_lon: str) -> DataFrame:
    """Events in the candidate leaves, within each point's reach, with the point's
    columns and the sphere distance ``_hkm``."""
    keep = [c for c in cand.columns if c not in ("_x", "_y", "_z", "_reach", "_level", "_cell", "_n", "_leaf")]
    placed = cells.leaves_of(cells.with_unit(ev, event_lat, event_lon), index).select(*columns, "_level", "_cell")
    if index.hot is not None:
        # Dense cells: of the events at one position only the first can be an answer.
        leaves = scratch_table(cand.where("_cell is not null").select("_level", "_cell").distinct(), "leaves")
        near = placed.join(leaves, ["_level", "_cell"], "left_semi")
        at = ["_level", "_cell", event_lat, event_lon]
        first = F.min_by(F.struct(*[c for c in columns if c not in at]), F.struct(event_key)).alias("_f")
        placed = near.groupBy(*at).agg(first).select(*at, "_f.*")
    pairs = placed.join(cand, ["_level", "_cell"])
    pairs = pairs.withColumn("_hkm", G.haversine_km("_plat", "_plon", event_lat, event_lon))
    within = 2 * F.sin(F.col("_hkm") / (2 * G.EARTH_RADIUS_KM)) <= F.col("_reach")
    return pairs.where(within).select(*keep, *columns, "_hkm")


def nearest_one(point: DataFrame, events: DataFrame, **kw) -> DataFrame:
    """Nearest event to each row of a (usually one-row) point table."""
    return nearest(point, events, **kw)


def place_labels(coords: DataFrame, places: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Readable place for each distinct coordinate pair, from the nearest gazetteer entry.

    ``"City, Country"`` from the first present of city/town/village, else the
    country; ``"Unknown Location"`` when the gazetteer offers no entry.
    """
    distinct = coords.where(_known(lat, lon)).select(lat, lon).distinct()
    gaz = places.select(
        "place_id",
        F.col("latitude").alias("_glat"),
        F.col("longitude").alias("_glon"),
        G.place_label("city", "town", "village", "country").alias("label"),
    )
    hit = nearest(
        distinct.withColumns({"_qlat": F.col(lat), "_qlon": F.col(lon)}),
        gaz,
        point_keys=(lat, lon),
        point_lat="_qlat",
        point_lon="_qlon",
        event_key="place_id",
        event_lat="_glat",
        event_lon="_glon",
        carry=("label",),
    )
    return hit.select(
        lat, lon, "place_id", F.coalesce("label", F.lit("Unknown Location")).alias("label"), "km"
    )


def map_clusters(df: DataFrame, zoom: int = 2, exact_scale: int | None = None) -> DataFrame:
    """Marker clusters as map tiles at ``zoom``: count, centroid and strongest magnitude.

    Rows beyond the Web-Mercator latitude limit belong to the tile row at that
    pole, so the counts add up to all rows with a position.
    """
    tx, ty = G.tile_xy("Latitude", "Longitude", zoom)
    inside = df.where(_known("Latitude", "Longitude"))
    return inside.groupBy(tx.alias("tile_x"), ty.alias("tile_y")).agg(
        F.count(F.lit(1)).alias("Count"),
        mean("Latitude", exact_scale).alias("center_latitude"),
        mean("Longitude", exact_scale).alias("center_longitude"),
        F.max("Magnitude").alias("max_magnitude"),
    ).withColumn("zoom", F.lit(zoom))


def with_place(rows: DataFrame, places: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """``rows`` with the ``label`` of the nearest place.

    Labels are looked up once per distinct position and joined back on it; the
    join is an outer one on the rows' side, so that a position with very many
    rows can be split over tasks.
    """
    labels = place_labels(rows, places, lat, lon).select(lat, lon, "label")
    joined = rows.join(labels, [lat, lon], "left")
    return joined.withColumn("label", F.coalesce("label", F.lit("Unknown Location"))).select(*rows.columns, "label")


def year_markers(year_rows: DataFrame, places: DataFrame) -> DataFrame:
    """Map-page markers of one year's events: radius ``min(Magnitude * 2, 10)``,
    orange, and a popup with the magnitude and the nearest place's label.
    """
    return with_place(year_rows.where(_known("Latitude", "Longitude")), places).select(
        "ID",
        "Latitude",
        "Longitude",
        "Magnitude",
        display.marker_radius("Magnitude").alias("radius"),
        F.lit("orange").alias("colour"),
        F.concat(
            F.lit("Magnitude: "), F.col("Magnitude").cast("string"), F.lit(" | Location: "),
            F.col("label"),
        ).alias("popup"),
    )

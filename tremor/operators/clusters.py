"""Marker clusters over zoom levels, merged by their distance in pixels.

At a zoom, a marker that no higher-ranked centre is within the radius of
becomes a centre; every other one belongs to the nearest centre in reach, on
ties to the higher-ranked.  Ranks: more events first, then the smaller key.  The
clusters of a zoom are the markers of the next coarser one, so parents are
nested.  Positions are Web-Mercator pixels; the map joins at +-180 degrees.

That order is settled in rounds, each a few grid joins: cells are as wide as
the radius, and a marker is copied to the cells around its own (the halo), so a
pair in reach meets in the cell of one of them, at tile edges and at the seam
too.  A marker is decided as soon as all its higher-ranked neighbours are.  The
events themselves are read once: they are added up by squares of ``grain`` pixels
of the finest zoom before any join.  So a spot that very many events share is
one row, and no marker has more than about pi (radius / grain + 1)^2 neighbours,
however many events there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions import geo as G
from tremor.operators.cells import known
from tremor.scratch import drop_scratch, scratch_table

TILE = 256
MARKER = ["key", "n", "x", "y", "lat_sum", "lon_sum", "strongest"]


def world_pixels(lat: str, lon: str, zoom: int) -> tuple[Column, Column]:
    """Pixel of a position on the world map of a zoom; rows nearer to a pole than the map reaches lie on its edge."""
    size = TILE * 2**zoom
    limit = F.lit(G.MERCATOR_LAT_LIMIT)
    p = F.radians(F.greatest(F.least(F.col(lat), limit), -limit))
    x = (F.col(lon) + 180.0) / 360.0 * float(size)
    y = (1.0 - F.ln(F.tan(p) + 1.0 / F.cos(p)) / F.lit(3.141592653589793)) / 2.0 * float(size)
    top = F.lit(size - 1)
    inside = [F.greatest(F.least(F.floor(c).cast("long"), top), F.lit(0)) for c in (x, y)]
    return inside[0], inside[1]


def _markers(events: DataFrame, lat: str, lon: str, magnitude: str, zoom: int, grain: int) -> DataFrame:
    """One marker per occupied square of the finest zoom, at its middle."""
    squares = (F.floor(c / grain) for c in world_pixels(lat, lon, zoom))
    at = events.where(known(lat, lon)).select(*[q.alias(n) for q, n in zip(squares, "xy")], lat, lon, magnitude)
    sums = [F.sum(F.col(c).cast("decimal(28,12)")).alias(n) for c, n in ((lat, "lat_sum"), (lon, "lon_sum"))]  # exact, in any order
    grouped = at.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), *sums, F.max(magnitude).alias("strongest"))
    keyed = grouped.withColumn("key", F.col("y") * -(-TILE * 2**zoom // grain) + F.col("x"))
    return keyed.withColumns({c: F.col(c) * grain + grain // 2 for c in "xy"}).select(*MARKER)


def _neighbours(markers: DataFrame, size: int, radius: int) -> DataFrame:
    """``key, other, n, other_n, d2``: all ordered pairs of markers at most ``radius`` pixels apart."""
    across = max(1, size // radius)  # cells are at least as wide as the radius; the last one takes the rest
    cx, cy = (F.least(F.floor(F.col(c) / radius).cast("long"), F.lit(across - 1)) for c in "xy")
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    own = markers.select("key", "n", "x", "y", cx.alias("cx"), cy.alias("cy"))
    halo = own.withColumn("dx", around).withColumn("dy", around)
    halo = halo.select(
        F.col("key").alias("other"), F.col("n").alias("other_n"), F.col("x").alias("ox"), F.col("y").alias("oy"),
        F.pmod(F.col("cx") + F.col("dx"), F.lit(across)).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"),
    )
    if across < 3:  # a neighbour is met from both sides
        halo = halo.distinct()
    dx = F.abs(F.col("x") - F.col("ox"))
    dx = F.least(dx, F.lit(size) - dx)
    dy = F.col("y") - F.col("oy")
    pairs = own.join(halo, ["cx", "cy"]).where("key <> other").withColumn("d2", dx * dx + dy * dy)
    return pairs.where(F.col("d2") <= radius * radius).select("key", "other", "n", "other_n", "d2")


def _merged(markers: DataFrame, zoom: int, radius: int) -> DataFrame:
    """``key, parent``: the centre that each marker of a zoom belongs to, itself if it is one."""
    pairs = scratch_table(_neighbours(markers, TILE * 2**zoom, radius), "neighbours")
    above = (F.col("other_n") > F.col("n")) | ((F.col("other_n") == F.col("n")) & (F.col("other") < F.col("key")))
    higher = scratch_table(pairs.where(above).select("key", "other", "d2"), "higher")
    undecided = scratch_table(higher.select("key").distinct(), "undecided")
    centres = scratch_table(markers.select("key").join(undecided, "key", "left_anti"), "centres")
    while undecided.take(1):
        # In reach of a centre above it: a member.  Nothing above it is undecided any more, and no centre: a centre.
        open_pairs = higher.join(undecided, "key")
        covered = open_pairs.join(centres.withColumnRenamed("key", "other"), "other", "left_semi").select("key").distinct()
        left = scratch_table(undecided.join(covered, "key", "left_anti"), "undecided")
        waiting = higher.join(left, "key").join(left.withColumnRenamed("key", "other"), "other", "left_semi").select("key").distinct()
        still = scratch_table(waiting, "undecided")
        more = scratch_table(centres.unionByName(left.join(still, "key", "left_anti")), "centres")
        drop_scratch(undecided, left, centres)
        undecided, centres = still, more
    reach = pairs.join(centres.withColumnRenamed("key", "other"), "other", "left_semi").join(centres, "key", "left_anti")
    rank = F.struct("d2", (-F.col("other_n")).alias("n"), "other")
    member = reach.groupBy("key").agg(F.min_by("other", rank).alias("parent"))
    out = scratch_table(member.unionByName(centres.select("key", F.col("key").alias("parent"))), "parents")
    drop_scratch(pairs, higher, undecided, centres)
    return out


def clusters_by_zoom(
    events: DataFrame, finest: int = 5, coarsest: int = 0, radius: int = 80, grain: int = 8, lat: str = "Latitude", lon: str = "Longitude", magnitude: str = "Magnitude"
) -> DataFrame:
    """``zoom, cluster, parent, Count, center_latitude, center_longitude, max_magnitude`` for every zoom.

    ``cluster`` is the key of the cluster's centre marker, its square at zoom
    ``finest`` (row by row from the north west); ``parent`` is the cluster of the next coarser zoom that it goes
    into (null at the coarsest).  Counts of a zoom add up to all events with a
    position; null, NaN and infinite coordinates have none.  An empty table
    gives no rows.  Centres of gravity are exact decimal means.
    """
    if not 0 <= coarsest <= finest or not 1 <= grain <= radius:
        raise ValueError("zooms run from a finest one down to 0, and the radius is at least the grain, that at least a pixel")
    markers = scratch_table(_markers(events, lat, lon, magnitude, finest, grain), "markers")
    found = []
    for zoom in range(finest, coarsest - 1, -1):
        shift = finest - zoom
        at_zoom = markers.withColumns({"x": F.shiftright("x", shift), "y": F.shiftright("y", shift)})
        parents = _merged(at_zoom, zoom, radius)
        if found:
            found[-1] = found[-1].join(parents.withColumnsRenamed({"key": "cluster", "parent": "_parent"}), "cluster").withColumn("parent", F.col("_parent")).drop("_parent")
        sums = [F.sum("n").alias("n"), F.sum("lat_sum").alias("lat_sum"), F.sum("lon_sum").alias("lon_sum"), F.max("strongest").alias("strongest")]
        grouped = markers.join(parents, "key").groupBy("parent").agg(*sums).withColumnRenamed("parent", "key")
        # A cluster stands where its centre marker does.
        markers = scratch_table(grouped.join(markers.select("key", "x", "y"), "key").select(*MARKER), "markers")
        mean = lambda c: (F.col(c) / F.col("n")).cast("decimal(20,12)")
        found.append(
            markers.select(
                F.lit(zoom).alias("zoom"), F.col("key").alias("cluster"), F.lit(None).cast("long").alias("parent"), F.col("n").alias("Count"),
                mean("lat_sum").alias("center_latitude"), mean("lon_sum").alias("center_longitude"), F.col("strongest").alias("max_magnitude"),
            )
        )
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out

"""A cell index of positions on the sphere, and its branch-and-bound descent.

Positions are unit vectors (no seam at +-180 degrees or at the poles) in cubic
cells of nested grids.  The index has a row per occupied cell: how many
positions it holds and one of them.

* One aggregate over the positions gives the cells of the base grid (0.8 km);
  coarser grids are rolled up from it.  Base cells that hold more than ``LEAF``
  positions are opened: the finest grid (6 m) is aggregated for them alone.  A
  leaf is a base cell that is not opened, or a finest cell.  So every position
  has one leaf, and leaves stay small however many positions there are.
* A point descends grid by grid.  The nearest of the cells' known positions is
  an upper bound, the distance to a cell's cube a lower one; cells within the
  bound are opened next.  As base cells are judged one by one, what is left are
  the few cells that the bound itself touches, at any number of positions.
* The upper grids are sent to the tasks as far as ``SHARED_CELLS`` cells reach
  (the first two are bounded by the geometry of the sphere: about 250,000
  cells).  Finer grids stay tables: each is one equi-join of the open cells
  with their children, and one minimum per point.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremor.functions import geo as G
from tremor.scratch import drop_scratch, scratch_table

# Grids: 2^level cells along each axis of the cube [-1, 1]^3.  The base grid has
# cells of 0.8 km, the finest of 6 m (three places of 21 bits make one long).
LEVELS = (4, 7, 10, 13)
DEEP = (17, 21)
LEAF = 64
SHARED_CELLS = 400_000
# Points whose descents advance together; about 1000 cells each at the first grid.
POINTS = 256
# Chords are compared with this slack, far above their rounding errors and
# above the rounding of distances that ties are decided on.
SLACK = 1e-9


def known(lat: str, lon: str) -> Column:
    """Both coordinates are there: neither null nor NaN nor infinite."""
    at = F.abs(F.col(lat)) + F.abs(F.col(lon))
    return at.isNotNull() & ~F.isnan(at) & (at < F.lit(float("inf")))


def with_unit(df: DataFrame, lat: str, lon: str) -> DataFrame:
    x, y, z = G.unit_xyz(lat, lon)
    return df.withColumns({"_x": x, "_y": y, "_z": z})


def cell(level: int) -> Column:
    """The cell of a unit vector ``_x, _y, _z``: its three places as one number."""
    n = 1 << level
    i = [F.least(F.floor((F.col(f"_{a}") + 1.0) * (n / 2)).cast("long"), F.lit(n - 1)) for a in "xyz"]
    return F.shiftleft(i[0], 2 * level) + F.shiftleft(i[1], level) + i[2]


def _places(key, level: int, shift, mask):
    """The three places of a cell, for columns and arrays alike."""
    return shift(key, 2 * level), mask(shift(key, level)), mask(key)


def above(key: Column, level: int, up: int) -> Column:
    """The cell of the coarser grid ``up`` that holds a cell."""
    bits = F.lit((1 << level) - 1)
    i = [F.shiftright(p, level - up) for p in _places(key, level, F.shiftright, lambda x: x.bitwiseAND(bits))]
    return F.shiftleft(i[0], 2 * up) + F.shiftleft(i[1], up) + i[2]


def _places_np(key: np.ndarray, level: int):
    return _places(key, level, lambda x, n: x >> n, lambda x: x & ((1 << level) - 1))


def _above_np(key: np.ndarray, level: int, up: int) -> np.ndarray:
    i = [p >> (level - up) for p in _places_np(key, level)]
    return (i[0] << (2 * up)) + (i[1] << up) + i[2]


def _one(extra=()) -> list[Column]:
    return [*extra, *[F.first(c).alias(c) for c in ("_x", "_y", "_z")]]  # all of the same position


def _rolled_up(grids: dict, levels: tuple[int, ...]) -> dict:
    """Coarser grids of the finest of ``levels``, where it is: in memory or as tables."""
    for fine, up in zip(levels[::-1], levels[-2::-1]):
        grid = grids[fine]
        if isinstance(grid, pd.DataFrame):
            rows = grid.assign(cell=_above_np(grid["cell"].to_numpy(np.int64), fine, up))
            grids[up] = rows.groupby("cell", as_index=False).agg(n=("n", "sum"), _x=("_x", "first"), _y=("_y", "first"), _z=("_z", "first"))
        else:
            rolled = grid.groupBy(above(F.col("cell"), fine, up).alias("cell")).agg(*_one([F.sum("n").alias("n")]))
            grids[up] = scratch_table(rolled, "cells")
    return grids


@dataclass
class CellIndex:
    """``shared``: the upper grids, sent to the tasks; ``stored``: the others, tables.

    Both map a level to cells (``cell, n, _x, _y, _z``), in order from the top.
    ``hot`` has the keys of the opened base cells, None if there are none.
    """

    shared: dict[int, pd.DataFrame]
    stored: dict[int, DataFrame] = field(default_factory=dict)
    hot: DataFrame | None = None

    @property
    def empty(self) -> bool:
        return not any(map(len, self.shared.values()))

    @property
    def levels(self) -> list[int]:
        return [*self.shared, *self.stored]

    def drop(self) -> None:
        drop_scratch(*self.stored.values())


def is_leaf(level: int, n):
    """Whether a cell is opened no further; ``n`` is a number, an array or a column."""
    if level < LEVELS[-1] or level in DEEP[:-1]:
        return n < 0
    return n <= LEAF if level == LEVELS[-1] else n >= 0


def build_index(events: DataFrame, lat: str, lon: str) -> CellIndex:
    """The index of ``events``, whose coordinates are all known."""
    spark = events.sparkSession
    at = with_unit(events.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")), "_lat", "_lon")
    count = F.count(F.lit(1)).alias("n")
    base = scratch_table(at.groupBy(cell(LEVELS[-1]).alias("cell")).agg(*_one([count])), "cells")
    head = base.limit(SHARED_CELLS + 1).toPandas()
    local = len(head) <= SHARED_CELLS
    grids = _rolled_up({LEVELS[-1]: head if local else base}, LEVELS)
    grids = {level: grids[level] for level in LEVELS}

    hot = None
    opened = base.where(F.col("n") > LEAF).select("cell")
    if (head["n"] > LEAF).any() if local else bool(opened.take(1)):
        hot = scratch_table(opened, "hot-cells")
        inside = at.withColumn("_base", cell(LEVELS[-1])).join(hot, F.col("_base") == F.col("cell"), "left_semi")
        fine = scratch_table(inside.groupBy(cell(DEEP[-1]).alias("cell")).agg(*_one([count])), "cells")
        deep = _rolled_up({DEEP[-1]: fine}, DEEP)
        grids |= {level: deep[level] for level in DEEP}

    shared, stored, room = {}, {}, SHARED_CELLS
    for level, grid in grids.items():
        if not stored and not isinstance(grid, pd.DataFrame):
            few = grid.limit(room + 1).toPandas() if level > LEVELS[1] else grid.toPandas()
            if len(few) <= room or level <= LEVELS[1]:
                drop_scratch(grid)
                grid = few
        if stored or not isinstance(grid, pd.DataFrame):
            stored[level] = spark.createDataFrame(grid) if isinstance(grid, pd.DataFrame) else grid
        else:
            shared[level] = grid
            room = max(0, room - len(grid))
    if base not in stored.values():
        drop_scratch(base)
    return CellIndex(shared, stored, hot)


def _cube(key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.stack(_places_np(key, level), axis=1)
    side = 2.0 / (1 << level)
    return i * side - 1.0, (i + 1) * side - 1.0


class Descent:
    """Branch and bound of many points at once over the shared grids."""

    def __init__(self, shared: dict[int, pd.DataFrame], margin: float):
        self.margin, self.grids, up = margin, [], None
        for level, cells in shared.items():
            key = cells["cell"].to_numpy(np.int64)
            parent = np.full(len(key), -1) if up is None else _above_np(key, level, up)
            order = np.argsort(parent, kind="stable")
            n = cells["n"].to_numpy(np.int64)[order]
            at = cells[["_x", "_y", "_z"]].to_numpy(float)[order]
            self.grids.append((level, parent[order], key[order], *_cube(key[order], level), at, n, is_leaf(level, n)))
            up = level

    def reach(self, chord: np.ndarray) -> np.ndarray:
        """The chord within which the nearest position must lie, given one at ``chord``."""
        angle = np.minimum(2 * np.arcsin(np.minimum(1.0, chord / 2)) * self.margin, math.pi)
        return 2 * np.sin(angle / 2) + SLACK

    def leaves(self, points: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(point, level, cell, n, leaf)`` of the cells that are left, and the reach of every point."""
        best = np.full(len(points), 4.0)
        who, todo, found = np.arange(len(points)), np.full(len(points), -1), []
        for level, parent, key, low, high, at, n, leaf in self.grids:
            first, last = np.searchsorted(parent, todo, "left"), np.searchsorted(parent, todo, "right")
            many = last - first
            who = np.repeat(who, many)
            rows = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            p = points[who]
            gap = np.maximum(np.maximum(low[rows] - p, p - high[rows]), 0.0)
            near = np.sqrt((gap * gap).sum(axis=1))
            np.minimum.at(best, who, np.sqrt(((at[rows] - p) ** 2).sum(axis=1)))
            keep = near <= self.reach(best)[who]
            who, rows, near = who[keep], rows[keep], near[keep]
            end = leaf[rows] | (level == self.grids[-1][0])
            found.append((who[end], np.full(end.sum(), level), key[rows[end]], n[rows[end]], leaf[rows[end]], near[end]))
            who, todo = who[~end], key[rows[~end]]
        who, level, key, n, leaf, near = (np.concatenate(x) for x in zip(*found, strict=True))
        reach = self.reach(best)
        keep = near <= reach[who]
        return who[keep], level[keep], key[keep], n[keep], leaf[keep], reach


ADDED = "_rid long, _reach double, _level int, _cell long, _n long, _leaf boolean"


def open_cells(points: DataFrame, index: CellIndex, margin: float) -> DataFrame:
    """One row per cell of the shared grids that is left for a point, one without a cell for a missing position.

    ``points``: any columns, ``_plat`` and ``_plon`` among them.  Adds ``_x, _y,
    _z``, ``_rid``, a number for each point, ``_reach``, ``_level``, ``_cell``, ``_n``
    and ``_leaf``.
    """
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast(index.shared)  # see SHARED_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        descent = Descent(shared.value, margin)
        for whole in batches:
            for a in range(0, whole.num_rows, POINTS):
                batch = whole.slice(a, POINTS)
                at = np.stack([batch.column(f"_{a}").to_numpy() for a in "xyz"], axis=1)
                there = np.isfinite(at).all(axis=1)
                real, missing = np.flatnonzero(there), np.flatnonzero(~there)
                who, level, key, n, leaf, reach = descent.leaves(at[real])
                none = pa.nulls(len(missing))
                table = pa.Table.from_batches([batch]).take(pa.array(np.concatenate((real[who], missing))))
                added = {"_reach": (reach[who], pa.float64()), "_level": (level, pa.int32()), "_cell": (key, pa.int64()), "_n": (n, pa.int64()), "_leaf": (leaf, pa.bool_())}
                for name, (values, kind) in added.items():
                    column = pa.chunked_array([pa.array(values).cast(kind), none.cast(kind)])
                    table = table.append_column(name, column)
                yield from table.combine_chunks().to_batches()

    # The descent costs far more than moving a point: as many tasks as a shuffle has.
    spread = points.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = with_unit(spread, "_plat", "_plon")
    is_known = known("_plat", "_plon")
    placed = placed.withColumns({a: F.when(is_known, F.col(a)).otherwise(F.lit(float("nan"))) for a in ("_x", "_y", "_z")})
    placed = placed.withColumn("_rid", F.monotonically_increasing_id())
    fields = [*placed.schema.fields[:-1], *StructType.fromDDL(ADDED).fields]
    return placed.mapInArrow(run, StructType(fields))


def _reach(chord: Column, margin: float) -> Column:
    angle = F.least(2 * F.asin(F.least(F.lit(1.0), chord / 2)) * F.lit(margin), F.lit(math.pi))
    return 2 * F.sin(angle / 2) + F.lit(SLACK)


def _opened(cand: DataFrame, grid: DataFrame, level: int, up: int, margin: float) -> DataFrame:
    """The children of open cells that are within reach, as a table; one step of the descent as joins."""
    kids = grid.select(
        above(F.col("cell"), level, up).alias("_cell"), F.col("cell").alias("_kid"), F.col("n").alias("_kn"), *[F.col(f"_{a}").alias(f"_k{a}") for a in "xyz"]
    )
    side, bits = 2.0 / (1 << level), F.lit((1 << level) - 1)
    places = _places(F.col("_kid"), level, F.shiftright, lambda x: x.bitwiseAND(bits))
    gaps = [F.greatest(i * side - 1.0 - F.col(f"_{a}"), F.col(f"_{a}") - ((i + 1) * side - 1.0), F.lit(0.0)) for i, a in zip(places, "xyz")]
    near = F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))
    off = [F.col(f"_k{a}") - F.col(f"_{a}") for a in "xyz"]
    far = F.sqrt(sum((d * d for d in off[1:]), off[0] * off[0]))
    pairs = cand.join(kids, "_cell").withColumns({"_near": near, "_far": far}).where("_near <= _reach")
    pairs = scratch_table(pairs.drop("_kx", "_ky", "_kz", "_cell", "_level", "_n", "_leaf"), "open")
    best = pairs.groupBy("_rid").agg(_reach(F.min("_far"), margin).alias("_best"))
    left = pairs.join(best, "_rid").withColumn("_reach", F.least("_reach", "_best")).where("_near <= _reach")
    found = left.withColumns({"_level": F.lit(level), "_leaf": is_leaf(level, F.col("_kn"))}).withColumnsRenamed({"_kid": "_cell", "_kn": "_n"})
    out = scratch_table(found.drop("_near", "_far", "_best"), "open")
    drop_scratch(pairs)
    return out


def candidates(points: DataFrame, index: CellIndex, margin: float) -> DataFrame:
    """``open_cells`` descended to leaves through the stored grids, as a table."""
    found = scratch_table(open_cells(points, index, margin), "candidates")
    if not index.stored:
        return found
    columns, parts = found.columns, [found.where("_leaf or _cell is null")]
    still = found.where("not _leaf")
    up = list(index.shared)[-1]
    for level, grid in index.stored.items():
        opened = _opened(still, grid, level, up, margin).select(columns)
        parts.append(opened.where("_leaf"))
        still, up = opened.where("not _leaf"), level
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    return scratch_table(parts[0], "candidates")


def leaves_of(events: DataFrame, index: CellIndex) -> DataFrame:
    """``events`` (with ``_x, _y, _z``) with ``_level`` and ``_cell``, the leaf of each."""
    base = events.withColumn("_cell", cell(LEVELS[-1]))
    if index.hot is None:
        return base.withColumn("_level", F.lit(LEVELS[-1]))
    hot = index.hot.select(F.col("cell").alias("_cell"), F.lit(True).alias("_hot"))
    # The events' side is streamed or split: a base cell with very many events is no single task.
    joined = base.join(hot, "_cell", "left")
    deep = F.col("_hot").isNotNull()
    return joined.withColumns(
        {"_level": F.when(deep, F.lit(DEEP[-1])).otherwise(F.lit(LEVELS[-1])), "_cell": F.when(deep, cell(DEEP[-1])).otherwise(F.col("_cell"))}
    ).drop("_hot")


# The descent runs in tasks: its code travels by value, as ``functions.geo`` does.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Regression trees, forests and boosting from one aggregate, in exact arithmetic.

Training reads the rows twice: once for split candidates, once to add them up
into cells.  A cell is a tree and a combination of bins, one per feature; it holds
the sums of weight and label of its rows.  Rows of one cell go the same way, so
all levels of all trees, and all rounds of boosting, need nothing but the cells:
there are at most trees x bins^features, whatever the input.  Up to ``LOCAL_CELLS`` of them are grown into trees where they are read;
beyond that each level is one more aggregate, over the table of cells.

Nothing depends on how the rows are partitioned or ordered:

* split candidates are the 1/32 quantiles of each feature over the rows whose
  hash falls below a bound (all rows, if there are at most ``sample_rows``);
* a row's weight in a tree's bootstrap sample is a Poisson number drawn from the
  hash of its values (equal rows have equal weights), a node's features from
  the hash of tree and node;
* labels are whole numbers of 10^-9, so sums are exact in any order, and splits
  are compared as whole numbers: the best has the largest
  ``floor(S_l^2 / W_l) + floor(S_r^2 / W_r)``, on ties the first feature, then
  the lowest threshold, and it must beat ``floor(S^2 / W)`` by 2.

A fitted model is a table of nodes.  Scoring compiles it to column expressions,
so it stays inside the plan of its input: no Python, no vectors.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tremor.scratch import drop_scratch, scratch_table

# Whole numbers per unit of the label, and per unit of what is hashed.
UNIT = 10**9
HASH_UNIT = 10**6
# Defaults of Spark ML's tree estimators.
MAX_DEPTH, MAX_BINS = 5, 32
TREES, ROUNDS, STEP = 20, 20, 10  # a boosting round adds a tenth of its tree
# Sums are kept in two parts of a label, so that neither overflows at 10^12 rows.
LOW_BITS = 20
LOW = (1 << LOW_BITS) - 1
LOCAL_CELLS = 1_000_000


@dataclass(frozen=True)
class Node:
    """A split (``value`` None: rows with feature <= threshold go to 2n, others to 2n + 1) or a leaf."""

    tree: int
    node: int
    feature: int | None
    threshold: float | None
    value: int | None


NODES = "tree int, node int, feature string, threshold double, value long"


@dataclass(frozen=True)
class TreeModel:
    """The prediction is the sum of the leaves' values over ``divisor``; null where a feature is null."""

    features: tuple[str, ...]
    nodes: tuple[Node, ...]
    divisor: int

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.column())

    def column(self) -> Column:
        by_place = {(n.tree, n.node): n for n in self.nodes}
        names = ["`" + f.replace("`", "``") + "`" for f in self.features]

        def text(tree: int, at: int) -> str:
            n = by_place[tree, at]
            if n.feature is None:
                return f"{n.value}L"
            return f"CASE WHEN {names[n.feature]} <= {n.threshold!r}D THEN {text(tree, 2 * at)} ELSE {text(tree, 2 * at + 1)} END"

        # Text, as one column call per node costs far more; no brackets, whose nesting the parser is slow at.
        total = F.lit(0).cast("long")
        for tree in sorted({n.tree for n in self.nodes}):
            total = total + F.expr(text(tree, 1))
        there = F.col(names[0]).isNotNull()
        for name in names[1:]:
            there = there & F.col(name).isNotNull()
        return F.when(there, total.cast("double") / F.lit(float(self.divisor)))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; with ``divisor`` and the feature order this is the whole model."""
        rows = [(n.tree, n.node, None if n.feature is None else self.features[n.feature], n.threshold, n.value) for n in self.nodes]
        return spark.createDataFrame(rows, NODES)

    def save(self, path: str) -> None:
        """The node table, and its description in a table of one row beside it."""
        spark = SparkSession.active()
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"features": self.features, "divisor": self.divisor})
        spark.createDataFrame([(about,)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load(spark: SparkSession, path: str) -> TreeModel:
    about = json.loads(spark.read.parquet(f"{path}/about").first()["model"])
    return _model(spark.read.parquet(f"{path}/nodes"), tuple(about["features"]), about["divisor"])


def _model(table: DataFrame, features: tuple[str, ...], divisor: int) -> TreeModel:
    place = {f: i for i, f in enumerate(features)}
    rows = table.orderBy("tree", "node").collect()  # a node table is as large as the model
    nodes = tuple(Node(r.tree, r.node, None if r.feature is None else place[r.feature], r.threshold, r.value) for r in rows)
    return TreeModel(features, nodes, divisor)


def _descend(nodes: dict, tree: int, at: int, test, leaf) -> Column:
    """Nested conditions from a node on; ``test`` and ``leaf`` give a split's and a leaf's column."""
    node = nodes[tree, at]
    if node.feature is None:
        return leaf(node)
    below = [_descend(nodes, tree, 2 * at + side, test, leaf) for side in (0, 1)]
    return F.when(test(node), below[0]).otherwise(below[1])


# ---- training -----------------------------------------------------------------


def row_key(columns: list[str]) -> Column:
    """A row's values as text that every engine writes alike."""
    fixed = [F.round(F.col(f"`{c}`") * float(HASH_UNIT)).cast("long").cast("string") for c in columns]
    return F.concat_ws(":", *fixed)


def poisson_steps() -> list[int]:
    """A 32-bit number has as many of these at or below it as a Poisson(1) number of the same rank."""
    steps, below = [], 0.0
    for k in range(16):
        below += math.exp(-1) / math.factorial(k)
        steps.append(min(int(below * 2**32), 2**32))
    return [s for s in steps if s < 2**32]


def bagged(rows: DataFrame, seed: int, trees: int) -> DataFrame:
    """One row per row of ``rows`` (with its ``_key``) and tree that draws it: ``tree`` and ``_w``.

    Eight trees share a digest; the generators keep it from being computed again.
    """
    blocks = rows.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in range(-(-trees // 8))])))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_k").cast("string"), F.lit(":"), F.col("_key")), 256)
    drawn = blocks.withColumn("_d", digest).drop("_key").withColumn("_j", F.explode(F.array(*[F.lit(j) for j in range(8)])))
    drawn = drawn.withColumn("tree", F.col("_k") * 8 + F.col("_j")).where(F.col("tree") < trees)
    steps = [f"{s:08x}" for s in poisson_steps()]  # eight digits compare like the numbers they spell
    u = F.substring(F.col("_d"), F.col("_j") * 8 + 1, F.lit(8))
    weight = F.when(u < steps[0], F.lit(0).cast("long"))
    for k, step in enumerate(steps[1:], 1):
        weight = weight.when(u < step, F.lit(k).cast("long"))
    return drawn.withColumn("_w", weight.otherwise(F.lit(len(steps)).cast("long"))).where("_w > 0").drop("_k", "_j", "_d")


def node_features(seed: int, tree: int, node: int, features: int, subset: int) -> list[int]:
    """The ``subset`` features a node may split on: those with the smallest hashes."""
    if subset >= features:
        return list(range(features))
    rank = sorted(range(features), key=lambda f: hashlib.sha256(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest())
    return sorted(rank[:subset])


def thresholds(rows: DataFrame, features: tuple[str, ...], label: str, seed: int, max_bins: int, sample_rows: int) -> list[list[float]]:
    """Split candidates per feature: the values at ranks k n / ``max_bins`` rounded up, the largest value excepted."""
    n = rows.count()
    if n > sample_rows:
        bound = f"{int(2**32 * (sample_rows / n)):08x}"
        rows = rows.where(F.substring(F.sha2(F.concat(F.lit(f"{seed}:sample:"), row_key([*features, label])), 256), 1, 8) < bound)
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"`{c}`").alias("x")) for i, c in enumerate(features)])).alias("v"))
    counts = long.groupBy("v.f", "v.x").agg(F.count(F.lit(1)).alias("c"))
    ordered = Window.partitionBy("f").orderBy("x")  # of the sample
    ranked = counts.select("f", "x", "c", F.sum("c").over(ordered).alias("upto"), F.sum("c").over(Window.partitionBy("f")).alias("n"))
    step = lambda c: F.floor(c * max_bins / F.col("n"))
    picked = ranked.where((F.col("upto") < F.col("n")) & (step(F.col("upto")) > step(F.col("upto") - F.col("c"))))
    out: list[list[float]] = [[] for _ in features]
    for r in picked.orderBy("f", "x").collect():  # at most max_bins - 1 per feature
        out[r.f].append(r.x)
    return out


def cells_of(rows: DataFrame, features: tuple[str, ...], label: str, cuts: list[list[float]], seed: int = 0, bags: int = 0) -> DataFrame:
    """``tree, b0, b1, ..., w, high, low`` as a table; b: how many cuts are below the feature's value.

    ``bags``: so many trees draw bootstrap samples; 0: one tree has every row once.
    """
    def number(x: Column, cut: list[float], at: int = 0) -> Column:
        if not cut:
            return F.lit(at).cast("short")
        half = len(cut) // 2
        return F.when(x <= F.lit(cut[half]), number(x, cut[:half], at)).otherwise(number(x, cut[half + 1 :], at + half + 1))

    bins = {f"b{i}": number(F.col(f"`{f}`"), cut) for i, (f, cut) in enumerate(zip(features, cuts, strict=True))}
    y = F.round(F.col(f"`{label}`") * float(UNIT)).cast("long")
    rows = rows.select(*[c.alias(n) for n, c in bins.items()], y.alias("_y"), row_key([*features, label]).alias("_key"))
    drawn = bagged(rows, seed, bags) if bags else rows.select("*", F.lit(0).alias("tree"), F.lit(1).cast("long").alias("_w"))
    high, low = F.shiftright("_y", LOW_BITS), F.col("_y").bitwiseAND(F.lit(LOW))
    found = drawn.groupBy("tree", *bins).agg(F.sum("_w").alias("w"), F.sum(F.col("_w") * high).alias("high"), F.sum(F.col("_w") * low).alias("low"))
    return scratch_table(found, "cells")


class LocalCells:
    """Cells in memory: tree -> bins ``b`` (cells x features) and the sums ``w``, ``high``, ``low``."""

    def __init__(self, trees: dict[int, tuple[np.ndarray, ...]]):
        self.trees = trees
        self.node = {t: np.ones(len(x[0]), np.int64) for t, x in trees.items()}

    def histogram(self, levels: list[list[Node]], active: list[tuple[int, int]], subset) -> dict:
        for n in levels[-1] if levels else []:
            at = self.node[n.tree]
            here = at == n.node
            at[here] = 2 * n.node + (self.trees[n.tree][0][here, n.feature] > n.threshold)
        out: dict = {}
        for tree, node in active:
            b, *sums = self.trees.get(tree, (None,))
            here = [] if b is None else np.flatnonzero(self.node[tree] == node)
            if len(here):
                out[tree, node] = {f: _added(b[here, f], [x[here] for x in sums]) for f in subset(tree, node)}
        return out

    def less(self, grown: dict[int, Node]) -> "LocalCells":
        """What one tree leaves of the labels."""
        if not self.trees:
            return self
        b, w, high, low = self.trees[0]
        at = np.ones(len(b), np.int64)
        while split := [n for n in np.unique(at).tolist() if grown[n].feature is not None]:
            for n in split:
                here = at == n
                at[here] = 2 * n + (b[here, grown[n].feature] > grown[n].threshold)
        value = np.array([grown[n].value for n in at.tolist()], np.int64)
        return LocalCells({0: (b, w, high - w * (value >> LOW_BITS), low - w * (value & LOW))})

    def twice(self) -> "LocalCells":
        return LocalCells({t: (b, w, 2 * high, 2 * low) for t, (b, w, high, low) in self.trees.items()})


def _added(bins: np.ndarray, sums: list[np.ndarray]) -> dict[int, tuple[int, int]]:
    totals = []
    for x in sums:
        total = np.zeros(int(bins.max()) + 1, np.int64)
        np.add.at(total, bins, x)
        totals.append(total.tolist())
    return {b: (w, (h << LOW_BITS) + low) for b, (w, h, low) in enumerate(zip(*totals, strict=True)) if w}


class StoredCells:
    """Cells as a table (``tree``, the bins as array ``b``, sums); each histogram is an aggregate over it."""

    def __init__(self, table: DataFrame, trees: int):
        self.table, self.trees = table, trees

    def histogram(self, levels: list[list[Node]], active: list[tuple[int, int]], subset) -> dict:
        return _histogram(self.table, levels, active, subset, self.trees)

    def less(self, grown: dict[int, Node]) -> "StoredCells":
        test = lambda n: F.element_at("b", n.feature + 1) <= F.lit(n.threshold)
        value = _descend({(0, n): x for n, x in grown.items()}, 0, 1, test, lambda n: F.lit(n.value).cast("long"))
        high, low = F.shiftright("_v", LOW_BITS), F.col("_v").bitwiseAND(F.lit(LOW))
        left = self.table.withColumn("_v", value).withColumns({"high": F.col("high") - F.col("w") * high, "low": F.col("low") - F.col("w") * low})
        return StoredCells(scratch_table(left.drop("_v"), "cells"), self.trees)

    def twice(self) -> "StoredCells":
        return StoredCells(self.table.withColumns({"high": 2 * F.col("high"), "low": 2 * F.col("low")}), self.trees)


def _cells(table: DataFrame, features: int, trees: int) -> LocalCells | StoredCells:
    bins = [f"b{i}" for i in range(features)]
    few = table.limit(LOCAL_CELLS + 1).toArrow()
    if few.num_rows > LOCAL_CELLS:
        return StoredCells(table.select("tree", F.array(*bins).alias("b"), "w", "high", "low"), trees)
    tree = few.column("tree").to_numpy()
    columns = [np.stack([few.column(b).to_numpy().astype(np.int64) for b in bins], axis=1), *[few.column(n).to_numpy() for n in ("w", "high", "low")]]
    return LocalCells({t: tuple(c[tree == t] for c in columns) for t in np.unique(tree).tolist()})


SPLITS = {"tree": "int32", "node": "int32", "f": "int32", "cut": "int32"}


def _small(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A table that is part of the plan (from Arrow), without a job to read it."""
    values = zip(*rows) if rows else [[] for _ in columns]
    return spark.createDataFrame(pa.table({n: pa.array(list(v), pa.type_for_alias(t)) for (n, t), v in zip(columns.items(), values)}))


def _down(rows: DataFrame, levels: list[list[Node]], count: int) -> DataFrame:
    """``rows`` (with ``tree`` and ``b``) and the ``node`` that the splits of the first levels lead to.

    One tree's splits are one condition.  Those of several are a broadcast table per
    level, at most trees x 2^depth rows.
    """
    rows = rows.withColumn("node", F.lit(1))
    if count == 1 and levels and levels[0]:
        nodes = {(n.tree, n.node): n for splits in levels for n in splits}
        ends = {(t, c) for t, n in nodes for c in (2 * n, 2 * n + 1)} - set(nodes)
        whole = {**nodes, **{(t, c): Node(t, c, None, None, c) for t, c in ends}}
        test = lambda n: F.element_at("b", n.feature + 1) <= F.lit(n.threshold)
        return rows.withColumn("node", _descend(whole, levels[0][0].tree, 1, test, lambda n: F.lit(n.value)))
    for splits in levels:
        table = _small(rows.sparkSession, SPLITS, [(n.tree, n.node, n.feature, n.threshold) for n in splits])
        side = (F.element_at("b", F.col("f") + 1) > F.col("cut")).cast("int")
        joined = rows.join(F.broadcast(table), ["tree", "node"], "left")
        rows = joined.withColumn("node", F.when(F.col("f").isNull(), F.col("node")).otherwise(2 * F.col("node") + side)).drop("f", "cut")
    return rows


def _histogram(cells: DataFrame, levels: list[list[Node]], active: list[tuple[int, int]], subset, count: int) -> dict:
    """(tree, node) -> feature -> bin -> (weight, sum of the goal), of the active nodes."""
    if count == 1:
        features = F.explode(F.array(*[F.lit(f) for f in subset(0, 1)])).alias("f")
        placed = _down(cells, levels, 1).where(F.col("node").isin([n for _, n in active])).select("*", features)
    else:
        ask = [(t, n, f) for t, n in active for f in subset(t, n)]
        asked = _small(cells.sparkSession, {"tree": "int32", "node": "int32", "f": "int32"}, ask)  # at most trees x nodes x features rows
        placed = _down(cells, levels, count).join(F.broadcast(asked), ["tree", "node"])
    by_bin = placed.groupBy("tree", "node", "f", F.element_at("b", F.col("f") + 1).alias("bin"))
    sums = by_bin.agg(F.sum("w").alias("w"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    out: dict = {}
    for r in sums.collect():  # at most trees x nodes x features x bins rows
        out.setdefault((r.tree, r.node), {}).setdefault(r.f, {})[r.bin] = (r.w, (r.high << LOW_BITS) + r.low)
    return out


def best_split(stats: dict[int, dict[int, tuple[int, int]]], cuts: list[int]) -> tuple | None:
    """``(feature, bin, left, right)`` of the best split of a node's histogram, sides as (weight, sum)."""
    any_feature = next(iter(stats.values()))
    weight, total = (sum(v[i] for v in any_feature.values()) for i in (0, 1))
    best = None
    for f in sorted(stats):
        w = s = 0
        for b in range(cuts[f]):
            dw, ds = stats[f].get(b, (0, 0))
            w, s = w + dw, s + ds
            if 0 < w < weight:
                score = s * s // w + (total - s) ** 2 // (weight - w)
                if best is None or score > best[0]:
                    best = (score, f, b, (w, s), (weight - w, total - s))
    if best is None or best[0] < total * total // weight + 2:
        return None
    return best[1:]


def _grow(cells: LocalCells | StoredCells, count: int, cuts: list[list[float]], subset, max_depth: int, leaf_value) -> dict[int, dict[int, Node]]:
    """``count`` trees of the cells, level by level, all at once; splits on bins."""
    trees: dict[int, dict[int, Node]] = {t: {} for t in range(count)}
    active, levels = [(t, 1) for t in range(count)], []
    known: dict[tuple[int, int], tuple[int, int]] = {}
    sizes = [len(c) for c in cuts]
    for _ in range(max_depth):
        if not active:
            break
        found = cells.histogram(levels, active, subset)
        after, splits = [], []
        for tree, node in active:
            stats = found.get((tree, node))
            if stats is None:  # no rows at all
                trees[tree][node] = Node(tree, node, None, None, 0)
                continue
            split = best_split(stats, sizes)
            if split is None:
                some = next(iter(stats.values()))
                trees[tree][node] = Node(tree, node, None, None, leaf_value(*(sum(v[i] for v in some.values()) for i in (0, 1))))
                continue
            f, b, left, right = split
            trees[tree][node] = Node(tree, node, f, b, None)
            splits.append(trees[tree][node])
            known[tree, 2 * node], known[tree, 2 * node + 1] = left, right
            after += [(tree, 2 * node), (tree, 2 * node + 1)]
        levels.append(splits)
        active = after
    for tree, node in active:
        trees[tree][node] = Node(tree, node, None, None, leaf_value(*known[tree, node]) if (tree, node) in known else 0)
    return trees


def _published(trees: dict[int, dict[int, Node]], cuts: list[list[float]]) -> tuple[Node, ...]:
    """Nodes in order, splits on the features' own values."""
    nodes = [n for t in sorted(trees) for _, n in sorted(trees[t].items())]
    return tuple(n if n.feature is None else Node(n.tree, n.node, n.feature, cuts[n.feature][n.threshold], None) for n in nodes)


def _mean(weight: int, total: int) -> int:
    return total // weight


def fit_forest(
    train: DataFrame, features, label: str, seed: int, trees: int = TREES, subset: int | None = None, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS,
    sample_rows: int = 200_000, bootstrap: bool = True,
) -> TreeModel:
    """A random forest: the mean of ``trees`` trees, ``subset`` features per node (None: a third, rounded up).

    Rows with a null feature or label must be dropped before (``ml.model_frame``);
    no rows give a model that predicts 0.
    """
    if trees > 1 and not bootstrap:
        raise ValueError("trees of the same rows differ by their bootstrap samples only")
    features = tuple(features)
    k = -(-len(features) // 3) if subset is None else subset
    cuts = thresholds(train, features, label, seed, max_bins, sample_rows)
    table = cells_of(train, features, label, cuts, seed, trees if bootstrap else 0)
    grown = _grow(_cells(table, len(features), trees), trees, cuts, lambda t, n: node_features(seed, t, n, len(features), k), max_depth, _mean)
    drop_scratch(table)
    return TreeModel(features, _published(grown, cuts), trees * UNIT)


def fit_tree(train: DataFrame, features, label: str, seed: int, **how) -> TreeModel:
    """One tree over all rows and features."""
    features = tuple(features)
    return fit_forest(train, features, label, seed, trees=1, subset=len(features), bootstrap=False, **how)


def fit_boosted(
    train: DataFrame, features, label: str, seed: int, rounds: int = ROUNDS, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS, sample_rows: int = 200_000
) -> TreeModel:
    """Gradient boosting with squared loss: the first tree counts whole, the others a tenth.

    Each further tree is fitted to twice what the sum of the trees so far leaves.
    """
    features = tuple(features)
    cuts = thresholds(train, features, label, seed, max_bins, sample_rows)
    table = cells_of(train, features, label, cuts)
    cells, out = _cells(table, len(features), 1), {}
    for r in range(rounds):
        step = _mean if r == 0 else (lambda w, s: s // w // STEP)
        grown = _grow(cells if r == 0 else cells.twice(), 1, cuts, lambda t, n: list(range(len(features))), max_depth, step)[0]
        out[r] = {n: Node(r, n, x.feature, x.threshold, x.value) for n, x in grown.items()}
        if r + 1 < rounds:
            cells = cells.less(grown)
    drop_scratch(table)
    return TreeModel(features, _published(out, cuts), UNIT)


# ---- models of Spark ML -------------------------------------------------------


def from_spark_ml(spark: SparkSession, path: str, features) -> TreeModel:
    """The node table of a saved Spark ML regression tree, forest or boosted ensemble (the last stage of a pipeline).

    Values become whole numbers of 10^-15, so predictions agree to that.
    """
    features = tuple(features)
    at = sorted(r.path for r in spark.read.format("binaryFile").load(f"{path}/stages/*/metadata/*").select("path").collect() if "/part-" in r.path)[-1]
    stage = at.rsplit("/metadata/", 1)[0]
    data = spark.read.parquet(f"{stage}/data")
    about = json.loads(spark.read.text(f"{stage}/metadata").first()[0])
    single = len(data.columns) > 2  # an ensemble has the tree and a struct per row
    rows = data.select(F.lit(0), F.struct("*")) if single else data
    kind = about["class"].rsplit(".", 1)[-1]
    weights = {0: 1.0}
    if not single:
        weights = {r[0]: r[2] for r in spark.read.parquet(f"{stage}/treesMetadata").collect()}  # tree, metadata, weight
    scale = 1 / len(weights) if kind.startswith("RandomForest") else 1.0
    nodes, unit = [], 10**15
    by_tree: dict[int, dict] = {}
    for r in rows.toDF("treeID", "nodeData").collect():  # as large as the model
        by_tree.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    for tree, found in by_tree.items():
        todo = [(0, 1)]
        while todo:
            own, place = todo.pop()
            x = found[own]
            if x.leftChild < 0:
                nodes.append(Node(tree, place, None, None, round(x.prediction * weights[tree] * scale * unit)))
            else:
                nodes.append(Node(tree, place, x.split.featureIndex, x.split.leftCategoriesOrThreshold[0], None))
                todo += [(x.leftChild, 2 * place), (x.rightChild, 2 * place + 1)]
    return TreeModel(features, tuple(sorted(nodes, key=lambda n: (n.tree, n.node))), unit)

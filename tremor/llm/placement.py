"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree: regions hold racks, racks hold shards, and
every node weighs what its shards weigh.  A key descends from the root: each
child draws an exponential number from the hash of key and child, divided by
the child's weight, and the smallest draw is taken.  So a child gets keys in
proportion to its weight, and where a weight changes only draws of the nodes
above it change: keys move into or out of those subtrees, never between two
others.  A new shard opens a region of its own, which leaves all other weights
as they are, so it takes rows into itself and nothing else moves.
"""

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import col, drop_staged, stage_table

ROOT = "root"


@dataclass(frozen=True)
class Tree:
    """``paths``: shard -> (region, rack); ``weights``: shard -> weight, above zero."""

    paths: dict[int, tuple[int, int]]
    weights: dict[int, float]

    def __post_init__(self):
        if not self.paths or set(self.paths) != set(self.weights):
            raise ValueError("a tree has at least one shard, and a weight for each")
        if not all(w > 0 for w in self.weights.values()):
            raise ValueError("weights are above zero")

    def grown(self, weight: float = 1.0) -> "Tree":
        """One more shard, the next number, in a region of its own."""
        shard = max(self.paths) + 1
        region = max(region for region, _ in self.paths.values()) + 1
        return Tree({**self.paths, shard: (region, 0)}, {**self.weights, shard: weight})

    def with_weight(self, shard: int, weight: float) -> "Tree":
        return Tree(self.paths, {**self.weights, shard: weight})

    def children(self) -> dict[str, list[dict]]:
        """Node -> its children: name, weight (the sum of its shards), and the shard of a leaf."""
        out: dict[str, dict[str, dict]] = {}
        for shard, (region, rack) in sorted(self.paths.items()):
            names = [ROOT, f"{region}", f"{region}/{rack}", f"{region}/{rack}/{shard}"]
            for above, name in zip(names, names[1:]):
                child = out.setdefault(above, {}).setdefault(name, {"name": name, "weight": 0.0, "shard": -1})
                child["weight"] += self.weights[shard]
            child["shard"] = shard
        return {node: list(found.values()) for node, found in out.items()}


def even_tree(shards: int, regions: int, racks: int) -> Tree:
    """Shards of weight 1 dealt in order to ``regions`` of ``racks`` racks each."""
    leaves = regions * racks
    place = [divmod(k * leaves // shards, racks) for k in range(shards)]
    return Tree(dict(enumerate(place)), {k: 1.0 for k in range(shards)})


def draw(key: Column, name: Column, weight: Column) -> Column:
    """An exponential number of rate ``weight`` from the hash of key and node: 52 bits of a sha256."""
    bits = F.conv(F.substring(F.sha2(F.concat_ws(":", key, name), 256), 1, 13), 16, 10).cast("double")
    return -F.ln((bits + 0.5) / float(1 << 52)) / weight


def shard_column(key: Column, tree: Tree) -> Column:
    """The shard of a key (a string).  The tree is a literal; its size is that of the shard list."""
    kind = "map<string,array<struct<name:string,weight:double,shard:int>>>"
    nodes = F.from_json(F.lit(json.dumps(tree.children())), kind)

    def below(node: Column) -> Column:
        tickets = F.transform(node, lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name"), c["shard"].alias("shard")))
        return F.array_min(tickets)

    region = below(F.element_at(nodes, F.lit(ROOT)))
    rack = below(F.element_at(nodes, region["name"]))
    return below(F.element_at(nodes, rack["name"]))["shard"]


def place(docs: DataFrame, tree: Tree, doc_id: str = "doc_id", text: str = "text", grown: Tree | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard``: one row per row of ``docs``.

    ``shard`` follows from the id and the tree alone; ``grown_shard`` from the
    id and the tree ``grown`` (``tree.grown()`` if none is given).  ``size`` is
    the text's UTF-8 bytes plus 1.  ``slot`` counts the rows of a shard without
    gaps from 0, by id (null first), checksum and size.

    Null text has no bytes and counts as empty; a null id is the key "".  Rows
    that repeat an id share its shard, equal rows take neighbouring slots.
    An empty table gives no rows.  Slots come from one range sort of the narrow
    rows: each range counts its own rows per shard, and a shard's counts before
    a range are added, so no shard is ever sorted in one task.
    """
    key = F.coalesce(col(doc_id).cast("string"), F.lit(""))
    raw = F.coalesce(col(text), F.lit("")).cast("binary")
    rows = docs.select(
        col(doc_id).alias("doc_id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        shard_column(key, tree).alias("shard"),
        shard_column(key, grown or tree.grown()).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),  # so that ranges can cut rows that are equal else
    )
    rows = stage_table(rows, "narrow")  # the ranges are found by a pass of its own, which need not read texts
    order = ["shard", "doc_id", "text_crc32", "size", "_row"]
    ranges = stage_table(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "placed")
    drop_staged(rows)
    part = F.shiftright("_at", 33)
    counts = ranges.groupBy("shard", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("_n")
    # A range's rows of one shard have numbers without gaps, as it is sorted by shard first.
    starts = stage_table(counts.select("shard", "_part", (before - F.col("_first")).alias("_shift")), "starts")
    found = ranges.withColumn("_part", part).join(starts, ["shard", "_part"])
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("_at") + F.col("_shift")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, tree: Tree, path: str, doc_id: str = "doc_id", files: int = 1) -> None:
    """``docs`` written as Parquet to one folder per shard (``shard=K``), ``files`` files each at most.

    A column named ``shard`` is refused.
    """
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("the column 'shard' is there already")
    key = F.coalesce(col(doc_id).cast("string"), F.lit(""))
    dealt = docs.withColumn("shard", shard_column(key, tree))
    deal = F.pmod(F.xxhash64(*[col(c) for c in docs.columns]), F.lit(files))
    dealt.repartition(len(tree.paths) * files, "shard", deal).write.partitionBy("shard").parquet(path)

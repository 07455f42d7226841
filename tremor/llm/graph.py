"""Connected components by alternating star contraction, in DataFrame joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import drop_staged, stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(a, b)``.

    ``root`` is the smallest node reachable.  Each round points all of a
    node's larger neighbours, then the node and its smaller neighbours, at the
    smallest one; the edges end as one star per component, after a number of
    rounds that grows with the logarithm of the nodes.  Minima are partial
    aggregates and the joins back are splittable, so a node with very many
    neighbours is no single task; each round's edges and minima are staged tables.
    Self-loops give their node as its own root; nulls are dropped.
    """
    nodes = edges.where("a is not null and b is not null")
    loops = nodes.where("a = b").select(F.col("a").alias("node"))
    cur = stage_table(
        nodes.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars"
    )
    mark = _mark(cur)
    while mark[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = stage_table(low, "low")  # a join with a staged table can split the rows of a hot node
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage_table(large, "stars")
        least = stage_table(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v"))
            .distinct()
        )
        nxt = stage_table(small, "stars")
        drop_staged(cur, low, large, least)
        before, mark, cur = mark, _mark(nxt), nxt
        if mark == before:
            break
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    centres = cur.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    alone = loops.distinct().join(stars.select("node").unionByName(centres.select("node")), "node", "left_anti")
    return stars.unionByName(centres).unionByName(alone.select("node", F.col("node").alias("root")))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))
    ).first()
    return tuple(row)

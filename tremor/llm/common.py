"""Helpers shared by the operators: staged tables, row keys, worker caches, hot groups."""

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.scratch import drop_scratch as drop_staged
from tremor.scratch import scratch_table

__all__ = ["col", "drop_staged", "fresh", "hot_pieces", "join_listed", "stage_table", "text_hash", "worker_cache"]


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to and read back from the shared folder (see ``tremor.scratch``)."""
    return scratch_table(df, name, "llm")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """The column called exactly ``name``, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_hash(text: Column) -> Column:
    """Second half of a row key: rows that share an id but not a text stay apart."""
    return F.xxhash64(text)


# Words of 64 bits in the filter of ``join_listed``: its size is bounded by this, whatever the input.
FILTER_WORDS = 1 << 18


def join_listed(docs: DataFrame, lists: DataFrame, doc_id: str, text: str, carry: str) -> DataFrame:
    """``docs`` with the column ``carry`` of ``lists`` (null without one), of which few texts are shuffled.

    ``lists`` is a staged table with at most one row per (``doc_id``, ``th``),
    the row key of some documents.  Their hashes set bits in a filter of at most
    FILTER_WORDS words, which is broadcast.  A document whose bit is not set has
    no list and passes by; only the others, with their texts, go through the
    join.  The more rows ``lists`` has, the more documents without a list go
    through it too, up to all of them: the rows are the same.
    """
    w, b, i, h = (fresh(docs, name) for name in ("_word", "_bits", "_i", "_h"))
    word = lambda k: F.pmod(F.shiftright(k, 6), F.lit(FILTER_WORDS))
    bit = lambda k: F.pmod(k, F.lit(64)).cast("int")
    listed = F.xxhash64("doc_id", "th")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit(listed))
    words = lists.select(word(listed).alias(w), one.alias(b)).groupBy(w).agg(F.bit_or(b).alias(b))
    key = F.xxhash64(col(doc_id).cast(lists.schema["doc_id"].dataType), text_hash(col(text)))
    marked = docs.withColumn(w, word(key)).join(F.broadcast(words), w, "left")
    maybe = F.coalesce(F.getbit(F.col(b), bit(key)) == 1, F.lit(False))
    lists = lists.select(F.col("doc_id").alias(i), F.col("th").alias(h), carry)
    same = col(doc_id).eqNullSafe(F.col(i)) & (text_hash(col(text)) == F.col(h))
    met = marked.where(maybe).drop(w, b).join(lists, same, "left").drop(i, h)
    passed = marked.where(~maybe).drop(w, b).withColumn(carry, F.lit(None).cast(lists.schema[carry].dataType))
    return met.unionByName(passed)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (function globals sent by value do not)."""
    return sys.__dict__.setdefault("_tremor_llm_cache", {})


def hot_pieces(rows: DataFrame, keys: list[str], member: Column, block: int) -> DataFrame:
    """Deal groups of rows to bounded pieces in which every pair of a group still meets.

    A group of up to ``block`` rows is one piece (0, 0).  A larger one is cut
    by the hash of ``member`` into ``m`` blocks of about ``block`` rows, and
    each block goes to the ``m`` pieces it shares with a block, itself
    included.  Adds ``_blk`` (own block), ``_bi`` and ``_bj`` (the piece).
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
    # Staged, so that the join is not tied to the grouping's partitions: a hot group's rows can be split.
    hot = stage_table(counted.select(*keys, F.ceil(F.col("_n") / block).cast("int").alias("_m")), "hot")
    m = F.coalesce(F.col("_m"), F.lit(1))
    return (
        rows.join(hot, keys, "left")
        .withColumn("_blk", F.pmod(F.xxhash64(member, F.lit("block")), m).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), m - 1)))
        .withColumn("_bi", F.least("_blk", "_other"))
        .withColumn("_bj", F.greatest("_blk", "_other"))
        .drop("_m", "_other")
    )

"""SimHash near-duplicates: segment bit counts, grid range join, exact check."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, drop_staged, fresh, hot_pieces, stage_table, text_hash
from tremor.llm.graph import connected_components

# Fixed value: A-Z in lower case, all other bytes as they are.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits: bit i is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    import xxhash

    words = [] if text is None else text.encode().translate(LOWER).split()  # splits at 0x20 and 0x09-0x0D
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    if n == 1:
        digests = xxhash.xxh64_digest(line, 42)
    else:
        gap = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20)
        starts = [0, *(gap[: n - 1] + 1).tolist()]
        ends = [*gap[shingle - 1 :].tolist(), len(line)]
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(line[a:b], 42) for a, b in zip(starts, ends, strict=True)])
    bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > n).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    """The fingerprint's bits as a (signed) long."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            bits = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(bits.view(np.int64))

    return F.pandas_udf(run, "long").asNondeterministic()(text)


def hex16(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def counts_code(bits: Column) -> Column:
    """The 32 two-bit segments' bit counts, each in unary: 0 as 00, 1 as 01, 2 as 11.

    Two codes differ in as many bits as the Manhattan distance of the count
    vectors, which is never more than the bit distance of the fingerprints.
    """
    low = F.lit(0x5555555555555555)
    high, mine = F.shiftrightunsigned(bits, 1).bitwiseAND(low), bits.bitwiseAND(low)
    return high.bitwiseOR(mine).bitwiseOR(F.shiftleft(high.bitwiseAND(mine), 1))


def grid_masks(max_bits: int, spare: int = 2) -> list[int]:
    """Grids of the count vectors, as masks over their codes.

    The 32 segments are cut into ``max_bits + spare`` groups.  Vectors within
    Manhattan distance ``max_bits`` differ in at most ``max_bits`` groups, so
    they share a cell (equal counts) in one of the grids of ``spare`` groups.
    """
    groups = max_bits + spare
    if groups > 32:
        raise ValueError("max_bits + spare may be at most 32")
    edges = [round(g * 32 / groups) for g in range(groups + 1)]
    masks = [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(edges, edges[1:])]
    out = [sum(parts) for parts in combinations(masks, spare)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def _codes(bits: np.ndarray) -> np.ndarray:
    low = np.uint64(0x5555555555555555)
    high, mine = (bits >> np.uint64(1)) & low, bits & low
    return high | mine | ((high & mine) << np.uint64(1))


def _near(bits: np.ndarray, codes: np.ndarray, a, b, k: int) -> np.ndarray:
    """Manhattan distance of the counts first, then the bit distance itself."""
    return (np.bitwise_count(codes[a] ^ codes[b]) <= k) & (np.bitwise_count(bits[a] ^ bits[b]) <= k)


def cell_links(bits: np.ndarray, group: np.ndarray, k: int, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each run of equal ``group``, all that pairs within ``k`` bits connect.

    Runs of up to ``small`` rows give all their links, longer ones the edges of
    a breadth-first search: at most one for each row.
    """
    codes = _codes(bits)
    edge = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]))
    length = np.diff(edge)
    left, right = [], []
    size = np.repeat(length, length)
    a = np.flatnonzero((size > 1) & (size <= small))
    for step in range(1, small):
        a = a[a + step < len(group)]
        a = a[group[a] == group[a + step]]
        if not len(a):
            break
        near = a[_near(bits, codes, a, a + step, k)]
        left.append(near)
        right.append(near + step)
    for g in np.flatnonzero(length > small):
        rest, todo = np.arange(edge[g], edge[g + 1]), []
        while len(rest) or todo:
            if not todo:
                todo, rest = [rest[0]], rest[1:]
            at = todo.pop()
            hit = _near(bits, codes, rest, at, k)
            found, rest = rest[hit], rest[~hit]
            left.append(np.full(len(found), at))
            right.append(found)
            todo += found.tolist()
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]).astype(np.int64), np.concatenate([none, *right]).astype(np.int64)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that end where a group of the sorted rows ends; the last group waits for the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        change = _changes(table, keys)
        if len(change):
            yield table.slice(0, int(change[-1]))
            held = table.slice(int(change[-1]))
        else:
            held = table
    if held is not None and held.num_rows:
        yield held


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    diff = np.zeros(max(0, table.num_rows - 1), dtype=bool)
    for key in keys:
        values = table.column(key).to_numpy()
        diff |= values[1:] != values[:-1]
    return np.flatnonzero(diff) + 1


CELL = ["grid", "cell", "_bi", "_bj"]


def fingerprint_links(prints: DataFrame, max_bits: int = 4, block: int = 4096) -> DataFrame:
    """``(a, b)``: links among distinct fingerprints ``fp`` that connect all pairs within ``max_bits``.

    Each fingerprint goes to one cell of every grid; cells with more than
    ``block`` fingerprints are cut into pieces in which all pairs still meet.
    """
    code = counts_code(F.col("fp"))
    grids = F.array(
        *[
            F.struct(F.lit(i).cast("short").alias("grid"), code.bitwiseAND(F.lit(m)).alias("cell"))
            for i, m in enumerate(grid_masks(max_bits))
        ]
    )
    cells = prints.select("fp", F.explode(grids).alias("g")).select("fp", "g.grid", "g.cell")
    pieces = hot_pieces(cells, ["grid", "cell"], F.col("fp"), block).select("fp", *CELL)

    def run(batches):
        for table in sorted_groups(batches, CELL):
            group = np.zeros(table.num_rows, dtype=np.int64)
            group[_changes(table, CELL)] = 1
            bits = table.column("fp").to_numpy().view(np.uint64)
            a, b = cell_links(bits, np.cumsum(group), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(bits[a].view(np.int64)), pa.array(bits[b].view(np.int64))], ["a", "b"])

    return pieces.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(run, "a long, b long")


def fingerprint_components(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """``(fp, root)`` of the fingerprints that are linked with another one."""
    distinct = stage_table(prints.select("fp").distinct(), "prints")
    links = stage_table(fingerprint_links(distinct, max_bits), "links")
    out = connected_components(links).select(F.col("node").alias("fp"), "root")
    drop_staged(distinct)
    return out


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)``, one row per row of ``docs``.

    Equal fingerprints are one node, so copies cost one row each.  Null, empty
    and wordless texts have fingerprint zero and are linked like any other.
    ``component_id`` is the smallest id reachable (null ids count only where
    there is no other); repeated rows repeat in the result.
    """
    rows = stage_table(docs.select(col(doc_id).alias("doc_id"), fingerprint_column(col(text), shingle).alias("fp")), "fingerprints")
    lowest = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    linked = lowest.join(fingerprint_components(rows, max_bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = stage_table(linked, "linked")
    roots = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    found = linked.join(roots, "root").select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", "fp", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id (then the smallest text hash).

    All columns stay as they are.  A repeated row stays once.
    """
    fp, root, key = (fresh(docs, n) for n in ("_fp", "_root", "_key"))
    keyed = docs.withColumn(key, F.struct(col(doc_id).alias("i"), text_hash(col(text)).alias("h")))
    rows = stage_table(keyed.select(col(key).alias("key"), fingerprint_column(col(text), shingle).alias("fp")), "fingerprints")
    parts = rows.select("fp").distinct().join(fingerprint_components(rows, max_bits), "fp", "left")
    parts = parts.withColumn("root", F.coalesce("root", "fp"))
    # Ids before no id: a null id is kept only where its group has no other.
    order = F.struct(F.col("key.i").isNull().alias("n"), F.col("key.i").alias("i"), F.col("key.h").isNull().alias("m"), F.col("key.h").alias("h"))
    first = rows.join(parts, "fp").groupBy("root").agg(F.min(order).alias("first"))
    keep = stage_table(
        first.select(F.col("root").alias(root), F.struct(F.col("first.i").alias("i"), F.col("first.h").alias("h")).alias(key)), "kept"
    )
    drop_staged(rows)
    marked = keyed.join(keep, keyed[key].eqNullSafe(keep[key])).drop(keep[key])
    return marked.dropDuplicates([root]).drop(root, key)

"""Repeated byte strings: suffixes in depth-limited radix passes, equal groups are the repeats.

Only the first ``depth`` bytes of a suffix count, so a suffix is a window.  The
passes refine groups of windows by further digits and drop what is settled:

1. The first digit of a window is the hash of its smallest ``gram`` (content
   alone decides which that is).  Neighbouring windows mostly share it, so a
   run of windows is one row, with its digit and the hash of all its bytes.
2. Digit groups that hold different runs are cut into blocks of windows at the
   same distance from the gram; the digit is the hash of the bytes that all
   windows of the block have in common.
3. Blocks that still differ are cut into single windows; the digit is the
   window itself.

In every pass rows with equal bytes are one row with a count: a count of two
or more is a repeat, a digit that no other row has is unique, both are done.
Passes are grouped counts (partial aggregates), so a digit that very many rows
share is no single task.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, drop_staged, stage_table, text_hash, worker_cache

# An odd multiplier with its inverse modulo 2^64, and mixing constants of a 64-bit finaliser.
RADIX = 0x9E3779B97F4A7C15
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
POSITION_BITS = 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    if "radix" not in cache or len(cache["radix"][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(RADIX, -1, 1 << 64)
        out = []
        for base in (RADIX, inverse):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            out.append(np.cumprod(step, dtype=np.uint64))
        cache["radix"] = tuple(out)
    return cache["radix"]


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes."""
    n = len(raw)
    power, inverse = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(raw * power[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * inverse[: n - gram + 1]
    h ^= h >> np.uint64(33)
    h *= np.uint64(MIX[0])
    h ^= h >> np.uint64(29)
    h *= np.uint64(MIX[1])
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    tile = padded.reshape(-1, width)
    before = np.minimum.accumulate(tile, axis=1).ravel()
    after = np.minimum.accumulate(tile[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def window_runs(raw: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same smallest gram: first window, windows, gram's place, gram's hash."""
    h = gram_hashes(raw, gram)
    place = np.uint64((1 << POSITION_BITS) - 1)
    ranked = (h & ~place) | np.arange(len(h), dtype=np.uint64)  # of equal grams the first
    at = (sliding_min(ranked, depth - gram + 1) & place).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    return first, np.diff(np.append(first, len(at))), at[first], h[at[first]]


def _digests(pieces: list) -> np.ndarray:
    """Two 64-bit halves of each piece's 128-bit hash."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(p) for p in pieces]), dtype=">i8").astype(np.int64).reshape(-1, 2)


RUN = "start long, windows int, reach int, digit long, c1 long, c2 long"


def _runs(depth: int, gram: int, id_type: str):
    span = (1 << POSITION_BITS) - depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            source, parts, content = [], [], []
            for i, text in enumerate(texts):
                raw = text.as_py() or b""
                for base in range(0, len(raw) - depth + 1, span):
                    chunk = raw[base : base + span + depth - 1]
                    first, n, at, digit = window_runs(np.frombuffer(chunk, dtype=np.uint8), depth, gram)
                    parts.append((first + base, n, at - first, digit.view(np.int64)))
                    source.append(np.full(len(first), i))
                    content += [chunk[a : a + k + depth - 1] for a, k in zip(first.tolist(), n.tolist(), strict=True)]
                if len(content) > 40_000 or i == len(texts) - 1:
                    if content:
                        start, n, reach, digit = map(np.concatenate, zip(*parts, strict=True))
                        hashes, rows = _digests(content), pa.array(np.concatenate(source))
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(rows),
                                batch.column(1).take(rows),
                                pa.array(start),
                                pa.array(n.astype(np.int32)),
                                pa.array(reach.astype(np.int32)),
                                pa.array(digit),
                                pa.array(hashes[:, 0]),
                                pa.array(hashes[:, 1]),
                            ],
                            ["doc_id", "th", "start", "windows", "reach", "digit", "c1", "c2"],
                        )
                    source, parts, content = [], [], []

    return run


def settle(rows: DataFrame, digit: list[str], keep: list[str]) -> DataFrame:
    """One row per digit and content: ``total`` copies and ``variants``, how many contents the digit has.

    ``rows`` has the digit columns, the content hash c1, c2, a count ``n`` and
    the columns ``keep``, of which one copy's values stay.
    """
    one = [F.first(c).alias(c) for c in keep]  # all of the same row; hash aggregation, unlike a struct's minimum
    content = stage_table(rows.groupBy(*digit, "c1", "c2").agg(F.sum("n").alias("total"), *one), "contents")
    variants = content.groupBy(*digit).agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    # Staged, so that the join is not tied to the grouping's partitions: a hot digit's rows can be split.
    return content.join(stage_table(variants, "variants"), digit, "left")


def _bytes_of_runs(depth: int):
    """The bytes of each listed run of a text."""

    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in parts:
            out = []
            for text, runs in zip(texts, lists, strict=True):
                raw = text.encode()
                out.append([raw[r["start"] : r["start"] + r["windows"] + depth - 1] for r in runs])
            yield pd.Series(out)

    return F.pandas_udf(run, "array<binary>").asNondeterministic()


BLOCK = "cid long, block int, start int, windows int, once boolean, n long, digit long, d1 long, d2 long, c1 long, c2 long"


def _blocks(depth: int, size: int):
    """Blocks of a run: windows whose distance to the gram lies in [size * block, size * block + size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields, cores, contents = [], [], []
            for row in batch.to_pylist():
                raw, reach = row["raw"], row["reach"]
                for block in range((reach - row["windows"] + 1) // size, reach // size + 1):
                    far, near = size * block + size - 1, size * block  # distances of the block's ends
                    a, b = max(0, reach - far), min(row["windows"] - 1, reach - near)
                    fields.append((row["cid"], block, a, b - a + 1, row["once"], row["n"], row["digit"]))
                    cores.append(block.to_bytes(4, "big") + raw[reach - near : reach - far + depth])
                    contents.append((a - reach).to_bytes(4, "big", signed=True) + raw[a : b + depth])
            if fields:
                core, content = _digests(cores), _digests(contents)
                columns = list(zip(*fields, strict=True))
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    + [pa.array(core[:, 0]), pa.array(core[:, 1]), pa.array(content[:, 0]), pa.array(content[:, 1])],
                    [f.split(" ")[0] for f in BLOCK.split(", ")],
                )

    return run


WINDOW = "cid long, start int, n long, c1 long, c2 long"


def _windows(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid, start, n, contents = [], [], [], []
            for row in batch.to_pylist():
                for b in row["blocks"]:
                    for a in range(b["start"], b["start"] + b["windows"]):
                        cid.append(row["cid"])
                        start.append(a)
                        n.append(b["total"])
                        contents.append(row["raw"][a : a + depth])
            if cid:
                content = _digests(contents)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int64()), pa.array(content[:, 0]), pa.array(content[:, 1])],
                    ["cid", "start", "n", "c1", "c2"],
                )

    return run


def repeated_windows(docs: DataFrame, doc_id: str, text: str, depth: int = 400, gram: int = 100, size: int = 16) -> DataFrame:
    """``(doc_id, th, start, windows)``: runs of window starts whose ``depth`` bytes start elsewhere too.

    ``th`` is the hash of the row's text (``text_hash``).  Every repeated window
    is in some run; runs can overlap and repeat.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(col(doc_id).alias("doc_id"), text_hash(col(text)).alias("th"), col(text).alias("text"))
    rows = rows.where(F.octet_length("text") >= depth)
    runs = stage_table(rows.select("doc_id", "th", "text").mapInArrow(_runs(depth, gram, id_type), f"doc_id {id_type}, th long, {RUN}"), "runs")
    own = ["doc_id", "th", "start", "windows", "reach"]
    found = stage_table(settle(runs.withColumn("n", F.lit(1).cast("long")), ["digit"], own), "settled")
    again = found.where("total > 1").select("digit", "c1", "c2")
    whole = stage_table(runs.join(again, ["digit", "c1", "c2"], "left_semi").select("doc_id", "th", "start", "windows"), "whole")

    open_runs = found.where("variants > 1").select("digit", "total", *own)
    lists = open_runs.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "windows", "reach", "digit", "total")).alias("runs"))
    # One row per listed text: of repeated rows any one will do.
    joined = rows.alias("r").join(lists.alias("l"), F.expr("r.doc_id <=> l.doc_id and r.th = l.th"))
    raw = _bytes_of_runs(depth)
    cut = joined.select("r.doc_id", "r.th", "l.runs", raw(F.col("r.text"), F.col("l.runs")).alias("raws"))
    cut = cut.select("doc_id", "th", F.explode(F.arrays_zip("runs", "raws")).alias("z"))
    cut = cut.select(
        F.monotonically_increasing_id().alias("cid"), "doc_id", "th", "z.runs.*", F.col("z.raws").alias("raw")
    ).withColumnsRenamed({"total": "n"}).withColumn("once", F.col("n") == 1)
    cut = stage_table(cut, "open-runs")
    drop_staged(runs, found)

    blocks = stage_table(cut.select("cid", "reach", "windows", "once", "n", "digit", "raw").mapInArrow(_blocks(depth, size), BLOCK), "blocks")
    digit = ["digit", "d1", "d2"]
    found = stage_table(settle(blocks, digit, ["cid", "block", "start", "windows", "once"]), "settled")
    again = found.where("total > 1").select(*digit, "c1", "c2")
    blocks_again = stage_table(
        blocks.where("once").join(again, [*digit, "c1", "c2"], "left_semi").select("cid", "start", "windows"), "blocks-again"
    )
    open_blocks = found.where("variants > 1").select("total", "cid", "start", "windows")
    lists = open_blocks.groupBy("cid").agg(F.collect_list(F.struct("start", "windows", "total")).alias("blocks"))
    singles = stage_table(cut.select("cid", "raw").join(lists, "cid").mapInArrow(_windows(depth), WINDOW), "windows")
    again = singles.groupBy("c1", "c2").agg(F.sum("n").alias("total")).where("total > 1").select("c1", "c2")
    singles_again = singles.where("n = 1").join(again, ["c1", "c2"], "left_semi").select("cid", "start", F.lit(1).alias("windows"))
    inside = blocks_again.unionByName(singles_again)
    places = cut.select("cid", "doc_id", "th", F.col("start").alias("base"))
    partly = inside.join(places, "cid").select("doc_id", "th", (F.col("base") + F.col("start")).alias("start"), "windows")
    return whole.unionByName(partly)


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary"


def merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans become one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > ends[:-1]))
    last = np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)
    return list(zip(starts[first].tolist(), ends[last].tolist(), strict=True))


def _removed(depth: int, with_text: bool):
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in parts:
            rows = []
            for text, runs in zip(texts, lists, strict=True):
                raw, spans = (text or "").encode(), []
                if runs is not None and len(runs):
                    start = np.array([r["start"] for r in runs])
                    spans = merge(start, start + np.array([r["windows"] for r in runs]) + depth - 1)
                edge = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edge[0::2], edge[1::2], strict=True))
                gone = [{"start": a, "end": b} for a, b in spans]
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), gone, kept if with_text else None))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return F.pandas_udf(run, RESULT).asNondeterministic()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = 400, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept.

    Removed is each byte covered by ``depth`` bytes that also start anywhere
    else, in the same or another row; ``spans`` are the maximal removed runs in
    byte offsets of the input, ``kept`` the remaining bytes (null unless
    ``with_text``; they need not be valid UTF-8).

    Null text counts as empty, and texts shorter than ``depth`` lose nothing.
    Repeated rows are each other's repeats.  Null ids are ids like any other.
    """
    found = repeated_windows(docs, doc_id, text, depth).distinct()
    lists = found.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))  # of one text
    rows = docs.select(col(doc_id).alias("doc_id"), text_hash(col(text)).alias("th"), col(text).alias("text"))
    joined = rows.alias("r").join(lists.alias("l"), F.expr("r.doc_id <=> l.doc_id and r.th = l.th"), "left")
    removed = _removed(depth, with_text)
    return joined.select("r.doc_id", removed(F.col("r.text"), F.col("l.runs")).alias("x")).select("doc_id", "x.*")

"""Substring dedup by unit hashing: the earliest occurrence of a unit stays."""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, drop_staged, stage_table, text_hash

# Sentences: they end with their line, or at a sentence end inside the line.
SENTENCE = re.compile(r"[^\n]*?(?:(?:[.!?]|[^\w\s]{2})[^\w\s]*(?=\s|$)|$|(?=\n))", re.M)
WORD = re.compile(r"\w+")


def units_of(text: str | None, min_words: int, whole_lines: bool = False) -> list[tuple[int, int, str]]:
    """``(start, end, normalised)`` of the units of a text, in code points.

    A unit is a sentence, or as many short ones after each other in a line as
    make ``min_words`` words: two copies of a passage have the same units from
    their first common unit end on.  What is left over at the end of a line is
    too short to tell copies by, unless it is the whole line and has two words.
    With ``whole_lines`` what is left over is told by its whole line: its unit
    has the offsets of the rest and the words of the line.
    Normalised: lower-case words alone, one space between.
    """
    out: list[tuple[int, int, str]] = []
    words: list[str] = []
    start, body = -1, text or ""
    for m in SENTENCE.finditer(body):
        found = WORD.findall(m.group())
        if found and not words:
            start = m.start() + len(m.group()) - len(m.group().lstrip())
        words += found
        ends = m.end() == len(body) or body[m.end()] == "\n"
        line = body.rfind("\n", 0, start) + 1 if ends and words else 0
        whole = ends and len(words) > 1 and not body[line:start].strip()
        if words and (len(words) >= min_words or whole):
            out.append((start, m.end(), " ".join(words).lower()))
            words = []
        elif ends:
            if words and whole_lines:
                out.append((start, m.end(), " ".join(WORD.findall(body[line : m.end()])).lower()))
            words = []
    return out


def _unit_rows(min_words: int, whole_lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            source, start, end, digest = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for a, b, unit in units_of(text, min_words, whole_lines):
                    source.append(i)
                    start.append(a)
                    end.append(b)
                    digest.append(xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass")))
            if source:
                halves, rows = np.frombuffer(b"".join(digest), dtype=">i8").astype(np.int64).reshape(-1, 2), pa.array(source)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                    ["doc_id", "th", "start", "end", "c1", "c2"],
                )

    return run


def _cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, lists in parts:
        rows = []
        for text, gone in zip(texts, lists, strict=True):
            body, spans = text or "", sorted({(g["start"], g["end"]) for g in gone} if gone is not None else set())
            edge = [0, *(x for s in spans for x in s), len(body)]
            kept = "".join(body[a:b] for a, b in zip(edge[0::2], edge[1::2], strict=True))
            rows.append((len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept.encode()).hexdigest(), [{"start": a, "end": b} for a, b in spans], kept))
        yield pd.DataFrame(rows, columns=["n_chars", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


RESULT = "n_chars long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept string"


def dedup_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 6, whole_lines: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, n_removed, n_spans, kept_sha256, spans, kept.

    Units are lines, cut further at sentence ends (see ``units_of``); equal
    normalised units are copies wherever they are.  The earliest (by
    document id, text hash and offset) stays, all others are removed; ``spans``
    are the removed units' code-point offsets in the input.  With
    ``whole_lines`` a copied line loses all its words, those after its last
    unit and a single one too.

    Null text counts as empty; a null id comes first.  Rows that repeat both id
    and text count as one document: neither is a copy of the other.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(col(doc_id).alias("doc_id"), text_hash(col(text)).alias("th"), col(text).alias("text"))
    units = rows.mapInArrow(_unit_rows(min_words, whole_lines), f"doc_id {id_type}, th long, start int, end int, c1 long, c2 long")
    units = stage_table(units, "units")
    place = F.struct("doc_id", "th", "start")
    often = units.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2")
    often = stage_table(often, "often")  # joins with staged tables can split the rows of a hot unit
    copies = stage_table(units.join(often, ["c1", "c2"], "left_semi"), "unit-copies")
    drop_staged(units)
    first = stage_table(copies.groupBy("c1", "c2").agg(F.min(place).alias("first")), "first")
    later = copies.join(first, ["c1", "c2"]).where(~place.eqNullSafe(F.col("first")))
    lists = later.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("gone"))  # of one text
    joined = rows.alias("r").join(lists.alias("l"), F.expr("r.doc_id <=> l.doc_id and r.th = l.th"), "left")
    cut = F.pandas_udf(_cut, RESULT).asNondeterministic()
    return joined.select("r.doc_id", cut(F.col("r.text"), F.col("l.gone")).alias("x")).select("doc_id", "x.*")

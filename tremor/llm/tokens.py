"""Token counts per section: whole texts encoded once, tokens laid over sections by their places."""

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, worker_cache

SECTION = "array<struct<section:int,start:long,end:long,n_tokens:long,n_crossing:long>>"


class ByteTokens:
    """A byte-level vocabulary whose tokens, joined, are the text's UTF-8 bytes."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """The byte offset after each token."""
        return np.cumsum(self.length[self.encoding.encode_to_numpy(text, disallowed_special=())])


def sections(raw: np.ndarray) -> np.ndarray:
    """Byte offsets where sections (lines with their line ends) begin, and the text's length."""
    starts = np.concatenate(([0], np.flatnonzero(raw == 0x0A) + 1))
    return np.append(starts[starts < max(1, len(raw))], len(raw))


def count_sections(text: str | None, tokens: ByteTokens) -> list[dict]:
    """Each section's span in code points, its tokens, and how many of them reach into a later section.

    The rule: a token counts for the section that holds its first byte.
    """
    if text is None:
        return []
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    edge, ends = sections(raw), tokens.ends(text)
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))[: len(ends)]
    owner, last = np.searchsorted(edge, starts, "right") - 1, np.searchsorted(edge, ends, "left") - 1
    n = len(edge) - 1
    own, crossing = np.bincount(owner, minlength=n), np.bincount(owner[last > owner], minlength=n)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[edge]
    return [
        {"section": k, "start": a, "end": b, "n_tokens": m, "n_crossing": c}
        for k, (a, b, m, c) in enumerate(zip(points[:-1].tolist(), points[1:].tolist(), own.tolist(), crossing.tolist(), strict=True))
    ]


def token_counts(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, section, start, end, n_tokens, n_crossing)``: one row per section of each row's text.

    Sections are lines, their line ends included; start and end are code
    points.  A text is encoded whole, so its sections' counts add up to its
    tokens.  Empty text is one empty section without tokens, null text gives no
    row; null ids and repeated rows are rows like any other.
    """

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = worker_cache()
        key = ("byte-tokens", path, pattern)
        if key not in cache:
            cache[key] = ByteTokens(path, pattern)
        for texts in parts:
            yield pd.Series([count_sections(t, cache[key]) for t in texts], dtype=object)

    count = F.pandas_udf(run, SECTION).asNondeterministic()
    return docs.select(col(doc_id).alias("doc_id"), F.explode(count(col(text))).alias("s")).select("doc_id", "s.*")

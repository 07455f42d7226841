"""Fill-in-middle by in-place block rotation.

A text's UTF-8 bytes are scanned once for the places of its cuts.  The three
sentinels are inserted into a bytearray in front of their segments, in the
order of the text: prefix, middle, suffix.  Two neighbouring blocks change
places by three reversals: each block by itself, then both together.  A form
is one such rotation, and its inverse is the rotation at the mirrored cut, so
the exact text comes back from the output and the form alone.

    plain  the text
    psm    <P>prefix<S>suffix<M>middle    middle and suffix rotated
    spm    <S>suffix<P>prefix<M>middle    prefix with middle, and suffix rotated
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col

# Sentinels of prefix, suffix and middle; percentages; the seed before the id.
SENTINELS = ("<P>", "<S>", "<M>")
TRANSFORMED = 90
SUFFIX_FIRST = 20
SEED = "1"


def rotate(block: bytearray, start: int, cut: int, end: int) -> None:
    """``block[start:cut]`` and ``block[cut:end]`` change places, by three reversals."""
    view = np.frombuffer(block, dtype=np.uint8)
    for a, b in ((start, cut), (cut, end), (start, end)):
        view[a:b] = view[a:b][::-1]


def draws(doc_id: str, seed: str) -> list[int]:
    """Four numbers of 32 bits from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def cut_places(raw: bytes) -> np.ndarray:
    """Where each code point begins, and the end."""
    starts = np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(raw))


def transform(raw: bytes, doc_id: str, seed: str, transformed: int, suffix_first: int, marks: tuple[bytes, bytes, bytes]) -> tuple:
    """``(code points, form, prefix, middle, output)`` of one text; lengths in code points, None if plain."""
    at = cut_places(raw)
    n = len(at) - 1
    h = draws(doc_id, seed)
    if n == 0 or any(m in raw for m in marks) or h[2] % 100 >= transformed:
        return n, "plain", None, None, raw
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    first, second = int(at[low]), int(at[high])
    p, s, m = marks
    block = bytearray(raw)
    block[second:second] = s  # from the back, so that the earlier cut stays where it is
    block[first:first] = m
    block[0:0] = p
    middle, suffix = len(p) + first, len(p) + len(m) + second
    form = "spm" if h[3] % 100 < suffix_first else "psm"
    rotate(block, 0 if form == "spm" else middle, suffix, len(block))
    return n, form, low, high - low, bytes(block)


def invert(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text of an output.  Sentinels are in it once each, as a text that holds one stays plain."""
    if form == "plain":
        return output
    p, s, m = marks
    block = bytearray(output)
    if form == "spm":
        rotate(block, 0, output.index(p), len(block))
    elif form == "psm":
        rotate(block, output.index(s), output.index(m), len(block))
    else:
        raise ValueError(f"unknown form {form!r}")
    suffix, middle = block.rindex(s), block.index(m)
    del block[suffix : suffix + len(s)]
    del block[middle : middle + len(m)]
    del block[: len(p)]
    return bytes(block)


RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def _marks(sentinels: tuple[str, str, str]) -> tuple[bytes, bytes, bytes]:
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels, none of them empty")
    for a in sentinels:
        for b in sentinels:
            # A sentinel that can begin inside another, or next to a text's end, would be found at the wrong place.
            if any(a.endswith(b[:k]) for k in range(1, len(b))) or (a != b and a in b):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")
    return tuple(x.encode() for x in sentinels)


def infill_column(
    text: Column, doc_id: Column, seed: str = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST, sentinels: tuple[str, str, str] = SENTINELS
) -> Column:
    """The struct of ``infill`` for a text and the decimal form of an id."""
    marks = _marks(sentinels)

    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ids in parts:
            rows = []
            for text, doc in zip(texts, ids, strict=True):
                n, form, prefix, middle, output = transform((text or "").encode(), doc, seed, transformed, suffix_first, marks)
                rows.append((n, form, prefix, middle, output.decode()))
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # Not to be computed again for each field that is read.
    return F.pandas_udf(run, RESULT).asNondeterministic()(text, F.coalesce(doc_id.cast("string"), F.lit("")))


def restored_column(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text of an output, from it and its form; null if either is null."""
    marks = _marks(sentinels)

    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in parts:
            yield pd.Series(
                [None if o is None or f is None else invert(o.encode(), f, marks).decode() for o, f in zip(outputs, forms, strict=True)],
                dtype=object,
            )

    return F.pandas_udf(run, "string")(output, form)


def infill(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "infill", **how) -> DataFrame:
    """``docs`` with a struct ``out``: n, form, prefix_chars, middle_chars, output.

    A text of n code points is cut into prefix, middle and suffix; the places
    come from the sha256 of the seed and the decimal id, so that they depend on
    nothing else and stay when the table grows.  ``form`` is plain (the text
    itself) where the text is empty or holds a sentinel, and for the share of
    ids that is left as it is; lengths are null there.

    Null text counts as empty, a null id as an empty one.  Rows that repeat an
    id are cut by the same numbers; equal rows have equal results.  Memory is a
    few copies of the longest text.  All other columns stay; a column named as
    ``out`` is refused.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the column {out!r} is there already")
    return docs.withColumn(out, infill_column(col(text), col(doc_id), **how))

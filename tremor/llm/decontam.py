"""Benchmark decontamination: one Aho-Corasick automaton over word sequences."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, fresh, stage_table, worker_cache

# A-Z in lower case; every other ASCII byte but 0-9 and a-z parts
# words; bytes from 0x80 on (UTF-8) are letters of words.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(WORD_BYTES).split()


def word_windows(words: list, size: int) -> Iterator[tuple]:
    """Runs of ``size`` words; a shorter text that has words is one window."""
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield tuple(words[i : i + size])


def build_automaton(items: list[tuple[str, str]], size: int):
    """``(vocabulary, automaton, windows)``; a window is (its length in words, item indices)."""
    import ahocorasick

    vocabulary: dict[bytes, int] = {}
    found: dict[tuple, set[int]] = {}
    for k, (_, text) in enumerate(items):
        for window in word_windows(words_of(text), size):
            key = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in window)
            found.setdefault(key, set()).add(k)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    windows = []
    for key, owners in found.items():
        automaton.add_word(key, len(windows))
        windows.append((len(key), sorted(owners)))
    if windows:
        automaton.make_automaton()
    return vocabulary, automaton, windows


def scan(text: str | None, items: list[tuple[str, str]], built) -> tuple[int, int, list[str], list[dict]]:
    """Words, hit words, item ids and code-point spans of hit runs in one text."""
    vocabulary, automaton, windows = built
    words = words_of(text)
    if not words or not windows:
        return len(words), 0, [], []
    get = vocabulary.get
    hits = list(automaton.iter(tuple([get(w, 0) for w in words])))  # 0: a word of no item, never part of a key
    if not hits:
        return len(words), 0, [], []
    change = np.zeros(len(words) + 1, dtype=np.int64)
    owners: set[int] = set()
    for last, window in hits:
        n, who = windows[window]
        change[last - n + 1] += 1
        change[last + 1] -= 1
        owners.update(who)
    hit = np.cumsum(change[:-1]) > 0
    return len(words), int(hit.sum()), sorted({items[k][0] for k in owners}), _spans(text, hit)


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    raw = text.encode()
    clean = np.frombuffer(b" " + raw.translate(WORD_BYTES) + b" ", dtype=np.uint8) != 0x20
    edge = np.flatnonzero(clean[1:] != clean[:-1])
    starts, ends = edge[0::2], edge[1::2]
    run = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    lead = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80  # the first byte of each code point
    points = np.concatenate(([0], np.cumsum(lead)))
    return [
        {"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in zip(run[0::2], run[1::2], strict=True)
    ]


def _scanner(items: list[tuple[str, str]], size: int, spark, key: str):
    shared = spark.sparkContext.broadcast(items)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = worker_cache()
        if cache.get("automaton", ("",))[0] != key:
            cache["automaton"] = (key, build_automaton(shared.value, size))
        for texts in parts:
            rows = [scan(t, shared.value, cache["automaton"][1]) for t in texts]
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return F.pandas_udf(run, RESULT).asNondeterministic()  # so a later filter does not run it twice


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shard_bytes: int = 2_000_000,
    out: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, items, spans.

    Words are runs of 0-9, a-z (A-Z in lower case) and non-ASCII letters.  The
    automaton holds every run of ``window`` consecutive words of an item, or
    the whole of a shorter item, as a sequence of word numbers; each text is
    scanned once.  ``items`` are the ids (as strings, sorted) whose windows
    occur, ``spans`` the maximal hit runs in code points of the original text.

    Only benchmark text is sent to the tasks, in shards: items are dealt by
    hash so that a shard holds about ``shard_bytes`` of text (one larger item
    is a shard's bound), and several shards scan the documents one after the
    other over a staged copy, their results merged per row.

    Null text, empty text and text without words: zeros and empty arrays.  A
    null item text has no windows; a null id reads ``null``; items that repeat
    an id count once.  Any other columns stay as they are (``out`` must be a
    free name).
    """
    spark = docs.sparkSession
    rows = benchmark.select(
        F.coalesce(col(item_id).cast("string"), F.lit("null")).alias("i"), col(item_text).alias("t")
    ).where("t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    names = []
    for s in range(shards):
        items = [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == s).collect()]
        udf = _scanner(items, window, spark, f"{spark.sparkContext.applicationId}-{id(items)}-{s}-{total}-{window}")
        name = out if shards == 1 else fresh(docs, f"_scan{s}")
        docs = docs.withColumn(name, udf(col(text)))
        names.append(name)
        if s < shards - 1:
            docs = stage_table(docs, "scanned")
    if shards == 1:
        return docs
    merge = F.pandas_udf(_merge, RESULT).asNondeterministic()
    return docs.withColumn(out, merge(F.array(*map(col, names)), col(text))).drop(*names)


def _merge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for found, texts in parts:
        rows = []
        for shards, text in zip(found, texts, strict=True):
            spans: list[list[int]] = []
            for a, b in sorted((x["start"], x["end"]) for s in shards for x in s["spans"]):
                if spans and not _has_word(text[spans[-1][1] : a]):
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            hit = sum(len(words_of(text[a:b])) for a, b in spans)
            items = sorted({i for s in shards for i in s["items"]})
            rows.append((shards[0]["n_words"], hit, items, [{"start": a, "end": b} for a, b in spans]))
        yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])


def _has_word(between: str) -> bool:
    return bool(words_of(between))

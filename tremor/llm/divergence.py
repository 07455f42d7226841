"""Source divergence audit: how the words of a language's sources differ.

Terms are counted by length-bucketed packing.  A task reads the bytes of many
texts at once and finds all terms in numpy.  A term of up to 8 bytes becomes
one 64-bit word, one of up to 16 bytes two (big-endian, zeros behind; a term
holds no zero byte).  The packed terms of a buffer are put in order by radix
passes over 16-bit digits, and equal ones are runs, counted by their borders.
Longer terms go to buckets of equal length, sorted as bytes.  What leaves the
task is one row per group, term and buffer; Spark adds them up.

The measure.  A term's count in a group gives its smoothed share p, scaled to
whole numbers, and two shares give f = floor((p - q)^2 / q), a chi-squared
term.  Everything is integer arithmetic: products above 64 bits are decimals.

All pairs of sources are compared over all kept terms without a row for terms
that a source lacks: with p0 and q0 the shares of a count of zero,

    sum of f(p, q) over all terms = V * f(p0, q0)
        + sum over the terms of the first  of f(p, q0) - f(p0, q0)
        + sum over the terms of the second of f(p0, q) - f(p0, q0)
        + sum over the terms of both       of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The second and third line need only how many terms a source has per count.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import col, drop_staged, stage_table

# Fixed value: shares are whole numbers of this part.
SCALE = 1_000_000_000
# Bytes of text that are packed and sorted at once.
BUFFER = 4 << 20


def _term_bytes() -> np.ndarray:
    """0 for a byte that ends a term, else the byte, A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    upper, lower = (table >= 0x41) & (table <= 0x5A), (table >= 0x61) & (table <= 0x7A)
    table[upper] += 0x20
    table[~(upper | lower | (np.arange(256) >= 0x80))] = 0
    return table


def find_terms(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as terms have them (0 between terms), and each term's first byte and length."""
    folded = _term_bytes()[raw]
    inside = np.concatenate(([False], folded != 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return folded, edge[0::2], edge[1::2] - edge[0::2]


def radix_order(digits: list[np.ndarray]) -> np.ndarray:
    """The stable order by 16-bit digits, the least significant first."""
    order = np.arange(len(digits[0]))
    for digit in digits:
        if digit[0] != digit[-1] or (digit != digit[0]).any():  # a digit that all share tells nothing
            order = order[np.argsort(digit[order], kind="stable")]  # a radix sort for 16 bits
    return order


def digits_of(words: np.ndarray) -> list[np.ndarray]:
    return [((words >> np.uint64(s)) & np.uint64(0xFFFF)).astype(np.uint16) for s in (0, 16, 32, 48)]


def pack(folded: np.ndarray, start: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms of at most ``8 * words`` bytes as that many 64-bit words each."""
    place = np.arange(8 * words)
    padded = np.concatenate((folded, np.zeros(8 * words, np.uint8)))
    matrix = padded[start[:, None] + place]
    matrix[place >= length[:, None]] = 0
    packed = matrix.view(">u8").astype(np.uint64)
    return [packed[:, k] for k in range(words)]


class Bucket:
    """Entries of one kind of term: keys, group, document, count; in order of documents.

    ``words`` is 1 or 2 for packed terms, 0 for terms as byte strings of one length.
    """

    def __init__(self, words: int, keys: list[np.ndarray], group: np.ndarray, doc: np.ndarray, count: np.ndarray):
        self.words, self.keys, self.group, self.doc, self.count = words, keys, group, doc, count

    def _order(self) -> np.ndarray:
        group = [(self.group & 0xFFFF).astype(np.uint16), (self.group >> 16).astype(np.uint16)]
        if self.words:
            return radix_order([d for key in self.keys[::-1] for d in digits_of(key)] + group)
        order = np.argsort(self.keys[0], kind="stable")
        return order[radix_order([d[order] for d in group])]

    def runs(self, by_doc: bool) -> tuple["Bucket", np.ndarray]:
        """One entry per group and term (and document, ``by_doc``), and in how many documents it is."""
        order = self._order()
        keys, group, doc, count = [k[order] for k in self.keys], self.group[order], self.doc[order], self.count[order]
        new = group[1:] != group[:-1]
        for key in keys:
            new = new | (key[1:] != key[:-1])
        new = np.concatenate(([True], new))
        new_doc = new | np.concatenate(([True], doc[1:] != doc[:-1]))
        first = np.flatnonzero(new_doc if by_doc else new)
        out = Bucket(self.words, [k[first] for k in keys], group[first], doc[first], np.add.reduceat(count, first))
        return out, np.add.reduceat(new_doc.astype(np.int64), first)

    def terms(self) -> pa.Array:
        """The keys as strings."""
        if self.words:
            matrix = np.stack(self.keys, axis=1).astype(">u8").view(np.uint8)
        else:
            matrix = self.keys[0].view(np.uint8).reshape(len(self.keys[0]), -1)
        filled = matrix != 0
        offsets = np.concatenate(([0], np.cumsum(filled.sum(axis=1)))).astype(np.int32)
        return pa.StringArray.from_buffers(len(matrix), pa.py_buffer(offsets), pa.py_buffer(matrix[filled].tobytes()))


def join_buckets(parts: list[Bucket]) -> Bucket:
    if len(parts) == 1:
        return parts[0]
    keys = [np.concatenate(k) for k in zip(*(p.keys for p in parts), strict=True)]
    return Bucket(parts[0].words, keys, *(np.concatenate([getattr(p, name) for p in parts]) for name in ("group", "doc", "count")))


def buckets_of(raw: np.ndarray, doc_start: np.ndarray, doc: np.ndarray, group: np.ndarray) -> dict[int, Bucket]:
    """The terms of texts that lie one behind the other, a byte that ends a term between them.

    Keys are 8 and 16 for packed terms, the length for longer ones.
    """
    folded, start, length = find_terms(raw)
    own = np.searchsorted(doc_start, start, side="right") - 1
    out = {}
    kind = np.where(length <= 8, 8, np.where(length <= 16, 16, length))
    for k in np.unique(kind).tolist():
        at = np.flatnonzero(kind == k)
        if k <= 16:
            keys = pack(folded, start[at], length[at], k // 8)
        else:
            keys = [np.array([folded[a : a + k].tobytes() for a in start[at].tolist()], dtype=f"S{k}")]
        out[k] = Bucket(k // 8 if k <= 16 else 0, keys, group[own[at]], doc[own[at]], np.ones(len(at), np.int64))
    return out


def long_text(raw: np.ndarray, doc: int, group: int, buffer: int) -> dict[int, Bucket]:
    """One entry per term of a text that is longer than a buffer: pieces of it are counted, then added."""
    found: dict[int, Bucket] = {}
    table, a = _term_bytes(), 0
    while a < len(raw):
        b = min(a + buffer, len(raw))
        while b < len(raw) and table[raw[b - 1]]:  # a piece ends behind a byte that ends a term
            stops = np.flatnonzero(table[raw[b : b + buffer]] == 0)
            b = b + int(stops[0]) + 1 if len(stops) else min(b + buffer, len(raw))
        for k, bucket in buckets_of(raw[a:b], np.zeros(1, np.int64), np.array([doc]), np.array([group])).items():
            found[k] = join_buckets([found[k], bucket] if k in found else [bucket]).runs(by_doc=True)[0]
        a = b
    return found


class Counter:
    """Counts of terms by group in one task, a buffer of whole texts at a time."""

    def __init__(self, buffer: int):
        self.buffer = buffer
        self.reset()

    def reset(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.texts: list[bytes] = []
        self.owner: list[int] = []
        self.long: list[dict[int, Bucket]] = []
        self.size, self.docs = 0, 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        group = self.groups.setdefault((lang, source), len(self.groups))
        if len(text) > self.buffer:
            self.long.append(long_text(np.frombuffer(text, np.uint8), -1 - len(self.long), group, self.buffer))
            self.size += sum(b.count.size * 24 for b in self.long[-1].values())
        else:
            self.texts.append(text)
            self.owner.append(group)
            self.size += len(text) + 1
        self.docs += 1

    def full(self) -> bool:
        return self.size >= self.buffer or self.docs >= 100_000

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``lang, source, term, count, docs`` of what was added, and a row without a term for each group."""
        if not self.groups:
            return
        langs, sources = (pa.array(list(x), pa.string()) for x in zip(*self.groups, strict=True))
        none = pa.array([None] * len(langs), pa.string())
        zero = pa.array(np.zeros(len(langs), np.int64))
        yield pa.RecordBatch.from_arrays([langs, sources, none, zero, zero], NAMES)
        parts: dict[int, list[Bucket]] = {}
        if self.texts:
            sizes = np.array([len(t) + 1 for t in self.texts])
            raw = np.frombuffer(b"\0".join([*self.texts, b""]), np.uint8)
            found = buckets_of(raw, np.cumsum(sizes) - sizes, np.arange(len(sizes)), np.array(self.owner))
            parts = {k: [b] for k, b in found.items()}
        for text in self.long:
            for k, bucket in text.items():
                parts.setdefault(k, []).append(bucket)
        for k in sorted(parts):
            found, docs = join_buckets(parts.pop(k)).runs(by_doc=False)
            at = pa.array(found.group)
            yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), found.terms(), pa.array(found.count), pa.array(docs)], NAMES)


NAMES = ["lang", "source", "term", "count", "docs"]


def _count(buffer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(buffer)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                counter.add(lang, source, text.as_py())
                if counter.full():
                    yield from counter.rows()
                    counter.reset()
        yield from counter.rows()

    return run


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", buffer: int = BUFFER) -> DataFrame:
    """``lang, source, term, count, docs``: how often a term occurs in a group, and in how many of its rows.

    A term is a longest run of ASCII letters and characters beyond ASCII, A-Z in
    lower case.  Every group that has a row has a row with a null term, count
    zero and its number of rows as ``docs`` zero.  Null columns count as ''.
    """
    rows = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = rows.mapInArrow(_count(buffer), "lang string, source string, term string, count long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + kept))`` as a long, exact; null if there is nothing to divide by."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1)
    whole = F.call_function("div", above, F.nullif(wide(total + kept), F.lit(0).cast("decimal(19,0)")))
    return whole.cast("long") + 1


def excess(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; shares are at most SCALE + 1, so the square fits into a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3, ranks: int = 200, buffer: int = BUFFER
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from its language's others, and by which terms.

    A language keeps the V terms that are in at least ``least_docs`` of its
    rows.  With N the kept occurrences, a share is 1 + floor(10^9 (count + 1) /
    (N + V)).  Part ``pair``: one row per other source of the language, its
    share q, the value f = floor((p - q)^2 / q) added up over all kept terms (0
    if there are none).  Part ``term``: the terms of the source with a share p
    above the language's q, value f, ranks up to ``ranks``.  Ranks go by falling
    value, then by the item's bytes.

    Null text, lang and source count as '', which is a name like any other.
    Rows are documents, repeated ones too.  A group without terms is compared
    like the others; a language of one source has no pairs.  An empty table
    gives no rows.  A text longer than ``buffer`` bytes is counted in pieces that
    end between terms; a single term may be longer than that.
    """
    counts = stage_table(term_counts(docs, text, lang, source, buffer), "term-counts")
    whole = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("count").alias("everywhere"), F.sum("docs").alias("docs"))
    often = stage_table(whole.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    # Staged sides let Spark split the rows of a term that very many sources have.
    kept = stage_table(counts.where("term is not null").join(often, ["lang", "term"]).select("lang", "source", "term", "count", "everywhere"), "kept-counts")
    langs = often.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("everywhere").alias("total_everywhere"))
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("own"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, ["lang"], "left")
    zero = F.lit(0).cast("long")
    groups = stage_table(groups.na.fill(0, ["total", "own", "kept", "total_everywhere"]).withColumn("p0", share(zero, F.col("total"), F.col("kept"))), "groups")
    drop_staged(counts)

    facts = groups.select("lang", "source", "total", "kept", "total_everywhere", "p0")
    shares = kept.join(facts, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("total"), F.col("kept")))
    shares = stage_table(shares.withColumn("q", share(F.col("everywhere"), F.col("total_everywhere"), F.col("kept"))).select("lang", "source", "term", "p", "p0", "q"), "shares")
    drop_staged(kept, often)
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
    terms = _ranked(above).where(F.col("rank") <= ranks)
    return _ranked(_pairs(groups, shares)).unionByName(terms)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang, source, part, item, value`` of every ordered pair of sources of a language."""
    own = ["lang", "source"]
    of = lambda side, names: [F.col(n).alias(n if n == "lang" else f"{side}_{n}") for n in names]
    # How many terms of a source have a share; few, as most counts are small.
    levels = stage_table(shares.groupBy(*own, "p").agg(F.count(F.lit(1)).alias("n")), "levels")
    facts = groups.select(*own, "p0", "kept")
    a, b = facts.select(*of("a", facts.columns)), facts.select(*of("b", facts.columns))
    pairs = a.join(b, "lang").where("a_source <> b_source")
    base = pairs.select("lang", "a_source", "b_source", F.when(F.col("a_kept") > 0, F.col("a_kept") * excess(F.col("a_p0"), F.col("b_p0"))).otherwise(0).alias("value"))
    a_levels, b_levels = (levels.select(*of(side, levels.columns)) for side in "ab")
    empty = excess(F.col("a_p0"), F.col("b_p0"))
    first = a_levels.join(pairs, ["lang", "a_source"]).select("lang", "a_source", "b_source", (F.col("a_n") * (excess(F.col("a_p"), F.col("b_p0")) - empty)).alias("value"))
    second = b_levels.join(pairs, ["lang", "b_source"]).select("lang", "a_source", "b_source", (F.col("b_n") * (excess(F.col("a_p0"), F.col("b_p")) - empty)).alias("value"))
    a_terms, b_terms = (shares.select(*of(side, [*own, "p", "p0"]), "term") for side in "ab")
    p, q, p0, q0 = (F.col(c) for c in ("a_p", "b_p", "a_p0", "b_p0"))
    both = a_terms.join(b_terms, ["lang", "term"]).where("a_source <> b_source")
    both = both.select("lang", "a_source", "b_source", (excess(p, q) - excess(p, q0) - excess(p0, q) + excess(p0, q0)).alias("value"))
    parts = [x.groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value")) for x in (first, second, both)]
    added = base
    for part in parts:
        added = added.unionByName(part)
    out = added.groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value"))
    return out.select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), "value")

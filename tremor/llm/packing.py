"""Best-fit packing of token pieces by a grouping genetic algorithm on islands."""

import random
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, stage_table, worker_cache

PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


class WordEncoder:
    """Token ids of whole texts by a tokenizer that never joins across white space.

    The vocabulary's pre-tokenizer drops white space, so a text's ids are those
    of its white-space-free chunks in order.  Chunks repeat: their ids are kept
    (as bytes, at most ``keep`` of them, then the cache starts again), and only
    new chunks go through the tokenizer's own normaliser, pre-tokenizer and
    model.  A new chunk that is a word of Latin-1 letters, with or without marks
    after it, needs neither of the first two: its parts are known.  Texts in which that does not hold (separators that Python splits on
    and the tokenizer does not, or strings of special tokens) are encoded whole.
    """

    MARKS = ".,;:!?"

    def __init__(self, path: str, keep: int = 300_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.keep, self.chunks, self.words = keep, {}, {}
        self.normalize, self.tokenize = self.whole.normalizer.normalize_str, self.whole.model.tokenize
        self.parts = self.whole.pre_tokenizer.pre_tokenize_str
        # The byte-level form of the letters, as the pre-tokenizer gives it.
        self.letters = {i: self.parts(chr(i))[0][0] for i in range(0x80, 0x100) if chr(i).isalpha()}

    def _words(self, chunk: str) -> list[str]:
        word = chunk.rstrip(self.MARKS)
        if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
            low = word.lower()
            low = low if low.isascii() else low.translate(self.letters)
            return [low] if len(word) == len(chunk) else [low, chunk[len(word) :]]
        return [w for w, _ in self.parts(chunk.lower() if chunk.isascii() else self.normalize(chunk))]

    def _chunk(self, chunk: str) -> bytes:
        out = b""
        for word in self._words(chunk):
            ids = self.words.get(word)
            if ids is None:
                tokens = self.tokenize(word)
                self.words[word] = ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            out += ids
        self.chunks[chunk] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as unsigned little-endian 32-bit integers."""
        if not text:
            return b""
        if any(c in text for c in "\x1c\x1d\x1e\x1f") or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.chunks) > self.keep:
            self.chunks.clear()
        if len(self.words) > self.keep:
            self.words.clear()
        get, new = self.chunks.get, self._chunk  # no chunk has no ids
        return b"".join([get(c) or new(c) for c in text.split()])


def _cutter(path: str, capacity: int):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = worker_cache()
        key = ("word-encoder", path)
        if key not in cache:
            cache[key] = WordEncoder(path)
        encoder = cache[key]
        for texts in parts:
            yield pd.Series([cut(encoder.encode(t) + b"\0\0\0\0", capacity) for t in texts])

    return F.pandas_udf(run, PIECES).asNondeterministic()


def cut(ids: bytes, capacity: int) -> list[dict]:
    """Pieces of at most ``capacity`` tokens of one document's ids (the end id included)."""
    n = len(ids) // 4
    return [
        {"piece": k, "start": s, "length": min(capacity, n - s), "ids_crc32": zlib.crc32(ids[4 * s : 4 * (s + capacity)])}
        for k, s in enumerate(range(0, n, capacity))
    ]


def tokenize_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: one row per piece of each row's text.

    Every document ends with id 0, so null and empty texts are one piece of one
    token.  Texts are encoded whole; only longer ones than ``capacity`` are cut.
    """
    cutter = _cutter(path, capacity)
    return (
        docs.select(col(doc_id).alias("doc_id"), cutter(col(text)).alias("_p"))
        .select("doc_id", F.explode("_p").alias("_p"))
        .select("doc_id", "_p.*")
    )


class Packing:
    """Bins as lists of item numbers; best fit finds the fullest bin that still holds an item."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0  # bit r is set if some bin has room r

    def open(self, items: list[int]) -> None:
        self.bins.append(items)
        self.room.append(self.capacity - sum(self.sizes[i] for i in items))
        self._list(len(self.bins) - 1)

    def _list(self, b: int) -> None:
        r = self.room[b]
        if r:
            self.by_room.setdefault(r, []).append(b)
            self.rooms |= 1 << r

    def best_fit(self, items: list[int]) -> None:
        for i in items:
            size = self.sizes[i]
            fits = self.rooms >> size
            if not fits:
                self.open([i])
                continue
            r = size + (fits & -fits).bit_length() - 1
            b = self.by_room[r].pop()
            if not self.by_room[r]:
                self.rooms &= ~(1 << r)
            self.bins[b].append(i)
            self.room[b] = r - size
            self._list(b)

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; of as many, the packing whose free room lies in fewer bins."""
        return len(self.bins), -sum(r * r for r in self.room)


def crossover(sizes: list[int], capacity: int, giver: Packing, taker: Packing, rng: random.Random) -> Packing:
    """Whole well-filled bins of ``giver`` go in; ``taker``'s bins that share an item
    with them go out; the documents displaced are best-fitted, largest first."""
    order = sorted(range(len(giver.bins)), key=lambda b: (giver.room[b], rng.random()))
    given = order[: max(1, int(len(order) * rng.uniform(0.3, 0.9)))]
    child, inside = Packing(sizes, capacity), set()
    for b in given:
        child.open(list(giver.bins[b]))
        inside.update(giver.bins[b])
    displaced = []
    for items, room in zip(taker.bins, taker.room, strict=True):
        if inside.isdisjoint(items):
            if room <= capacity // 64:
                child.open(list(items))
            else:  # a badly filled bin is broken up too, as a mutation
                displaced += items
        else:
            displaced += [i for i in items if i not in inside]
    child.best_fit(sorted(displaced, key=lambda i: (-sizes[i], rng.random())))
    return child


def evolve(sizes: list[int], capacity: int, population: int, generations: int, seed: int) -> Packing:
    """The best packing of an island; it stops early at the bound ceil(tokens / capacity)."""
    rng, bound = random.Random(seed), -(-sum(sizes) // capacity)
    herd = []
    for k in range(population):
        one, spread = Packing(sizes, capacity), k * capacity / (4 * population)
        one.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i] + rng.uniform(0, spread)))
        herd.append(one)
        if one.fitness()[0] <= bound:
            return one
    for _ in range(generations):
        herd.sort(key=Packing.fitness)
        if herd[0].fitness()[0] <= bound:
            break
        a, b = rng.sample(herd[: max(2, population // 2)], 2)
        herd[-1] = crossover(sizes, capacity, a, b, rng)
        herd[-2] = crossover(sizes, capacity, b, a, rng)
    return min(herd, key=Packing.fitness)


PACKED = "doc_id {0}, piece int, start long, length long, ids_crc32 long, _uid long, _island long, _bin long, _fill long, _at long"


def _island(capacity: int, population: int, generations: int, columns: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_uid", ignore_index=True)
        sizes = rows["length"].astype(int).tolist()
        best = evolve(sizes, capacity, population, generations, int(rows["_island"].iloc[0]))
        n = len(sizes)
        number, fill, at = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b, items in enumerate(best.bins):
            place = 0
            for i in items:
                number[i], at[i], place = b, place, place + sizes[i]
            for i in items:
                fill[i] = place
        return rows.assign(_bin=number, _fill=fill, _at=at)[columns]

    return run


def pack(
    pieces: DataFrame,
    capacity: int = 2048,
    island: int = 4000,
    epochs: int = 3,
    population: int = 6,
    generations: int = 12,
    elite_room: int = 2,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: few sequences of at most ``capacity`` tokens.

    Pieces of exactly ``capacity`` tokens are sequences of their own.  The
    others are dealt by hash to islands of about ``island`` pieces, and each
    island evolves a population of packings (see ``crossover``).  Elite bins,
    with at most ``elite_room`` tokens free, are settled; the documents of the
    others migrate, dealt anew to fewer islands, for ``epochs`` rounds in all.
    An island is a bounded group whatever the input; every piece is placed
    once, and a run repeated on the same staged pieces gives the same packing.

    ``pieces``: (doc_id, piece, start, length, ids_crc32), with
    ``1 <= length <= capacity``.  Repeated rows and null ids are pieces like any
    other; no pieces give no rows.
    """
    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = PACKED.format(kind)
    columns = [f.split(" ")[0] for f in schema.split(", ")]
    base = stage_table(pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    whole = base.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_uid") * 8).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    done, rest = [whole], base.where(F.col("length") < capacity)
    left = rest.count()
    for epoch in range(epochs):
        if not left:
            break
        islands = max(1, -(-left // island))
        dealt = rest.withColumn("_island", F.pmod(F.xxhash64("_uid", F.lit(epoch)), F.lit(islands)))
        run = _island(capacity, population, generations, columns)
        packed = stage_table(dealt.groupBy("_island").applyInPandas(run, schema), "packed")
        settled = F.lit(True) if epoch == epochs - 1 else F.col("_fill") >= capacity - elite_room
        ids = (F.col("_island") * (1 << 24) + F.col("_bin")) * 8 + epoch + 1
        done.append(
            packed.where(settled).select(
                "doc_id", "piece", "start", "length", "ids_crc32", ids.alias("sequence_id"), F.col("_at").alias("offset")
            )
        )
        rest = packed.where(~settled).drop("_island", "_bin", "_fill", "_at")
        left = rest.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, **options) -> DataFrame:
    """Tokenise whole texts and pack them; see ``tokenize_pieces`` and ``pack``."""
    return pack(tokenize_pieces(docs, path, doc_id, text, capacity), capacity, **options)

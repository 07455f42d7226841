"""Language identification: nearest TF-IDF centroid, several centroids per language."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col

# Fixed value: ASCII letters keep their place, other ASCII bytes part words.
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
RESULT = "lang string, score double, rejected boolean"


@dataclass
class Centroids:
    """A fitted classifier: idf weights, unit centroids (rows), their languages and reject limits."""

    idf: np.ndarray
    centroid: np.ndarray
    lang: list
    least: np.ndarray


def trigrams(text: str, bits: int) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased words, a space before and after each."""
    raw = b" " + b" ".join(text.lower().encode().translate(LETTERS).split()) + b" "
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:] if len(b) > 2 else np.zeros(0, np.uint32)
    return (code * np.uint32(2654435761)) >> np.uint32(32 - bits)


def counts(texts: list[str], bits: int) -> np.ndarray:
    return np.stack([np.bincount(trigrams(t, bits), minlength=1 << bits) for t in texts]).astype(np.float32)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors; a text without trigrams is zero."""
    x = counts(texts, int(math.log2(len(idf)))) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _document_counts(bits: int, chunk: int = 256):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(1 << bits, dtype=np.int64)
        for part in parts:
            texts = [t for t in part["text"] if t]
            n += len(texts)
            for i in range(0, len(texts), chunk):
                df += (counts(texts[i : i + chunk], bits) > 0).sum(axis=0)
        yield pd.DataFrame({"n": [n], "df": [df]})

    return run


def _cluster(idf: np.ndarray, clusters: int, rounds: int, quantile: float, slack: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_order", "text"], ignore_index=True)
        x = np.concatenate([vectors(list(rows["text"][i : i + 256]), idf) for i in range(0, len(rows), 256)])
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        c = _centres(x, clusters, rounds)
        cosine, near = np.max(x @ c.T, axis=1), np.argmax(x @ c.T, axis=1)
        least = [slack * float(np.quantile(cosine[near == k], quantile)) if (near == k).any() else 0.0 for k in range(len(c))]
        return pd.DataFrame({"lang": [rows["lang"][0]] * len(c), "centroid": list(c.astype(np.float64)), "least": least})

    return run


def _centres(x: np.ndarray, clusters: int, rounds: int) -> np.ndarray:
    """Spherical k-means of unit vectors: the largest cluster is split until there are ``clusters``.

    A cluster holds a twentieth of the vectors at least: those of a few odd
    texts would attract other languages' odd texts.  There are fewer only where
    the vectors are too few or all the same.
    """
    least = max(1, math.ceil(0.05 * len(x)))
    label, n = np.zeros(len(x), dtype=np.int64), 1
    while n < clusters:
        for k in np.argsort(-np.bincount(label), kind="stable"):
            at = np.flatnonzero(label == k)
            half = _far_half(x[at]) if len(at) >= 2 * least else None
            if half is not None:
                label[at[half]] = n
                break
        else:
            break
        n += 1
        for _ in range(rounds):
            near = np.argmax(x @ _means(x, label, n).T, axis=1)
            if np.bincount(near, minlength=n).min() < least or (near == label).all():
                break
            label = near
    return _means(x, label, n)


def _means(x: np.ndarray, label: np.ndarray, n: int) -> np.ndarray:
    return _unit(np.stack([x[label == k].mean(axis=0) for k in range(n)]))


def _far_half(x: np.ndarray) -> np.ndarray | None:
    """The half of the vectors that lies farther along their main direction; none if all are the same."""
    mean = x.mean(axis=0)
    axis = x[np.argmin(x @ mean)] - mean
    if np.linalg.norm(axis) < 1e-3:
        return None
    for _ in range(30):  # power iteration, without a copy of the sample
        along = x @ axis - mean @ axis
        axis = _unit((along @ x - along.sum() * mean)[None])[0]
    along = x @ axis
    return np.argsort(along, kind="stable")[len(x) // 2 :]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(
    train: DataFrame,
    text: str = "text",
    lang: str = "lang",
    bits: int = 12,
    sample_per_lang: int = 800,
    clusters: int = 4,
    rounds: int = 8,
    quantile: float = 0.01,
    slack: float = 0.25,
) -> Centroids:
    """Learn from rows of ``train`` with a text and a language.

    Document frequencies are counted over all of them (one vector of
    ``2^bits`` counts leaves each task).  The centroids of a language are the
    spherical k-means clusters of at most ``sample_per_lang`` of its texts,
    those of the smallest hash.  A centroid rejects texts whose cosine lies
    below ``slack`` times the ``quantile`` of its own sample's cosines.
    What reaches the driver is bounded by the languages and ``2^bits`` alone.
    """
    rows = train.select(col(text).alias("text"), col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    size = 1 << bits
    seen = rows.select("text").mapInPandas(_document_counts(bits), "n long, df array<long>")
    df = seen.select("n", F.posexplode("df").alias("slot", "df")).groupBy("slot").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    found = {r["slot"]: (r["df"], r["n"]) for r in df.collect()}  # 2^bits rows
    n = max([x[1] for x in found.values()], default=0)
    idf = np.array([math.log((1 + n) / (1 + found.get(s, (0, 0))[0])) + 1 for s in range(size)], dtype=np.float32)
    order = F.xxhash64("text", "lang")
    share = rows.groupBy("lang").agg((F.lit(2.0 * sample_per_lang) / F.count(F.lit(1))).alias("share"))
    unit = F.pmod(order, F.lit(1 << 40)) / float(1 << 40)
    picked = rows.withColumn("_order", order).join(F.broadcast(share) if _few(share) else share, "lang").where(unit < F.col("share"))
    ranked = picked.withColumn("_rank", F.row_number().over(_by_lang())).where(F.col("_rank") <= sample_per_lang)
    run = _cluster(idf, clusters, rounds, quantile, slack)
    model = ranked.groupBy("lang").applyInPandas(run, "lang string, centroid array<double>, least double").orderBy("lang").collect()
    return Centroids(
        idf,
        np.array([r["centroid"] for r in model], dtype=np.float32).reshape(-1, size),
        [r["lang"] for r in model],
        np.array([r["least"] for r in model]),
    )


def _few(share: DataFrame) -> bool:
    """At most 10,000 languages (a label and a number each): small enough to broadcast."""
    return share.limit(10_001).count() <= 10_000


def _by_lang():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy("_order", "text")


def predict_column(model: Centroids, text: Column, chunk: int = 256) -> Column:
    """Struct (lang, score, rejected) of the nearest centroid by cosine.

    ``und`` with score 0, rejected: null texts, texts without a letter, and all
    texts if nothing was learned.  ``rejected`` is also true where the cosine
    is below the nearest centroid's limit; ``lang`` is still the nearest.
    """
    classes = [str(x) for x in model.lang]

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            known = [i for i, t in enumerate(texts) if classes and has_letter(t)]
            values = texts.tolist()
            for i in range(0, len(known), chunk):
                at = known[i : i + chunk]
                cosine = vectors([values[j] for j in at], model.idf).astype(np.float64) @ model.centroid.T.astype(np.float64)
                best = np.argmax(cosine, axis=1)
                top = cosine[np.arange(len(at)), best]
                for j, b, s in zip(at, best, top, strict=True):
                    lang[j], score[j], rejected[j] = classes[b], min(1.0, max(0.0, s)), s < model.least[b]
            yield pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})

    return F.pandas_udf(run, RESULT).asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))

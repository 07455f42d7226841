"""SimHash and embedding components against brute force."""

import numpy as np
import pytest
import xxhash

from tests.llm.cases import frame, rows_of, texts
from tremor.llm import graph, simhash, vectors

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text, shingle):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        root[find(a)] = find(b)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(low.get(find(i), x), x)
    return [low.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("shingle", [1, 4])
def test_fingerprints(shingle):
    for _, text in texts():
        assert simhash.fingerprint(text, shingle) == slow_fingerprint(text, shingle)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("ab cd é f",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest("ab cd é f".encode(), 42)


def brute_simhash(rows):
    prints = [slow_fingerprint(t, 4) for _, t in rows]
    ids = [i for i, _ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    return sorted(zip(ids, (f"{p:016x}" for p in prints), components(ids, pairs)), key=repr)


def test_simhash_components(spark):
    assert rows_of(simhash.simhash_components(frame(spark)), "doc_id", "fingerprint", "component_id") == brute_simhash(texts())


def test_simhash_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id")
    assert got == brute_simhash([(r.doc_id, r.text) for r in docs.collect()])


def test_keep_one_of_each(spark):
    docs = frame(spark)
    got = simhash.keep_one_of_each(docs)
    assert got.columns == docs.columns
    want = {c for _, _, c in brute_simhash(texts())}
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_links_connect_what_all_pairs_connect(spark):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 40, dtype=np.uint64)
    values = {0, 2**64 - 1}
    for c in centres.tolist():
        for _ in range(int(rng.integers(1, 60))):
            x = c
            for b in rng.integers(0, 64, int(rng.integers(0, 6))).tolist():
                x ^= 1 << b
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    for block in (4096, 8):
        links = [(r.a, r.b) for r in simhash.fingerprint_links(prints, 4, block).collect()]
        at = {v: i for i, v in enumerate(signed)}
        assert all((values[at[a]] ^ values[at[b]]).bit_count() <= 4 for a, b in links)
        pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
        numbers = list(range(len(values)))
        assert components(numbers, [(at[a], at[b]) for a, b in links]) == components(numbers, pairs)


def test_manhattan_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.integers(0, 2**63, 5000, dtype=np.uint64)
    b[:2500] = a[:2500] ^ (np.uint64(1) << rng.integers(0, 63, 2500).astype(np.uint64))
    counts = lambda x: np.stack([np.bitwise_count(x >> np.uint64(2 * s) & np.uint64(3)).astype(int) for s in range(32)])
    manhattan = np.abs(counts(a) - counts(b)).sum(axis=0)
    assert (np.bitwise_count(simhash._codes(a) ^ simhash._codes(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_connected_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 2000 + i) for i in range(200)]
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    want = dict(zip(nodes, components(nodes, [(at[a], at[b]) for a, b in edges])))
    frame_ = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    assert {r.node: r.root for r in graph.connected_components(frame_).collect()} == want
    assert graph.connected_components(frame_.where("false")).count() == 0


# ---- embeddings --------------------------------------------------------------


def brute_vectors(rows, least=0.9):
    good = [k for k, (_, v) in enumerate(rows) if vectors.usable(v)]
    pairs = []
    for i in good:
        for j in good:
            if j < i and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    pairs.append((i, j))
    links = np.zeros(len(rows), dtype=int)
    for i, j in pairs:
        links[[i, j]] += 1
    return pairs, links, components([r[0] for r in rows], pairs)


def test_embedding_components(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(1 + 4 * c):
            rows.append((len(rows), (centre + 0.12 * rng.normal(size=16)).astype(np.float32).tolist()))
    rows += [(900, rows[5][1]), (901, rows[5][1]), (901, rows[5][1]), (902, None), (903, []), (904, [0.0] * 16), (905, [float("nan")] * 16)]
    rows += [(906, [1.0, None] + [0.0] * 14), (907, [1.0, 2.0, 3.0]), (908, [2.0, 4.0, 6.0]), (909, [5.0]), (None, rows[9][1]), (910, [float("inf")] * 16), (None, None)]
    frame_ = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    _, links, comp = brute_vectors(rows)
    want = sorted(((r[0], int(n), r[0] if not vectors.usable(r[1]) else c) for r, n, c in zip(rows, links, comp)), key=repr)
    for block in (2048, 8):
        got = vectors.embedding_components(frame_, pivots=16, nearest=6, block=block)
        assert rows_of(got, "vec_id", "n_links", "component_id") == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert vectors.embedding_components(frame_.where("false")).count() == 0


def test_embedding_recall(spark):
    from tremor.llm.queries import op8_embedding_near_dedup

    sf = SF.replace("0.01", "0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r for r in op8_embedding_near_dedup(spark, sf).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= n for (i, _), n in zip(rows, links))
    assert sum(r.n_links for r in got.values()) >= 0.9 * links.sum()
    # Random directions at exactly the threshold are the hardest pairs.
    rng = np.random.default_rng(4)
    a = rng.normal(size=(300, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    u = rng.normal(size=a.shape)
    u -= (u * a).sum(1, keepdims=True) * a
    b = 0.901 * a + np.sqrt(1 - 0.901**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    hard = [(i, x.tolist()) for i, x in enumerate(np.concatenate([a, b]))]
    found = vectors.embedding_components(spark.createDataFrame(hard, "vec_id long, embedding array<double>"))
    assert sum(r.n_links for r in found.collect()) >= 0.9 * 2 * len(a)


@pytest.mark.parametrize("chain", [30, 3000])
def test_embedding_chains_in_one_long_list(spark, chain):
    n, step = 3000, 2 * np.pi / 4000
    places = np.arange(n) + np.arange(n) // chain  # one place is free between chains
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(places * step)]
    np.random.default_rng(4).shuffle(rows)
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = vectors.embedding_components(frame_, least=float(np.cos(1.5 * step)), pivots=2, block=4096)
    want = sorted((i, int(i % chain > 0) + int(i % chain < chain - 1), i - i % chain, i % chain == 0) for i in range(n))
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)

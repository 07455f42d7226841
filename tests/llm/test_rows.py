"""Row-wise operators and packing: decontamination, secrets, tokens, languages, packing."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import frame, prose, rows_of, texts
from tremor.llm import decontam, langid, packing, secretscan, tokens

SF = "/root/testdata/sf0.01"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")

# ---- decontamination ---------------------------------------------------------


def slow_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute_leaks(rows, items, size):
    windows = defaultdict(set)
    for item, text in items:
        words = slow_words(text)
        if words:
            for i in range(max(1, len(words) - size + 1)):
                windows[tuple(words[i : i + size])].add("null" if item is None else str(item))
    out = []
    for doc, text in rows:
        words, hit, who = slow_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if (found := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    who |= found
        out.append((doc, len(words), len(hit), tuple(sorted(who))))
    return sorted(out, key=repr)


ITEMS = [(1, prose(2, 300)[100:400]), (2, "One, TWO three"), (3, None), (4, ""), (None, prose(1, 120)), (1, "one two three"), (30, "three"), (31, "É wa1 ##"), (32, "w" * 5000)]


@pytest.mark.parametrize("shard", [2_000_000, 1000])
def test_leaks_against_brute_force(spark, shard):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark)
    found = decontam.decontaminate(docs, items, window=10, shard_bytes=shard, out="found")
    assert found.columns == [*docs.columns, "found"]
    got = [(r.doc_id, r.found["n_words"], r.found["n_hit"], tuple(r.found["items"])) for r in found.collect()]
    assert sorted(got, key=repr) == brute_leaks(texts(), ITEMS, 10)
    for r in found.collect():
        inside = sum(len(slow_words(r.text[s.start : s.end])) for s in r.found.spans)
        assert inside == r.found.n_hit and all(slow_words(r.text[s.start : s.start + 1]) for s in r.found.spans)


def test_leaks_on_documents_and_no_items(spark):
    from tremor.llm.queries import op6_decontamination

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in want]
    got = rows_of(op6_decontamination(spark, SF), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(want, key=repr) and any(r[-1] for r in got)
    clean = decontam.decontaminate(frame(spark), items.where("false"))
    assert {r.contamination.n_hit for r in clean.collect()} == {0}
    assert decontam.decontaminate(frame(spark).where("false"), items).count() == 0


# ---- secrets -----------------------------------------------------------------


def brute_base(text):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def secret_rows():
    rng = random.Random(9)
    token = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    hexa, b64 = "0123456789abcdef", secretscan.ALPHABETS["base64"]
    rows = [(i, f"é {prose(i, 20)} {token(40, b64)} and {'abc123' * 6} end") for i in range(60)]
    rows += [(70, f"PassWord = '{token(9, hexa)}' paſſword=abcdefgh1 Key"), (71, "token:short"), (72, f"AKIA{token(16, 'ABC123')} AKIAX"), (73, token(64, hexa))]
    return rows + [(74, "api_key=" + token(40, hexa)), (75, None), (76, ""), (None, "secret: abcdefghij"), (76, "")]


def test_base_secrets_and_spans(spark):
    rows = secret_rows() + texts()
    got = secretscan.scan_secrets(frame(spark, rows)).select(
        "doc_id", "n_assign", "n_access", "n_hex", secretscan.as_text(F.col("base")).alias("b"), secretscan.as_text(F.col("spans")).alias("s")
    )
    want = []
    for doc, text in rows:
        base = brute_base(text or "")
        kinds = [b.split(":")[0] for b in base]
        want.append((doc, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), ",".join(base)))
    out = got.collect()
    assert sorted(((*r[:4], r.b) for r in out), key=repr) == sorted(want, key=repr)
    added = 0
    for r in out:
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))
        added += r.s.count("random:")
    assert added >= 55  # the random tokens
    everything = [r.s for r in out if r.doc_id is not None and r.doc_id < 60]
    assert sum(s.count("random:") for s in everything) <= 1.1 * 60  # and hardly any repeated pattern


def test_secrets_on_no_rows(spark):
    assert secretscan.scan_secrets(frame(spark).where("false")).count() == 0


def test_p_values_of_random_tokens_are_near_uniform():
    rng = random.Random(3)
    for encoding in ("hex", "base64"):
        p = [secretscan.randomness("".join(rng.choice(secretscan.ALPHABETS[encoding]) for _ in range(64)), encoding) for _ in range(800)]
        assert 0.35 < np.median(p) < 0.75 and np.mean(np.array(p) < 0.05) < 0.12
    assert secretscan.randomness("abc123" * 8, "lower36") < 1e-3


def test_limits_keep_the_share_of_ordinary_tokens():
    flat = [("hex", 5, b, 100) for b in range(200)]
    peak = [("base64", 5, b, 10 + (5000 if b == 0 else 0)) for b in range(200)]
    out = secretscan.limits(pd.DataFrame(flat + peak, columns=["encoding", "class", "bin", "n"]), 0.05)
    assert dict(zip(out["encoding"], out["least"])) == {"hex": 0, "base64": 1}


def test_a_token_alone_in_its_class_takes_the_limit_of_a_pool():
    flat = [("hex", 5, b, 100) for b in range(200)]
    alone = [("hex", 6, 30, 1), ("base64", 5, 20, 1), ("lower36", 4, 0, 1)]
    least = lambda rows: {(e, c): b for e, c, b in secretscan.limits(pd.DataFrame(rows, columns=["encoding", "class", "bin", "n"]), 0.05).itertuples(index=False)}
    assert least(flat + alone) == {("hex", 5): 0, ("hex", 6): 1, ("base64", 5): 1, ("lower36", 4): 1}
    assert set(least(alone).values()) == {10}


def test_one_secret_in_each_class_is_found(spark):
    rng, rows = random.Random(12), []
    for encoding in ("hex", "HEX", "base32", "base62", "base64", "base64url"):
        for n in (24, 50, 100):
            p = 1.0
            while not 0.05 <= p < 0.5:  # lost before
                token = "".join(rng.choice(secretscan.ALPHABETS[encoding]) for _ in range(n))
                p = secretscan.randomness(token, encoding) if secretscan.encoding_of(token) == encoding else 1.0
            rows.append((len(rows), f"one {token} here"))
    rows.append((900, f"an {'abc123' * 6} id"))
    got = {r.doc_id: [s.kind for s in r.spans].count("random") for r in secretscan.scan_secrets(frame(spark, rows)).collect()}
    assert got == {i: int(i != 900) for i, _ in rows}


# ---- tokens ------------------------------------------------------------------


def test_token_counts_against_another_tokenizer(spark):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = texts()
    got = defaultdict(list)
    for r in tokens.token_counts(frame(spark, rows), BYTES, public_tokenizers.PATTERN).collect():
        got[r.doc_id].append((r.section, r.start, r.end, r.n_tokens, r.n_crossing))
    want = defaultdict(list)
    for doc, text in rows:
        if text is None:
            continue
        starts = [0, *(m.end() for m in re.finditer("\n", text))]
        starts = [s for s in starts if s < len(text)] or [0]
        edge = [*starts, len(text)]
        inner = {s: 0 for s in starts}
        cross = dict(inner)
        for a, b in other.encode(text, add_special_tokens=False).offsets:
            home = max(s for s in starts if s <= a)
            inner[home] += 1
            cross[home] += b > next(e for e in edge if e > home)
        want[doc] += [(k, s, edge[k + 1], inner[s], cross[s]) for k, s in enumerate(starts)]
    for doc in want:
        if doc not in (15, 18):  # characters of several tokens: the other's offsets name the whole character
            assert sorted(got[doc]) == sorted(want[doc])
    assert tokens.token_counts(frame(spark).where("false"), BYTES, public_tokenizers.PATTERN).count() == 0


def test_every_token_is_counted_once():
    encoder = tokens.ByteTokens(BYTES, public_tokenizers.PATTERN)
    for _, text in texts():
        if text:
            parts = tokens.count_sections(text, encoder)
            assert sum(p["n_tokens"] for p in parts) == len(encoder.encoding.encode_ordinary(text))
            assert parts[0]["start"] == 0 and parts[-1]["end"] == len(text)
            assert all(a["end"] == b["start"] for a, b in zip(parts, parts[1:]))


# ---- languages ---------------------------------------------------------------


def test_language_accuracy_on_held_out_documents(spark):
    from tremor.llm.queries import op10_language_id

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    docs = frame(spark)
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    for r in docs.select("text", langid.predict_column(model, F.col("text")).alias("x")).collect():
        if langid.has_letter(r.text):
            assert r.x.lang in {"en", "fr"} and 0 <= r.x.score <= 1
        else:
            assert (r.x.lang, r.x.score, r.x.rejected) == ("und", 0.0, True)
    nothing = langid.fit(docs.where("false"))
    assert {r[0].lang for r in docs.select(langid.predict_column(nothing, F.col("text"))).collect()} == {"und"}


def test_every_language_keeps_several_centroids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    assert set(Counter(model.lang).values()) == {4}
    near = np.argmax(langid.vectors([r.text for r in docs.collect()], model.idf) @ model.centroid.T, axis=1)
    assert len(set(near)) == len(model.lang)  # and each is some text's nearest


def test_clusters_of_few_or_equal_vectors():
    x = langid._unit(np.random.default_rng(6).random((200, 16)).astype(np.float32))
    assert len(langid._centres(x, 4, 8)) == 4
    assert len(langid._centres(x[:3], 4, 8)) == 3
    assert len(langid._centres(np.repeat(x[:1], 50, axis=0), 4, 8)) == 1


# ---- packing -----------------------------------------------------------------


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_encoder_equals_the_tokenizer(whole):
    encoder = packing.WordEncoder(WORDS, keep=50)
    for _, text in texts():
        want = np.array(whole.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.encode(text) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aA'sS \n\t\x1c\x85\xa0 éÉΣςİßﬁ́​<|startoftext|>019!")), max_size=60))
def test_encoder_equals_the_tokenizer_on_any_text(text):
    from tokenizers import Tokenizer

    whole = test_encoder_equals_the_tokenizer_on_any_text.__dict__.setdefault("whole", Tokenizer.from_file(WORDS))
    encoder = test_encoder_equals_the_tokenizer_on_any_text.__dict__.setdefault("encoder", packing.WordEncoder(WORDS))
    assert encoder.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def check_packing(rows, want_pieces, capacity):
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want_pieces, key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(spark, whole):
    capacity = 64
    want = []
    for doc, text in texts():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            want.append((doc, k, s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    packed = packing.pack_documents(frame(spark), WORDS, capacity=capacity)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    n = check_packing(packed.collect(), want, capacity)
    assert n <= -(-sum(w[3] for w in want) // capacity) + 1
    assert packing.pack_documents(frame(spark).where("false"), WORDS).count() == 0


def test_many_islands(spark):
    rng = random.Random(5)
    pieces = [(i, 0, 0, min(2048, 1 + int(rng.expovariate(1 / 500))), i) for i in range(3000)]
    frame_ = spark.createDataFrame(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(7)
    n = check_packing(packing.pack(frame_, island=300).collect(), pieces, 2048)
    assert n <= 1.004 * -(-sum(p[3] for p in pieces) // 2048) + 1


def test_sizes_that_cannot_share_a_sequence(spark):
    pieces = [(i, 0, 0, 1025, i) for i in range(500)]
    frame_ = spark.createDataFrame(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")
    assert check_packing(packing.pack(frame_, island=100).collect(), pieces, 2048) == 500


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=80), st.integers(0, 5))
def test_crossover_keeps_every_document(sizes, seed):
    rng = random.Random(seed)
    herd = []
    for k in range(2):
        p = packing.Packing(sizes, 50)
        p.best_fit(rng.sample(range(len(sizes)), len(sizes)))
        herd.append(p)
    child = packing.crossover(sizes, 50, *herd, rng)
    assert sorted(i for b in child.bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) == 50 - r >= 0 for b, r in zip(child.bins, child.room))

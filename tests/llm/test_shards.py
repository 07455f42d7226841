"""Sharding, fill-in-middle and the divergence audit against brute force and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import frame, prose, rows_of, texts
from tremor.llm import divergence, infill, oracle, placement, queries
from tremor.plans.verify import duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_whole_table_equals_sql(spark, name):
    found = queries.QUERIES[name](spark, SF)
    cursor = duck(SF).execute(oracle.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == Counter(cursor.fetchall())


# ---- sharding ----------------------------------------------------------------


def slow_draw(key, name, weight):
    bits = int(hashlib.sha256(f"{key}:{name}".encode()).hexdigest()[:13], 16)
    return -math.log((bits + 0.5) / 2**52) / weight


def slow_shard(key, tree):
    """Each level: the child with the smallest draw; a node weighs what its shards weigh."""
    inside = list(tree.paths)
    for depth in range(3):
        names = defaultdict(list)
        for shard in inside:
            names["/".join(str(x) for x in (*tree.paths[shard], shard)[: depth + 1])].append(shard)
        best = min(names, key=lambda n: slow_draw(key, n, sum(tree.weights[s] for s in names[n])))
        inside = names[best]
    return inside[0]


def key_of(doc):
    return "" if doc is None else str(doc)


def test_shards_against_brute_force(spark):
    docs = frame(spark)
    tree = placement.even_tree(16, 4, 2)
    found = placement.place(docs, tree)
    assert found.columns == ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"]
    expected = Counter()
    for doc, text in texts():
        raw = (text or "").encode()
        expected[(doc, len(raw) + 1, zlib.crc32(raw), slow_shard(key_of(doc), tree), slow_shard(key_of(doc), tree.grown()))] += 1
    rows = found.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows) == expected
    for shard in {r.shard for r in rows}:
        mine = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in mine]
        assert order == sorted(order)


def shards(spark, tree, n=20_000):
    rows = spark.range(n).select(placement.shard_column(F.col("id").cast("string"), tree).alias("s")).collect()
    return np.array([r.s for r in rows])


def test_new_shard_takes_rows_only_into_itself(spark):
    tree = placement.even_tree(16, 4, 2)
    for _ in range(3):
        before, after = shards(spark, tree), shards(spark, tree.grown())
        moved = before != after
        assert set(after[moved]) == {max(tree.paths) + 1}
        share = 1 / (len(tree.paths) + 1)
        assert abs(moved.mean() - share) < 0.01
        tree = tree.grown()


def test_shares_follow_weights(spark):
    tree = placement.Tree({0: (0, 0), 1: (0, 0), 2: (0, 1), 3: (1, 0)}, {0: 1.0, 1: 2.0, 2: 3.0, 3: 4.0})
    counts = np.bincount(shards(spark, tree), minlength=4) / 20_000
    assert np.abs(counts - np.array([0.1, 0.2, 0.3, 0.4])).max() < 0.015
    even = np.bincount(shards(spark, placement.even_tree(16, 4, 2)), minlength=16)
    assert even.min() > 20_000 / 16 * 0.9 and even.max() < 20_000 / 16 * 1.1


def test_movement_stays_in_subtrees_whose_weight_changes(spark):
    tree = placement.even_tree(16, 4, 2)
    before, after = shards(spark, tree), shards(spark, tree.with_weight(5, 3.0))
    region = np.array([tree.paths[s][0] for s in range(16)])
    moved = before != after
    heavier = tree.paths[5][0]
    # Keys come into the region that grew heavier or move inside it; none leaves it, none moves between two others.
    assert moved.any() and set(region[after[moved]]) == {heavier}
    # Inside it they go to the heavier rack, inside that to the heavier shard.
    inside = moved & (region[before] == heavier)
    assert {tree.paths[s] for s in after[inside]} == {tree.paths[5]}
    assert set(after[inside & np.array([tree.paths[s] == tree.paths[5] for s in before])]) == {5}


def test_hot_id_and_ranges(spark):
    rows = [(7, "same")] * 400 + [(7, f"text {i}") for i in range(300)] + [(i, None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    found = placement.place(docs, placement.even_tree(4, 2, 2)).collect()
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    assert len(found) == 1000 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in found if r.doc_id == 7}) == 1


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert placement.place(docs, placement.even_tree(16, 4, 2)).count() == 0
    assert infill.infill(docs).count() == 0
    assert divergence.audit(docs).count() == 0


def test_trees_are_checked():
    with pytest.raises(ValueError):
        placement.Tree({}, {})
    with pytest.raises(ValueError):
        placement.Tree({0: (0, 0)}, {0: 0.0})


def test_write_shards(spark, tmp_dir):
    tree = placement.even_tree(4, 2, 2)
    docs = frame(spark)
    placement.write_shards(docs, tree, f"{tmp_dir}/out", files=2)
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert rows_of(back, "doc_id", "text") == rows_of(docs, "doc_id", "text")
    assert all(r.shard == slow_shard(key_of(r.doc_id), tree) for r in back.collect())
    with pytest.raises(ValueError):
        placement.write_shards(back, tree, f"{tmp_dir}/again")


# ---- fill-in-middle ----------------------------------------------------------


def slow_infill(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{key_of(doc)}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_infill_against_brute_force(spark):
    rows = texts() + [(200 + i, prose(i, 40) + "🙂" * i) for i in range(40)]
    rows += [(300, "a <M> b"), (301, "<P>"), (302, "<"), (303, "<S"), (304, "P>"), (305, "S><" * 50), (306, "é日本🙂" * 30)]
    docs = frame(spark, rows)
    found = infill.infill(docs, out="x")
    assert found.columns == [*docs.columns, "x"]
    back = found.withColumn("back", infill.restored_column(F.col("x.output"), F.col("x.form"))).collect()
    got = Counter((r.doc_id, r.text, *r.x) for r in back)
    assert got == Counter((doc, text, *slow_infill(doc, text)) for doc, text in rows)
    assert {r.x.form for r in back} == {"plain", "psm", "spm"}
    assert all(r.back == (r.text or "") for r in back)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("<>PSM aé日🙂\x00\n"), max_size=40), st.integers(-5, 2000))
def test_infill_round_trip(text, doc):
    marks = (b"<P>", b"<S>", b"<M>")
    n, form, prefix, middle, output = infill.transform(text.encode(), str(doc), "1", 100, 50, marks)
    assert infill.invert(output, form, marks).decode() == text
    assert (form == "plain") == (not text or any(m.decode() in text for m in marks))
    assert output.decode() and n == len(text) or not text


def test_infill_of_a_very_long_text():
    text = ("日本語 text 🙂\n" * 1_500_000).encode()
    marks = (b"<P>", b"<S>", b"<M>")
    for doc in ("1", "2", "3"):
        n, form, prefix, middle, output = infill.transform(text, doc, "1", 100, 50, marks)
        assert form != "plain" and len(output) == len(text) + 9
        assert infill.invert(output, form, marks) == text


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.data())
def test_rotation(raw, data):
    a, b, c = sorted(data.draw(st.lists(st.integers(0, len(raw)), min_size=3, max_size=3)))
    block = bytearray(raw)
    infill.rotate(block, a, b, c)
    assert bytes(block) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]
    infill.rotate(block, a, a + c - b, c)
    assert bytes(block) == raw


def test_infill_refuses_what_cannot_be_undone(spark):
    with pytest.raises(ValueError):
        infill.infill(frame(spark), out="TEXT")
    for bad in (("<P>", "<P>", "<M>"), ("ab", "ba", "x"), ("aa", "b", "c"), ("a", "b", "")):
        with pytest.raises(ValueError):
            infill.infill(frame(spark), out="x", sentinels=bad)


# ---- divergence --------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def slow_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_audit(rows, ranks=200):
    """rows: (lang, source, text).  Every pair of sources, every kept term."""
    count, docs, groups = defaultdict(Counter), Counter(), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = slow_terms(text)
        count[lang, source].update(words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang, sources in groups.items():
        kept = [w for (x, w), n in docs.items() if x == lang and n >= 3]

        def shares(c):
            total = sum(c[w] for w in kept)
            return {w: 1 + math.floor(Fraction(10**9 * (c[w] + 1), total + len(kept))) for w in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda a, b: math.floor(Fraction((a - b) ** 2, b))
        for s in sources:
            found = {"pair": [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in sources if o != s]}
            found["term"] = [(w, f(p[s][w], q[w])) for w in kept if count[lang, s][w] and p[s][w] > q[w]]
            for part, items in found.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, w, v, k) for k, (w, v) in enumerate(items, 1) if part == "pair" or k <= ranks]
    return sorted(out)


AUDIT = "lang string, source string, text string"


def audit_rows():
    rows = [(["en", "fr", None][i % 3], f"s{i % 4}", t) for i, (_, t) in enumerate(texts())]
    rng = random.Random(5)
    words = ["a", "B", "été", "Éa", "日本語", "x" * 8, "y" * 9, "Z" * 16, "z" * 17, "w" * 17, "q" * 200, "🙂", "straße", "a1b", "ÿÿÿÿ"]
    for i in range(60):
        rows.append((rng.choice(["en", "", None, "de"]), rng.choice(["s0", "s1", None, ""]), rng.choice(" ,\n\x00@[`{\x7f0").join(rng.choices(words, k=rng.randrange(30)))))
    return rows + [("xx", "only", "one two three"), ("xx", "other", None), ("yy", "alone", "a b c"), ("yy", "alone", "a b c"), ("yy", "alone", "a b c")]


@pytest.mark.parametrize("buffer", [1 << 22, 700, 3])
def test_audit_against_brute_force(spark, buffer):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, AUDIT).repartition(3)
    found = divergence.audit(docs, buffer=buffer)
    assert rows_of(found, *found.columns) == sorted(slow_audit(rows), key=repr)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_audit_ranks_and_other_columns(spark):
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], AUDIT + ", count int, term string, p int")
    found = divergence.audit(docs, ranks=4)
    assert rows_of(found, *found.columns) == sorted(slow_audit(rows, ranks=4), key=repr)


def test_ranked_terms_are_limited_before_the_shuffle(spark):
    docs = spark.createDataFrame(audit_rows(), AUDIT)
    plan = divergence.audit(docs)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_shares_beyond_64_bits(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**13, 7), (0, 0, 1), (5, 5, 0), (0, 0, 0)], "c long, n long, v long")
    got = [r.p for r in rows.select(divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()]
    assert got == [1 + 10**9 * (10**13 + 1) // (3 * 10**13 + 7), 1 + 10**9, 1 + 10**9 * 6 // 5, None]


def test_terms_of_a_very_long_text():
    rng = random.Random(3)
    words = [prose(i, 1).strip(" .,\n").lower() for i in range(500)] + ["k" * n for n in (8, 9, 16, 17, 5000)]
    text = " ".join(rng.choices(words, k=300_000)) + " " + "v" * 3_000_000
    counter = divergence.Counter(1 << 16)
    counter.add("en", "s", text.encode())
    counter.add("en", "s", b"k KKKKKKKK")
    got = {}
    for batch in counter.rows():
        for r in batch.to_pylist():
            if r["term"] is not None:
                assert r["term"] not in got
                got[r["term"]] = (r["count"], r["docs"])
    expected = Counter(slow_terms(text))
    more = Counter(["k", "kkkkkkkk"])
    assert got == {w: (expected[w] + more[w], (expected[w] > 0) + (more[w] > 0)) for w in {*expected, *more}}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200))
def test_radix_order(numbers):
    words = np.array(numbers, dtype=np.uint64)
    assert np.array_equal(divergence.radix_order(divergence.digits_of(words)), np.argsort(words, kind="stable"))

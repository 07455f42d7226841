"""Line dedup, repeated bytes and unit dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest

from tests.llm.cases import frame, rows_of, texts
from tremor.llm import lines, suffixes, units

SF = "/root/testdata/sf0.001"


def key(row):
    return (row[0] is not None, row[0] or 0, row[1])


# ---- repeated bytes ----------------------------------------------------------


def brute_bytes(rows, depth):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + depth] for r in raws for i in range(len(r) - depth + 1))
    out = []
    for (doc, _), raw in zip(rows, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - depth + 1):
            if seen[raw[i : i + depth]] > 1:
                gone[i : i + depth] = b"\1" * depth
        flags = [0, *gone]
        spans = sum(a == 0 and b == 1 for a, b in zip(flags, flags[1:]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeated_bytes_on_awkward_rows(spark):
    assert rows_of(suffixes.remove_repeats(frame(spark)), *COLUMNS) == brute_bytes(texts(), 400)


def test_repeated_bytes_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_bytes(rows, 400)
    assert rows_of(suffixes.remove_repeats(docs, with_text=False), *COLUMNS) == want
    assert sum(r[2] for r in want) > 0


def test_repeated_bytes_kept_text_and_spans(spark):
    for row in suffixes.remove_repeats(frame(spark)).collect():
        assert row.n_bytes - len(row.kept) == row.n_removed == sum(s.end - s.start for s in row.spans)
        assert hashlib.sha256(row.kept).hexdigest() == row.kept_sha256


@pytest.mark.parametrize("depth,gram", [(5, 2), (12, 3), (40, 10)])
def test_short_depths_and_periodic_texts(spark, depth, gram):
    rows = [(i, ("abc" * 30)[i : 40 + 3 * i] + "xyz"[: i % 4] * (i % 5) + "abcab" * (i % 7)) for i in range(40)]
    found = suffixes.repeated_windows(frame(spark, rows), "doc_id", "text", depth, gram, size=4)
    got = defaultdict(set)
    for r in found.collect():
        got[r.doc_id].update(range(r.start, r.start + r.windows))
    seen = Counter(t[i : i + depth] for _, t in rows for i in range(len(t) - depth + 1))
    for doc, t in rows:
        assert got[doc] == {i for i in range(len(t) - depth + 1) if seen[t[i : i + depth]] > 1}


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "POSITION_BITS", 10)
    assert rows_of(suffixes.remove_repeats(frame(spark)), *COLUMNS) == brute_bytes(texts(), 400)


def test_no_rows(spark):
    empty = frame(spark).where("false")
    assert suffixes.remove_repeats(empty).count() == 0
    assert units.dedup_units(empty).count() == 0
    assert lines.dedup_lines(empty).count() == 0


# ---- lines -------------------------------------------------------------------


def brute_lines(rows, least):
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seqs = {r: [(k, x) for k, x in enumerate((r[1] or "").split("\n")) if x.strip(" ")] if r[1] is not None else [] for r in docs}
    gone = {r: set() for r in docs}
    # The order among texts with one id is by hash: such ties are checked by counts alone.
    seen = set()
    for r in docs:
        seq = seqs[r]
        for i in range(len(seq) - least + 1):
            window = tuple(x for _, x in seq[i : i + least])
            if window in seen:
                gone[r].update(k for k, _ in seq[i : i + least])
            seen.add(window)
    return gone


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_lines_against_brute_force(spark, least):
    rows = [r for r in texts() if r[0] is not None]
    got = lines.dedup_lines(frame(spark, rows), min_lines=least)
    assert got.columns[:-1] == frame(spark, rows).columns
    want = brute_lines(rows, least)
    by_id = {r[0]: (r[1], gone) for r, gone in want.items()}
    for row in got.collect():
        text, gone = by_id[row.doc_id]
        assert set(row.line_dedup.deleted) == gone
        if text is None:
            assert row.text is None and row.line_dedup.n_lines == 0
        else:
            assert row.text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
            assert row.line_dedup.n_lines == len(text.split("\n"))
        assert row.line_dedup.n_deleted == len(gone)


def test_lines_null_ids_and_repeated_rows(spark):
    text = "first line\nsecond line\nthird"
    rows = [(None, text), (1, text), (1, text), (None, None), (2, None)]
    got = lines.dedup_lines(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.line_dedup.n_deleted) for r in got) == [(0, "", 0), (0, text, 0), (1, "", 3), (1, "", 3), (2, "", 0)]


def test_intervals_hold_the_repeated_prefixes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    repeats = lines.prefix_doubling(docs)
    seqs = {r.doc_id: [x for x in r.text.split("\n") if x.strip(" ")] for r in docs.collect()}
    places = {r.place: (r.doc_id, r.seq) for r in repeats.lines.collect()}
    found = repeats.intervals.collect()
    top = max(r.level for r in found)
    assert top >= 2
    for level in range(top + 1):
        n = 2**level
        groups = defaultdict(list)
        for doc, seq in seqs.items():
            for i in range(len(seq) - n + 1):
                groups[tuple(seq[i : i + n])].append((doc, i))
        want = {p: min(g) for g in groups.values() if len(g) > 1 for p in g}
        assert {(r.doc_id, r.seq): places[r.name] for r in found if r.level == level} == want


def test_lines_oracle(spark):
    import duckdb

    from tremor.llm.queries import ORACLE_SQL, op2_line_dedup

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op2_line_dedup"])
    names = [d[0] for d in want.description]
    got = op2_line_dedup(spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got, *names) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("least,level", [(1, 1), (2, 1), (5, 2)])
def test_lines_are_doubled_as_far_as_they_are_read(spark, monkeypatch, least, level):
    made, doubling = [], lines.prefix_doubling
    monkeypatch.setattr(lines, "prefix_doubling", lambda *a: made.append(doubling(*a)) or made[-1])
    monkeypatch.setattr(lines.Repeats, "drop", lambda self: None)  # the tables are read below
    rows = [(i, "\n".join(f"line {k}" for k in range(20))) for i in range(3)]
    got = lines.dedup_lines(frame(spark, rows), min_lines=least).collect()
    assert sorted((r.doc_id, r.line_dedup.n_runs, r.line_dedup.longest_run) for r in got) == [(0, 0, 0), (1, 1, 20), (2, 1, 20)]
    assert {r.level for r in made[0].intervals.collect()} == set(range(level + 1))


def brute_runs(rows, least):
    """Per document id the lengths of the deleted runs: neighbours that one window with an earlier copy covers."""
    width, seen, out = max(least, 2), set(), {}
    gone = brute_lines(rows, least)
    for doc, text in sorted(set(rows)):
        seq = [(k, x) for k, x in enumerate((text or "").split("\n")) if x.strip(" ")] if text is not None else []
        linked = set()
        for i in range(len(seq) - width + 1):
            window = tuple(x for _, x in seq[i : i + width])
            if window in seen:
                linked.update(range(i + 1, i + width))
            seen.add(window)
        runs = []
        for i, (k, _) in enumerate(seq):
            if k in gone[(doc, text)]:
                if i in linked:
                    runs[-1] += 1
                else:
                    runs.append(1)
        out[doc] = runs
    return out


@pytest.mark.parametrize("least", [1, 2, 3])
def test_runs_that_only_touch_are_counted_apart(spark, least):
    glued = [(1, "a a\nb b"), (2, "c c\nd d"), (3, "a a\nb b\nc c\nd d"), (4, "b b\n \nc c\nx"), (5, "x\nx\n\nx"), (6, "")]
    shared = [(10 + i, "\n".join(f"s{(i * 7 + k * (i % 4 + 1)) % 9}" for k in range(12))) for i in range(30)]
    got = lines.dedup_lines(frame(spark, glued + shared), min_lines=least).collect()
    want = brute_runs(glued + shared, least)
    assert {r.doc_id: (r.line_dedup.n_runs, r.line_dedup.longest_run) for r in got} == {d: (len(x), max(x, default=0)) for d, x in want.items()}
    if least < 3:
        assert want[3] == [2, 2]


def brute_copies(rows, least):
    """Per document id the copies: widest windows followed along their first copies, without those inside another."""
    docs = sorted(set(rows))
    seqs = {r[0]: [(k, x) for k, x in enumerate((r[1] or "").split("\n")) if x.strip(" ")] if r[1] is not None else [] for r in docs}
    widest, n = {}, least
    while n <= max(map(len, seqs.values())):
        first = {}
        for d, seq in seqs.items():
            for i in range(len(seq) - n + 1):
                q = first.setdefault(tuple(x for _, x in seq[i : i + n]), (d, i))
                if q != (d, i):
                    widest[(d, i)] = (n, q)
        n = 1 << n.bit_length()
    out = {}
    for d, seq in seqs.items():
        found = []
        for i in range(len(seq)):
            if (d, i) in widest:
                n, q = widest[(d, i)]
                if widest.get((d, i - 1)) == (n, (q[0], q[1] - 1)):
                    found[-1][1] = i + n
                else:
                    found.append([i, i + n])
        out[d] = [(seq[a][0], b - a) for k, (a, b) in enumerate(found) if all(e < b for _, e in found[:k])]
    return out


@pytest.mark.parametrize("least", [1, 2, 3])
def test_copies_come_from_all_levels(spark, least):
    text = [f"line {k}" for k in range(20)]
    rows = [(1, "\n".join(text)), (2, "new\n" + "\n \n".join(text[3:])), (3, "a\nb"), (4, "b\nc"), (5, "a\nb\nc\n" + "\n".join(text[:11])), (6, "x\n" * 9), (7, ""), (8, None)]
    rows += [(10 + i, "\n".join(f"s{(i * 7 + k * (i % 4 + 1)) % 9}" for k in range(12))) for i in range(30)]
    rows += [(50, "p"), (51, "q"), (52, "p\nq")]  # first copies at the end of one text and the start of the next
    got = lines.dedup_lines(frame(spark, rows), min_lines=least, copies=True).collect()
    copies = {r.doc_id: [(c.line, c.lines) for c in r.line_dedup.copies] for r in got}
    assert copies == brute_copies(rows, least)
    assert copies[2] == [(1, 17)] and copies[5][-1] == (3, 11)
    if least < 3:
        assert copies[5][:2] == [(0, 2), (1, 2)]  # one run of three lines, which no earlier place holds as a whole
    plain = lines.dedup_lines(frame(spark, rows), min_lines=least)
    assert sorted((r.doc_id, r.text, *r.line_dedup[:5]) for r in got if r.text) == sorted((r.doc_id, r.text, *r.line_dedup) for r in plain.collect() if r.text)


def test_query_doubles_until_nothing_repeats(spark, monkeypatch, tmp_dir):
    from tremor.llm.queries import op2_line_dedup

    made, doubling = [], lines.prefix_doubling
    monkeypatch.setattr(lines, "prefix_doubling", lambda *a, **k: made.append(doubling(*a, **k)) or made[-1])
    monkeypatch.setattr(lines.Repeats, "drop", lambda self: None)  # the tables are read below
    rows = [(i, "\n".join(f"line {k}" for k in range(20))) for i in range(3)]
    frame(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    got = op2_line_dedup(spark, str(tmp_dir)).collect()
    assert sorted((r.doc_id, r.n_deleted, r.n_runs, r.longest_run) for r in got) == [(0, 0, 0, 0), (1, 20, 1, 20), (2, 20, 1, 20)]
    assert {r.level for r in made[0].intervals.collect()} == {0, 1, 2, 3, 4}  # 16 lines are shared, 32 are not


@pytest.mark.parametrize("words", [1, 4, 1 << 18])
def test_texts_meet_their_lists_at_any_filter_size(spark, monkeypatch, words):
    from tremor.llm import common

    monkeypatch.setattr(common, "FILTER_WORDS", words)
    docs = frame(spark)
    lists = docs.where("doc_id % 3 = 0 or doc_id is null").dropDuplicates(["doc_id", "text"])
    lists = lists.select("doc_id", common.text_hash(common.col("text")).alias("th"), (lists.doc_id + 1).alias("_l"))
    got = common.join_listed(docs, common.stage_table(lists, "lists"), "doc_id", "text", "_l")
    assert got.columns == [*docs.columns, "_l"]
    want = [(r.doc_id, r.text, r.doc_id + 1 if r.doc_id is not None and r.doc_id % 3 == 0 else None) for r in docs.collect()]
    assert rows_of(got, "doc_id", "text", "_l") == sorted(want, key=repr)


def test_a_footer_stays_once(spark):
    rows = [(i, f"page {i}\nFOOT of every page") for i in range(4)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(spark, rows), min_lines=1).collect()}
    assert got == {i: f"page {i}" + ("\nFOOT of every page" if i == 0 else "") for i in range(4)}


# ---- units -------------------------------------------------------------------


def test_units_against_brute_force(spark):
    rows = [r for r in texts() if r[0] is not None]
    seen, want = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: r[0]):
        gone = []
        for a, b, unit in units.units_of(text, 6):
            if unit in seen:
                gone.append((a, b))
            seen.add(unit)
        want[doc] = gone
    for row in units.dedup_units(frame(spark, rows), min_words=6).collect():
        text = dict(rows)[row.doc_id] or ""
        assert [(s.start, s.end) for s in row.spans] == want[row.doc_id]
        kept = "".join(c for i, c in enumerate(text) if not any(a <= i < b for a, b in want[row.doc_id])) if len(text) < 50_000 else row.kept
        assert row.kept == kept and row.n_removed == len(text) - len(kept)
        assert row.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_unit_bounds():
    text = "One two three. Four five. Six\n\nsix seven? eight\n nine ten\neleven\nA b. C d! E f"
    assert [(text[a:b], u) for a, b, u in units.units_of(text, 3)] == [
        ("One two three.", "one two three"),
        ("Four five. Six", "four five six"),
        ("six seven? eight", "six seven eight"),
        ("nine ten", "nine ten"),
        ("A b. C d!", "a b c d"),
    ]
    assert units.units_of(None, 1) == [] and units.units_of("", 1) == []


def test_copied_lines_go_with_their_tails(spark, tmp_dir):
    from tremor.llm.queries import op9_substring_dedup

    first = "One two three four five six. Seven eight\n\nalone\n这是没有空格的一行\nnine ten"
    rows = [(1, first), (2, first), (3, "Another start of six words here. Seven eight\nALONE!"), (4, "one two three four five six seven, eight.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in op9_substring_dedup(spark, tmp_dir).collect()}
    kept = {1: first, 2: " \n\n\n\n", 3: "Another start of six words here. Seven eight\n", 4: ""}
    spans = {1: 0, 2: 5, 3: 1, 4: 1}
    assert got == {d: (len(t) - len(kept[d]), spans[d], hashlib.sha256(kept[d].encode()).hexdigest()) for d, t in rows}


def test_exact_copies_keep_no_word(spark):
    rows = [(i, t) for i, t in texts() if i in (1, 2, 11, 12, 16)]
    rows += [(i + 1000, t) for i, t in rows]
    seen = set()
    for row in units.dedup_units(frame(spark, rows), whole_lines=True).orderBy("doc_id").collect():
        text = dict(rows)[row.doc_id]
        assert text not in seen or row.doc_id < 1000 or not units.WORD.findall(row.kept)
        seen.add(text)

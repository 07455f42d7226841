"""The pipeline's stages, one by one and together, against brute force."""

from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm.cases import frame, texts
from tests.llm.test_copies import brute_simhash
from tests.llm.test_repeats import brute_lines
from tests.llm.test_rows import brute_leaks
from tremor.llm import langid

SF = "/root/testdata/sf0.001"
STAGE = dict(P.STAGES)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage_on_no_rows_and_awkward_rows(spark, name):
    docs = frame(spark)
    assert STAGE[name](spark, docs.where("false"), SF).count() == 0
    out = STAGE[name](spark, docs, SF)
    if name != P.STAGES[-1][0]:
        assert out.columns == docs.columns
    assert out.count() > 0


def test_language_stage_drops_what_has_no_letters(spark):
    kept = {r.doc_id for r in STAGE["language_id"](spark, frame(spark), SF).collect()}
    assert not kept & {6, 7, 8, 19}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert STAGE["language_id"](spark, docs, SF).count() >= 0.98 * docs.count()


def test_line_stage(spark):
    rows = [r for r in texts() if r[0] is not None]
    gone = {r[0]: (r[1], g) for r, g in brute_lines(rows, P.MIN_LINES).items()}
    want = set()
    for doc, (text, lines) in gone.items():
        left = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in lines)
        if not lines or left.strip(" "):
            want.add((doc, left, len(left) if lines else len(text or "")))
    got = STAGE["line_dedup"](spark, frame(spark, rows), SF)
    assert {(r.doc_id, r.text, r.n_chars) for r in got.collect()} == want


def test_whole_run(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet").where(~langid.held_out(P.F.col("doc_id"))))
    x = langid.vectors([t for _, t in docs], model.idf) @ model.centroid.T
    best = np.argmax(x, axis=1)
    docs = [d for d, b, c in zip(docs, best, x) if langid.has_letter(d[1]) and c[b] >= model.least[b]]
    left = []
    for (doc, text), lines in brute_lines(docs, P.MIN_LINES).items():
        now = "\n".join(y for k, y in enumerate(text.split("\n")) if k not in lines)
        if not lines or now.strip(" "):
            left.append((doc, now))
    keep = {c for _, _, c in brute_simhash(left)}
    left = [r for r in left if r[0] in keep]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, _, hit, _ in brute_leaks(left, items, 10) if not hit}
    got = P.run(spark, SF).collect()
    assert {r.doc_id for r in got} == clean
    fill = defaultdict(int)
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1

"""Secret scans: patterns, and a battery of randomness tests with false-discovery control.

Candidates are unbroken tokens of a code alphabet.  Each is tested for
randomness in its inferred encoding: a chi-squared test that its symbols are
uniform over the alphabet, a runs test and a serial-correlation test of their
order, combined (Fisher) to one p-value, which is uniform for random tokens and
near zero for ordinary ones.

What is reported are the tokens that look random, so a false discovery is an
ordinary token among them.  In each length class of an encoding, random tokens
put the same share into every p-value bin; the upper half's bins tell how many
random tokens there are, what lies above that in the bins from a limit on is
the estimate of ordinary ones.  The limit is the smallest one at which their
share is at most ``fdr``.  A class of few tokens takes the limit of its whole
encoding, or of all tokens where these are few, but not the first bin, where
ordinary tokens are; in a corpus of few tokens the limit is the p-value ``fdr``.
"""

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import col, stage_table

# The base patterns and the shortest value each accepts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run, leftmost, is the same with or without the lower bound
ASSIGN_VALUE, ACCESS_TOKEN = 8, 16
KINDS = ("assign", "access", "hex", "random")

# Alphabets of the encodings, narrowest first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "upper36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
BINS = 200
FEW = 100  # fewer tokens tell nothing of the share of random ones


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns' matches, in code points."""
    out = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_TOKEN]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text)]


def encoding_of(token: str) -> str | None:
    """The narrowest alphabet that holds the token; none for words and for numbers."""
    body = token.rstrip("=")
    if not any(c.isdigit() for c in body) or not any(c.isalpha() for c in body):
        return None
    symbols = set(body)
    return next((name for name, alphabet in ALPHABETS.items() if symbols <= set(alphabet)), None)


def _chi2_tail(x: float, k: int) -> float:
    """Upper tail of chi-squared with k degrees of freedom (Wilson-Hilferty)."""
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(token: str, encoding: str) -> float:
    """One p-value of the three tests; near zero where the token is not random."""
    alphabet = ALPHABETS[encoding]
    x = np.array([alphabet.index(c) for c in token.rstrip("=")], dtype=np.float64)
    n, size = len(x), len(alphabet)
    counts = np.bincount(x.astype(int), minlength=size)
    uniform = _chi2_tail(float(((counts - n / size) ** 2).sum() * size / n), size - 1)
    high = x >= size / 2
    a, b = int(high.sum()), int((~high).sum())
    if a and b:
        mean = 2 * a * b / n + 1
        spread = math.sqrt(max(1e-12, (mean - 1) * (mean - 2) / (n - 1)))
        runs = math.erfc(max(0.0, abs(1 + int((high[1:] != high[:-1]).sum()) - mean) - 0.5) / spread / math.sqrt(2))
    else:
        runs = 2.0 ** (1 - n)  # all in one half
    dev = x - x.mean()
    total = float((dev * dev).sum())
    serial = float((dev[1:] * dev[:-1]).sum()) / total if total else 1.0
    correlated = math.erfc(abs(serial + 1 / n) * math.sqrt(n) / math.sqrt(2))
    p = [max(1e-300, min(1.0, v)) for v in (uniform, runs, correlated)]
    half = -sum(map(math.log, p))  # Fisher: twice this is chi-squared with six degrees
    return math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    """Classes double in width: 20-31, 32-63, 64-127, ... symbols."""
    return max(4, n.bit_length() - 1)


SCAN = "n_assign long, n_access long, n_hex long, base array<struct<start:int,end:int,kind:string>>, tokens array<struct<start:int,end:int,encoding:string,class:int,p:double,bin:int>>"


def _scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    rank = {k: i for i, k in enumerate(KINDS)}
    for texts in parts:
        rows = []
        for text in texts:
            base = base_spans(text or "")
            tokens = []
            for m in CANDIDATE.finditer(text or ""):
                encoding = encoding_of(m[0])
                if encoding:
                    p = randomness(m[0], encoding)
                    size = length_class(len(m[0].rstrip("=")))
                    tokens.append({"start": m.start(), "end": m.end(), "encoding": encoding, "class": size, "p": p, "bin": min(BINS - 1, int(p * BINS))})
            kinds = [k for _, _, k in base]
            spans = [{"start": a, "end": b, "kind": k} for a, b, k in sorted(base, key=lambda s: (s[0], rank[s[2]]))]
            rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), spans, tokens))
        yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "tokens"])


def _limit(counts: np.ndarray, fdr: float) -> int:
    random_in_bin = counts[BINS // 2 :].sum() / (BINS - BINS // 2)
    above = counts[::-1].cumsum()[::-1]
    ordinary = np.maximum(0, above - random_in_bin * np.arange(BINS, 0, -1))
    fine = (above > 0) & (ordinary <= fdr * above)
    return int(np.argmax(fine)) if fine.any() else BINS


def limits(bins: pd.DataFrame, fdr: float) -> pd.DataFrame:
    """For each encoding and length class the first p-value bin that is reported (BINS: none)."""
    count = lambda part: np.bincount(part["bin"], weights=part["n"], minlength=BINS)
    out, every = [], count(bins)
    for encoding, of_encoding in bins.groupby("encoding"):
        for size, of_class in of_encoding.groupby("class"):
            own, pools = count(of_class), (count(of_encoding), every)
            if own.sum() >= FEW:
                least = _limit(own, fdr)
            else:
                counts = next((c for c in pools if c.sum() >= FEW), None)
                least = math.ceil(fdr * BINS) if counts is None else max(1, _limit(counts, fdr))
            out.append((encoding, size, least))
    return pd.DataFrame(out, columns=["encoding", "class", "least"])


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base, spans.

    ``base`` and ``spans`` are arrays of (start, end, kind) in code points, by
    start, then kind as in ``KINDS``; ``spans`` are the base spans and those of
    kind ``random`` that the tests add.  The tests' limits come from the bin
    counts of all tokens (at most 200 bins for each encoding and length class;
    only those counts reach the driver).

    Null text counts as empty and has no spans; null ids and repeated rows are
    rows like any other.
    """
    scan = F.pandas_udf(_scan, SCAN).asNondeterministic()
    found = stage_table(docs.select(col(doc_id).alias("doc_id"), scan(col(text)).alias("r")).select("doc_id", "r.*"), "secrets")
    tokens = found.select(F.explode("tokens").alias("t")).select("t.*")
    bins = tokens.groupBy("encoding", "class", "bin").agg(F.count(F.lit(1)).alias("n")).toPandas()
    least = {(e, int(c)): int(b) for e, c, b in limits(bins, fdr).itertuples(index=False)}
    key = lambda t: F.concat_ws("/", t["encoding"], t["class"].cast("string"))
    entries = [x for (e, c), b in sorted(least.items()) for x in (F.lit(f"{e}/{c}"), F.lit(b))]
    limit = F.create_map(*entries) if entries else F.lit(None).cast("map<string,int>")
    added = F.transform(
        F.filter("tokens", lambda t: t["bin"] >= F.element_at(limit, key(t))),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit("random").alias("kind")),
    )
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    ranked = F.transform(
        F.concat("base", added), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base", spans.alias("spans"))


def as_text(spans):
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")

"""Small tables with the awkward cases: nulls, empties, ties, repeated rows, clashing extra columns."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # Names the operators use themselves.
        StructField("fp", StringType()),
        StructField("component_id", StringType()),
        StructField("th", StringType()),
        StructField("start", LongType()),
        StructField("r", StringType()),
        StructField("_root", StringType()),
        StructField("line", LongType()),
    ]
)


def prose(seed, words, vocabulary=400, line=9):
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append("w%s%d" % (rng.choice(["a", "é", "ß", "Q"]), rng.randrange(vocabulary)))
        out.append("\n" if i % line == line - 1 else rng.choice([" ", " ", ". ", ", "]))
    return "".join(out)


def texts():
    """(doc_id, text) with copies, near copies, shared passages, odd and very long texts."""
    shared = prose(1, 120)
    base = prose(2, 300)
    rows = [
        (1, base),
        (2, base),
        (2, base),
        (3, base.replace("wa1", "wa2")),
        (4, prose(3, 90) + shared + prose(4, 80)),
        (5, prose(5, 30) + "\n" + shared + "\n" + prose(6, 200)),
        (6, None),
        (7, ""),
        (8, "   \t\n \x0b"),
        (9, "one"),
        (10, "One two three"),
        (None, base + " tail"),
        (None, None),
        (11, "a" * 1500),
        (12, "ab" * 700 + "c" * 500),
        (13, "same line here\n" * 40),
        (14, "same line here\nsame line here\n\nother line\n"),
        (15, "é" * 300 + "a" * 1500),
        (16, prose(7, 5000)),
        (17, prose(7, 5000)[3:] + "end"),
        (18, "zero\x00byte \x1c sep\x85 nbsp\xa0x " + shared[:500]),
        (19, "!!! ??? ### 123 456"),
        (-5, "one"),
    ]
    rows += [(100 + i, prose(50 + i % 7, 60 + i) + shared[: 40 * (i % 9)]) for i in range(40)]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(i, t, ["en", "fr", None][k % 3], f"s{k % 2}", 0 if t is None else len(t), "f", "c", "t", k, "r", "x", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

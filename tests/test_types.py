"""Date layouts, inferred types and distinct-count sketches against plain Python."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tremor.functions import dates
from tremor.operators import sketches
from tremor.sources import infer, sinks

SOURCED = "k int, Source string, Date string"


def read(spark, rows):
    df = spark.createDataFrame([(k, s, d) for k, (s, d) in enumerate(rows)], SOURCED).repartition(3)
    got = dates.parse_dates(df).withColumn("t", F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSS")).collect()
    return [r.t for r in sorted(got, key=lambda r: r.k)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("1998-03-05", "1998-03-05 00:00:00.000"),
        (" 1998-3-5 ", "1998-03-05 00:00:00.000"),
        ("1998-03-05T06:07", "1998-03-05 06:07:00.000"),
        ("1998-03-05 06:07:08.25", "1998-03-05 06:07:08.250"),
        ("1998-12-31T23:30:00Z", "1998-12-31 23:30:00.000"),
        ("1998-12-31T23:30:00-02:00", "1999-01-01 01:30:00.000"),
        ("1999-01-01T01:30:00+05:30", "1998-12-31 20:00:00.000"),
        ("1998/03/05", "1998-03-05 00:00:00.000"),
        ("1998.3.5", "1998-03-05 00:00:00.000"),
        ("19980305", "1998-03-05 00:00:00.000"),
        ("5 Mar 1998", "1998-03-05 00:00:00.000"),
        ("05-MAR-98", "1998-03-05 00:00:00.000"),
        ("5 march, 2068", "2068-03-05 00:00:00.000"),
        ("5 may 68", "2068-05-05 00:00:00.000"),
        ("5 may 69", "1969-05-05 00:00:00.000"),
        ("March 5, 1998", "1998-03-05 00:00:00.000"),
        ("Mar. 5 1998", "1998-03-05 00:00:00.000"),
        ("29/02/2000", "2000-02-29 00:00:00.000"),
        ("13.5.99", "1999-05-13 00:00:00.000"),
        ("29/02/1999", None),
        ("1999-02-29", None),
        ("1999/02/29", None),
        ("31 Apr 1998", None),
        ("00/01/1998", None),
        ("19981332", None),
        ("5/3-1998", None),
        ("5 Mars 1998", None),
        ("1998", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_layouts(text, want, layouts_read):
    assert layouts_read[text] == want


@pytest.fixture(scope="module")
def layouts_read(spark):
    texts = [p.args[0][0] if hasattr(p, "args") else p[0] for p in test_layouts.pytestmark[0].args[1]]
    return dict(zip(texts, read(spark, [(f"s{k}", t) for k, t in enumerate(texts)])))


def test_a_source_votes_for_its_order(spark):
    rows = [("us", "03/04/1998"), ("us", "12/31/1998"), ("us", "31/12/1998"), ("us", "12/30/1998")]
    rows += [("eu", "03/04/1998"), ("eu", "31/12/1998"), ("tie", "03/04/98"), (None, "12/31/1998"), (None, "1/2/1998"), ("us", "1998-05-06")]
    day = lambda m, d, y=1998: f"{y}-{m:02d}-{d:02d} 00:00:00.000"
    assert read(spark, rows) == [day(3, 4), day(12, 31), None, day(12, 30), day(4, 3), day(12, 31), day(4, 3), day(12, 31), day(1, 2), day(5, 6)]
    assert read(spark, []) == []


def test_every_day_is_read_in_every_layout(spark):
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=13 * k) for k in range(120)]
    layouts = ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%y", "%Y%m%d", "%d %b %Y", "%B %d, %Y", "%d %B %Y", "%Y/%m/%d"]
    rows = [(layout, d.strftime(layout)) for layout in layouts for d in days]
    assert read(spark, rows) == [f"{d} 00:00:00.000" for _ in layouts for d in days]


def text_frame(spark, columns):
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.createDataFrame(list(zip(*columns.values())), schema).repartition(4)


CASES = {
    "flag": (["true", "FALSE", None, " true "], "boolean"),
    "whole": (["1", "-2", "+3", "NA"], "bigint"),
    "wide": (["9223372036854775808", "1", "2", ""], "double"),
    "real": (["1", "2.5", ".5", "1e-3"], "double"),
    "not real": (["1", "2.5", "Infinity", "2d"], "string"),
    "day": (["1998-02-28", "2000-02-29", "n/a", None], "date"),
    "no day": (["1998-02-29", "2000-02-29", None, None], "string"),
    "instant": (["1998-02-28", "1998-02-28 10:00", "1998-02-28T10:00:00.5Z", None], "timestamp"),
    "mixed": (["1", "true", "1998-02-28", "x"], "string"),
    "nothing": ([None, "", "  ", "NaN"], "string"),
    "a.b`c": (["7", "8", "9", "10"], "bigint"),
}


def test_types_of_columns(spark):
    df = text_frame(spark, {k: v for k, (v, _) in CASES.items()}).withColumn("given", F.lit(1))
    found = infer.infer_schema(df)
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {**{k: t for k, (_, t) in CASES.items()}, "given": "int"}
    out = infer.apply_schema(df, found)
    assert out.schema.fieldNames() == df.columns
    assert sorted(r["whole"] for r in out.collect() if r["whole"] is not None) == [-2, 1, 3]
    assert {r["mixed"] for r in out.collect()} == {"1", "true", "1998-02-28", "x"}


def test_one_value_in_many_decides(spark):
    many = spark.range(200_000).select(F.when(F.col("id") == 199_999, "x").otherwise(F.col("id").cast("string")).alias("a"), F.col("id").cast("string").alias("b"))
    assert [f.dataType.simpleString() for f in infer.infer_schema(many).fields] == ["string", "bigint"]


def test_empty_and_typed_tables(spark):
    empty = text_frame(spark, {"a": [], "b": []})
    assert [f.dataType for f in infer.infer_schema(empty).fields] == [StringType(), StringType()]
    assert infer.apply_schema(empty, infer.infer_schema(empty)).count() == 0
    with pytest.raises(ValueError):
        infer.type_counts(spark.range(3))


def test_inferred_csv(spark, tmp_dir):
    sinks.export_csv(text_frame(spark, {"n": ["1", "2", None], "t": ["a, b", 'say "x"', "c"]}), f"{tmp_dir}/csv")
    got = infer.read_inferred_csv(spark, f"{tmp_dir}/csv")
    assert got.schema["n"].dataType == LongType()
    assert sorted((r.n or 0, r.t) for r in got.collect()) == [(0, "c"), (1, "a, b"), (2, 'say "x"')]


def test_sketches_of_a_range_are_within_the_bound(spark):
    rows = spark.range(60_000).select(
        (1990 + F.col("id") % 6).cast("int").alias("Year"), (F.col("id") % 40_000).alias("many"), (F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none")
    )
    rows = rows.unionByName(rows.limit(5).withColumn("Year", F.lit(None).cast("int")))
    stored = sketches.yearly_sketches(rows, ("many", "few", "none"))
    for lo, hi in [(1990, 1990), (1991, 1993), (1990, 1995), (1980, 2010)]:
        part = rows.where(F.col("Year").between(lo, hi))
        exact = part.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("many").alias("many"), F.count_distinct("few").alias("few")).first()
        got = sketches.distinct_in_range(stored, lo, hi).first()
        assert (got.Events, got.few, got.none) == (exact.n, exact.few, 0)
        assert abs(got.many - exact.many) <= 4 * sketches.standard_error() * exact.many
    assert tuple(sketches.distinct_in_range(stored, 1800, 1801).first()) == (0, 0, 0, 0)


def test_windows_equal_their_ranges(spark):
    rows = spark.range(9_000).select((2000 + F.col("id") % 5).cast("int").alias("Year"), F.col("id").alias("v")).where("Year <> 2002")
    stored = sketches.yearly_sketches(rows, ("v",)).cache()
    got = {r.First: (r.Events, r.v) for r in sketches.distinct_by_window(stored, 3).collect()}
    assert set(got) == {2000, 2001, 2003, 2004}
    for lo, figures in got.items():
        assert tuple(sketches.distinct_in_range(stored, lo, lo + 2).first()) == figures
    stored.unpersist()

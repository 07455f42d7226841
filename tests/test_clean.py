"""Cleaning rules on hand-written rows: nulls, NaN, dates, missing columns."""


import pytest

from tremor import schema
from tremor.operators import clean as C
from tremor.functions.parse import to_double, year_of

COLS = ["ID", "Date", "Latitude", "Longitude", "Depth", "Magnitude", "Type"]


def raw(spark, rows, extra=()):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLS + list(extra)))


def test_year_two_layouts_else_null(spark):
    df = spark.createDataFrame([("02/01/1996",), ("1996-01-02",), ("31/31/1999",), (None,), ("1/2/1965",), ("junk",)], "d string")
    got = [r[0] for r in df.select(year_of("d")).collect()]
    assert got == [1996, 1996, None, None, None, None]


def test_to_double_bad_and_nan_are_null(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), ("NaN",), (None,), ("-0.25",)], "x string")
    got = [r[0] for r in df.select(to_double("x")).collect()]
    assert got == [1.5, None, None, None, -0.25]


def test_strict_cast_fails_on_bad_input(spark):
    from tremor.functions.parse import to_double_strict

    df = spark.createDataFrame([("n/a",)], "x string")
    with pytest.raises(Exception):
        df.select(to_double_strict("x")).collect()


def test_clean_drops_any_null_and_keeps_schema(spark):
    rows = [
        ("a", "01/02/1999", "1.0", "2.0", "3.0", "6.0", "Earthquake"),
        ("b", "31/31/1999", "1.0", "2.0", "3.0", "6.0", "Earthquake"),
        ("c", "1999-02-01", "n/a", "2.0", "3.0", "6.0", "Earthquake"),
        ("d", "1999-02-01", "1.0", "2.0", "3.0", "NaN", "Earthquake"),
        ("e", "1999-02-01", "1.0", "2.0", "3.0", "6.5", None),
        ("f", "1999-02-01", "1.0", "2.0", "3.0", "6.5", "Explosion"),
    ]
    out = C.clean(raw(spark, rows))
    assert [f.name for f in out.schema.fields] == [f.name for f in schema.QUAKE.fields]
    assert sorted(r.ID for r in out.collect()) == ["a", "f"]


def test_drop_unused_ignores_absent_and_drops_present(spark):
    df = raw(spark, [("a", "01/02/1999", "1", "2", "3", "6", "T", "12:00:00", "reviewed")], extra=("Time", "Status"))
    assert C.drop_unused(df).columns == COLS
    assert C.drop_store_key(df).columns == df.columns


def test_clean_subset_only_listed(spark):
    df = spark.createDataFrame([(1.0, None), (None, "x"), (2.0, "y")], "Magnitude double, Type string")
    assert C.clean_subset(df, ["Magnitude"]).count() == 2


def test_harmonize_feed(spark):
    feed = spark.createDataFrame(
        [("01/02/1999", "1.5", "2.5", "6.1", "10", "x", "extra")], "time string, latitude string, longitude string, mag string, depth string, id string, other string"
    )
    out = C.harmonize_feed(feed)
    assert out.columns == ["Date", "Latitude", "Longitude", "Magnitude", "Depth"]
    assert out.first() == ("01/02/1999", 1.5, 2.5, 6.1, 10.0)


def test_missing_column_guard(spark):
    df = spark.createDataFrame([("x",)], "time string")
    with pytest.raises(C.MissingColumns):
        C.harmonize_feed(df)


def test_validate_and_split_points(spark):
    df = spark.createDataFrame([("1", "2", "3"), ("a", "2", "3"), ("1", None, "3")], "latitude string, longitude string, depth string")
    valid, rejected = C.split_points(df)
    assert valid.count() == 1 and rejected.count() == 2
    assert valid.first() == (1.0, 2.0, 3.0)


def test_clean_is_narrow(spark):
    """Cleaning never shuffles: no Exchange in the physical plan."""
    from tremor.sources import fixture
    from tests.conftest import SF_SMALL

    plan = C.clean(fixture.raw_catalog(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_display_helpers(spark):
    from tremor.functions import display

    df = spark.createDataFrame([(0.125, 4.0), (0.135, 6.0), (2.5, 1.234)], "x double, m double")
    got = df.select(display.round2("x"), display.fmt2("m"), display.marker_radius("m")).collect()
    assert [r[0] for r in got] == [0.12, 0.14, 2.5]
    assert [r[1] for r in got] == ["4.00", "6.00", "1.23"]
    assert [r[2] for r in got] == [8.0, 10.0, 2.468]

"""Statistics and dashboard operators: properties and edge cases."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tremor.operators import clean as C
from tremor.operators import stats, trends
from tremor.sources import fixture


@pytest.fixture(scope="module")
def raw(spark):
    return fixture.raw_catalog(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def cat(raw):
    return C.clean(raw).cache()


def rows(df):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_yearly_join_equals_yearly_stats(raw):
    assert rows(stats.yearly_join(raw)) == rows(stats.yearly_stats(raw))


def test_yearly_stats_one_shuffle(raw):
    plan = stats.yearly_stats(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_yearly_stats_counts_raw_rows(raw):
    total = raw.where(F.col("Date").isNotNull()).count()
    assert stats.yearly_stats(raw).agg(F.sum("Counts")).first()[0] <= total


def test_type_share_sums_to_100(cat):
    assert abs(stats.type_share(cat).agg(F.sum("Share")).first()[0] - 100.0) < 1e-9


def test_histogram_counts_sum_to_rows(cat):
    h = trends.magnitude_histogram(cat, 0.1)
    assert h.agg(F.sum("Count")).first()[0] == cat.count()


def test_histogram_edges(spark):
    df = spark.createDataFrame([(5.5,), (5.6,), (5.59999,), (9.0,)], "Magnitude double")
    got = {r.bin: r.Count for r in trends.magnitude_histogram(df, 0.1).collect()}
    assert got == {55: 2, 56: 1, 90: 1}


def test_kpi_empty_defaults(cat):
    out = stats.kpi(cat.where(F.lit(False))).first()
    assert tuple(out) == (0, 0, 0.0, 0.0, 0.0, 0)


def test_kpi_average_yearly(cat):
    k = stats.kpi(cat).first()
    assert k.average_yearly == pytest.approx(k.total_earthquakes / k.unique_years)


def test_top_quakes_ties_by_id(spark):
    df = spark.createDataFrame([("b", 7.0), ("a", 7.0), ("c", 6.0), ("d", 7.0)], "ID string, Magnitude double")
    assert [r.ID for r in trends.top_quakes(df, 2).collect()] == ["a", "b"]


def test_severity_extremes_first_on_ties(spark):
    df = spark.createDataFrame(
        [("b", "d1", 7.0, 1.0, 0.0, 0.0), ("a", "d2", 7.0, 1.0, 0.0, 0.0), ("d", "d3", 5.0, 1.0, 0.0, 0.0), ("c", "d4", 5.0, 1.0, 0.0, 0.0)],
        "ID string, Date string, Magnitude double, Depth double, Latitude double, Longitude double",
    )
    df = trends.top_quakes(df)
    ext = {r.role: r.ID for r in trends.severity_extremes(df).collect()}
    assert ext == {"most": "a", "least": "c"}
    assert trends.top_remaining(df).count() == 0


def test_default_range_is_first_six_years(cat):
    b = trends.year_bounds(cat).first()
    assert b.range_lo == b.min_year and b.range_hi == min(b.min_year + 5, b.max_year)
    r = trends.year_range(cat)
    assert r.agg(F.min("Year"), F.max("Year")).first() == (b.range_lo, b.range_hi)


def test_year_slice_default_is_latest(cat):
    latest = cat.agg(F.max("Year")).first()[0]
    assert trends.year_slice(cat).count() == cat.where(F.col("Year") == latest).count()


def test_trend_line_matches_polyfit(cat):
    import numpy as np

    pdf = cat.select("Longitude", "Magnitude").toPandas()
    slope, intercept = np.polyfit(pdf.Longitude, pdf.Magnitude, 1)
    t = trends.trend_line(cat).first()
    assert t.slope == pytest.approx(slope, rel=1e-9, abs=1e-12)
    assert t.intercept == pytest.approx(intercept, rel=1e-9)
    rm = trends.trend_rmse(cat).first().rmse
    assert rm == pytest.approx(float(np.sqrt(np.mean((pdf.Magnitude - (slope * pdf.Longitude + intercept)) ** 2))), rel=1e-9)


def test_trend_fitted_no_cross_join(cat):
    plan = trends.trend_fitted(cat)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_depth_scaled_range_and_constant(spark, cat):
    d = trends.depth_scaled(cat).agg(F.min("size"), F.max("size")).first()
    assert d[0] == pytest.approx(20.0) and d[1] == pytest.approx(200.0)
    flat = spark.createDataFrame([("a", 3.0, 6.0), ("b", 3.0, 7.0)], "ID string, Depth double, Magnitude double")
    assert {r.size for r in trends.depth_scaled(flat).collect()} == {20.0}


def test_correlation_depth_magnitude(cat):
    assert trends.correlations(cat).first().corr_depth > 0.9


def test_marker_table_roles(cat):
    top = trends.top_quakes(trends.year_range(cat))
    m = trends.marker_table(top)
    roles = Counter(r.role for r in m.collect())
    assert roles["most"] == 1 and roles["least"] == 1
    assert roles["other"] == trends.top_remaining(top).count()


def test_two_level_top_n_equals_plain(cat):
    plain = [tuple(r) for r in trends.top_quakes(cat, 50, buckets=0).collect()]
    two = [tuple(r) for r in trends.top_quakes(cat.repartition(16), 50, buckets=4).collect()]
    assert plain == two
    plan = trends.top_quakes(cat.repartition(16), 50, buckets=4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_severity_roles_need_a_bounded_list(spark):
    wide = spark.range(20_000).selectExpr("cast(id as string) as ID", "cast(id as double) as Magnitude")
    with pytest.raises(ValueError):
        trends.severity_extremes(wide)
    assert {r.role: r.ID for r in trends.severity_extremes(trends.top_quakes(wide)).collect()} == {"most": "19999", "least": "19950"}


def test_exact_mean_keeps_all_decimals(spark):
    df = spark.createDataFrame([(1.000049, 3.0, 5.5), (1.000049, 3.0, 5.5)], "Latitude double, Longitude double, Magnitude double")
    assert float(trends.top_centroid(df, exact_scale=12).first().avg_latitude) == 1.000049
    assert trends.top_centroid(df).first().avg_latitude == pytest.approx(1.000049, abs=1e-15)


@pytest.mark.parametrize(
    "values,width",
    [
        ([i / 10 for i in range(1000)], 10.0),  # 2 * 50 / 10
        ([5 + i / 100_000 for i in range(1000)], 0.001),
        ([7.0] * 30, 1.0),
        ([7.0] * 30 + [9.0], 0.2),  # equal quartiles: 2 / (1 + log2(31)) = 0.335
        ([3.0], 1.0),
        ([], 1.0),
    ],
)
def test_histogram_width_follows_the_data(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "Magnitude double")
    got = trends.fitted_width(df).first()["width"]
    assert got == pytest.approx(width)
    rows = trends.fitted_histogram(df).collect()
    assert sum(r.Count for r in rows) == len(values)
    assert all(r.bin_end - r.bin_start == pytest.approx(width) for r in rows)
    for r in rows:
        assert r.Count == sum(r.bin == int(round(v / width, 9) // 1) for v in values)

"""The named query catalogue: one builder per operator, over the test tables.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame.  Most are lazy;
the nearest-event, place-label, model and file round-trip builders run jobs
when called, and the first use of the curated store writes it.  Inputs come from ``sources.fixture`` (raw catalogue from ``orders``, points from
``nation``, gazetteer from ``supplier``), so every query's work grows with the
tables.  Derived doubles are rounded (6 places; 9 for slopes and
correlations) so that an independent engine can be compared value by value;
the operators themselves return exact values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from tremor import schema
from tremor.functions import dates, display
from tremor.operators import clean as C
from tremor.operators import clusters, geo, ml, sketches, stats, trends
from tremor.plans import store
from tremor.scratch import scratch_table
from tremor.session import shared_dir
from tremor.sources import catalog as read
from tremor.sources import documents, fixture, infer, sinks
from tremor.sources.sinks import preview as preview_rows


def rounded(df: DataFrame, places: int = 6, wide: tuple = (), wide_places: int = 9) -> DataFrame:
    """Round every double and decimal column (``wide`` ones to ``wide_places``).

    Doubles are rounded as ``round(x * 10^p) / 10^p``: an integer-scale
    rounding of one binary value, which every engine resolves the same way.
    Decimals (exact averages) are rounded half-up in decimal, then made double.
    """
    cols = []
    for f in df.schema.fields:
        p = wide_places if f.name in wide else places
        if isinstance(f.dataType, DoubleType):
            scale = float(10**p)
            cols.append((F.round(F.col(f.name) * F.lit(scale), 0) / F.lit(scale)).alias(f.name))
        elif isinstance(f.dataType, DecimalType):
            cols.append(F.round(F.col(f.name), p).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Decimals in which the comparable queries sum (see ``functions.agg.mean``): more
# than a coordinate or magnitude read from text carries, so nothing is rounded away.
EXACT = 12


# ---- shared inputs -----------------------------------------------------------


def raw(spark, d):
    return fixture.raw_catalog(spark, d)


def cleaned(spark, d):
    """Curated rows computed from the raw catalogue (the ETL's own output)."""
    return C.clean(raw(spark, d))


def curated(spark, d):
    """Curated rows as the dashboard reads them: from the store."""
    return store.curated_store(spark, d)


def base(spark, d):
    """Dashboard input.  The store was written by ``clean`` (typed, no nulls,
    NaN already removed), so typing and dropping rows again would change nothing
    and is not done: filters on plain columns then reach the scan."""
    return curated(spark, d)


def in_range(spark, d):
    return trends.year_range(base(spark, d), years=store.year_counts(spark, d))


def latest(spark, d):
    return trends.year_slice(curated(spark, d), years=store.year_counts(spark, d))


def top(spark, d):
    return trends.top_quakes(in_range(spark, d))


def quakes(spark, d):
    return curated(spark, d).where(F.col("Type") == "Earthquake")


def train_test(spark, d):
    # The test table is one file, so one split: dealt out, as any layout gives the same models.
    train = ml.model_frame(C.clean(fixture.raw_training(spark, d))).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    test = ml.model_frame(C.harmonize_feed(fixture.raw_feed(spark, d)))
    return train, test


# ---- cleaning ----------------------------------------------------------------


def q_scan_catalog(spark, d):
    return rounded(curated(spark, d))


def q_scan_type_filter(spark, d):
    return rounded(quakes(spark, d))


def q_project_catalog(spark, d):
    return C.project_catalog(raw(spark, d))


def q_catalog_columns(spark, d):
    return C.catalog_columns(raw(spark, d))


def q_harmonize_feed(spark, d):
    return rounded(C.harmonize_feed(fixture.raw_feed(spark, d, holdout=False)))


def q_parse_year(spark, d):
    from tremor.functions.parse import year_dmy, year_of

    return raw(spark, d).select("ID", "Date", year_dmy("Date").alias("Year_dmy"), year_of("Date").alias("Year"))


def q_coerce_numeric(spark, d):
    return rounded(C.coerce_numeric(raw(spark, d).select("ID", "Latitude", "Longitude", "Depth", "Magnitude")))


def q_clean_catalog(spark, d):
    return rounded(cleaned(spark, d))


def q_clean_subset(spark, d):
    return rounded(C.clean_subset(C.typed(raw(spark, d))))


def q_reject_points(spark, d):
    pts = raw(spark, d).select(
        "ID", F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"), F.col("Depth").alias("depth")
    )
    return rounded(C.validate_points(pts))


def q_preview(spark, d):
    return rounded(preview_rows(curated(spark, d), 5, ["ID"]))


def q_dates_any(spark, d):
    """Every network's own date layout, day and month in the order that its rows vote for."""
    out = dates.parse_dates(fixture.raw_any_dates(spark, d), source="Network", out="at")
    return out.select("ID", "Date", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("Instant"), F.year("at").alias("Year"))


def q_date_votes(spark, d):
    return dates.date_votes(fixture.raw_any_dates(spark, d), "Date", "Network")


def q_inferred_types(spark, d):
    return infer.type_counts(fixture.raw_loose(spark, d)).withColumnRenamed("column", "name")


def q_column_guard(spark, d):
    """What the guard says of the catalogue, of one without two of its columns, and of the feed; rows where it lets pass."""
    whole = raw(spark, d)
    inputs = {"catalogue": whole, "without two": whole.drop("Depth", "Type"), "feed": fixture.raw_feed(spark, d, holdout=False)}
    out = None
    for name, rows in inputs.items():
        missing = C.missing_columns(rows, schema.CATALOG_COLUMNS)
        try:
            passed = C.catalog_columns(rows).agg(F.count(F.lit(1)).alias("passed"))
        except C.MissingColumns:
            passed = rows.agg(F.lit(0).cast("long").alias("passed"))
        part = passed.select(F.lit(name).alias("input"), F.lit(",".join(missing)).alias("missing"), "passed")
        out = part if out is None else out.unionByName(part)
    return out


# ---- statistics --------------------------------------------------------------


def q_yearly_stats(spark, d):
    return rounded(stats.yearly_stats(raw(spark, d), EXACT))


def q_yearly_join(spark, d):
    return rounded(stats.yearly_join(raw(spark, d), EXACT))


def q_yearly_stats_clean(spark, d):
    return rounded(stats.yearly_stats_clean(cleaned(spark, d), EXACT))


def q_trend_stats(spark, d):
    return rounded(stats.trend_stats(base(spark, d), EXACT))


def q_yearly_counts(spark, d):
    return stats.yearly_counts(curated(spark, d))


def q_type_counts(spark, d):
    return stats.type_counts(base(spark, d))


def q_type_share(spark, d):
    return rounded(stats.type_share(base(spark, d)))


def q_kpi_home(spark, d):
    return rounded(stats.kpi(curated(spark, d), EXACT))


def q_kpi_year(spark, d):
    return rounded(stats.kpi_year(latest(spark, d), EXACT))


def q_kpi_empty(spark, d):
    before_first = store.year_counts(spark, d).agg(F.min("Year") - 1).scalar()
    return rounded(stats.kpi(trends.year_slice(curated(spark, d), before_first), EXACT))


def q_kpi_text(spark, d):
    return stats.kpi_text(stats.kpi(curated(spark, d)))


def q_distinct_sketch(spark, d):
    """Distinct values in every span of three years from stored yearly sketches; few values are
    counted exactly, the many IDs within four standard errors of the events (each has its own)."""
    yearly = scratch_table(sketches.yearly_sketches(base(spark, d), ("ID", "Network", "Type")), "sketches")
    bound = F.lit(4 * sketches.standard_error()) * F.col("Events")
    found = sketches.distinct_by_window(yearly, 3)
    return found.select("First", "Events", "Network", "Type", (F.abs(F.col("ID") - F.col("Events")) <= bound).alias("ids_within"))


def q_year_options(spark, d):
    return stats.year_options(store.year_counts(spark, d))


# ---- trends ------------------------------------------------------------------


def q_year_slice(spark, d):
    return rounded(latest(spark, d))


def q_year_range(spark, d):
    return rounded(in_range(spark, d))


def q_default_year_range(spark, d):
    return trends.year_bounds(store.year_counts(spark, d))


def q_top_quakes(spark, d):
    return rounded(top(spark, d))


def q_severity_extremes(spark, d):
    return rounded(trends.severity_extremes(top(spark, d)))


def q_top_remaining(spark, d):
    return rounded(trends.top_remaining(top(spark, d)))


def q_top_centroid(spark, d):
    return rounded(trends.top_centroid(top(spark, d), EXACT))


def q_magnitude_histogram(spark, d):
    return rounded(trends.magnitude_histogram(base(spark, d)))


def q_histogram_fitted(spark, d):
    return rounded(trends.fitted_histogram(base(spark, d)))


def q_trend_line(spark, d):
    return rounded(trends.trend_line(in_range(spark, d)), wide=("slope", "intercept"))


def q_trend_line_all(spark, d):
    return rounded(trends.trend_line(base(spark, d)), wide=("slope", "intercept"))


def q_trend_fitted(spark, d):
    return rounded(trends.trend_fitted(in_range(spark, d)))


def q_trend_rmse(spark, d):
    return rounded(trends.trend_rmse(in_range(spark, d)))


def q_correlations(spark, d):
    out = trends.correlations(base(spark, d))
    return rounded(out, wide=tuple(out.columns))


def q_scatter_points(spark, d):
    return rounded(trends.scatter_points(in_range(spark, d)))


def q_depth_scaled(spark, d):
    return rounded(trends.depth_scaled(base(spark, d)))


def q_marker_table(spark, d):
    return rounded(trends.marker_table(top(spark, d)))


# ---- geo ---------------------------------------------------------------------


def q_map_clusters(spark, d):
    return rounded(geo.map_clusters(latest(spark, d), zoom=2, exact_scale=EXACT))


def q_map_clusters_zoom(spark, d):
    return rounded(clusters.clusters_by_zoom(base(spark, d), finest=4))


def q_nearest_hav(spark, d):
    return geo.nearest(fixture.points(spark, d), quakes(spark, d), carry=("Magnitude",), metric="haversine")


def q_nearest_one(spark, d):
    one = fixture.points(spark, d).orderBy("point_id").limit(1)
    return geo.nearest_one(one, quakes(spark, d), carry=("Date", "Magnitude", "Depth"), metric="geodesic")


def q_nearest_batch(spark, d):
    return geo.nearest(fixture.points(spark, d), quakes(spark, d), carry=("Date", "Magnitude", "Depth"), metric="geodesic")


def q_nearest_text(spark, d):
    out = geo.nearest(fixture.points(spark, d), quakes(spark, d), carry=("Date", "Magnitude", "Depth"), metric="geodesic")
    return out.withColumn("popup", display.popup_text("Magnitude", "Date"))


def q_nearest_edge(spark, d):
    """Repeated keys, NaN and missing coordinates, and points near one place, over all events."""
    p = fixture.points(spark, d)
    case = F.col("point_id") % 5
    near = case == 3
    edge = p.select(
        (F.col("point_id") % 10).alias("point_id"),
        F.when(case == 1, F.lit(float("nan"))).when(case == 2, F.lit(None))
        .when(near, -(F.col("latitude") / 90) - 45).otherwise(F.col("latitude")).alias("latitude"),
        F.when(near, F.col("longitude") / 180 - 120).otherwise(F.col("longitude")).alias("longitude"),
    )
    return geo.nearest(edge, quakes(spark, d), metric="haversine")


def q_extremes_labelled(spark, d):
    return rounded(geo.with_place(trends.severity_extremes(top(spark, d)), fixture.places(spark, d)))


def q_place_labels(spark, d):
    return geo.place_labels(latest(spark, d), fixture.places(spark, d))


def q_year_markers(spark, d):
    return rounded(geo.year_markers(latest(spark, d), fixture.places(spark, d)))


# ---- models ------------------------------------------------------------------


def _predict(name):
    def run(spark, d):
        train, test = train_test(spark, d)
        # Predictions at 4 places: solver paths (normal equations, trees) agree
        # far below that, so another engine's closed form can be compared.
        return rounded(ml.predict(ml.fit(train, name), test), wide=("prediction",), wide_places=4)

    run.__name__ = f"q_{name}_predict"
    return run


def q_model_compare(spark, d):
    return rounded(ml.compare(*train_test(spark, d)), wide=("rmse",), wide_places=4)


def q_model_select(spark, d):
    return rounded(ml.select_best(ml.compare(*train_test(spark, d))), wide=("rmse",), wide_places=4)


def q_prediction_table(spark, d):
    train, test = train_test(spark, d)
    return rounded(ml.prediction_table(ml.fit(train, "RandomForest"), test), wide=("Pred_Magnitude", "RMSE"), wide_places=4)


def q_score_points(spark, d):
    train, _ = train_test(spark, d)
    scored = ml.score_points(ml.fit(train, "RandomForest"), fixture.points(spark, d))
    return rounded(scored, wide=("Pred_Magnitude",), wide_places=4)


def linear(spark, d):
    train, test = train_test(spark, d)
    return ml.fit(train, "LinearRegression"), test


def q_lr_metrics(spark, d):
    train, test = train_test(spark, d)
    return rounded(ml.compare(train, test, ("LinearRegression",)).drop("pos"), wide=("rmse",), wide_places=4)


def q_lr_prediction_table(spark, d):
    return rounded(ml.prediction_table(*linear(spark, d)), wide=("Pred_Magnitude", "RMSE"), wide_places=4)


def q_lr_score_points(spark, d):
    scored = ml.score_points(linear(spark, d)[0], fixture.points(spark, d))
    return rounded(scored, wide=("Pred_Magnitude",), wide_places=4)


# ---- files: what is written comes back --------------------------------------


def place(spark, name):
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


_RAW = ["ID", "Date", "Latitude", "Longitude", "Depth", "Magnitude", "Type", "Network"]


def q_csv_strings(spark, d):
    """Written with one column order, read by header name in another."""
    at = place(spark, "landing")
    sinks.export_csv(raw(spark, d).select(*reversed(_RAW)), at)
    return read.read_raw_csv(spark, at, schema.strings(_RAW))


def q_csv_typed(spark, d):
    at = place(spark, "landing")
    sinks.export_csv(raw(spark, d).select(*_RAW), at)
    return rounded(read.read_typed_csv(spark, at))


def q_csv_inferred(spark, d):
    """A column of every type written as text; the types come from all values."""
    at = place(spark, "landing")
    sinks.export_csv(fixture.raw_loose(spark, d).select(*_RAW, *fixture.LOOSE_SQL), at)
    return rounded(read_day(infer.read_inferred_csv(spark, at)))


def read_day(df):
    """Days and instants as text, which every engine writes alike."""
    return df.withColumn("Day", F.col("Day").cast("string")).withColumn("Seen", F.date_format("Seen", "yyyy-MM-dd HH:mm:ss"))


def q_csv_export(spark, d):
    at = place(spark, "export")
    sinks.export_csv(latest(spark, d), at)
    return rounded(read.read_typed_csv(spark, at).withColumn("Year", F.col("Year").cast("int")))


def q_stored_yearly_stats(spark, d):
    """Written twice: the second version replaces the first, which has no rows."""
    at = place(spark, "yearly")
    sinks.replace_table(stats.yearly_stats(raw(spark, d).limit(0), EXACT), at, "orc")
    sinks.replace_table(stats.yearly_stats(raw(spark, d), EXACT), at, "orc")
    return rounded(read.read_catalog(spark, at, "orc"))


def q_stored_predictions(spark, d):
    at = place(spark, "predictions")
    sinks.replace_table(ml.prediction_table(*linear(spark, d)), at)
    return rounded(read.read_catalog(spark, at), wide=("Pred_Magnitude", "RMSE"), wide_places=4)


def q_stored_model(spark, d):
    at = place(spark, "model")
    model, test = linear(spark, d)
    sinks.save_model(model, at)
    return rounded(ml.predict(read.load_model(at), test), wide=("prediction",), wide_places=4)


def q_stored_forest(spark, d):
    """A forest's node table, written, read again and applied."""
    at = place(spark, "forest")
    train, test = train_test(spark, d)
    sinks.save_model(ml.fit(train, "RandomForest"), at)
    return rounded(ml.predict(read.load_model(at), test), wide=("prediction",), wide_places=4)


def q_store_key_dropped(spark, d):
    at = place(spark, "keyed")
    sinks.write_table(curated(spark, d).withColumn("_id", F.sha1("ID")), at)
    return rounded(read.read_catalog(spark, at))


def q_document_scan(spark, d):
    """Written as JSON lines, read by the document source with the type filter sent to its reader."""
    at = place(spark, "documents")
    documents.register(spark)
    rows = curated(spark, d)
    sinks.write_table(rows, at, "json")
    found = spark.read.format(documents.FORMAT).schema(rows.schema).option("splitBytes", 1 << 20).load(at)
    return rounded(found.where(F.col("Type") == "Earthquake"))


def q_strict_cast(spark, d):
    text = curated(spark, d).select("ID", *[F.col(c).cast("string").alias(c) for c in schema.NUMERIC_COLUMNS])
    return rounded(C.strict_numeric(text))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_catalog": q_scan_catalog,
    "scan_type_filter": q_scan_type_filter,
    "project_catalog": q_project_catalog,
    "harmonize_feed": q_harmonize_feed,
    "parse_year": q_parse_year,
    "coerce_numeric": q_coerce_numeric,
    "clean_catalog": q_clean_catalog,
    "clean_subset": q_clean_subset,
    "reject_points": q_reject_points,
    "preview": q_preview,
    "yearly_stats": q_yearly_stats,
    "yearly_join": q_yearly_join,
    "yearly_stats_clean": q_yearly_stats_clean,
    "trend_stats": q_trend_stats,
    "yearly_counts": q_yearly_counts,
    "type_counts": q_type_counts,
    "type_share": q_type_share,
    "kpi_home": q_kpi_home,
    "kpi_year": q_kpi_year,
    "kpi_empty": q_kpi_empty,
    "year_options": q_year_options,
    "year_slice": q_year_slice,
    "year_range": q_year_range,
    "default_year_range": q_default_year_range,
    "top_quakes": q_top_quakes,
    "severity_extremes": q_severity_extremes,
    "top_remaining": q_top_remaining,
    "top_centroid": q_top_centroid,
    "magnitude_histogram": q_magnitude_histogram,
    "histogram_fitted": q_histogram_fitted,
    "trend_line": q_trend_line,
    "trend_fitted": q_trend_fitted,
    "trend_rmse": q_trend_rmse,
    "correlations": q_correlations,
    "scatter_points": q_scatter_points,
    "depth_scaled": q_depth_scaled,
    "marker_table": q_marker_table,
    "map_clusters": q_map_clusters,
    "map_clusters_zoom": q_map_clusters_zoom,
    "nearest_hav": q_nearest_hav,
    "nearest_one": q_nearest_one,
    "nearest_batch": q_nearest_batch,
    "place_labels": q_place_labels,
    "year_markers": q_year_markers,
    "rf_predict": _predict("RandomForest"),
    "lr_predict": _predict("LinearRegression"),
    "dt_predict": _predict("DecisionTree"),
    "gbt_predict": _predict("GBT"),
    "model_compare": q_model_compare,
    "model_select": q_model_select,
    "prediction_table": q_prediction_table,
    "score_points": q_score_points,
    "lr_metrics": q_lr_metrics,
    "lr_prediction_table": q_lr_prediction_table,
    "lr_score_points": q_lr_score_points,
    "catalog_columns": q_catalog_columns,
    "kpi_text": q_kpi_text,
    "trend_line_all": q_trend_line_all,
    "nearest_text": q_nearest_text,
    "nearest_edge": q_nearest_edge,
    "extremes_labelled": q_extremes_labelled,
    "csv_strings": q_csv_strings,
    "csv_typed": q_csv_typed,
    "csv_export": q_csv_export,
    "stored_yearly_stats": q_stored_yearly_stats,
    "stored_predictions": q_stored_predictions,
    "stored_model": q_stored_model,
    "stored_forest": q_stored_forest,
    "store_key_dropped": q_store_key_dropped,
    "document_scan": q_document_scan,
    "strict_cast": q_strict_cast,
    "dates_any": q_dates_any,
    "date_votes": q_date_votes,
    "inferred_types": q_inferred_types,
    "csv_inferred": q_csv_inferred,
    "column_guard": q_column_guard,
    "distinct_sketch": q_distinct_sketch,
}

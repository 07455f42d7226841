"""Dashboard operators: year filters, strongest events, lines and shapes.

Single-row results (bounds, fitted lines) are attached to rows as scalar
subqueries: Spark computes them once as a small aggregate and inlines the
value, so no cross join and no window over unbounded input is needed.  The
only key-less windows run over the output of a top-n limit (at most n rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions import display
from tremor.functions.agg import mean

# Strongest-event list size and default range width (years after the first).
TOP_N = 50
RANGE_YEARS = 5
# The longest list whose rows are compared in one task.
MAX_LIST = 10_000


def latest_year(df: DataFrame) -> Column:
    """The newest year as a scalar subquery (the year selector's default)."""
    return df.agg(F.max("Year")).scalar()


def year_slice(df: DataFrame, year=None, years: DataFrame | None = None) -> DataFrame:
    """Rows of one year (default: the newest); prunes Year partitions when stored by Year.

    ``years``: a small table of the years that occur, read for the default in place of ``df``.
    """
    if year is None:
        target = latest_year(df if years is None else years)
    else:
        target = year if isinstance(year, Column) else F.lit(year)
    return df.where(F.col("Year") == target)


def year_bounds(df: DataFrame) -> DataFrame:
    """One row: first and last year, and the default range ``[first, first + 5]``."""
    b = df.agg(F.min("Year").cast("int").alias("min_year"), F.max("Year").cast("int").alias("max_year"))
    return b.select(
        "min_year",
        "max_year",
        F.col("min_year").alias("range_lo"),
        F.least(F.col("min_year") + RANGE_YEARS, F.col("max_year")).alias("range_hi"),
    )


def with_scalar(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Attach a one-row, one-struct result to every row as column ``name``.

    The scalar subquery is bound to a column once: each use of one of its
    fields then reads the column, so Spark plans and runs the subquery once
    (field accesses on the subquery expression itself would each become a
    separate subquery with its own scan).
    """
    return df.withColumn(name, one_row.scalar())


def year_range(df: DataFrame, lo=None, hi=None, years: DataFrame | None = None) -> DataFrame:
    """Rows with ``lo <= Year <= hi``; missing bounds take the default range (of ``years``, if given)."""
    if lo is not None and hi is not None:
        return df.where((F.col("Year") >= F.lit(lo)) & (F.col("Year") <= F.lit(hi)))
    bounds = year_bounds(df if years is None else years).select(F.struct("range_lo", "range_hi"))
    t = with_scalar(df, "_bounds", bounds)
    lo_c = F.col("_bounds.range_lo") if lo is None else F.lit(lo)
    hi_c = F.col("_bounds.range_hi") if hi is None else F.lit(hi)
    return t.where((F.col("Year") >= lo_c) & (F.col("Year") <= hi_c)).drop("_bounds")


def top_quakes(df: DataFrame, n: int = TOP_N, buckets: int | None = None) -> DataFrame:
    """The ``n`` largest magnitudes, ties by ID.

    Plans as a per-partition top-n whose survivors (``n`` per task) are merged
    in one task.  With very many input partitions (say 10^5 and up) that one
    task fetches a shuffle block from every map task; pass ``buckets`` (about
    the square root of the partition count) to merge in two levels instead:
    map tasks are spread over ``buckets`` groups by partition id, a
    ``row_number() <= n`` per group (limited before the shuffle by Spark's
    window group limit) keeps ``n`` rows per group, and the final top-n reads
    ``buckets * n`` rows.  The result is the same either way.
    """
    order = [F.desc("Magnitude"), F.asc("ID")]
    if not buckets or buckets <= 1:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy("_bucket").orderBy(*order)
    per_bucket = (
        df.withColumn("_bucket", F.spark_partition_id() % F.lit(buckets))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .drop("_bucket", "_rn")
    )
    return per_bucket.orderBy(*order).limit(n)


_EVENT_FIELDS = ("ID", "Date", "Magnitude", "Depth", "Latitude", "Longitude")


def tag_extremes(top: DataFrame) -> DataFrame:
    """Mark each row of a top-n list with its severity roles, in one pass.

    ``top`` must be bounded (the output of ``top_quakes``): the windows below
    have no partition key and gather the list into one task.  A frame whose
    plan does not prove at most ``MAX_LIST`` rows is refused.  Adds ``_most``
    (largest magnitude, first ID), ``_least`` (smallest magnitude, first ID)
    and ``_other`` (magnitude equals neither extreme).
    """
    bound = top._jdf.queryExecution().optimizedPlan().maxRows()
    if bound.isEmpty() or int(bound.get()) > MAX_LIST:
        raise ValueError(f"severity roles need a list of at most {MAX_LIST} rows: pass the output of top_quakes")
    every = Window.partitionBy()
    down = Window.orderBy(F.desc("Magnitude"), F.asc("ID"))
    up = Window.orderBy(F.asc("Magnitude"), F.asc("ID"))
    t = top.withColumns(
        {
            "_most": F.row_number().over(down) == 1,
            "_least": F.row_number().over(up) == 1,
            "_hi": F.max("Magnitude").over(every),
            "_lo": F.min("Magnitude").over(every),
        }
    )
    return t.withColumn("_other", (F.col("Magnitude") != F.col("_hi")) & (F.col("Magnitude") != F.col("_lo"))).drop(
        "_hi", "_lo"
    )


def _roles(tagged: DataFrame, with_other: bool) -> DataFrame:
    roles = [F.when(F.col("_most"), F.lit("most")), F.when(F.col("_least"), F.lit("least"))]
    if with_other:
        roles.append(F.when(F.col("_other"), F.lit("other")))
    return tagged.withColumn("role", F.explode(F.array_compact(F.array(*roles)))).drop("_most", "_least", "_other")


def severity_extremes(top: DataFrame) -> DataFrame:
    """Most and least severe event of a (bounded) list, first ID on ties."""
    fields = [c for c in _EVENT_FIELDS if c in top.columns]
    return _roles(tag_extremes(top), with_other=False).select("role", *fields)


def top_remaining(top: DataFrame) -> DataFrame:
    """List rows whose magnitude equals neither extreme."""
    return tag_extremes(top).where("_other").drop("_most", "_least", "_other")


def top_centroid(top: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Plain mean position of a list (no wrap-around at +-180 degrees)."""
    return top.agg(
        mean("Latitude", exact_scale).alias("avg_latitude"), mean("Longitude", exact_scale).alias("avg_longitude")
    )


def magnitude_histogram(df: DataFrame, width: float = 0.1) -> DataFrame:
    """Counts per magnitude bin ``[k*w, (k+1)*w)``.

    The bin index is taken after rounding ``m / w`` to 9 places so that values
    sitting on an edge (5.5 / 0.1 = 54.999...) land in their own bin.
    """
    idx = F.floor(F.round(F.col("Magnitude") / F.lit(width), 9)).cast("long")
    out = df.where(F.col("Magnitude").isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("Count"))
    return out.select(
        "bin",
        (F.col("bin") * F.lit(width)).alias("bin_start"),
        ((F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        "Count",
    )


def fitted_width(df: DataFrame, column: str = "Magnitude") -> DataFrame:
    """``width``: a bin width for ``column``, one row, from one aggregate.

    Twice the interquartile range over the cube root of the count; where the
    quartiles are equal, the range over ``1 + log2(count)``; where all values are
    (or there are none), 1.  It is then taken to the nearest of 1, 2 or 5 times a
    power of ten.  Quartiles come from a mergeable sketch (ranks within 1/10000 of
    the count), whose error the rounding nearly always absorbs.  Null and NaN are left out.
    """
    x = F.col(column)
    known = df.where(x.isNotNull() & ~F.isnan(x.cast("double"))).select(x.cast("double").alias("x"))
    q = F.percentile_approx("x", [0.25, 0.75], 10_000)
    found = known.agg(F.count(F.lit(1)).alias("n"), q.alias("q"), (F.max("x") - F.min("x")).alias("range"))
    spread = F.col("q")[1] - F.col("q")[0]
    raw = (
        F.when(spread > 0, 2 * spread / F.pow(F.col("n").cast("double"), F.lit(1 / 3)))
        .when(F.col("range") > 0, F.col("range") / (1 + F.log2(F.col("n").cast("double"))))
        .otherwise(F.lit(1.0))
    )
    unit = F.pow(F.lit(10.0), F.floor(F.log10("raw")).cast("double"))
    part = F.col("raw") / F.col("unit")
    nice = F.when(part < 1.5, 1.0).when(part < 3.5, 2.0).when(part < 7.5, 5.0).otherwise(10.0)
    return found.select(raw.alias("raw")).withColumn("unit", unit).select((nice * F.col("unit")).alias("width"))


def fitted_histogram(df: DataFrame, column: str = "Magnitude") -> DataFrame:
    """Counts per bin of ``fitted_width``: ``bin, bin_start, bin_end, Count``; values on an edge begin a bin."""
    x, width = F.col(column).cast("double"), fitted_width(df, column).scalar()
    known = df.where(F.col(column).isNotNull() & ~F.isnan(x)).select(x.alias("x"), width.alias("width"))
    idx = F.floor(F.round(F.col("x") / F.col("width"), 9)).cast("long")
    out = known.groupBy(idx.alias("bin"), "width").agg(F.count(F.lit(1)).alias("Count"))
    return out.select("bin", (F.col("bin") * F.col("width")).alias("bin_start"), ((F.col("bin") + 1) * F.col("width")).alias("bin_end"), "Count")


def trend_line(df: DataFrame, x: str = "Longitude", y: str = "Magnitude") -> DataFrame:
    """Least-squares line ``y = slope * x + intercept`` (same fit as a degree-1 polyfit)."""
    return df.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_count(F.col(y), F.col(x)).alias("n"),
    )


def trend_fitted(df: DataFrame, x: str = "Longitude", y: str = "Magnitude") -> DataFrame:
    """Each row with the fitted line evaluated at its ``x``."""
    fit = trend_line(df, x, y).select(F.struct("slope", "intercept"))
    keep = [c for c in ("ID",) if c in df.columns]
    t = with_scalar(df, "_fit", fit)
    return t.select(*keep, x, y, (F.col("_fit.slope") * F.col(x) + F.col("_fit.intercept")).alias("fitted"))


def trend_rmse(df: DataFrame, x: str = "Longitude", y: str = "Magnitude") -> DataFrame:
    """Root mean squared residual of the least-squares line, with the row count.

    One pass: the residual sum of squares of the fitted line is
    ``Syy - Sxy^2 / Sxx`` (centred sums), so no second scan for residuals.
    Null when the line is undefined (fewer than two distinct ``x``).
    """
    a = df.agg(
        F.regr_sxx(F.col(y), F.col(x)).alias("sxx"),
        F.regr_sxy(F.col(y), F.col(x)).alias("sxy"),
        F.regr_syy(F.col(y), F.col(x)).alias("syy"),
        F.regr_count(F.col(y), F.col(x)).alias("n"),
    )
    sse = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
    return a.select(
        F.when(F.col("sxx") > 0, F.sqrt(sse / F.col("n"))).alias("rmse"),
        F.when(F.col("sxx") > 0, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n"),
    )


def correlations(df: DataFrame, target: str = "Magnitude", features=("Latitude", "Longitude", "Depth")) -> DataFrame:
    """Pearson correlation of each feature with the target, one row."""
    return df.agg(*[F.corr(F.col(f), F.col(target)).alias(f"corr_{f.lower()}") for f in features])


def scatter_points(df: DataFrame) -> DataFrame:
    """Scatter inputs: position, depth and magnitude, plus a depth-proportional size."""
    return df.select(
        "ID", "Latitude", "Longitude", "Depth", "Magnitude", display.bubble_linear("Depth").alias("size")
    )


def depth_scaled(df: DataFrame, smallest: float = 20.0, largest: float = 200.0) -> DataFrame:
    """Depth min-max scaled onto ``[smallest, largest]`` as a bubble size."""
    b = df.agg(F.min("Depth").alias("lo"), F.max("Depth").alias("hi")).select(F.struct("lo", "hi"))
    t = with_scalar(df.where(F.col("Depth").isNotNull()), "_b", b)
    return t.select(
        "ID",
        "Depth",
        "Magnitude",
        display.bubble_scaled("Depth", F.col("_b.lo"), F.col("_b.hi"), smallest, largest).alias("size"),
    )


def marker_table(top: DataFrame) -> DataFrame:
    """Trends-map markers: the two extremes, then every other listed event.

    Events sharing an extreme's magnitude are not drawn, as on the map.  One
    pass over the (bounded) list.
    """
    return _roles(tag_extremes(top), with_other=True).select(
        "role",
        "ID",
        "Latitude",
        "Longitude",
        "Magnitude",
        "Date",
        display.role_colour("role").alias("colour"),
        display.role_radius("role").alias("radius"),
        display.popup_text("Magnitude", "Date", display.role_heading("role")).alias("popup"),
    )

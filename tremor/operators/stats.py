"""Catalogue statistics: yearly figures, counts, shares and key figures.

Every statistic is one ``groupBy().agg()``: Catalyst plans a partial
(map-side) aggregate before the shuffle, so a year or type holding a large
share of the rows only ever crosses the network as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.functions import display
from tremor.functions.agg import mean, mean_of_parts, mean_parts, zero_like
from tremor.functions.parse import to_double, year_of


def yearly_stats(raw: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Rows per Year before null removal, with mean and max magnitude.

    One aggregate over the raw rows: ``Counts`` counts every row of the year,
    the magnitude figures skip missing values; years without a year or without
    any magnitude are dropped.
    """
    t = raw.select(year_of("Date").alias("Year"), to_double("Magnitude").alias("Magnitude"))
    return yearly_stats_typed(t, exact_scale)


def yearly_stats_typed(typed_rows: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """``yearly_stats`` over rows already typed (``Year`` int, ``Magnitude`` double), nulls kept."""
    out = typed_rows.groupBy("Year").agg(
        F.count(F.lit(1)).alias("Counts"),
        mean("Magnitude", exact_scale).alias("Avg_Magnitude"),
        F.max("Magnitude").alias("Max_Magnitude"),
    )
    return out.na.drop(how="any")


def yearly_join(raw: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """The same figures as three aggregates joined on Year (the ETL's plan shape).

    Kept for parity; ``yearly_stats`` computes the same rows with one scan and
    one shuffle instead of three and three.
    """
    t = raw.select(year_of("Date").alias("Year"), to_double("Magnitude").alias("Magnitude"))
    freq = t.groupBy("Year").agg(F.count(F.lit(1)).alias("Counts"))
    avg = t.groupBy("Year").agg(mean("Magnitude", exact_scale).alias("Avg_Magnitude"))
    mx = t.groupBy("Year").agg(F.max("Magnitude").alias("Max_Magnitude"))
    return freq.join(avg, ["Year"], "inner").join(mx, ["Year"], "inner").na.drop(how="any")


def yearly_stats_clean(catalog: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Yearly count, mean and max magnitude over curated rows."""
    return catalog.groupBy("Year").agg(
        F.count(F.lit(1)).alias("Counts"),
        mean("Magnitude", exact_scale).alias("Avg_Magnitude"),
        F.max("Magnitude").alias("Max_Magnitude"),
    )


def trend_stats(base: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Per Year: events with an ID, max and mean magnitude."""
    return base.groupBy("Year").agg(
        F.count("ID").alias("Total_Earthquakes"),
        F.max("Magnitude").alias("Max_Magnitude"),
        mean("Magnitude", exact_scale).alias("Avg_Magnitude"),
    )


def value_counts(df: DataFrame, column: str, name: str = "Count") -> DataFrame:
    """Frequency of each non-null value of ``column``."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))


def yearly_counts(df: DataFrame) -> DataFrame:
    """Events per Year, oldest first."""
    return value_counts(df, "Year").orderBy("Year")


def type_counts(df: DataFrame) -> DataFrame:
    """Events per Type, most frequent first (ties by Type)."""
    return value_counts(df, "Type").orderBy(F.desc("Count"), F.asc("Type"))


def type_share(df: DataFrame) -> DataFrame:
    """Per Type: count and percentage of all typed events.

    The grand total is a scalar subquery over the (tiny) per-type counts, not a
    global window, so no step gathers rows into one partition.
    """
    counts = value_counts(df, "Type")
    total = counts.agg(F.sum("Count").alias("total")).scalar()
    return counts.withColumn("Share", F.col("Count") * F.lit(100.0) / total)


def kpi(df: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Home-page key figures of a table, with the empty-input defaults (0).

    Two levels: a partial-aggregated rollup per (Year, Type), then the
    figures over that small table.  The distinct counts run on the rollup, so
    the rows are not expanded once per distinct aggregate.
    """
    m_sum, m_cnt = mean_parts("Magnitude", exact_scale)
    per = df.groupBy("Year", "Type").agg(
        F.count(F.lit(1)).alias("n"), m_sum.alias("m_sum"), m_cnt.alias("m_cnt"), F.max("Depth").alias("d_max")
    )
    agg = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_earthquakes"),
        F.count_distinct("Year").alias("unique_years"),
        mean_of_parts("m_sum", "m_cnt").alias("average_magnitude"),
        F.max("d_max").alias("max_depth"),
        F.count_distinct("Type").alias("unique_types"),
    )
    return agg.select(
        "total_earthquakes",
        "unique_years",
        F.when(F.col("unique_years") > 0, F.col("total_earthquakes") / F.col("unique_years"))
        .otherwise(F.lit(0.0))
        .alias("average_yearly"),
        F.coalesce("average_magnitude", zero_like(exact_scale)).alias("average_magnitude"),
        F.coalesce("max_depth", F.lit(0.0)).alias("max_depth"),
        "unique_types",
    )


def kpi_text(figures: DataFrame) -> DataFrame:
    """The home page's figures as shown: counts as text, the yearly mean rounded to
    two places (half to even), magnitude and depth as two-decimal text."""
    return figures.select(
        F.col("total_earthquakes").cast("string").alias("total"),
        display.round2("average_yearly").alias("average_yearly"),
        display.fmt2("average_magnitude").alias("average_magnitude"),
        display.fmt2("max_depth").alias("max_depth"),
    )


def kpi_year(df: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Key figures of one year's rows: count, min, max and mean magnitude."""
    return df.agg(
        F.count(F.lit(1)).alias("total_earthquakes"),
        F.min("Magnitude").alias("min_magnitude"),
        F.max("Magnitude").alias("max_magnitude"),
        mean("Magnitude", exact_scale).alias("avg_magnitude"),
    )


def year_options(df: DataFrame) -> DataFrame:
    """Distinct years, newest first."""
    return df.where(F.col("Year").isNotNull()).select("Year").distinct().orderBy(F.desc("Year"))

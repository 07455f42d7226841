"""Cleaning: projections, renames, typing and missing-value rules.

Landing zone (all strings) -> typed rows -> curated catalogue.  All of it is
narrow (per-row) work that Catalyst fuses into one codegen stage right after
the scan; nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor import schema
from tremor.functions.parse import to_double, to_double_strict, year_dmy, year_of


class MissingColumns(ValueError):
    """A plan asked for columns its input does not have."""


def missing_columns(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail before planning when an expected column is absent."""
    missing = missing_columns(df, columns)
    if missing:
        raise MissingColumns(f"missing columns: {missing}; have {df.columns}")
    return df


def drop_unused(df: DataFrame, columns=schema.DROPPED_COLUMNS) -> DataFrame:
    """Drop the ETL's named columns; names the input lacks are ignored."""
    return df.drop(*columns)


def drop_store_key(df: DataFrame, key: str = "_id") -> DataFrame:
    return df.drop(key)


def project_catalog(raw: DataFrame) -> DataFrame:
    """A raw table without the ETL's dropped columns and the store's key, still strings.

    The seven catalogue columns come first, then any other column the source has.
    """
    kept = drop_store_key(drop_unused(require_columns(raw, schema.CATALOG_COLUMNS)))
    return kept.select(*schema.CATALOG_COLUMNS, *[f"`{c}`" for c in kept.columns if c not in schema.CATALOG_COLUMNS])


def catalog_columns(raw: DataFrame) -> DataFrame:
    """The seven catalogue columns alone."""
    return require_columns(raw, schema.CATALOG_COLUMNS).select(*schema.CATALOG_COLUMNS)


def harmonize_feed(feed: DataFrame) -> DataFrame:
    """Holdout feed -> catalogue names and types (Date stays a string)."""
    require_columns(feed, list(schema.FEED_RENAMES))
    renamed = feed.select(*schema.FEED_RENAMES).withColumnsRenamed(schema.FEED_RENAMES)
    return renamed.select("Date", *[to_double(c).alias(c) for c in ("Latitude", "Longitude", "Magnitude", "Depth")])


def with_year(df: DataFrame, rule: str = "any") -> DataFrame:
    """Add ``Year``: ``any`` tries every known date layout, ``dmy`` only ``dd/MM/yyyy``."""
    year = year_of("Date") if rule == "any" else year_dmy("Date")
    return df.withColumn("Year", year)


def coerce_numeric(df: DataFrame, columns=schema.NUMERIC_COLUMNS) -> DataFrame:
    """Numeric columns from strings; unparsable values and NaN become null.

    Columns that are already doubles only get the NaN rule.
    """
    types = dict(df.dtypes)
    out = {}
    for c in columns:
        if c not in types:
            continue
        out[c] = to_double(c) if types[c] == "string" else F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    return df.withColumns(out)


def typed(raw: DataFrame) -> DataFrame:
    """Raw catalogue -> typed rows in the curated column order (the source's other
    columns after them, as they are), nulls kept."""
    t = coerce_numeric(with_year(project_catalog(raw)))
    first = [f.name for f in schema.QUAKE.fields]
    return t.select(*first, *[f"`{c}`" for c in t.columns if c not in first])


def evaluate_once(df: DataFrame) -> DataFrame:
    """Evaluate the current columns once before a following filter.

    Catalyst pushes a filter below a projection by substituting the projected
    expressions into it, so a null check placed after string parsing parses
    every value a second time.  A one-element ``inline`` is a generator, which
    filters do not cross; it stays inside the same codegen stage.  Use it only
    after expensive derived columns: it also stops filters on plain columns
    from reaching the scan.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def clean(raw: DataFrame) -> DataFrame:
    """Curated catalogue: typed rows with no missing value in any column, the
    source's other columns included."""
    return evaluate_once(typed(raw)).na.drop(how="any")


def typed_flagged(raw: DataFrame) -> DataFrame:
    """Every raw row typed once, with ``complete`` = no missing value in any column.

    One parse of the landing data feeds both the curated catalogue
    (``complete`` rows) and the statistics that count every row.
    """
    t = evaluate_once(typed(raw))
    complete = F.lit(True)
    for c in t.columns:
        complete = complete & F.col(f"`{c}`").isNotNull()
    return t.withColumn("complete", complete)


def clean_subset(df: DataFrame, subset=("Latitude", "Longitude", "Depth", "Magnitude", "Year")) -> DataFrame:
    """Drop rows missing a value in the listed columns only."""
    return df.na.drop(how="any", subset=list(subset))


def strict_numeric(df: DataFrame, columns=schema.NUMERIC_COLUMNS) -> DataFrame:
    """Numeric columns by a strict cast: text that is no number is an error, not a null."""
    return df.withColumns({c: to_double_strict(c) for c in columns})


def validate_points(df: DataFrame, columns=("latitude", "longitude", "depth")) -> DataFrame:
    """Typed point columns plus ``is_valid`` (every listed column parsed)."""
    typed_cols = {c: to_double(c) for c in columns}
    out = df.withColumns(typed_cols)
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.col(c).isNotNull()
    return out.withColumn("is_valid", valid)


def split_points(df: DataFrame, columns=("latitude", "longitude", "depth")) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` point tables from string input."""
    checked = validate_points(df, columns)
    return checked.where("is_valid").drop("is_valid"), checked.where(~F.col("is_valid")).drop("is_valid")

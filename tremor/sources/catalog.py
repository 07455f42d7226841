"""Readers: raw CSV catalogues, the curated store, points, saved models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tremor import schema
from tremor.functions.parse import to_double
from tremor.operators import trees
from tremor.sources import versions


def read_raw_csv(spark: SparkSession, path: str, raw_schema=None) -> DataFrame:
    """Raw catalogue CSV with a header; every column a string (no inference pass).

    Columns bind by header name.  With ``raw_schema`` its columns are picked
    from the files' own, whatever their order; one that is missing is an error,
    and so is a file in the folder whose header differs from the first one's
    (``enforceSchema`` off: Spark would bind it by position otherwise).
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    names = reader.csv(path).columns
    header = StructType([StructField(n, StringType()) for n in names])
    df = reader.option("enforceSchema", False).schema(header).csv(path)
    if raw_schema is None:
        return df
    missing = [n for n in raw_schema.names if n not in names]
    if missing:
        raise ValueError(f"missing columns: {missing}; the files have {names}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in raw_schema.fields])


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV read whose numeric columns come back as doubles (missing on bad input)."""
    df = read_raw_csv(spark, path)
    return df.select(*[to_double(c).alias(c) if c in schema.NUMERIC_COLUMNS else F.col(c) for c in df.columns])


def read_catalog(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Full scan of a stored catalogue; the store's own ``_id`` key is dropped if present.

    Of a versioned table (``sources.versions``) the current version is read.
    """
    df = spark.read.format(fmt).options(**(options or {})).load(versions.current(spark, path))
    return df.drop("_id")


def read_catalog_of_type(
    spark: SparkSession, path: str, event_type: str = "Earthquake", fmt: str = "parquet", options: dict | None = None
) -> DataFrame:
    """Catalogue scan restricted to one event type; the filter reaches the source scan."""
    return read_catalog(spark, path, fmt, options).where(F.col("Type") == event_type)


def points_frame(spark: SparkSession, rows) -> DataFrame:
    """A points table from literal ``(point_id, latitude, longitude, depth)`` rows."""
    return spark.createDataFrame(list(rows), schema.POINT)


def load_model(path: str):
    """What ``save_model`` or ``replace_model`` wrote: a node table or a Spark ML pipeline."""
    from pyspark.ml import PipelineModel

    path = versions.current(SparkSession.active(), path)
    try:
        SparkSession.active().read.parquet(f"{path}/nodes")
    except AnalysisException:  # no node table there
        return PipelineModel.load(path)
    return trees.load(SparkSession.active(), path)

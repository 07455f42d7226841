"""Incremental landing: the cleaning step as a Structured Streaming job.

New raw catalogue files (CSV, string schema) dropped into a folder are cleaned
with exactly the batch rules and appended to the curated store, partitioned
by Year.  The checkpoint location records which files were processed, so a
restarted or failed job neither loses nor repeats a file.  The yearly
statistics are recomputed from the store by the batch operators; no streaming
state is kept.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tremor import schema
from tremor.operators import clean as C


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    store_dir: str,
    checkpoint: str,
    raw_schema=None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the job.  Columns bind by header name: the layout is that of the files
    already in ``landing_dir`` (or ``raw_schema``), a file with another header
    fails the query, and a layout without the catalogue's columns is refused.
    """
    if raw_schema is None:
        names = spark.read.option("header", True).csv(landing_dir).columns
        raw_schema = StructType([StructField(n, StringType()) for n in names])
    missing = [c for c in schema.CATALOG_COLUMNS if c not in raw_schema.names]
    if missing:
        raise C.MissingColumns(f"missing columns: {missing}; have {raw_schema.names}")
    reader = spark.readStream.schema(raw_schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    curated = C.clean(reader.csv(landing_dir))
    writer = (
        curated.writeStream.format("parquet")
        .option("path", store_dir)
        .option("checkpointLocation", checkpoint)
        .partitionBy("Year")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()

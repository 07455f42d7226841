"""The curated store: the cleaned catalogue written once, read by many queries.

The ETL writes the curated catalogue and the dashboard reads it back (the
reference's split).  Here the store is a parquet table partitioned by Year in
the shared checkpoint folder (``spark.checkpoint.dir``), keyed by the source
table's files (paths, lengths and modification times), so it is rebuilt only
when the input changes.  Beside it stands a table of the events per Year, from
which year lists and default ranges are read without opening the store.  Reading it back prunes Year partitions and pushes Type and position
filters into the scan, and it cuts the lineage between cleaning and every
dashboard query.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import clean as C
from tremor.scratch import drop_scratch, scratch_table
from tremor.session import jvm_context, shared_dir
from tremor.sources import fixture, sinks

_READY = "_SUCCESS"
# Bumped whenever the stored layout or cleaning rules change.
LAYOUT_VERSION = 3


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


# Store DataFrames already opened in this process, by (application, store key).
# A published store never changes, so its file listing can be reused; a new
# input version has a new key.
_OPENED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def build_store(spark: SparkSession, raw: DataFrame, path: str) -> None:
    """Write ``quakes`` (the curated catalogue) and ``years`` (events per Year) under ``path``.

    The raw rows are parsed once, into a scratch table that the range sampler
    and the layout read.
    """
    rows = scratch_table(C.clean(raw), "curated")
    sinks.write_catalog(rows, f"{path}/quakes")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/quakes")
    counts = stored.groupBy("Year").agg(F.count(F.lit(1)).alias("Count"))
    sinks.write_table(counts.coalesce(1), f"{path}/years")  # one row per year
    drop_scratch(rows)


def _open(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = f"{sf_dir.rstrip('/')}/orders.parquet"
    key = hashlib.sha1(f"v{LAYOUT_VERSION}|{fixture.signature(spark, source)}".encode()).hexdigest()[:16]
    opened = _OPENED.get((spark.sparkContext.applicationId, key))
    if opened is not None:
        return opened
    root = f"{shared_dir(spark)}/tremor-store/{key}"
    path = f"{root}/store"
    raw = fixture.raw_catalog(spark, sf_dir)
    if not _exists(spark, f"{path}/years/{_READY}"):
        # Write aside, then rename into place: a concurrent or failed writer
        # never leaves a half-written store at ``path``.
        attempt = f"{root}/attempt-{uuid.uuid4().hex}"
        build_store(spark, raw, attempt)
        fs, target = _fs(spark, path)
        _, staged = _fs(spark, attempt)
        if not fs.rename(staged, target):
            fs.delete(staged, True)  # another writer won; its copy is complete
        if not _exists(spark, f"{path}/years/{_READY}"):
            raise RuntimeError(f"curated store at {path} is incomplete")
    # The schemas are known (they are what was written), so no footer is read to infer them.
    kind = C.typed(raw).schema
    quakes = spark.read.schema(kind).parquet(f"{path}/quakes").select(*kind.names)
    years = spark.read.schema("Year int, Count long").parquet(f"{path}/years")
    _OPENED[(spark.sparkContext.applicationId, key)] = (quakes, years)
    return quakes, years


def curated_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated catalogue of ``sf_dir``, written on first use, then read."""
    if jvm_context(spark) is None:
        # No file-system access from this client: compute the curated rows in the plan.
        return C.clean(fixture.raw_catalog(spark, sf_dir))
    return _open(spark, sf_dir)[0]


def year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(Year, Count)`` of the store: one row per year."""
    if jvm_context(spark) is None:
        return curated_store(spark, sf_dir).groupBy("Year").agg(F.count(F.lit(1)).alias("Count"))
    return _open(spark, sf_dir)[1]


def drop_stores(spark: SparkSession, keep: str | None = None) -> None:
    """Delete the stores of earlier input versions: all but that of the inputs in ``keep``."""
    if jvm_context(spark) is None:
        return
    kept = hashlib.sha1(f"v{LAYOUT_VERSION}|{fixture.signature(spark, f'{keep.rstrip('/')}/orders.parquet')}".encode()).hexdigest()[:16] if keep else None
    fs, root = _fs(spark, f"{shared_dir(spark)}/tremor-store")
    if fs.exists(root):
        for st in fs.listStatus(root):
            if st.getPath().getName() != kept:
                fs.delete(st.getPath(), True)
    for at in [k for k in _OPENED if k[0] == spark.sparkContext.applicationId and k[1] != kept]:
        del _OPENED[at]

"""Scratch tables in the shared folder: written once, read by later jobs, deleted with the session."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from tremor.session import jvm_context, shared_dir

_WRITTEN: dict[str, SparkSession] = {}


def scratch_table(df: DataFrame, name: str, folder: str = "scratch") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage, fixes generated values such as ids (a task that runs
    again after an executor was lost commits its files anew, readers see
    committed files only), and gives the planner the true size, so that it
    broadcasts the table only if it is below the session's own threshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._tremor_scratch = path
    return out


def drop_scratch(*tables: DataFrame | None) -> None:
    """Delete scratch tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_tremor_scratch", None)
        if path and _WRITTEN.pop(path, None) is not None:
            delete_path(table.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    sc = jvm_context(spark)
    if sc is not None:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _drop_all() -> None:
    """Results are lazy and may read scratch tables until the job ends."""
    for path, spark in list(_WRITTEN.items()):
        try:
            delete_path(spark, path)
        except Exception:  # the session is gone already; the shared folder keeps the table
            return

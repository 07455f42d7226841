"""Writers: curated catalogue, yearly statistics, predictions, CSV export, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.trees import TreeModel
from tremor.sources import versions


def write_catalog(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Curated catalogue, partitioned by Year so year filters prune files.

    Rows are range-partitioned on (Year, Type, hash of the ID): each task holds
    a contiguous range, so it writes one or two Year folders, and a year or type
    with a large share of the rows is spread by the range sampler over as many
    tasks as that share is worth.  Rows within a file are sorted on (Year,
    Type), so ``Type`` filters skip row groups; there is no sort on the ID.  The
    sampler reads its input once more: pass a stored table, not a parse (see
    ``plans.store`` and ``plans.etl``).
    """
    salt = F.xxhash64("ID") if "ID" in df.columns else F.lit(0)
    out = df.repartitionByRange("Year", "Type", salt).sortWithinPartitions("Year", "Type")
    out.write.mode(mode).format(fmt).partitionBy("Year").save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Any derived table (yearly statistics, predictions)."""
    df.write.mode(mode).format(fmt).save(path)


def replace_catalog(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """``write_catalog`` as a new version of the table ``root``; its folder.  Readers see the old one or the new one."""
    return versions.publish(df.sparkSession, root, lambda path: write_catalog(df, path, fmt))


def replace_table(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """``write_table`` as a new version of the table ``root``; its folder."""
    return versions.publish(df.sparkSession, root, lambda path: write_table(df, path, fmt))


def replace_model(model, root: str) -> str:
    """``save_model`` as a new version of ``root``; its folder."""
    return versions.publish(SparkSession.active(), root, lambda path: save_model(model, path))


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export with a header row and no index column.

    ``single_file`` funnels the rows through one task and is meant for small,
    already-reduced results only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """A Spark ML pipeline in its own format, a tree model as its node table."""
    if isinstance(model, TreeModel):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def preview(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows under a stated order (an unordered ``take`` is not repeatable)."""
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.limit(n)

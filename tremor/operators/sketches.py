"""Distinct counts of any range of years from one stored sketch per year.

An exact distinct count of a range reads all its events again.  A HyperLogLog
sketch of a year's values is a few kilobytes at any number of events, and the
sketches of a range merge into the sketch of its values, so a range reads as
many rows as it has years.  The relative standard error is about
``1.04 / sqrt(2 ** lg_k)``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / math.sqrt(2**lg_k)


def yearly_sketches(df: DataFrame, columns: tuple[str, ...], lg_k: int = LG_K) -> DataFrame:
    """``Year, Events`` and per column a sketch of its values (nulls are no values).

    One aggregate; what is shuffled is one partial row per task and year.
    Rows without a year are in no range and leave.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in columns]
    return df.where("Year is not null").groupBy("Year").agg(F.count(F.lit(1)).alias("Events"), *sketches)


def distinct_in_range(sketches: DataFrame, lo: int, hi: int) -> DataFrame:
    """One row: the events of the years ``lo`` to ``hi`` and the distinct values of each column, estimated."""
    rows = sketches.where(F.col("Year").between(lo, hi))
    return rows.agg(F.coalesce(F.sum("Events"), F.lit(0)).alias("Events"), *_estimates(sketches))


def distinct_by_window(sketches: DataFrame, years: int) -> DataFrame:
    """``distinct_in_range`` for every span of ``years`` years that begins with a year of the table."""
    first = F.explode(F.sequence(F.col("Year") - F.lit(years - 1), F.col("Year"))).alias("First")
    spread = sketches.select("*", first)
    begins = sketches.select(F.col("Year").alias("First"))
    out = spread.groupBy("First").agg(F.sum("Events").alias("Events"), *_estimates(sketches))
    return out.join(begins, "First", "left_semi")


def _estimates(sketches: DataFrame) -> list:
    columns = [c for c in sketches.columns if c not in ("Year", "Events")]
    # Sketches merge at the size they have; an empty range has no distinct values.
    return [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in columns]

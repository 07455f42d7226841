"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(c, exact_scale: int | None = None) -> Column:
    """Average of a column.

    ``exact_scale=None``: Spark's double ``avg`` (partial sums per task, so the
    last bits depend on the summation order).  With ``exact_scale=k`` the
    values (which must have at most ``k`` decimals) are summed as
    ``DECIMAL(k + 8, k)`` and divided by the count in decimal: the result is a
    ``DECIMAL(38, 20)`` that does not depend on row order, for reports that
    must agree digit for digit with another engine.
    """
    col = F.col(c) if isinstance(c, str) else c
    if exact_scale is None:
        return F.avg(col)
    dec = col.cast(f"decimal({exact_scale + 8},{exact_scale})")
    return F.sum(dec) / F.count(dec)


def zero_like(exact_scale: int | None) -> Column:
    """A zero of the type ``mean`` returns (for empty-input defaults)."""
    return F.lit(0.0) if exact_scale is None else F.lit(0).cast("decimal(38,20)")


def mean_parts(c, exact_scale: int | None = None) -> tuple[Column, Column]:
    """``(sum, count)`` partials of ``mean``, to be merged in a later aggregate."""
    col = F.col(c) if isinstance(c, str) else c
    if exact_scale is not None:
        col = col.cast(f"decimal({exact_scale + 8},{exact_scale})")
    return F.sum(col), F.count(col)


def mean_of_parts(sum_col: str, count_col: str) -> Column:
    """Merge ``mean_parts`` columns into the mean (same type as ``mean``)."""
    return F.sum(sum_col) / F.sum(count_col)

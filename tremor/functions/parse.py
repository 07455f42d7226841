"""Parsing rules: strings to years and numbers, one rule everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts the catalogue uses, tried in this order.
DATE_FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """First layout that parses, else null (never raises under ANSI)."""
    c = _col(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def year_of(c, formats=DATE_FORMATS) -> Column:
    """Calendar year of a date string; null when no layout matches."""
    return F.year(parse_date(c, formats))


def year_dmy(c) -> Column:
    """Year under the single ``dd/MM/yyyy`` rule of the batch ETL."""
    return year_of(c, DATE_FORMATS[:1])


def to_double(c) -> Column:
    """String to double, null on bad input; NaN is treated as missing."""
    # nanvl references its input once, so stacked conversions stay linear in size.
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def to_double_strict(c) -> Column:
    """String to double that fails the job on bad input (ANSI cast)."""
    return _col(c).cast("double")

"""Dates in any of the layouts that catalogues use, the order of day and month voted per source.

Most layouts can be told by their shape: ISO dates and times with or without a
zone, eight digits, month names.  Two numbers and a year cannot: ``03/04/1998``
is a day of April or of March.  A source (a file, a network) keeps to one order,
so all its rows vote, in one aggregate, and the rows are read by the winner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.scratch import scratch_table

# The shapes, and the English month names by their first three letters.
ISO = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
YEAR_FIRST = r"^(\d{4})([/.])(\d{1,2})\2(\d{1,2})$"
COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
NUMERIC = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})$"
DAY_NAME = r"^(\d{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4}|\d{2})$"
NAME_DAY = r"^([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4})$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
FULL_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# Two-digit years from here on belong to the 1900s, those below to the 2000s.
PIVOT = 69


def _full_year(y: Column) -> Column:
    short = F.length(y) == 2
    return F.when(short & (y.try_cast("int") >= PIVOT), F.concat(F.lit("19"), y)).when(short, F.concat(F.lit("20"), y)).otherwise(y)


def _month_number(name: Column) -> Column:
    """Number of an English month, in full or by three letters, as text; null for other words."""
    low = F.lower(name)
    names = F.array(*[F.lit(m) for m in MONTHS])
    full = F.array(*[F.lit(m) for m in FULL_MONTHS])
    at = F.greatest(F.array_position(names, low), F.array_position(full, low))
    return F.when(at > 0, at.cast("string"))


def _date(y: Column, m: Column, d: Column) -> Column:
    """Midnight of a day; null if there is no such day."""
    return F.try_to_timestamp(F.concat_ws("-", _full_year(y), m, d), F.lit("y-M-d"))


def _parts(text: Column, pattern: str, *groups: int) -> list[Column]:
    return [F.regexp_extract(text, pattern, g) for g in groups]


def by_shape(text: Column) -> Column:
    """Timestamp of texts whose layout their shape tells; null for all others."""
    y1, m1, d1 = _parts(text, YEAR_FIRST, 1, 3, 4)
    y2, m2, d2 = _parts(text, COMPACT, 1, 2, 3)
    d3, m3, y3 = _parts(text, DAY_NAME, 1, 2, 3)
    m4, d4, y4 = _parts(text, NAME_DAY, 1, 2, 3)
    m3, m4 = _month_number(m3), _month_number(m4)
    return (
        F.when(text.rlike(ISO), text.try_cast("timestamp"))
        .when(text.rlike(YEAR_FIRST), _date(y1, m1, d1))
        .when(text.rlike(COMPACT), _date(y2, m2, d2))
        .when(text.rlike(DAY_NAME) & m3.isNotNull(), _date(y3, m3, d3))
        .when(text.rlike(NAME_DAY) & m4.isNotNull(), _date(y4, m4, d4))
    )


def day_first(text: Column) -> Column:
    d, m, y = _parts(text, NUMERIC, 1, 3, 4)
    return F.when(text.rlike(NUMERIC), _date(y, m, d))


def month_first(text: Column) -> Column:
    m, d, y = _parts(text, NUMERIC, 1, 3, 4)
    return F.when(text.rlike(NUMERIC), _date(y, m, d))


def date_votes(df: DataFrame, column: str, source: str) -> DataFrame:
    """Per source: rows that read as day-month and as month-day, and the order that reads more (a tie: the day)."""
    text = F.trim(F.col(column))
    votes = df.groupBy(source).agg(F.count(day_first(text)).alias("day_month"), F.count(month_first(text)).alias("month_day"))
    return votes.withColumn("order", F.when(F.col("day_month") >= F.col("month_day"), "day_month").otherwise("month_day"))


def parse_dates(df: DataFrame, column: str = "Date", source: str = "Source", out: str = "Timestamp") -> DataFrame:
    """``df`` with ``out``, the UTC instant of ``column``, whatever the layout of its source.

    Texts with a zone are moved to UTC, those without are UTC, dates are
    midnight.  Null where no layout fits, where the day does not exist, or where
    two numbers and a year do not fit their source's order.  A null source is a
    source.  The votes, one row a source, are staged: Spark broadcasts them
    while they are below its threshold and splits a hot source's rows otherwise.
    """
    votes = date_votes(df, column, source).select(F.col(source).alias("_source"), (F.col("order") == "day_month").alias("_day_first"))
    votes = scratch_table(votes, "date-votes")
    text = F.trim(F.col(column))
    numeric = F.when(F.col("_day_first"), day_first(text)).otherwise(month_first(text))
    joined = df.join(votes, F.col(source).eqNullSafe(F.col("_source")), "left")
    return joined.withColumn(out, F.coalesce(by_shape(text), numeric)).drop("_source", "_day_first")

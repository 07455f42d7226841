"""Column types found from all values: one aggregate over all rows, no sample.

Every value of a string column has a narrowest type; a column has the narrowest
one that all its values have:

    boolean < string,  bigint < double < string,  date < timestamp < string

A column without values is a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from tremor.sources.catalog import read_raw_csv

# Texts that stand for a missing value, and the shapes of the types.
MISSING = ("", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null")
BOOLEAN = r"^(true|false|TRUE|FALSE|True|False)$"
INTEGER = r"^[+-]?\d+$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"

# Type, shape and Spark type, in the order in which they are tried.
LATTICE: tuple[tuple[str, str, DataType], ...] = (
    ("boolean", BOOLEAN, BooleanType()),
    ("bigint", INTEGER, LongType()),
    ("double", NUMBER, DoubleType()),
    ("date", DATE, DateType()),
    ("timestamp", TIMESTAMP, TimestampType()),
)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def value_of(column: Column, missing: tuple[str, ...] = MISSING) -> Column:
    """The trimmed text; null if it stands for a missing value."""
    text = F.trim(column)
    return F.when(~text.isin(*missing), text)


def _has_type(text: Column, shape: str, kind: DataType) -> Column:
    return text.rlike(shape) & text.try_cast(kind).isNotNull()


def type_counts(df: DataFrame, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """One row per string column: its values, its missing values, how many values have each type, and its type."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        raise ValueError("no string column to infer a type for")
    parts = []
    for name in names:
        text = value_of(_col(name), missing)
        found = [F.count(F.when(_has_type(text, shape, kind), 1)).alias(label) for label, shape, kind in LATTICE]
        parts.append(F.struct(F.lit(name).alias("column"), F.count(text).alias("n_values"), (F.count(F.lit(1)) - F.count(text)).alias("n_missing"), *found))
    rows = df.agg(F.array(*parts).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    kind = F.lit("string")
    for label, _, _ in reversed(LATTICE):
        kind = F.when((F.col("n_values") > 0) & (F.col(label) == F.col("n_values")), label).otherwise(kind)
    return rows.withColumn("type", kind)


def infer_schema(df: DataFrame, missing: tuple[str, ...] = MISSING) -> StructType:
    """The schema that all rows of ``df`` fit; other than string columns keep their type."""
    kinds = {label: kind for label, _, kind in LATTICE}
    found = {r["column"]: kinds.get(r["type"], StringType()) for r in type_counts(df, missing).select("column", "type").collect()}
    return StructType([StructField(f.name, found.get(f.name, f.dataType), True) for f in df.schema.fields])


def apply_schema(df: DataFrame, schema: StructType, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """String columns cast to the types of ``schema``.  In typed columns missing texts are null; strings stay as they are."""
    out = []
    for f in df.schema.fields:
        kind = schema[f.name].dataType
        column = _col(f.name)
        same = kind == f.dataType
        out.append(column if same else value_of(column, missing).cast(kind).alias(f.name))
    return df.select(*out)


def read_inferred_csv(spark: SparkSession, path: str, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """CSV with a header, each column of the narrowest type that all its values have.  Reads the files twice."""
    raw = read_raw_csv(spark, path)
    return apply_schema(raw, infer_schema(raw, missing), missing)

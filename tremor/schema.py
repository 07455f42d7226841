"""Explicit schemas: a string landing zone and a typed curated zone."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column names of the event catalogue and of the holdout feed.
CATALOG_COLUMNS = ["Date", "Latitude", "Longitude", "Type", "Depth", "Magnitude", "ID"]
NUMERIC_COLUMNS = ["Latitude", "Longitude", "Depth", "Magnitude"]
# The 13 columns the ETL drops from the raw catalogue.
DROPPED_COLUMNS = [
    "Depth Error",
    "Time",
    "Depth Seismic Stations",
    "Magnitude Error",
    "Magnitude Seismic Stations",
    "Azimuthal Gap",
    "Horizontal Distance",
    "Horizontal Error",
    "Root Mean Square",
    "Source",
    "Location Source",
    "Magnitude Source",
    "Status",
]
# Holdout feed column -> catalogue column.
FEED_RENAMES = {
    "time": "Date",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "mag": "Magnitude",
    "depth": "Depth",
}
FEATURES = ["Latitude", "Longitude", "Depth"]
LABEL = "Magnitude"


def strings(names) -> StructType:
    """A schema of string columns."""
    return StructType([StructField(n, StringType(), True) for n in names])


# Landing zone: every column a string.  The readers bind CSV columns by header name.
RAW = strings(["ID", "Date", "Latitude", "Longitude", "Depth", "Magnitude", "Type", "Time", "Status"])
FEED = strings(["time", "latitude", "longitude", "mag", "depth", "id"])

QUAKE = StructType(
    [
        StructField("Date", StringType(), True),
        StructField("Latitude", DoubleType(), True),
        StructField("Longitude", DoubleType(), True),
        StructField("Type", StringType(), True),
        StructField("Depth", DoubleType(), True),
        StructField("Magnitude", DoubleType(), True),
        StructField("ID", StringType(), True),
        StructField("Year", IntegerType(), True),
    ]
)

YEARLY = StructType(
    [
        StructField("Year", IntegerType(), True),
        StructField("Counts", LongType(), False),
        StructField("Avg_Magnitude", DoubleType(), True),
        StructField("Max_Magnitude", DoubleType(), True),
    ]
)

PREDICTION = StructType(
    [
        StructField("Latitude", DoubleType(), True),
        StructField("Longitude", DoubleType(), True),
        StructField("Pred_Magnitude", DoubleType(), True),
        StructField("Year", IntegerType(), False),
        StructField("RMSE", DoubleType(), False),
    ]
)

POINT = StructType(
    [
        StructField("point_id", LongType(), False),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("depth", DoubleType(), True),
    ]
)

PLACE = StructType(
    [
        StructField("place_id", LongType(), False),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("city", StringType(), True),
        StructField("town", StringType(), True),
        StructField("village", StringType(), True),
        StructField("country", StringType(), True),
    ]
)

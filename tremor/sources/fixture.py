"""Test-table mapping: the driver's TPC-H-like tables to seismic inputs.

``orders`` (unique ``o_orderkey``) becomes the raw event catalogue, all
strings, with bad dates, bad numbers and nulls planted on fixed key
residues; ``nation`` becomes query points and ``supplier`` x ``nation`` a
gazetteer.  The values are invented, not seismology.  Every mapping is a
narrow projection (no shuffle), so it scales with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.session import jvm_context

# Holdout share of the catalogue, by key residue.
HOLDOUT_MOD = 5


_OPENED: dict[tuple, DataFrame] = {}


def signature(spark: SparkSession, path: str) -> str:
    """Every file at or below ``path`` with its length and modification time."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    files, found = p.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(p, True), []
    while files.hasNext():
        st = files.next()
        found.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
    return "\n".join(sorted(found))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table.  The opened DataFrame is reused while none of its files
    changes (no repeated footer reads)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if jvm_context(spark) is None:
        return spark.read.parquet(path)
    key = (spark.sparkContext.applicationId, path, signature(spark, path))
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(path)
    return _OPENED[key]


# The raw-catalogue mapping from ``orders`` (FIXTURES.md), as
# Spark SQL.  Doubles are written ``10e0`` (``10.0`` would be a decimal).
RAW_SQL = {
    "ID": "concat('eq_', cast(o_orderkey as string))",
    "Date": (
        "case when o_orderkey % 101 = 0 then '31/31/1999' "
        "when o_orderkey % 103 = 0 then cast(null as string) "
        "when o_orderkey % 17 = 0 then date_format(o_orderdate, 'yyyy-MM-dd') "
        "else date_format(o_orderdate, 'dd/MM/yyyy') end"
    ),
    "Latitude": (
        "case when o_orderkey % 97 = 0 then 'n/a' "
        "else cast((((o_custkey * 7919 + o_orderkey * 31) % 1801) - 900) / 10e0 as string) end"
    ),
    "Longitude": "cast((((o_custkey * 104729 + o_orderkey * 17) % 3601) - 1800) / 10e0 as string)",
    "Depth": "cast(cast(floor(o_totalprice) as bigint) % 7000 / 10e0 as string)",
    "Magnitude": (
        "case when o_orderkey % 89 = 0 then cast(null as string) "
        "else cast((11000 + cast(floor(o_totalprice) as bigint) % 7001) / 2000e0 as string) end"
    ),
    "Type": (
        "case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Earthquake' "
        "else o_orderpriority end"
    ),
    # Two of the columns the ETL drops, so that the drop does real work.
    "Time": "date_format(o_orderdate, 'HH:mm:ss')",
    "Status": "o_orderstatus",
    # A column of the source's own: kept as a string, and its nulls count as missing values.
    "Network": "case when o_orderkey % 107 <> 0 then concat('net_', cast(o_custkey % 11 as string)) end",
}


def _raw_columns(o: DataFrame) -> list:
    return [F.expr(sql).alias(name) for name, sql in RAW_SQL.items()]


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event catalogue (landing zone, all strings) from ``orders``."""
    o = table(spark, sf_dir, "orders")
    return o.select(*_raw_columns(o))


def raw_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalogue rows outside the holdout (the model's training source)."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderkey") % HOLDOUT_MOD != 0).select(*_raw_columns(o))


def raw_feed(spark: SparkSession, sf_dir: str, holdout: bool = True) -> DataFrame:
    """Feed with its own lower-case column names: the holdout's rows, or all."""
    o = table(spark, sf_dir, "orders")
    rows = o.where(F.col("o_orderkey") % HOLDOUT_MOD == 0) if holdout else o
    raw = rows.select(*_raw_columns(o))
    return raw.select(
        F.col("Date").alias("time"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        F.col("Magnitude").alias("mag"),
        F.col("Depth").alias("depth"),
        F.col("ID").alias("id"),
    )


# Dates as sources write them (the layout follows the network), and columns of
# every type as text, with the missing values that files use.
ANY_DATE_SQL = (
    "case when o_orderkey % 101 = 0 then '31/31/1999' when o_orderkey % 103 = 0 then cast(null as string) "
    "when o_orderkey % 109 = 0 then 'soon' when o_orderkey % 13 = 0 then date_format(o_orderdate, 'yyyyMMdd') "
    "when o_custkey % 11 < 4 then date_format(o_orderdate, 'dd/MM/yyyy') "
    "when o_custkey % 11 < 6 then date_format(o_orderdate, 'MM/dd/yyyy') "
    "when o_custkey % 11 = 6 then date_format(o_orderdate, 'yyyy-MM-dd') "
    "when o_custkey % 11 = 7 then concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T23:30:00-02:00') "
    "when o_custkey % 11 = 8 then date_format(o_orderdate, 'd MMM yyyy') "
    "when o_custkey % 11 = 9 then date_format(o_orderdate, 'dd/MM/yy') "
    "else date_format(o_orderdate, 'MMMM d, yyyy') end"
)
LOOSE_SQL = {
    "Key": "cast(o_orderkey as string)",
    "Day": "case when o_orderkey % 5 = 0 then 'NA' else date_format(o_orderdate, 'yyyy-MM-dd') end",
    "Seen": "concat(date_format(o_orderdate, 'yyyy-MM-dd'), case when o_orderkey % 2 = 0 then ' 12:30:00' else '' end)",
    "Felt": "case o_orderkey % 3 when 0 then 'true' when 1 then 'False' else 'n/a' end",
    "Odd": "case when o_orderkey % 1000 = 7 then '1,5' else cast(o_orderkey as string) end",
    "Blank": "' '",
}


def raw_any_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ID, Network, Date`` with each network's own date layout."""
    return table(spark, sf_dir, "orders").select(F.expr(RAW_SQL["ID"]).alias("ID"), F.expr(RAW_SQL["Network"]).alias("Network"), F.expr(ANY_DATE_SQL).alias("Date"))


def raw_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw catalogue with a column of every type, all as text."""
    o = table(spark, sf_dir, "orders")
    return o.select(*_raw_columns(o), *[F.expr(sql).alias(name) for name, sql in LOOSE_SQL.items()])


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query points (``point_id, latitude, longitude, depth``) from ``nation``."""
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf_dir, "nation").select(
        k.alias("point_id"),
        ((k * 6133 + 411) % 1801 - 900) / F.lit(10.0),
        ((k * 70001 + 77) % 3601 - 1800) / F.lit(10.0),
        (k * 37 % 700) * F.lit(1.0),
    ).toDF("point_id", "latitude", "longitude", "depth")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer (``place_id``, position, city/town/village, country) from suppliers."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    name_if = lambda r: F.when(k % 4 == r, F.col("s_name"))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        k.alias("place_id"),
        (((k * 7919) % 1801 - 900) / F.lit(10.0)).alias("latitude"),
        (((k * 104729) % 3601 - 1800) / F.lit(10.0)).alias("longitude"),
        name_if(0).alias("city"),
        name_if(1).alias("town"),
        name_if(2).alias("village"),
        F.col("n_name").alias("country"),
    )

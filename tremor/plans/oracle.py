"""Independent DuckDB SQL for every SQL-expressible query in the catalogue.

Each statement rebuilds its inputs from the pre-registered test tables
(``orders``, ``nation``, ``supplier``) with the same fixture rules, then
computes the operator in plain SQL.  Doubles are rounded as the Spark side
rounds them.  Tree models are trained in SQL too (``oracle_trees``).
"""

from __future__ import annotations

from tremor import schema
from tremor.plans import oracle_trees as trees
from tremor.plans.oracle_types import type_sql


def _dbl(x: str) -> str:
    return f"(CASE WHEN isnan(try_cast({x} AS DOUBLE)) THEN NULL ELSE try_cast({x} AS DOUBLE) END)"


def _raw_select(where: str = "") -> str:
    return f"""
  SELECT
    'eq_' || CAST(o_orderkey AS VARCHAR) AS "ID",
    CASE WHEN o_orderkey % 101 = 0 THEN '31/31/1999'
         WHEN o_orderkey % 103 = 0 THEN NULL
         WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%d/%m/%Y') END AS "Date",
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
         ELSE CAST((((o_custkey * 7919 + o_orderkey * 31) % 1801) - 900) / 10e0 AS VARCHAR) END AS "Latitude",
    CAST((((o_custkey * 104729 + o_orderkey * 17) % 3601) - 1800) / 10e0 AS VARCHAR) AS "Longitude",
    CAST((CAST(floor(o_totalprice) AS BIGINT) % 7000) / 10e0 AS VARCHAR) AS "Depth",
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
         ELSE CAST((11000 + CAST(floor(o_totalprice) AS BIGINT) % 7001) / 2000e0 AS VARCHAR) END AS "Magnitude",
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Earthquake'
         ELSE o_orderpriority END AS "Type",
    CASE WHEN o_orderkey % 107 <> 0 THEN 'net_' || CAST(o_custkey % 11 AS VARCHAR) END AS "Network"
  FROM orders {where}"""


_YEAR_ANY = """CAST(year(coalesce(try_strptime("Date", '%d/%m/%Y'), try_strptime("Date", '%Y-%m-%d'))) AS INTEGER)"""
_YEAR_DMY = """CAST(year(try_strptime("Date", '%d/%m/%Y')) AS INTEGER)"""


def _typed(src: str) -> str:
    return f"""
  SELECT "Date", {_dbl('"Latitude"')} AS "Latitude", {_dbl('"Longitude"')} AS "Longitude", "Type",
         {_dbl('"Depth"')} AS "Depth", {_dbl('"Magnitude"')} AS "Magnitude", "ID", {_YEAR_ANY} AS "Year", "Network"
  FROM {src}"""


_NOT_NULL = """ "Date" IS NOT NULL AND "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND "Type" IS NOT NULL
    AND "Depth" IS NOT NULL AND "Magnitude" IS NOT NULL AND "ID" IS NOT NULL AND "Year" IS NOT NULL
    AND "Network" IS NOT NULL"""

BASE = f"""WITH
raw AS ({_raw_select()}),
typed AS ({_typed('raw')}),
curated AS (SELECT * FROM typed WHERE {_NOT_NULL}),
base AS (SELECT * FROM curated),
bounds AS (
  SELECT min("Year") AS min_year, max("Year") AS max_year, min("Year") AS range_lo,
         least(min("Year") + 5, max("Year")) AS range_hi
  FROM base),
in_range AS (SELECT b.* FROM base b, bounds r WHERE b."Year" >= r.range_lo AND b."Year" <= r.range_hi),
top AS (SELECT * FROM in_range ORDER BY "Magnitude" DESC, "ID" ASC LIMIT 50),
most AS (SELECT * FROM top ORDER BY "Magnitude" DESC, "ID" ASC LIMIT 1),
least_ AS (SELECT * FROM top ORDER BY "Magnitude" ASC, "ID" ASC LIMIT 1),
extremes AS (
  SELECT 'most' AS role, "ID", "Date", "Magnitude", "Depth", "Latitude", "Longitude" FROM most
  UNION ALL
  SELECT 'least' AS role, "ID", "Date", "Magnitude", "Depth", "Latitude", "Longitude" FROM least_),
remaining AS (SELECT * FROM top WHERE "Magnitude" NOT IN (SELECT "Magnitude" FROM extremes)),
latest AS (SELECT * FROM curated WHERE "Year" = (SELECT max("Year") FROM curated)),
quakes AS (SELECT * FROM curated WHERE "Type" = 'Earthquake'),
points AS (
  SELECT CAST(n_nationkey AS BIGINT) AS point_id,
         ((CAST(n_nationkey AS BIGINT) * 6133 + 411) % 1801 - 900) / 10e0 AS latitude,
         ((CAST(n_nationkey AS BIGINT) * 70001 + 77) % 3601 - 1800) / 10e0 AS longitude,
         (CAST(n_nationkey AS BIGINT) * 37 % 700) * 1e0 AS depth
  FROM nation),
places AS (
  SELECT s_suppkey AS place_id,
         (((s_suppkey * 7919) % 1801) - 900) / 10e0 AS latitude,
         (((s_suppkey * 104729) % 3601) - 1800) / 10e0 AS longitude,
         CASE WHEN s_suppkey % 4 = 0 THEN s_name END AS city,
         CASE WHEN s_suppkey % 4 = 1 THEN s_name END AS town,
         CASE WHEN s_suppkey % 4 = 2 THEN s_name END AS village,
         n_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
feed AS ({_raw_select('WHERE o_orderkey % 5 = 0')})
"""


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2))"
    )
    return f"(2 * 6371.0088e0 * asin(sqrt(least({a}, 1e0))))"


def _r(x: str, p: int = 6) -> str:
    """Round as the Spark side does: integer-scale rounding of the binary value."""
    return f"(round(({x}) * 1e{p}) / 1e{p} + 0e0)"


def _avg(x: str, p: int = 6, scale: int = 12) -> str:
    """Exact mean of values with at most ``scale`` decimals, rounded half away
    from zero to ``p`` places, in integer arithmetic."""
    s = f"sum(CAST(CAST({x} AS DECIMAL(20, {scale})) * 1000000000000 AS HUGEINT))"
    n = f"nullif(CAST(count({x}) AS HUGEINT) * {10 ** (scale - p)}, 0)"
    return f"(CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DOUBLE) / 1e{p} + 0e0)"


_CURATED_COLS = ', '.join(
    ['"Date"', _r('"Latitude"') + ' AS "Latitude"', _r('"Longitude"') + ' AS "Longitude"', '"Type"',
     _r('"Depth"') + ' AS "Depth"', _r('"Magnitude"') + ' AS "Magnitude"', '"ID"', '"Year"', '"Network"']
)

_TILE_N = 4  # 2 ** zoom, zoom 2
_TILE_X = f"least(CAST(floor(({'"Longitude"'} + 180e0) / 360e0 * {_TILE_N}e0) AS BIGINT), {_TILE_N - 1})"
_ON_MAP = 'radians(greatest(least("Latitude", 85.0511287798066e0), -85.0511287798066e0))'
_TILE_Y = (
    f"greatest(least(CAST(floor((1e0 - ln(tan({_ON_MAP}) + 1e0 / cos({_ON_MAP})) / pi()) / 2e0"
    f" * {_TILE_N}e0) AS BIGINT), {_TILE_N - 1}), 0)"
)

SQL: dict[str, str] = {
    "scan_catalog": f"SELECT {_CURATED_COLS} FROM curated",
    "scan_type_filter": f"SELECT {_CURATED_COLS} FROM quakes",
    "project_catalog": 'SELECT "Date", "Latitude", "Longitude", "Type", "Depth", "Magnitude", "ID", "Network" FROM raw',
    "catalog_columns": 'SELECT "Date", "Latitude", "Longitude", "Type", "Depth", "Magnitude", "ID" FROM raw',
    "harmonize_feed": f"""SELECT "Date", {_r(_dbl('"Latitude"'))} AS "Latitude", {_r(_dbl('"Longitude"'))} AS "Longitude",
        {_r(_dbl('"Magnitude"'))} AS "Magnitude", {_r(_dbl('"Depth"'))} AS "Depth" FROM raw""",
    "parse_year": f'SELECT "ID", "Date", {_YEAR_DMY} AS "Year_dmy", {_YEAR_ANY} AS "Year" FROM raw',
    "coerce_numeric": f"""SELECT "ID", {_r(_dbl('"Latitude"'))} AS "Latitude", {_r(_dbl('"Longitude"'))} AS "Longitude",
        {_r(_dbl('"Depth"'))} AS "Depth", {_r(_dbl('"Magnitude"'))} AS "Magnitude" FROM raw""",
    "clean_catalog": f"SELECT {_CURATED_COLS} FROM curated",
    "clean_subset": f"""SELECT {_CURATED_COLS} FROM typed WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL
        AND "Depth" IS NOT NULL AND "Magnitude" IS NOT NULL AND "Year" IS NOT NULL""",
    "reject_points": f"""SELECT "ID", {_r(_dbl('"Latitude"'))} AS latitude, {_r(_dbl('"Longitude"'))} AS longitude,
        {_r(_dbl('"Depth"'))} AS depth,
        ({_dbl('"Latitude"')} IS NOT NULL AND {_dbl('"Longitude"')} IS NOT NULL AND {_dbl('"Depth"')} IS NOT NULL) AS is_valid
        FROM raw""",
    "preview": f'SELECT {_CURATED_COLS} FROM curated ORDER BY "ID" LIMIT 5',
    "yearly_stats": f"""SELECT * FROM (
        SELECT "Year", count(*) AS "Counts", {_avg('"Magnitude"')} AS "Avg_Magnitude",
               {_r('max("Magnitude")')} AS "Max_Magnitude"
        FROM (SELECT {_YEAR_ANY} AS "Year", {_dbl('"Magnitude"')} AS "Magnitude" FROM raw) GROUP BY "Year")
        WHERE "Year" IS NOT NULL AND "Avg_Magnitude" IS NOT NULL AND "Max_Magnitude" IS NOT NULL""",
    "yearly_stats_clean": f"""SELECT "Year", count(*) AS "Counts", {_avg('"Magnitude"')} AS "Avg_Magnitude",
        {_r('max("Magnitude")')} AS "Max_Magnitude" FROM curated GROUP BY "Year\"""",
    "trend_stats": f"""SELECT "Year", count("ID") AS "Total_Earthquakes", {_r('max("Magnitude")')} AS "Max_Magnitude",
        {_avg('"Magnitude"')} AS "Avg_Magnitude" FROM base GROUP BY "Year\"""",
    "yearly_counts": 'SELECT "Year", count(*) AS "Count" FROM curated WHERE "Year" IS NOT NULL GROUP BY "Year" ORDER BY "Year"',
    "type_counts": """SELECT "Type", count(*) AS "Count" FROM base WHERE "Type" IS NOT NULL GROUP BY "Type"
        ORDER BY "Count" DESC, "Type\"""",
    "type_share": f"""SELECT "Type", "Count", {_r('"Count" * 100e0 / sum("Count") OVER ()')} AS "Share" FROM (
        SELECT "Type", count(*) AS "Count" FROM base WHERE "Type" IS NOT NULL GROUP BY "Type")""",
    "kpi_home": f"""SELECT total_earthquakes, unique_years,
        {_r('CASE WHEN unique_years > 0 THEN total_earthquakes / unique_years ELSE 0e0 END')} AS average_yearly,
        coalesce(average_magnitude, 0e0) AS average_magnitude, {_r('coalesce(max_depth, 0e0)')} AS max_depth,
        unique_types FROM (
        SELECT count(*) AS total_earthquakes, count(DISTINCT "Year") AS unique_years,
               {_avg('"Magnitude"')} AS average_magnitude, max("Depth") AS max_depth, count(DISTINCT "Type") AS unique_types
        FROM curated)""",
    "kpi_year": f"""SELECT count(*) AS total_earthquakes, {_r('min("Magnitude")')} AS min_magnitude,
        {_r('max("Magnitude")')} AS max_magnitude, {_avg('"Magnitude"')} AS avg_magnitude FROM latest""",
    "kpi_empty": f"""SELECT total_earthquakes, unique_years,
        {_r('CASE WHEN unique_years > 0 THEN total_earthquakes / unique_years ELSE 0e0 END')} AS average_yearly,
        coalesce(average_magnitude, 0e0) AS average_magnitude, {_r('coalesce(max_depth, 0e0)')} AS max_depth,
        unique_types FROM (
        SELECT count(*) AS total_earthquakes, count(DISTINCT "Year") AS unique_years,
               {_avg('"Magnitude"')} AS average_magnitude, max("Depth") AS max_depth, count(DISTINCT "Type") AS unique_types
        FROM curated WHERE "Year" = (SELECT min("Year") - 1 FROM curated))""",
    "year_options": 'SELECT DISTINCT "Year" FROM curated WHERE "Year" IS NOT NULL ORDER BY "Year" DESC',
    "year_slice": f"SELECT {_CURATED_COLS} FROM latest",
    "year_range": f"SELECT {_CURATED_COLS} FROM in_range",
    "default_year_range": "SELECT min_year, max_year, range_lo, range_hi FROM bounds",
    "top_quakes": f"SELECT {_CURATED_COLS} FROM top",
    "severity_extremes": f"""SELECT role, "ID", "Date", {_r('"Magnitude"')} AS "Magnitude", {_r('"Depth"')} AS "Depth",
        {_r('"Latitude"')} AS "Latitude", {_r('"Longitude"')} AS "Longitude" FROM extremes""",
    "top_remaining": f"SELECT {_CURATED_COLS} FROM remaining",
    "top_centroid": f"""SELECT {_avg('"Latitude"')} AS avg_latitude, {_avg('"Longitude"')} AS avg_longitude FROM top""",
    "magnitude_histogram": f"""SELECT bin, {_r('bin * 0.1e0')} AS bin_start, {_r('(bin + 1) * 0.1e0')} AS bin_end, count(*) AS "Count"
        FROM (SELECT CAST(floor(round("Magnitude" / 0.1e0, 9)) AS BIGINT) AS bin FROM base WHERE "Magnitude" IS NOT NULL)
        GROUP BY bin""",
    "histogram_fitted": f"""SELECT bin, {_r('bin * width')} AS bin_start, {_r('(bin + 1) * width')} AS bin_end, count(*) AS "Count"
        FROM (SELECT CAST(floor(round(x / width, 9)) AS BIGINT) AS bin, width
              FROM (SELECT "Magnitude" AS x FROM base WHERE "Magnitude" IS NOT NULL), (
                SELECT unit * CASE WHEN raw / unit < 1.5e0 THEN 1e0 WHEN raw / unit < 3.5e0 THEN 2e0 WHEN raw / unit < 7.5e0 THEN 5e0 ELSE 10e0 END AS width
                FROM (SELECT raw, pow(10e0, floor(log10(raw))) AS unit FROM (
                  SELECT CASE WHEN q3 > q1 THEN 2e0 * (q3 - q1) / pow(n::DOUBLE, 1e0 / 3e0)
                              WHEN high > low THEN (high - low) / (1e0 + log2(n::DOUBLE)) ELSE 1e0 END AS raw
                  FROM (SELECT count(*) AS n, quantile_disc("Magnitude", 0.25) AS q1, quantile_disc("Magnitude", 0.75) AS q3,
                               min("Magnitude") AS low, max("Magnitude") AS high FROM base WHERE "Magnitude" IS NOT NULL)))))
        GROUP BY bin, width""",
    "trend_line": f"""SELECT {_r('regr_slope("Magnitude", "Longitude")', 9)} AS slope,
        {_r('regr_intercept("Magnitude", "Longitude")', 9)} AS intercept,
        CAST(regr_count("Magnitude", "Longitude") AS BIGINT) AS n FROM in_range""",
    "trend_fitted": f"""SELECT "ID", {_r('"Longitude"')} AS "Longitude", {_r('"Magnitude"')} AS "Magnitude",
        {_r('f.slope * "Longitude" + f.intercept')} AS fitted
        FROM in_range, (SELECT regr_slope("Magnitude", "Longitude") AS slope,
                               regr_intercept("Magnitude", "Longitude") AS intercept FROM in_range) f""",
    "trend_rmse": f"""SELECT {_r('sqrt(avg(("Magnitude" - (f.slope * "Longitude" + f.intercept)) * ("Magnitude" - (f.slope * "Longitude" + f.intercept))))')} AS rmse,
        count(*) AS n
        FROM in_range, (SELECT regr_slope("Magnitude", "Longitude") AS slope,
                               regr_intercept("Magnitude", "Longitude") AS intercept FROM in_range) f""",
    "correlations": f"""SELECT {_r('corr("Latitude", "Magnitude")', 9)} AS corr_latitude,
        {_r('corr("Longitude", "Magnitude")', 9)} AS corr_longitude,
        {_r('corr("Depth", "Magnitude")', 9)} AS corr_depth FROM base""",
    "scatter_points": f"""SELECT "ID", {_r('"Latitude"')} AS "Latitude", {_r('"Longitude"')} AS "Longitude",
        {_r('"Depth"')} AS "Depth", {_r('"Magnitude"')} AS "Magnitude", {_r('"Depth" * 10e0')} AS size FROM in_range""",
    "depth_scaled": f"""SELECT "ID", {_r('"Depth"')} AS "Depth", {_r('"Magnitude"')} AS "Magnitude",
        {_r('CASE WHEN b.hi - b.lo > 0 THEN 20e0 + 180e0 * ("Depth" - b.lo) / (b.hi - b.lo) ELSE 20e0 END')} AS size
        FROM base, (SELECT min("Depth") AS lo, max("Depth") AS hi FROM base) b WHERE "Depth" IS NOT NULL""",
    "marker_table": f"""SELECT role, "ID", {_r('"Latitude"')} AS "Latitude", {_r('"Longitude"')} AS "Longitude",
        {_r('"Magnitude"')} AS "Magnitude", "Date",
        CASE role WHEN 'most' THEN 'red' WHEN 'least' THEN 'blue' ELSE 'orange' END AS colour,
        CASE WHEN role IN ('most', 'least') THEN 12 ELSE 5 END AS radius,
        CASE role WHEN 'most' THEN 'Most Severe Earthquake' WHEN 'least' THEN 'Least Severe Earthquake'
             ELSE 'Magnitude' END || ': ' || CAST("Magnitude" AS VARCHAR) || ' | Date: ' || "Date" AS popup
        FROM (SELECT role, "ID", "Latitude", "Longitude", "Magnitude", "Date" FROM extremes
              UNION ALL SELECT 'other', "ID", "Latitude", "Longitude", "Magnitude", "Date" FROM remaining)""",
    "map_clusters": f"""SELECT tile_x, tile_y, count(*) AS "Count", {_avg('"Latitude"')} AS center_latitude,
        {_avg('"Longitude"')} AS center_longitude, {_r('max("Magnitude")')} AS max_magnitude, 2 AS zoom
        FROM (SELECT {_TILE_X} AS tile_x, {_TILE_Y} AS tile_y, * FROM latest)
        GROUP BY tile_x, tile_y""",
    "nearest_hav": f"""SELECT point_id, "ID", "Magnitude", "Latitude", "Longitude", km FROM (
        SELECT p.point_id, q."ID", q."Magnitude", q."Latitude", q."Longitude", {_r(_hav('p.latitude', 'p.longitude', 'q."Latitude"', 'q."Longitude"'))} AS km,
               row_number() OVER (PARTITION BY p.point_id ORDER BY
                   {_r(_hav('p.latitude', 'p.longitude', 'q."Latitude"', 'q."Longitude"'))}, q."ID") AS rn
        FROM points p, quakes q) WHERE rn = 1""",
    "place_labels": f"""SELECT "Latitude", "Longitude", place_id, label, km FROM (
        SELECT c."Latitude", c."Longitude", g.place_id,
               CASE WHEN coalesce(g.city, g.town, g.village) IS NOT NULL
                    THEN coalesce(g.city, g.town, g.village) || ', ' || coalesce(g.country, 'Unknown')
                    ELSE coalesce(g.country, 'Unknown') END AS label,
               {_r(_hav('c."Latitude"', 'c."Longitude"', 'g.latitude', 'g.longitude'))} AS km,
               row_number() OVER (PARTITION BY c."Latitude", c."Longitude" ORDER BY
                   {_r(_hav('c."Latitude"', 'c."Longitude"', 'g.latitude', 'g.longitude'))}, g.place_id) AS rn
        FROM (SELECT DISTINCT "Latitude", "Longitude" FROM latest) c, places g) WHERE rn = 1""",
}

SQL["year_markers"] = f"""SELECT l."ID", {_r('l."Latitude"')} AS "Latitude", {_r('l."Longitude"')} AS "Longitude",
    {_r('l."Magnitude"')} AS "Magnitude", {_r('least(l."Magnitude" * 2e0, 10e0)')} AS radius, 'orange' AS colour,
    'Magnitude: ' || CAST(l."Magnitude" AS VARCHAR) || ' | Location: ' || coalesce(p.label, 'Unknown Location') AS popup
    FROM latest l LEFT JOIN ({SQL["place_labels"]}) p
    ON l."Latitude" = p."Latitude" AND l."Longitude" = p."Longitude"
"""


# Vincenty (1975) on WGS-84 for every (point, event) pair by brute force: a
# recursive CTE iterates lambda per pair and freezes the pair's terms in the
# iteration where it converges (|new - old| < 1e-12, at most 200 rounds);
# nearly antipodal pairs, which never converge, have no distance: they are
# farther than any pair that does.
_F = "(1e0 / 298.257223563e0)"
_A = "6378137e0"
_B = f"((1e0 - {_F}) * {_A})"


def _vincenty_nearest(points_where: str = "", text: str = "") -> str:
    return f""",
vpairs AS (
  SELECT p.point_id, q."ID", q."Date", q."Magnitude", q."Depth", q."Latitude", q."Longitude",
         {_hav('p.latitude', 'p.longitude', 'q."Latitude"', 'q."Longitude"')} AS hav_km,
         radians(q."Longitude") - radians(p.longitude) AS big_l,
         atan((1e0 - {_F}) * tan(radians(p.latitude))) AS u1,
         atan((1e0 - {_F}) * tan(radians(q."Latitude"))) AS u2
  FROM (SELECT * FROM points {points_where}) p, quakes q
  WHERE p.latitude IS NOT NULL AND p.longitude IS NOT NULL),
vstart AS (SELECT point_id, "ID", big_l, sin(u1) AS su1, cos(u1) AS cu1, sin(u2) AS su2, cos(u2) AS cu2 FROM vpairs),
vit AS (
  SELECT point_id, "ID", big_l, su1, cu1, su2, cu2, big_l AS lam, 0 AS it, false AS done,
         0e0 AS sin_s, 0e0 AS cos_s, 0e0 AS sig, 0e0 AS cos2a, 0e0 AS cos2sm
  FROM vstart
  UNION ALL
  SELECT point_id, "ID", big_l, su1, cu1, su2, cu2, nw, it + 1, abs(nw - lam) < 1e-12, s_s, c_s, sg, c2a, c2sm
  FROM (
    SELECT *, big_l + (1e0 - c) * {_F} * sin_a * (sg + c * s_s * (c2sm + c * c_s * (-1e0 + 2e0 * (c2sm * c2sm)))) AS nw
    FROM (
      SELECT *, {_F} / 16e0 * c2a * (4e0 + {_F} * (4e0 - 3e0 * c2a)) AS c
      FROM (
        SELECT *, CASE WHEN c2a = 0 THEN 0e0 ELSE c_s - 2e0 * su1 * su2 / c2a END AS c2sm
        FROM (
          SELECT *, 1e0 - sin_a * sin_a AS c2a
          FROM (
            SELECT *, atan2(s_s, c_s) AS sg, CASE WHEN s_s = 0 THEN 0e0 ELSE cu1 * cu2 * sl / s_s END AS sin_a
            FROM (
              SELECT *, sqrt((cu2 * sl) * (cu2 * sl) + (cu1 * su2 - su1 * cu2 * cl) * (cu1 * su2 - su1 * cu2 * cl)) AS s_s,
                     su1 * su2 + cu1 * cu2 * cl AS c_s
              FROM (SELECT point_id, "ID", big_l, su1, cu1, su2, cu2, lam, it, sin(lam) AS sl, cos(lam) AS cl
                    FROM vit WHERE NOT done AND it < 200)))))))),
vend AS (
  SELECT point_id, "ID", done, sin_s, cos_s, sig, cos2sm,
         cos2a * ({_A} * {_A} - {_B} * {_B}) / ({_B} * {_B}) AS u_sq
  FROM vit WHERE done OR it = 200),
vdist AS (
  SELECT point_id, "ID",
         CASE WHEN done THEN (CASE WHEN sin_s = 0 THEN 0e0 ELSE {_B} * big_a * (sig - d_sig) END) / 1000e0 END AS gkm
  FROM (
    SELECT *, big_b * sin_s * (cos2sm + big_b / 4e0 * (cos_s * (-1e0 + 2e0 * (cos2sm * cos2sm))
              - big_b / 6e0 * cos2sm * (-3e0 + 4e0 * (sin_s * sin_s)) * (-3e0 + 4e0 * (cos2sm * cos2sm)))) AS d_sig
    FROM (
      SELECT *, 1e0 + u_sq / 16384e0 * (4096e0 + u_sq * (-768e0 + u_sq * (320e0 - 175e0 * u_sq))) AS big_a,
             u_sq / 1024e0 * (256e0 + u_sq * (-128e0 + u_sq * (74e0 - 47e0 * u_sq))) AS big_b
      FROM vend))),
vranked AS (
  SELECT v.point_id, v."ID", v."Date", v."Magnitude", v."Depth", v."Latitude", v."Longitude", d.gkm AS km,
         row_number() OVER (PARTITION BY v.point_id ORDER BY {_r('d.gkm')}, v."ID") AS rn
  FROM vpairs v JOIN vdist d ON v.point_id = d.point_id AND v."ID" = d."ID")
SELECT point_id, "ID", "Date", "Magnitude", "Depth", "Latitude", "Longitude", {_r('km')} AS km{text} FROM vranked WHERE rn = 1
"""


# Ordinary least squares of Magnitude on (Latitude, Longitude, Depth): Spark's
# LinearRegression with its defaults (no regularisation) solves the normal
# equations, so its predictions equal the closed form below up to solver
# rounding; predictions are compared at 4 decimals.
_LR_TRAIN = f"""train_raw AS ({_raw_select('WHERE o_orderkey % 5 <> 0')}),
train_typed AS ({_typed('train_raw')}),
train AS (SELECT "Latitude" AS x1, "Longitude" AS x2, "Depth" AS x3, "Magnitude" AS y
          FROM train_typed WHERE {_NOT_NULL}),
mom AS (
  SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my,
         var_pop(x1) AS a, covar_pop(x1, x2) AS b, covar_pop(x1, x3) AS c,
         var_pop(x2) AS d, covar_pop(x2, x3) AS e, var_pop(x3) AS f,
         covar_pop(x1, y) AS g1, covar_pop(x2, y) AS g2, covar_pop(x3, y) AS g3
  FROM train),
inv AS (
  SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - d * c) AS det FROM mom),
coef AS (
  SELECT m1, m2, m3, my,
         ((d * f - e * e) * g1 + (c * e - b * f) * g2 + (b * e - c * d) * g3) / det AS w1,
         ((c * e - b * f) * g1 + (a * f - c * c) * g2 + (b * c - a * e) * g3) / det AS w2,
         ((b * e - c * d) * g1 + (b * c - a * e) * g2 + (a * d - b * b) * g3) / det AS w3
  FROM inv),
test AS (
  SELECT {_dbl('"Latitude"')} AS "Latitude", {_dbl('"Longitude"')} AS "Longitude",
         {_dbl('"Depth"')} AS "Depth", {_dbl('"Magnitude"')} AS "Magnitude" FROM feed)
"""

SQL_LR = f""",
{_LR_TRAIN}
SELECT {_r('t."Latitude"')} AS "Latitude", {_r('t."Longitude"')} AS "Longitude", {_r('t."Depth"')} AS "Depth",
       {_r('t."Magnitude"')} AS "Magnitude",
       {_r('k.my + k.w1 * (t."Latitude" - k.m1) + k.w2 * (t."Longitude" - k.m2) + k.w3 * (t."Depth" - k.m3)', 4)} AS prediction
FROM test t, coef k
WHERE t."Latitude" IS NOT NULL AND t."Longitude" IS NOT NULL AND t."Depth" IS NOT NULL AND t."Magnitude" IS NOT NULL
"""

# The three-aggregate plan must give the merged aggregate's rows.
SQL["yearly_join"] = SQL["yearly_stats"]


RECURSIVE_SQL = {
    "nearest_batch": _vincenty_nearest(),
    "nearest_one": _vincenty_nearest("WHERE point_id = (SELECT min(point_id) FROM points)"),
    "nearest_text": _vincenty_nearest(
        text=""", 'Magnitude: ' || CAST("Magnitude" AS VARCHAR) || ' | Date: ' || "Date" AS popup"""
    ),
}

# Points the search must not trip over: repeated keys, NaN and missing
# coordinates, and points on the far side of the globe from the events.
SQL["nearest_edge"] = f"""SELECT point_id, "ID", "Latitude", "Longitude", CASE WHEN "ID" IS NOT NULL THEN km END AS km FROM (
    SELECT p.rid, p.point_id, q."ID", q."Latitude", q."Longitude",
           {_r(_hav('p.latitude', 'p.longitude', 'q."Latitude"', 'q."Longitude"'))} AS km,
           row_number() OVER (PARTITION BY p.rid ORDER BY
               {_r(_hav('p.latitude', 'p.longitude', 'q."Latitude"', 'q."Longitude"'))}, q."ID") AS rn
    FROM (SELECT point_id AS rid, point_id % 10 AS point_id,
                 CASE WHEN point_id % 5 = 1 OR point_id % 5 = 2 THEN NULL
                      WHEN point_id % 5 = 3 THEN -(latitude / 90e0) - 45e0 ELSE latitude END AS latitude,
                 CASE WHEN point_id % 5 = 3 THEN longitude / 180e0 - 120e0 ELSE longitude END AS longitude FROM points) p
    LEFT JOIN quakes q ON p.latitude IS NOT NULL) WHERE rn = 1"""

# Labels of the two extremes' positions, and the line over the whole catalogue.
SQL["extremes_labelled"] = f"""SELECT role, "ID", "Date", {_r('"Magnitude"')} AS "Magnitude", {_r('"Depth"')} AS "Depth",
    {_r('"Latitude"')} AS "Latitude", {_r('"Longitude"')} AS "Longitude", label FROM (
    SELECT e.*, CASE WHEN coalesce(g.city, g.town, g.village) IS NOT NULL
                     THEN coalesce(g.city, g.town, g.village) || ', ' || coalesce(g.country, 'Unknown')
                     ELSE coalesce(g.country, 'Unknown') END AS label,
           row_number() OVER (PARTITION BY e.role ORDER BY
               {_r(_hav('e."Latitude"', 'e."Longitude"', 'g.latitude', 'g.longitude'))}, g.place_id) AS rn
    FROM extremes e, places g) WHERE rn = 1"""
SQL["trend_line_all"] = SQL["trend_line"].replace("FROM in_range", "FROM base")

# Round trips through files give back what went in.
SQL["document_scan"] = SQL["scan_type_filter"]
SQL["csv_strings"] = 'SELECT "ID", "Date", "Latitude", "Longitude", "Depth", "Magnitude", "Type", "Network" FROM raw'
SQL["csv_typed"] = f"""SELECT "ID", "Date", {_r(_dbl('"Latitude"'))} AS "Latitude", {_r(_dbl('"Longitude"'))} AS "Longitude",
    {_r(_dbl('"Depth"'))} AS "Depth", {_r(_dbl('"Magnitude"'))} AS "Magnitude", "Type", "Network" FROM raw"""
SQL["csv_export"] = SQL["year_slice"]
SQL["stored_yearly_stats"] = SQL["yearly_stats"]
SQL["store_key_dropped"] = SQL["scan_catalog"]
SQL["strict_cast"] = f"""SELECT "ID", {_r('"Latitude"')} AS "Latitude", {_r('"Longitude"')} AS "Longitude",
    {_r('"Depth"')} AS "Depth", {_r('"Magnitude"')} AS "Magnitude" FROM curated"""
SQL["kpi_text"] = f"""SELECT CAST(total_earthquakes AS VARCHAR) AS total, {{even}} AS average_yearly,
    printf('%.2f', average_magnitude) AS average_magnitude, printf('%.2f', max_depth) AS max_depth
    FROM (SELECT count(*) AS total_earthquakes, count(DISTINCT "Year") AS years, {_avg('"Magnitude"')} AS average_magnitude,
                 max("Depth") AS max_depth FROM curated)""".replace(
    "{even}", "round_even(CAST(total_earthquakes AS DOUBLE) / years, 2)"
)


# The linear model again: its prediction table with the RMSE on the feed, the
# feed's metrics, the points' scores.
_LR_ERR = f"""err AS (
  SELECT sqrt(avg((t."Magnitude" - p) * (t."Magnitude" - p))) AS rmse, count(*) AS n
  FROM (SELECT t.*, k.my + k.w1 * (t."Latitude" - k.m1) + k.w2 * (t."Longitude" - k.m2) + k.w3 * (t."Depth" - k.m3) AS p
        FROM test t, coef k WHERE t."Latitude" IS NOT NULL AND t."Longitude" IS NOT NULL AND t."Depth" IS NOT NULL
          AND t."Magnitude" IS NOT NULL) t)"""
LR_SQL = {
    "lr_predict": SQL_LR,
    "stored_model": SQL_LR,
    "lr_metrics": f""",
{_LR_TRAIN},
{_LR_ERR}
SELECT 'LinearRegression' AS model, {_r('rmse', 4)} AS rmse, rmse < 0.5e0 AS accepted FROM err""",
    "lr_prediction_table": f""",
{_LR_TRAIN},
{_LR_ERR}
SELECT {_r('t."Latitude"')} AS "Latitude", {_r('t."Longitude"')} AS "Longitude",
       {_r('k.my + k.w1 * (t."Latitude" - k.m1) + k.w2 * (t."Longitude" - k.m2) + k.w3 * (t."Depth" - k.m3)', 4)} AS "Pred_Magnitude",
       2017 AS "Year", {_r('err.rmse', 4)} AS "RMSE"
FROM test t, coef k, err
WHERE t."Latitude" IS NOT NULL AND t."Longitude" IS NOT NULL AND t."Depth" IS NOT NULL AND t."Magnitude" IS NOT NULL""",
    "lr_score_points": f""",
{_LR_TRAIN}
SELECT t.point_id, {_r('t.latitude')} AS "Latitude", {_r('t.longitude')} AS "Longitude", {_r('t.depth')} AS "Depth",
       {_r('k.my + k.w1 * (t.latitude - k.m1) + k.w2 * (t.longitude - k.m2) + k.w3 * (t.depth - k.m3)', 4)} AS "Pred_Magnitude"
FROM points t, coef k""",
}
LR_SQL["stored_predictions"] = LR_SQL["lr_prediction_table"]


# Tree models, trained in SQL from the same rules (``oracle_trees``).
_ASK = f"""{_LR_TRAIN.rstrip()},
asked AS (SELECT "Latitude" AS x1, "Longitude" AS x2, "Depth" AS x3, "Magnitude" AS y FROM test
          WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND "Depth" IS NOT NULL AND "Magnitude" IS NOT NULL)"""
_TREE = f",\n{_ASK}{trees.prepared('asked')},\n"
_TREE_POINTS = f"""{_LR_TRAIN.rstrip()},
asked AS (SELECT point_id, latitude AS x1, longitude AS x2, depth AS x3 FROM points)"""


def _tree_rows(name: str) -> str:
    return f"""SELECT {_r('x1')} AS "Latitude", {_r('x2')} AS "Longitude", {_r('x3')} AS "Depth", {_r('y')} AS "Magnitude",
  {_r('p', 4)} AS prediction FROM ask JOIN {name}_pred USING (id)"""


_COMPARED = f"""{_TREE}{trees.forest()},
{trees.single()},
{trees.boosted()},
lr_pred AS (SELECT id, k.my + k.w1 * (x1 - k.m1) + k.w2 * (x2 - k.m2) + k.w3 * (x3 - k.m3) AS p FROM ask, coef k),
compared AS (
  SELECT pos, model, sqrt(avg((y - p) * (y - p))) AS rmse FROM (
    SELECT 0 AS pos, 'RandomForest' AS model, * FROM rf_pred UNION ALL SELECT 1, 'LinearRegression', * FROM lr_pred
    UNION ALL SELECT 2, 'DecisionTree', * FROM dt_pred UNION ALL SELECT 3, 'GBT', * FROM gb_pred) JOIN ask USING (id) GROUP BY ALL)
SELECT pos, model, {_r('rmse', 4)} AS rmse, rmse < 0.5e0 AS accepted FROM compared"""

TREE_SQL = {
    "rf_predict": f"{_TREE}{trees.forest()}\n{_tree_rows('rf')}",
    "dt_predict": f"{_TREE}{trees.single()}\n{_tree_rows('dt')}",
    "gbt_predict": f"{_TREE}{trees.boosted()}\n{_tree_rows('gb')}",
    "model_compare": _COMPARED,
    "model_select": f"{_COMPARED} ORDER BY compared.rmse, pos LIMIT 1",
    "prediction_table": f"""{_TREE}{trees.forest()}
SELECT {_r('x1')} AS "Latitude", {_r('x2')} AS "Longitude", {_r('p', 4)} AS "Pred_Magnitude", 2017 AS "Year", {_r('rmse', 4)} AS "RMSE"
FROM ask JOIN rf_pred USING (id), (SELECT sqrt(avg((y - p) * (y - p))) AS rmse FROM ask JOIN rf_pred USING (id))""",
    "score_points": f""",
{_TREE_POINTS}{trees.prepared('asked')},
{trees.forest()}
SELECT point_id, {_r('x1')} AS "Latitude", {_r('x2')} AS "Longitude", {_r('x3')} AS "Depth", {_r('p', 4)} AS "Pred_Magnitude"
FROM ask JOIN rf_pred USING (id)""",
}
TREE_SQL["stored_forest"] = TREE_SQL["rf_predict"]


def oracle_sql() -> dict[str, str]:
    out = {k: BASE + v for k, v in SQL.items()}
    rec = BASE.replace("WITH\n", "WITH RECURSIVE\n", 1).rstrip()
    out.update({k: rec + v for k, v in RECURSIVE_SQL.items()})
    out.update({k: BASE.rstrip() + v for k, v in {**LR_SQL, **TREE_SQL}.items()})
    out.update(type_sql(_raw_select, BASE, _r, schema.CATALOG_COLUMNS))
    return out

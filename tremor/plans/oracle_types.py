"""DuckDB SQL of the queries on date layouts, inferred types, the column guard and distinct counts."""

from __future__ import annotations

# The fixture's columns of every type and its dates in every layout (see ``sources.fixture``).
_DATE = """CASE WHEN o_orderkey % 101 = 0 THEN '31/31/1999' WHEN o_orderkey % 103 = 0 THEN NULL
    WHEN o_orderkey % 109 = 0 THEN 'soon' WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y%m%d')
    WHEN o_custkey % 11 < 4 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN o_custkey % 11 < 6 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN o_custkey % 11 = 6 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN o_custkey % 11 = 7 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:30:00-02:00'
    WHEN o_custkey % 11 = 8 THEN strftime(o_orderdate, '%-d %b %Y')
    WHEN o_custkey % 11 = 9 THEN strftime(o_orderdate, '%d/%m/%y')
    ELSE strftime(o_orderdate, '%B %-d, %Y') END"""
_LOOSE = """CAST(o_orderkey AS VARCHAR) AS "Key",
    CASE WHEN o_orderkey % 5 = 0 THEN 'NA' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Day",
    strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 2 = 0 THEN ' 12:30:00' ELSE '' END AS "Seen",
    CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'False' ELSE 'n/a' END AS "Felt",
    CASE WHEN o_orderkey % 1000 = 7 THEN '1,5' ELSE CAST(o_orderkey AS VARCHAR) END AS "Odd",
    ' ' AS "Blank" """


def _numeric(order: str) -> str:
    return f"""CASE WHEN regexp_full_match(t, '\\d\\d/\\d\\d/\\d{{4}}') THEN try_strptime(t, '{order}/%Y')
        WHEN regexp_full_match(t, '\\d\\d/\\d\\d/\\d\\d') THEN try_strptime(t, '{order}/%y') END"""


def _dates(network: str, key: str) -> str:
    return f"""WITH src AS (SELECT {key} AS "ID", {network} AS "Network", {_DATE} AS t FROM orders),
read AS (
  SELECT *, {_numeric('%d/%m')} AS dm, {_numeric('%m/%d')} AS md,
    CASE WHEN regexp_full_match(t, '\\d{{8}}') THEN try_strptime(t, '%Y%m%d')
      WHEN regexp_full_match(t, '\\d{{4}}-\\d\\d-\\d\\d') THEN try_strptime(t, '%Y-%m-%d')
      WHEN t LIKE '%T%-02:00' THEN try_strptime(replace(t, '-02:00', ''), '%Y-%m-%dT%H:%M:%S') + INTERVAL 2 HOUR
      WHEN regexp_full_match(t, '\\d+ [A-Za-z]+ \\d{{4}}') THEN try_strptime(t, '%d %b %Y')
      WHEN regexp_full_match(t, '[A-Za-z]+ \\d+, \\d{{4}}') THEN try_strptime(t, '%B %d, %Y') END AS sure
  FROM src),
votes AS (
  SELECT "Network", count(dm) AS day_month, count(md) AS month_day,
    CASE WHEN count(dm) >= count(md) THEN 'day_month' ELSE 'month_day' END AS "order"
  FROM read GROUP BY "Network")"""


def _types(raw: str, names: list[str]) -> str:
    rows = []
    for n in names:
        kinds = {
            "boolean": "regexp_full_match(v, '(?i:true|false)')",
            "bigint": "regexp_full_match(v, '[+-]?\\d+') AND try_cast(v AS BIGINT) IS NOT NULL",
            "double": "regexp_full_match(v, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')",
            "date": "regexp_full_match(v, '\\d{4}-\\d\\d-\\d\\d') AND try_cast(v AS DATE) IS NOT NULL",
            "timestamp": "regexp_full_match(v, '\\d{4}-\\d\\d-\\d\\d( \\d\\d:\\d\\d:\\d\\d)?') AND try_cast(v AS TIMESTAMP) IS NOT NULL",
        }
        counts = ", ".join(f'count(CASE WHEN {test} THEN 1 END) AS "{k}"' for k, test in kinds.items())
        rows.append(
            f"""SELECT '{n}' AS name, count(v) AS n_values, count(*) - count(v) AS n_missing, {counts}
FROM (SELECT CASE WHEN trim("{n}") NOT IN ('', 'NA', 'N/A', 'n/a', 'NaN', 'nan', 'NULL', 'null') THEN trim("{n}") END AS v FROM loose)"""
        )
    choice = " ".join(f"""WHEN n_values > 0 AND "{k}" = n_values THEN '{k}'""" for k in ("boolean", "bigint", "double", "date", "timestamp"))
    union = "\nUNION ALL\n".join(rows)
    return f"""WITH loose AS ({raw})
SELECT *, CASE {choice} ELSE 'string' END AS type FROM ({union})"""


def type_sql(raw_select, base: str, rounded, catalog_columns: list[str]) -> dict[str, str]:
    """The statements, given the raw catalogue's SELECT, the common WITH clause, the rounding and its columns."""
    key = "'eq_' || CAST(o_orderkey AS VARCHAR)"
    network = "CASE WHEN o_orderkey % 107 <> 0 THEN 'net_' || CAST(o_custkey % 11 AS VARCHAR) END"
    found = _dates(network, key)
    plain = raw_select()
    loose = plain.replace("FROM orders", f""", strftime(o_orderdate, '%H:%M:%S') AS "Time", o_orderstatus AS "Status", {_LOOSE} FROM orders""")
    names = ["ID", "Date", "Latitude", "Longitude", "Depth", "Magnitude", "Type", "Time", "Status", "Network", "Key", "Day", "Seen", "Felt", "Odd", "Blank"]
    number = {c: rounded(f"try_cast(\"{c}\" AS DOUBLE)") for c in ("Latitude", "Longitude", "Depth", "Magnitude")}
    typed = ", ".join(f'{x} AS "{c}"' for c, x in number.items())
    return {
        "dates_any": f"""{found},
best AS (
  SELECT r."ID", r.t, coalesce(r.sure, CASE WHEN v."order" = 'day_month' THEN r.dm ELSE r.md END) AS ts
  FROM read r JOIN votes v ON r."Network" IS NOT DISTINCT FROM v."Network")
SELECT "ID", t AS "Date", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Instant", CAST(year(ts) AS INTEGER) AS "Year" FROM best""",
        "date_votes": f"{found} SELECT * FROM votes",
        "inferred_types": _types(loose, names),
        "csv_inferred": f"""WITH loose AS ({loose})
SELECT "ID", "Date", {typed}, "Type", "Network", CAST("Key" AS BIGINT) AS "Key",
  CASE WHEN "Day" <> 'NA' THEN "Day" END AS "Day", substr("Seen", 1, 10) || CASE WHEN length("Seen") = 10 THEN ' 00:00:00' ELSE substr("Seen", 11) END AS "Seen",
  CASE "Felt" WHEN 'true' THEN true WHEN 'False' THEN false END AS "Felt", "Odd",
  CASE WHEN trim("Blank") <> '' THEN "Blank" END AS "Blank" FROM loose""",
        "column_guard": f"""{base} SELECT 'catalogue' AS input, '' AS missing, count(*) AS passed FROM raw
UNION ALL SELECT 'without two', '{",".join(c for c in catalog_columns if c in ("Depth", "Type"))}', 0
UNION ALL SELECT 'feed', '{",".join(catalog_columns)}', 0""",
        "distinct_sketch": f"""{base}, span AS (
  SELECT unnest([("Year" - 2), ("Year" - 1), "Year"]) AS "First", "ID", "Network", "Type" FROM base)
SELECT "First", count(*) AS "Events", count(DISTINCT "Network") AS "Network", count(DISTINCT "Type") AS "Type",
  count(DISTINCT "ID") = count(*) AS ids_within
FROM span WHERE "First" IN (SELECT "Year" FROM base) GROUP BY "First" """,
    }

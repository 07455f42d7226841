"""Side-by-side check of the catalogue against its DuckDB oracles.

``python -m tremor.plans.verify [sf_dir] [name ...]`` runs each Spark query
and, where one exists, its oracle SQL, and compares row count, column names
and an order-insensitive multiset of rows.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


STRICT = False


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if STRICT else round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict:
    from tremor.plans.catalog import QUERIES
    from tremor.plans.oracle import oracle_sql

    sql = oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or QUERIES:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        cols = df.columns
        rows = [tuple(_norm(v) for v in r) for r in df.collect()]
        entry = {"rows": len(rows), "sec": round(time.time() - t0, 2)}
        if name in sql:
            cur = con.execute(sql[name])
            ocols = [d[0] for d in cur.description]
            orows = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
            entry["oracle_rows"] = len(orows)
            entry["columns_match"] = sorted(cols) == sorted(ocols)
            if entry["columns_match"]:
                idx = [ocols.index(c) for c in cols]
                orows = [tuple(r[i] for i in idx) for r in orows]
            entry["values_match"] = Counter(rows) == Counter(orows)
            if not entry["values_match"]:
                a, b = Counter(rows), Counter(orows)
                entry["only_spark"] = list((a - b).elements())[:3]
                entry["only_oracle"] = list((b - a).elements())[:3]
                entry["spark_cols"], entry["oracle_cols"] = cols, ocols
        report[name] = entry
        print(name, entry, flush=True)
    return report


def main(argv):
    from tremor.session import build_session

    global STRICT
    if "--strict" in argv:
        STRICT = True
        argv = [a for a in argv if a != "--strict"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or None
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    rep = compare(spark, sf_dir, names)
    bad = [k for k, v in rep.items() if "values_match" in v and not (v["values_match"] and v["columns_match"])]
    print("MISMATCH:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

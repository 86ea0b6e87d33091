"""Compares every query with its SQL on the driver tables. ``python tests/oracle.py [sf] [name ...]``"""

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def difference(spark, con, sf_dir, name, queries, oracle):
    """None when both sides agree in names, types, and rows as a multiset; else what differs."""
    df = queries[name](spark, sf_dir)
    names = sorted(df.columns)
    types = {c: DUCK.get(t, t) for c, t in df.dtypes}
    got = sorted(tuple(map(_plain, r)) for r in df.select(*[f"`{c}`" for c in names]).collect())
    if name not in oracle:
        return None if got else "no rows"
    cur = con.execute(oracle[name])
    described = {d[0]: str(d[1]) for d in cur.description}
    rows = cur.fetchall()
    if sorted(described) != names:
        return f"columns {names} vs {sorted(described)}"
    wrong = {c: (types[c], described[c]) for c in names if types[c] != described[c]}
    if wrong:
        return f"types {wrong}"
    at = [list(described).index(c) for c in names]
    want = sorted(tuple(_plain(r[i]) for i in at) for r in rows)
    if got != want:
        left, right = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} vs {len(want)} rows; e.g. {sorted(left)[:2]} vs {sorted(right)[:2]}"
    return None if got else "no rows"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name, entry.queries(), entry.oracle_sql())
        except Exception as e:  # noqa: BLE001 - reported per query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f} {name} {problem or ''}", flush=True)
    print(f"{len(chosen)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))

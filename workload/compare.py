"""Compare registered queries with their SQL in DuckDB: rows, column names, types, values.

Usage: python -m workload.compare SF_DIR [name ...]
"""

import sys
import time
from collections import Counter

import duckdb

from tallyhouse.session import build_session
from workload.bound import Bound
from workload.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def duck_type(kind):
    return TYPES.get(kind, kind.upper())


def differences(df, con, oracle):
    """Text of each difference between a DataFrame and the SQL's result."""
    result = con.execute(oracle)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = []
    for name, kind in df.dtypes:
        if duck_type(kind) != kinds[name].replace(", ", ","):
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    order = sorted(names)
    ours = Counter(tuple(r[c] for c in order) for r in df.collect())
    index = [names.index(c) for c in order]
    other = Counter(tuple(r[i] for i in index) for r in theirs)
    if ours != other:
        only_ours, only_theirs = ours - other, other - ours
        found.append(f"rows {ours.total()} vs {other.total()}; {only_ours.total()} only ours, {only_theirs.total()} only theirs")
        found.append(f"columns {order}")
        found += [f"ours   {r}" for r in sorted(only_ours, key=str)[:3]]
        found += [f"theirs {r}" for r in sorted(only_theirs, key=str)[:3]]
    return found


def main(sf_dir, names):
    spark = build_session("compare", master="local[8]", spark_sql_shuffle_partitions=8, spark_ui_enabled="false",
                          spark_driver_memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name, (build, oracle) in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            df = build(Bound(spark, sf_dir))
            found = differences(df, con, oracle) if oracle else [] if df.count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        label = "BAD " if found else "ok  " if oracle else "rows"
        print(f"{label} {name} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("       ", line[:1200], flush=True)
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))

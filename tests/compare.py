"""Run registered queries on Spark and their SQL on DuckDB and compare all values.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return ("number", str(value.normalize() + 0))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("number", str(Decimal(value).normalize() + 0))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    mine = multiset(df.columns, df.collect())
    result = connection.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    theirs = multiset(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if mine != theirs:
        return (
            f"{sum(mine.values())} rows against {sum(theirs.values())}; only Spark: "
            f"{list((mine - theirs).items())[:3]}; only SQL: {list((theirs - mine).items())[:3]}"
        )
    return None if mine else "no rows"


if __name__ == "__main__":
    from conftest import session

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = session(), connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or queries():
        start = time.time()
        if name not in oracle_sql():
            print(f"{name}: {queries()[name](spark, sf_dir).count()} rows, no SQL")
            continue
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # the run goes on, the failure is reported
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {problem or 'equal'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{bad} differ")

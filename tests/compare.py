"""Run registered queries beside their SQL counterparts and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in data)


def difference(spark, con, query, sql: str, folder: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, folder)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    names = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if names.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} vs {kinds[name]}"
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows(columns, result.fetchall())
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows, only ours "
        f"{list((ours - theirs).items())[:2]}, only theirs {list((theirs - ours).items())[:2]}"
    )


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from stockyard.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con, sql = local_session("compare"), sql_connection(folder), oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = difference(spark, con, query, sql[name], folder) or "same"
        except Exception as error:
            found = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        print(f"{name} {time.time() - start:.1f}s {found}", flush=True)

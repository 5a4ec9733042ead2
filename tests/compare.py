"""Compare a Spark result with its SQL counterpart as unordered rows, columns by name."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(value):
    return float(f"{value:.10g}") if isinstance(value, float) else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, otherwise what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = rows_of(names, cursor.fetchall())
    have = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = {d[0]: str(d[1]) for d in con.execute(sql).description}
    odd = {n: (k, types[n]) for n, k in spark_df.dtypes if kinds.get(k) != types[n].upper()}
    if odd:
        return f"types {odd}"
    if want != have:
        return f"{sum(have.values())} rows, expected {sum(want.values())}; unexpected {list((have - want))[:2]}; missing {list((want - have))[:2]}"
    return None

"""Run a query on Spark and its SQL on DuckDB and compare the rows, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in row) for row in df.select(*names).collect())


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def difference(left: Counter, right: Counter, n: int = 3) -> str:
    return (
        f"rows {sum(left.values())} / {sum(right.values())}; only Spark {list((left - right).items())[:n]}; "
        f"only SQL {list((right - left).items())[:n]}"
    )

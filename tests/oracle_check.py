"""Compare a Spark result with the SQL counterpart run by DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else round(value, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def difference(con, spark_df, sql: str) -> str | None:
    """None where both agree, else what differs."""
    names = spark_df.columns
    mine = _rows(names, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    other_names = [d[0] for d in cursor.description]
    other = _rows(other_names, cursor.fetchall())
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} != {sorted(other_names)}"
    if len(mine) != len(other):
        return f"{len(mine)} rows != {len(other)} rows"
    for a, b in zip(mine, other):
        if a != b:
            return f"{a} != {b}"
    return None

"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(type_name: str) -> str:
    t = str(type_name).lower()
    if t.startswith(("bool",)):
        return "bool"
    if any(t.startswith(p) for p in ("tinyint", "smallint", "int", "bigint", "long", "hugeint", "short", "byte")):
        return "int"
    if t.startswith(("double", "float", "decimal")):
        return "float"
    return "text" if t.startswith(("varchar", "string")) else t


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if hasattr(value, "tolist"):
        value = value.tolist()
    return tuple(plain(v) for v in value) if isinstance(value, (list, tuple)) else value


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows; else a short account."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if names != sorted(relation.columns):
        return f"columns {sorted(set(names) ^ set(relation.columns))}"
    ours = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {n: kind(t) for n, t in zip(relation.columns, relation.types)}
    wrong = {n: (ours[n], theirs[n]) for n in names if ours[n] != theirs[n]}
    if wrong:
        return f"types {wrong}"
    left = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    order = [relation.columns.index(n) for n in names]
    right = Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    key = lambda r: tuple(str(v) for v in r)
    return (f"rows {sum(left.values())} vs {sum(right.values())}; {names}; spark only "
            f"{sorted(only_left, key=key)[:2]}; sql only {sorted(only_right, key=key)[:2]}")

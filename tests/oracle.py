"""Runs a query on Spark and its statement on DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    # repr keeps 1, 1.0, True and '1' apart.
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def compare(spark_df, con, sql):
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    if sorted(duck_names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(set(duck_names) ^ set(spark_df.columns))}"
    duck = rows_of(duck_names, result.fetchall())
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(duck) != len(ours):
        return f"{len(ours)} rows on Spark, {len(duck)} on DuckDB"
    differing = [(a, b) for a, b in zip(ours, duck) if a != b]
    if differing:
        names = sorted(duck_names)
        a, b = differing[0]
        return f"{len(differing)} of {len(ours)} rows differ, first: " + str(
            {n: (x, y) for n, x, y in zip(names, a, b) if x != y})
    return None

"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        value = float(value)
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def normal_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark_df, sf_dir: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_names, got = normal_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    names, rows = normal_rows(*oracle_rows(sf_dir, sql))
    if got_names != names:
        return f"columns {got_names} != {names}"
    if len(got) != len(rows):
        return f"rows {len(got)} != {len(rows)}"
    for a, b in zip(got, rows, strict=True):
        if a != b:
            return f"first difference {a} != {b}"
    return None

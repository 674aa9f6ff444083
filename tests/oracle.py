"""Run one query in Spark and its SQL in DuckDB and compare them value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as short texts; empty when both results are equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    same = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
        "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
    }
    out = [
        f"type of {n}: {t} against {kinds[n]}"
        for n, t in spark_df.dtypes
        if same.get(t) != kinds[n]
    ]
    ours = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    theirs = _rows(names, result.fetchall())
    if len(ours) != len(theirs):
        out.append(f"{len(ours)} rows against {len(theirs)}")
    out += [f"{a} against {b}" for a, b in zip(ours, theirs) if a != b][:3]
    return out

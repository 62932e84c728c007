"""Compare a Spark result with the rows DuckDB gives for the same SQL."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(keyed, key=repr)


FAMILIES = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "HUGEINT": "int", "int": "int",
    "bigint": "int", "DOUBLE": "double", "double": "double", "FLOAT": "double", "VARCHAR": "string",
    "string": "string", "DATE": "date", "date": "date", "TIMESTAMP": "timestamp", "timestamp": "timestamp",
    "timestamp_ntz": "timestamp", "BOOLEAN": "boolean", "boolean": "boolean",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when both results agree in columns, type families and every value."""
    rel = con.execute(sql)
    expected_columns = [d[0] for d in rel.description]
    expected_types = {d[0]: FAMILIES.get(str(d[1]), str(d[1])) for d in rel.description}
    expected = normalised(expected_columns, rel.fetchall())
    actual_types = {f.name: FAMILIES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    actual = normalised(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if actual[0] != expected[0]:
        return [f"columns {actual[0]} != {expected[0]}"]
    for name in expected_columns:
        if actual_types[name] != expected_types[name]:
            out.append(f"type of {name}: {actual_types[name]} != {expected_types[name]}")
    if len(actual[1]) != len(expected[1]):
        out.append(f"rows {len(actual[1])} != {len(expected[1])}")
    bad = [(a, e) for a, e in zip(actual[1], expected[1], strict=False) if a != e]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {bad[0][0]} != {bad[0][1]}")
    return out

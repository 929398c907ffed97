"""Compare a Spark result with the DuckDB result of its SQL twin: names, rows and values, order aside."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(folder, f"{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return ("-0.0" if value == 0 and math.copysign(1, value) < 0 else value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_canonical(row[i]) for i in order) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


_KIND = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "HUGEINT": "hugeint",
}


def differences(spark_df, con, sql: str) -> list[str]:
    found = []
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    duck_types = {d[0]: _KIND.get(str(d[1]), str(d[1])) for d in result.description}
    duck = _rows(duck_columns, result.fetchall())
    ours = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(duck_columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(duck_columns)}"]
    types = {name: kind for name, kind in spark_df.dtypes if kind != duck_types[name]}
    if types:
        found.append(f"types {types} != { {n: duck_types[n] for n in types} }")
    if len(duck) != len(ours):
        found.append(f"rows {len(ours)} != {len(duck)}")
    bad = [(a, b) for a, b in zip(ours, duck) if a != b]
    if bad:
        found.append(f"{len(bad)} differing rows, first: {bad[0][0]} != {bad[0][1]}")
    return found

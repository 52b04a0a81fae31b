"""Compare each query with its SQL twin, row for row, names and kinds of types included."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con, sql: str) -> list[str]:
    """What differs, empty when nothing does."""
    names = sorted(df.columns)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    problems = []
    if sorted(described) != names:
        return [f"columns: {sorted(set(described) ^ set(names))}"]
    for field in df.schema.fields:
        kind = KINDS.get(field.dataType.simpleString())
        if kind != described[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} and {described[field.name]}")
    order = [list(described).index(n) for n in names]
    want = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    have = Counter(tuple(_plain(v) for v in row) for row in df.select(*(f"`{n}`" for n in names)).collect())
    if have != want:
        extra, missing = list((have - want).items())[:2], list((want - have).items())[:2]
        problems.append(
            f"rows: {sum(have.values())} and {sum(want.values())}; names {names}; only here {extra}; only there {missing}"
        )
    return problems

"""Compare a Spark result with SQL run by DuckDB on the same parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# Spark type name -> DuckDB type name.
_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _sortable(row):
    return tuple((value is None, str(value)) for value in row)


def _canonical(rows):
    return sorted((tuple(r) for r in rows), key=_sortable)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types, and all cells agree (row order aside)."""
    columns = sorted(df.columns)
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    if columns != sorted(expected_types):
        return [f"columns {columns} != {sorted(expected_types)}"]
    spark_types = {name: _TYPES.get(kind, kind) for name, kind in df.dtypes}
    problems = [
        f"type of {c}: {spark_types[c]} != {expected_types[c]}"
        for c in columns
        if spark_types[c] != expected_types[c]
    ]
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = _canonical(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    got = _canonical(df.select(*columns).collect())
    if len(got) != len(wanted):
        return problems + [f"rows {len(got)} != {len(wanted)}"]
    for mine, other in zip(got, wanted):
        if mine != other:
            problems.append(f"first differing row:\n{dict(zip(columns, mine))}\n{dict(zip(columns, other))}")
            break
    return problems

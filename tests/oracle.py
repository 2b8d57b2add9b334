"""Compares a query with its SQL twin, value by value, in any row order."""

from __future__ import annotations

import duckdb

from siltbed.registry import ENTRIES
from siltbed.registry.core import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _types(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def _rows(table) -> list[tuple]:
    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return sorted(zip(*columns), key=repr)


# Nodes that leave the JVM or pair all rows with each other.
UNWANTED = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"]


def differences(spark, connection, name: str, sf_dir: str) -> list[str]:
    """What differs; empty if types, number and values of all rows agree."""
    item = ENTRIES[name]
    df = item.run(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [f"{node} in the plan" for node in UNWANTED if node in plan]
    ours = df.toArrow()
    expected = connection.sql(item.sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(expected.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(expected.column_names)}"]
    for column, kind in _types(ours).items():
        if kind != _types(expected)[column]:
            found.append(f"type of {column}: {kind} != {_types(expected)[column]}")
    if ours.num_rows != expected.num_rows:
        found.append(f"rows {ours.num_rows} != {expected.num_rows}")
    if ours.num_rows == 0:
        found.append("no rows")
    ours_rows, expected_rows = _rows(ours), _rows(expected)
    if ours_rows != expected_rows:
        pairs = [(a, b) for a, b in zip(ours_rows, expected_rows) if a != b]
        found.append(f"values, e.g. {sorted(ours.column_names)}: {pairs[:2]}")
    return found

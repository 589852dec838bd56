"""Queries over literal inputs: an operator run on a small table, beside the rows it must give as SQL VALUES."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]", "array<int>": "INTEGER[]", "array<double>": "DOUBLE[]"}


def columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ", 1)) for c in ddl.split(", ")]  # type: ignore[misc]


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(literal, value)) + "]"
    return "'" + str(value).replace("'", "''") + "'"


def values_sql(ddl: str, rows: Sequence[Sequence]) -> str:
    """SELECT of the given rows, each column cast to the type of the DDL."""
    cols = columns(ddl)
    some = rows or [[None] * len(cols)]
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in some)
    picked = ", ".join(f"CAST(c{i} AS {_TYPES[t]}) AS {n}" for i, (n, t) in enumerate(cols))
    return f"SELECT {picked} FROM (VALUES {body}) AS t({', '.join(f'c{i}' for i in range(len(cols)))})" + ("" if rows else " WHERE false")


class Cases:
    """Collects queries and their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, ddl: str, rows: Sequence[Sequence], op: Callable[[DataFrame], DataFrame], out: str, expected: Sequence[Sequence]) -> None:
        """A query of op over rows (ddl), whose rows must be `expected` (out)."""
        self.queries[name] = lambda spark, d: op(spark.createDataFrame([tuple(r) for r in rows], ddl))
        self.sql[name] = values_sql(out, expected)

    def many(self, name: str, tables: dict[str, tuple[str, Sequence[Sequence]]], op: Callable[..., DataFrame], out: str, expected: Sequence[Sequence]) -> None:
        """The same for an operator of several tables, by name."""
        self.queries[name] = lambda spark, d: op(**{k: spark.createDataFrame([tuple(r) for r in rows], ddl) for k, (ddl, rows) in tables.items()})
        self.sql[name] = values_sql(out, expected)

    def table(self, name: str, op: Callable, sql: str | None = None) -> None:
        """A query op(spark, d) over the test tables, with its SQL where there is one."""
        self.queries[name] = op
        if sql:
            self.sql[name] = sql

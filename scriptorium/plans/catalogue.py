"""How queries are registered, and literal rows for both engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Small worked examples, (function, SQL) by name: for tests, not queries, as they read no table.
CASES: dict[str, tuple[Callable[[SparkSession], DataFrame], str]] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of (table reader, spark) under a name, with SQL for the same result."""

    def keep(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return f

    return keep


def case(name: str, oracle: str):
    """Keep a function of (table reader, spark) over rows of its own as a worked example, with SQL for the same result."""

    def keep(f):
        CASES[name] = (lambda spark: f(None, spark), oracle)
        return f

    return keep


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(literal, value)) + "]"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return repr(value)


def values(rows: list[tuple], names: str) -> str:
    """The rows as a FROM item for SQL."""
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({names})"

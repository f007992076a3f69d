"""Named queries: a Spark plan plus, where the result is deterministic and
SQL-expressible, the equivalent DuckDB SQL over the same Parquet tables.

A plan is a callable ``(spark, sf_dir) -> DataFrame``.  Column names of the
plan and of its oracle SQL are aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    plan: Plan
    oracle: str | None
    group: str


_REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None, group: str = ""):
    """Register ``fn`` under ``name`` with its oracle SQL (``None`` = rows-only check)."""

    def deco(fn: Plan) -> Plan:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Entry(name, fn, oracle, group or fn.__module__.rsplit(".", 1)[-1])
        return fn

    return deco


def sql_query(name: str, spark_sql: str, oracle: str | None = None, group: str = "",
              views=None) -> None:
    """Register a query whose Spark side is SQL over the table views.

    ``oracle`` defaults to the same text (when it is portable to DuckDB).
    """
    from lakeshard.sources.tables import TABLES, register_views

    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_views(spark, sf_dir, views or TABLES)
        return spark.sql(spark_sql)

    plan.__name__ = name
    query(name, spark_sql if oracle == "same" else oracle, group or "sql")(plan)


def entries() -> dict[str, Entry]:
    import lakeshard.plans  # noqa: F401  (imports every plan module)

    return dict(_REGISTRY)

"""Queries and oracle SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL that gives the same rows."""

    def keep(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tasks per core, and tasks at least, of rows that are dealt out.
TASKS_PER_CORE, TASKS = 4, 64


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """rows dealt to tasks by their key.  A table of few bytes is read by one task, however dear the work on each of its rows is."""
    return rows.repartition(max(TASKS, TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism), key)


def _load() -> None:
    from cardloom.plans import coverage, geometry, jobs, pages, raster, records, search, sources, store  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)

"""Registry of named jobs runnable on the driver tables, with DuckDB oracles.

Each job takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
given tables (or files Spark writes from them).  ``ORACLES`` holds the same
result as ANSI SQL over the tables for the jobs that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Job) -> Job:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register jobs."""
    from sluice.plans import jobs_core, jobs_files, jobs_json, jobs_loads, jobs_publish  # noqa: F401

"""Relational sources over JDBC.

Discovery is one query against ``information_schema.columns`` whose filter
runs in the database; tables are read in parallel ranges of a key whose
bounds are the key's own quantiles (``predicates``), so every executor pulls
about as many rows, however the keys are spread and whatever their type.
Reading needs a reachable database; the test suite starts none and runs the
queries built here with an in-process SQL engine.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.export import REPORT_SCHEMA, export_ordered_csv


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def discovery_query(schema: str, column: str) -> str:
    return ("(SELECT table_name FROM information_schema.columns "
            f"WHERE table_schema = {_lit(schema)} AND column_name = {_lit(column)}) q")


def jdbc_tables_with_column(spark: SparkSession, url: str, schema: str, column: str,
                            properties: Mapping[str, str] | None = None) -> list[str]:
    """Sorted names of the tables of ``schema`` having ``column``."""
    df = spark.read.jdbc(url, discovery_query(schema, column), properties=dict(properties or {}))
    return sorted(r[0] for r in df.select(F.col(df.columns[0])).distinct().collect())


def quoted(*names: str) -> str:
    """A (qualified) identifier in standard SQL quotes."""
    return ".".join('"' + n.replace('"', '""') + '"' for n in names)


def quantile_query(table: str, key: str, parts: int) -> str:
    """(t, b): the least key ``b`` of each of ``parts`` runs of as many rows in
    key order.  The order is the database's own, by its collation."""
    return (f"(SELECT t, min({key}) AS b FROM "
            f"(SELECT {key}, ntile({max(1, parts)}) OVER (ORDER BY {key}) AS t FROM {table} "
            f"WHERE {key} IS NOT NULL) q GROUP BY t) r")


def literal(value) -> str | None:
    """A key value in standard SQL; None for a type without a safe literal."""
    if isinstance(value, bool):
        return None
    if isinstance(value, (int, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else str(value)
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'" if value.tzinfo is None else None
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str) and "\\" not in value:  # an escape in some databases
        return _lit(value)
    return None


def range_predicates(key: str, bounds: Sequence) -> list[str]:
    """Conditions that split a table at the ascending bounds, every row in one
    of them: the first also takes the rows without a key and below all bounds
    (added since), the last is open; a key that fills several runs gives one
    bound.  Empty if there is nothing to split or a bound has no literal."""
    texts = [literal(b) for b in bounds]
    if None in texts:
        return []
    inner = list(dict.fromkeys(texts))[1:]  # the least key needs no bound
    if not inner:
        return []
    return [f"{key} < {inner[0]} OR {key} IS NULL",
            *(f"{key} >= {lo} AND {key} < {hi}" for lo, hi in zip(inner, inner[1:])),
            f"{key} >= {inner[-1]}"]


def jdbc_read_table(spark: SparkSession, url: str, table: Sequence[str], key: str,
                    properties: Mapping[str, str] | None = None,
                    rows_per_partition: int = 1_000_000,
                    max_connections: int = 64) -> DataFrame:
    """Read a table, given as (schema, name), in parallel ranges of a key, at
    most ``max_connections``.

    The database counts the rows and finds the quantiles (an index on the key
    serves both); as many bounds as ranges come back.  A key of a type without
    a literal here (float, binary, boolean, with a time zone) and a table of
    one range are read by one connection.  A key that holds many rows is one
    range: its rows cannot be told apart by the key.
    """
    props, name, col = dict(properties or {}), quoted(*table), quoted(key)
    n = spark.read.jdbc(url, f"(SELECT count(*) n FROM {name}) c", properties=props).first()[0]
    parts = min(max_connections, int(n) // rows_per_partition)
    if parts > 1:
        runs = spark.read.jdbc(url, quantile_query(name, col, parts), properties=props)
        ranges = range_predicates(col, [b for _, b in sorted(
            ((r[0], r[1]) for r in runs.collect()), key=lambda x: x[0])])
        if ranges:
            return spark.read.jdbc(url, name, predicates=ranges, properties=props)
    return spark.read.jdbc(url, name, properties=props)


def jdbc_to_landing(spark: SparkSession, url: str, schema: str, key: str, out_dir: str,
                    run_at: _dt.datetime, properties: Mapping[str, str] | None = None
                    ) -> DataFrame:
    """Discover -> export ordered CSV -> compressed landing files (M5).  A table
    that cannot be read is reported, and the others are exported."""
    names = jdbc_tables_with_column(spark, url, schema, key, properties)
    tables: dict[str, DataFrame] = {}
    failed = []
    for n in names:
        try:
            tables[n] = jdbc_read_table(spark, url, (schema, n), key, properties)
        except Exception as exc:  # noqa: BLE001 - per-table isolation
            failed.append((n, None, "failed", f"{type(exc).__name__}: {exc}"))
    report = export_ordered_csv(spark, tables, key, out_dir, run_at, sorted(tables))
    return report.unionByName(spark.createDataFrame(failed, REPORT_SCHEMA)) if failed else report

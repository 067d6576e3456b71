"""Export tables ordered by a key to compressed CSV.

The reference finds every table of a schema that has a key column, dumps
each one ordered by the key to ``<table>_<yyyyMMddHHmmss>_UTC.csv`` and
gzips it while copying to the landing area.  Here the sort is Spark's range
partitioned sort, the writer compresses directly (one step instead of two)
and the part files are renamed in key order: a table that fits one part
keeps the exact name, larger tables get ``..._UTC_<nnnnn>.csv.gz`` parts.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import utc_stamp_text
from sluice.operators.snapshot import delete, list_status
from sluice.sources.files import guard_new_dir, profile
from sluice.sources.streams import move_files

REPORT_SCHEMA = "table_name string, file_name string, status string, message string"


def tables_with_column(tables: Mapping[str, DataFrame], column: str) -> list[str]:
    """Names of the tables having ``column``, sorted (A15 over DataFrames)."""
    return sorted(name for name, df in tables.items() if column in df.columns)


def catalog_tables_with_column(spark: SparkSession, column: str,
                               database: str | None = None) -> list[str]:
    """Same over the session catalog (tables and views)."""
    out = []
    for t in spark.catalog.listTables(database):
        name = t.name if database is None else f"{database}.{t.name}"
        if any(c.name == column for c in spark.catalog.listColumns(name)):
            out.append(t.name)
    return sorted(out)


def export_ordered_csv(spark: SparkSession, tables: Mapping[str, DataFrame], key: str,
                       out_dir: str, run_at: _dt.datetime,
                       names: Sequence[str] | None = None) -> DataFrame:
    """Export each table ordered by ``key``; one report row per written file.

    Stops before writing anything if ``out_dir`` exists (A18).  A failing
    table is reported and the next one is exported (K1).
    """
    guard_new_dir(spark, out_dir)
    stamp = utc_stamp_text(run_at, "time")
    report = []
    for name in (names if names is not None else tables_with_column(tables, key)):
        tmp = f"{out_dir.rstrip('/')}/_tmp_{name}"
        try:
            # ORDER BY key NULLS LAST; the other columns break ties so the range
            # partitioner can split one very frequent key over several tasks
            df = tables[name]
            ties = [c for c, t in df.dtypes if c != key and not t.startswith(
                ("variant", "map", "struct", "array"))]
            (df.orderBy(F.col(f"`{key}`").asc_nulls_last(), *ties).write.mode("errorifexists")
             .options(**profile("export_csv")).csv(tmp))
            parts = sorted(f for f in list_status(spark, tmp) if f[0].startswith("part-"))
            files = ([f"{name}_{stamp}.csv.gz"] if len(parts) == 1 else
                     [f"{name}_{stamp}_{i:05d}.csv.gz" for i in range(len(parts))])
            move_files(spark, [(full, f"{out_dir.rstrip('/')}/{f}")
                               for f, (_, full, _, _) in zip(files, parts)])
            report += [(name, f, "exported", None) for f in files]
            delete(spark, tmp)
        except Exception as exc:  # noqa: BLE001 - per-table isolation
            report.append((name, None, "failed", f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(report, REPORT_SCHEMA)

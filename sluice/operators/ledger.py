"""The load ledger: which files were loaded, by which load, with what outcome.

SURVEY A10, I5, K1.  One row per file and run that loaded it or newly failed
on it.  The ledger is a log of *runs*::

    <warehouse>/_ledger/run-<level>-<first>-<last>-<buckets>/[b=<bucket>/]part-*

A commit writes a run of level 0 with the next sequence number.  ``FAN`` runs
of a level are merged into one of the next level, which keeps of every file
only the rows that still say something, so ``n`` commits leave at most
``FAN * log_FAN(n)`` runs.  Merged runs are bucketed by a hash of the file
name (one bucket for every ``ROWS_PER_BUCKET`` rows), so a look-up of a few
names reads their buckets only.

A run counts once its marker file stands in it.  The runs that a merge has
replaced are not read any more and are deleted by the next commit, so a reader
that listed them just before finds their files.  One writer at a time.

The newest row of a file name decides: a file that was replaced is loaded
again, and from its commit on only the new load's rows are seen.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.snapshot import _fs, delete, list_status

LEDGER = "_ledger"
LEDGER_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    # range of the entity's first data column in the file, as text
    T.StructField("key_min", T.StringType()),
    T.StructField("key_max", T.StringType()),
    T.StructField("seq", T.LongType()),
])
FAN = 8
ROWS_PER_BUCKET = 200_000
_RUN = re.compile(r"run-(\d+)-(\d+)-(\d+)-(\d+)")
_READY = "_ready"


@dataclass(frozen=True)
class Run:
    path: str
    level: int
    first: int
    last: int
    buckets: int

    def holds(self, other: Run) -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


def _all_runs(spark: SparkSession, warehouse: str) -> list[Run]:
    """Committed runs, replaced ones included."""
    out = []
    for name, full, _, is_dir in list_status(spark, f"{warehouse.rstrip('/')}/{LEDGER}"):
        m = _RUN.fullmatch(name)
        if is_dir and m:
            fs, marker = _fs(spark, f"{full}/{_READY}")
            if fs.exists(marker):
                out.append(Run(full, *map(int, m.groups())))
    return sorted(out, key=lambda r: (r.first, -r.level))


def ledger_runs(spark: SparkSession, warehouse: str) -> list[Run]:
    """The runs that make up the ledger."""
    runs = _all_runs(spark, warehouse)
    return [r for r in runs if not any(o.holds(r) for o in runs)]


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("file_name"), F.lit(buckets))


def _read(spark: SparkSession, runs: list[Run], names: DataFrame | None = None) -> DataFrame:
    paths = []
    for buckets in sorted({r.buckets for r in runs}):
        mine = [r.path for r in runs if r.buckets == buckets]
        if buckets == 1:
            paths += mine
            continue
        wanted = range(buckets) if names is None else [
            r[0] for r in names.select(_bucket(buckets)).distinct().collect()]
        for path in mine:
            there = {n for n, *_ in list_status(spark, path)}
            paths += [f"{path}/b={b}" for b in wanted if f"b={b}" in there]
    if not paths:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(*paths)


def read_ledger(spark: SparkSession, warehouse: str, names: DataFrame | None = None) -> DataFrame:
    """Rows of the ledger; with ``names`` (a column ``file_name``) at least those
    of these files."""
    return _read(spark, ledger_runs(spark, warehouse), names)


def current_loads(ledger: DataFrame) -> DataFrame:
    """Of every file name the row of its newest load."""
    row = F.struct(*[F.col(f.name) for f in LEDGER_SCHEMA.fields])
    return ledger.where(F.col("status") == "LOADED").groupBy("entity", "file_name").agg(
        F.max_by(row, "seq").alias("r")).select("r.*")


def last_failures(ledger: DataFrame) -> DataFrame:
    """Of every file name the newest row, where that is a failure."""
    row = F.struct(*[F.col(f.name) for f in LEDGER_SCHEMA.fields])
    return ledger.groupBy("entity", "file_name").agg(F.max_by(row, "seq").alias("r")) \
        .select("r.*").where(F.col("status") != "LOADED")


def _mark(spark: SparkSession, path: str) -> None:
    fs, marker = _fs(spark, f"{path}/{_READY}")
    fs.create(marker, True).close()


def _write_run(spark: SparkSession, warehouse: str, rows: DataFrame, level: int, first: int,
               last: int, buckets: int) -> None:
    path = f"{warehouse.rstrip('/')}/{LEDGER}/run-{level}-{first:012d}-{last:012d}-{buckets}"
    delete(spark, path)  # of a commit or merge that broke off: it has no marker
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields])
    if buckets == 1:
        rows.coalesce(1).write.parquet(path)
    else:
        rows.withColumn("b", _bucket(buckets)).repartition(buckets, "b") \
            .write.partitionBy("b").parquet(path)
    _mark(spark, path)


def append_ledger(spark: SparkSession, warehouse: str, rows: DataFrame, fan: int = FAN,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Commit rows (without ``seq``); returns their sequence number."""
    runs = _all_runs(spark, warehouse)
    for r in runs:
        if any(o.holds(r) for o in runs):  # replaced before this commit
            delete(spark, r.path)
    seq = max((r.last for r in runs), default=0) + 1
    _write_run(spark, warehouse, rows.withColumn("seq", F.lit(seq)), 0, seq, seq, 1)
    _merge(spark, warehouse, fan, rows_per_bucket)
    return seq


def _merge(spark: SparkSession, warehouse: str, fan: int, rows_per_bucket: int) -> None:
    """Merge full levels, lowest first."""
    level = 0
    while True:
        runs = ledger_runs(spark, warehouse)
        mine = [r for r in runs if r.level == level]
        if len(mine) < fan:
            return
        # Failures are news until the file is loaded; an older load of the same
        # run is superseded.  Rows of other runs are not needed to say so.
        rows = _read(spark, mine)
        kept = current_loads(rows).unionByName(last_failures(rows))
        n = kept.count()
        _write_run(spark, warehouse, kept, level + 1, mine[0].first, mine[-1].last,
                   max(1, n // rows_per_bucket))
        level += 1

"""Insert-only merge and the failover snapshot (K5).

``MERGE INTO t USING s ON t.k = s.k WHEN NOT MATCHED THEN INSERT ...``
becomes an anti join of the source against the target's keys, aligned to
the target's column list, appended to the target.  No update, no delete and
no source dedup; a NULL key never matches, so such rows are inserted on
every run (all as in the reference).

Re-running with the same source is a no-op for non-NULL keys.  The rows are
appended by ``append_table`` and every merge first mends what an earlier one
has left half done, so a failed job can be run again also when several source
rows share a key.  Parquet has no row locks: one writer per target at a time.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.joins import anti_join
from sluice.operators.snapshot import (append_table, create_table_as_if_absent, list_status,
                                       mend_appends, path_exists)


@dataclass
class MergeResult:
    target: str
    rows_inserted: int
    message: str


def _prepare(source: DataFrame, keys: Sequence[str], dedupe: bool,
             skip_null_keys: bool) -> DataFrame:
    """The two options beyond the reference: drop NULL keys, dedupe the source."""
    src = source
    if skip_null_keys:
        for k in keys:
            src = src.where(F.col(f"`{k}`").isNotNull())
    if dedupe:
        src = src.dropDuplicates(list(keys))
    return src


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
               dedupe: bool = False, skip_null_keys: bool = False) -> DataFrame:
    """Rows the merge would insert, in the target's column order and types."""
    src = _prepare(source, keys, dedupe, skip_null_keys)
    new = anti_join(src, target, keys)
    return new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                        for f in target.schema.fields])


def merge_insert_only(spark: SparkSession, target_path: str, source: DataFrame,
                      keys: Sequence[str], *, dedupe: bool = False,
                      skip_null_keys: bool = False, sort_by: Sequence[str] | None = None
                      ) -> MergeResult:
    """Insert the source rows whose key is not in the target parquet table.

    A missing target is created from the source (every row is new).
    ``sort_by`` clusters the appended files (range partition + local sort),
    which keeps min/max statistics tight for later key lookups.
    """
    obs = Observation(f"merge_{uuid.uuid4().hex}")
    exists = path_exists(spark, target_path)
    if exists:
        mend_appends(spark, target_path)
        exists = any(not x[0].startswith(("_", ".")) for x in list_status(spark, target_path))
    if exists:
        target = spark.read.parquet(target_path)
        new = merge_rows(target, source, keys, dedupe=dedupe, skip_null_keys=skip_null_keys)
    else:
        new = _prepare(source, keys, dedupe, skip_null_keys)
    if sort_by:
        new = new.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    new = new.observe(obs, F.count(F.lit(1)).alias("n"))
    append_table(spark, new, target_path)
    n = int(obs.get.get("n", 0))
    return MergeResult(target_path, n, f"{n} rows inserted into {target_path}")


def merge_with_failover(spark: SparkSession, target_path: str, load_path: str,
                        keys: Sequence[str], run_date: _dt.date | None = None,
                        **kw) -> MergeResult:
    """Merge the staged load table; on any error snapshot it.

    The snapshot is ``<load_path>_<yyyymmdd>``, created only if absent, and
    holds the load table exactly as it was staged.
    """
    run_date = run_date or _dt.datetime.now(_dt.timezone.utc).date()
    failover = f"{load_path.rstrip('/')}_{run_date:%Y%m%d}"
    try:
        return merge_insert_only(spark, target_path, spark.read.parquet(load_path), keys, **kw)
    except Exception as exc:  # noqa: BLE001 - any failure triggers the snapshot
        create_table_as_if_absent(spark, failover, spark.read.parquet(load_path))
        return MergeResult(target_path, 0,
                           f"merge failed ({type(exc).__name__}), load table kept at: {failover}")

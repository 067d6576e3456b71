"""The reference's procedures as Python entry points.

Each returns a short message and appends its run report rows to a report
table in one write per run (A26), so a scheduler can call them the way the
task graph called the procedures.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.clean import clean_csv_files
from sluice.operators.load import (create_entity_tables, load_files, verify,
                                   verify_summary)
from sluice.operators.merge import MergeResult, merge_with_failover
from sluice.operators.snapshot import create_table, stage
from sluice.plans.master import Side, build_master_lookup
from sluice.sources.api import RESPONSES_SCHEMA, land_responses
from sluice.sources.unload import unload_json

CREATE_REPORT = "create_report"
LOAD_REPORT = "load_report"


def create_schema_and_tables(spark: SparkSession, landing: str, warehouse: str) -> str:
    """One table per entity; a report row per entity (entity, file_name, created, columns)."""
    wh = warehouse.rstrip("/")
    created = stage(spark, create_entity_tables(spark, landing, wh), "create-report")
    created.write.mode("append").parquet(f"{wh}/{CREATE_REPORT}")
    made, all_ = created.agg(F.count(F.when(F.col("created"), 1)), F.count(F.lit(1))).first()
    return f"{made} of {all_} tables created, report in {wh}/{CREATE_REPORT}"


def load_data_from_files(spark: SparkSession, landing: str, warehouse: str,
                         loaded_at: _dt.datetime) -> str:
    """Load the new files; a report row per file (file_name, entity, status,
    rows_loaded, result_text, all_loaded, message)."""
    wh = warehouse.rstrip("/")
    run = load_files(spark, landing, wh, loaded_at)
    report = stage(spark, run.report, "load-report")
    rows = report.join(verify(report), "file_name").select(
        "file_name", "entity", "status", "rows_loaded", "result_text", "all_loaded", "message")
    rows.write.mode("append").parquet(f"{wh}/{LOAD_REPORT}")
    n = verify_summary(report).first()
    state = "nothing new" if n["zero_files_processed"] and n["all_loaded"] else (
        "loaded" if n["all_loaded"] else "loaded with failures")
    return (f"{state}: {n['files_loaded']} loaded, {n['files_failed']} failed, "
            f"{n['files_skipped']} skipped, report in {wh}/{LOAD_REPORT}")


def merge_data_to_master(spark: SparkSession, base: DataFrame, base_key: str, base_alias: str,
                         sides: Sequence[Side], lookup_key: str, master_path: str,
                         run_date: _dt.date) -> MergeResult:
    """Build the lookup (M1), stage it
    (A23), merge insert-only (G1); on failure snapshot the staged table (K5)."""
    lookup = build_master_lookup(base, base_key, base_alias, sides, lookup_key=lookup_key,
                                 order=False)  # the merge orders what it appends
    load_path = f"{master_path.rstrip('/')}_LOAD"
    lookup.write.mode("overwrite").parquet(load_path)
    return merge_with_failover(spark, master_path, load_path, [lookup_key], run_date=run_date,
                               sort_by=[base_alias, lookup_key])


def prep_csv_files(spark: SparkSession, source: str, target: str, **kw) -> str:
    """``prep_csv_files``: clean all files, return the summary message (M4)."""
    result = clean_csv_files(spark, source, target, **kw)
    return f"cleaning done: {result.summary}"


def land_and_unload(spark: SparkSession, requests: DataFrame,
                    make_fetcher: Callable[[], Callable[..., object]], param_cols: Sequence[str],
                    responses_path: str, out_dir: str, run_date: _dt.date,
                    feeds: Sequence[str] | None = None) -> str:
    """Fetch and land responses, then unload each feed to gzip JSON (M3)."""
    create_table(spark, responses_path, RESPONSES_SCHEMA)
    # one action: each request is fetched once
    land_responses(requests, make_fetcher, param_cols, run_date) \
        .write.mode("append").parquet(responses_path)
    # every response of the feed goes to the run's file, whatever its date
    table = spark.read.parquet(responses_path)
    files = unload_json(spark, table, out_dir, run_date, feeds=feeds)
    return "unloaded: " + json.dumps({r["feed"]: {
        "rows_unloaded": r["rows_unloaded"], "input_bytes": r["input_bytes"],
        "output_bytes": r["output_bytes"], "files": list(r["files"])}
        for r in files.orderBy("feed").collect()})  # one row per feed

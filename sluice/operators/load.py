"""Create entity tables and load landed files with a ledger and a report.

SURVEY A2, A9, A10, D1-D5, I5, K1-K3.

Layout of a warehouse folder::

    <warehouse>/<ENTITY>/_schema.json          frozen schema (first good header decides)
    <warehouse>/<ENTITY>/load_id=<id>/part-*   one folder per load
    <warehouse>/_ledger/run-*/part-*           manifest of the loads (``ledger.py``):
                                               per file its load, rows and key range

Exactly once without a transactional table format: data is written first
into a fresh ``load_id`` folder, then the ledger rows naming that load are
committed.  ``read_table_rows`` reads only files of loads that the ledger
names, so rows of a run that is under way or broke off, and rows of files that
failed, are never seen.  What a broken-off run left is deleted by a later one
once it is older than ``ORPHAN_AGE``; its files are loaded again.  Already
loaded files (same name, length and modification time) are reported
``SKIPPED`` and not read again.  A file that was replaced is loaded as a new
one, and its newest load is the one that is read: both versions are never seen
together, and loads with no current file left are deleted like leftovers.

Per-file isolation: headers are judged before a table is made or a file is
read; the new files of an entity are parsed once, in one job; the files that
held a bad row are marked failed in the ledger, so a file loads whole or not
at all; whatever else goes wrong with an entity is the report of its files and
stops no other entity.
"""

from __future__ import annotations

import datetime as _dt
import threading
import time
import uuid
import zlib
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.json import array_text, object_text
from sluice.operators.infer import (create_table_if_absent, entity_schema, infer_schema,
                                    read_entity, table_schema)
from sluice.operators.ledger import (LEDGER_SCHEMA, append_ledger, current_loads, last_failures,
                                     read_ledger)
from sluice.operators.snapshot import _fs, delete, stage
from sluice.session import conf_for, listing_conf
from sluice.sources.files import filter_names, list_files, profile
from sluice.sources.headers import Header, header_fault, read_headers
from sluice.sources.landing import (LANDED_PATTERN, LINEAGE_FIELDS, entity_from_file,
                                    read_landed_csv, with_lineage)
from sluice.sources.streams import each_file, file_chunks

# Fixed value: what the dialect says of a load that found no new file.
NOTHING_LOADED = "Copy executed with 0 files processed"
#: Entities whose load jobs run side by side.
ENTITIES_AT_ONCE = 4
#: Names that a table's own columns have.
RESERVED = [*(name for name, _ in LINEAGE_FIELDS), "load_id"]
REPORT_SCHEMA = ("file_name string, entity string, status string, rows_loaded bigint, "
                 "message string")


@dataclass
class RunResult:
    message: str
    report: DataFrame


# ---------------------------------------------------------------------------
# listing and ledger

def landed(files: DataFrame, pattern: str = LANDED_PATTERN) -> DataFrame:
    """Of files (path, length, modified) those whose name has an entity:
    (path, file_name, length, modified, entity)."""
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    return filter_names(named, pattern=pattern).select(
        "path", "file_name", "length", "modified",
        entity_from_file("file_name", pattern).alias("entity"))


def landed_files(spark: SparkSession, landing: str, pattern: str = LANDED_PATTERN) -> DataFrame:
    """The landing folder's files whose name has an entity (see ``landed``)."""
    lst = list_files(spark, landing)
    return landed(lst.select("path", "length", F.col("modification_time").alias("modified")),
                  pattern)


#: Age from which a load folder without a current file is taken for a leftover.
ORPHAN_AGE = _dt.timedelta(hours=24)


def _old_loads(spark: SparkSession, table: str, age: _dt.timedelta) -> dict[str, str]:
    """Load id -> folder of the loads that are older than ``age``."""
    fs, p = _fs(spark, table)
    oldest, prefix = time.time() - age.total_seconds(), "load_id="
    return {st.getPath().getName()[len(prefix):]: st.getPath().toString()
            for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)
            and st.getModificationTime() / 1000 < oldest}


def _drop_orphan_loads(spark: SparkSession, warehouse: str, entities: Sequence[str],
                       age: _dt.timedelta = ORPHAN_AGE) -> list[str]:
    """Delete old load folders without a current file: of runs that broke off,
    and of files that were all replaced."""
    old = {e: _old_loads(spark, f"{warehouse.rstrip('/')}/{e}", age) for e in entities}
    if not any(old.values()):
        return []
    rows = current_loads(read_ledger(spark, warehouse).where(F.col("entity").isin(list(old))))
    known = {r[0] for r in rows.select("load_id").distinct().collect()}  # one per load
    gone = [path for loads in old.values() for i, path in loads.items() if i not in known]
    for path in gone:
        delete(spark, path)
    return gone


# ---------------------------------------------------------------------------
# create

def _first_with_header(spark: SparkSession, candidates: dict[str, list],
                       options: dict[str, str] | None, passed: set[str]
                       ) -> tuple[dict[str, object], dict[str, Header], dict[str, str]]:
    """Per entity, the first file (by name) whose header can name columns.

    Empty files have no row 1 and are passed over, as discovery does in the
    reference; so are files whose bytes cannot be read and the paths in
    ``passed``.  Files with a faulty header are passed over with a reason
    (path -> reason).  Candidates are tried in growing batches (1, 8, 64, ...),
    so normally only each entity's first file is opened.
    """
    chosen: dict[str, object] = {}
    found: dict[str, Header] = {}
    faults: dict[str, str] = {}
    start, size = 0, 1
    while True:
        batch = {e: rows[start:start + size] for e, rows in candidates.items()
                 if e not in chosen and len(rows) > start}
        if not batch:
            return chosen, found, faults
        headers = read_headers(spark, [r["path"] for rs in batch.values() for r in rs
                                       if r["path"] not in passed], options)
        for e, rows in batch.items():
            for r in rows:
                header = headers.get(r["path"])
                if header is None or not (header.columns or header.fault):
                    continue
                why = header_fault(header, RESERVED)
                if why is None:
                    chosen[e], found[r["path"]] = r, header
                    break
                faults[r["path"]] = why
        start, size = start + size, size * 8


def _reason(exc: Exception) -> str:
    return f"{type(exc).__name__}: {(str(exc).strip().splitlines() or [''])[0][:300]}"


def _infer_chosen(spark: SparkSession, chosen: dict[str, object], headers: dict[str, Header],
                  options: dict[str, str] | None) -> tuple[dict[str, list], dict[str, str]]:
    """Columns of each chosen file (path -> (name, type)), and why others have none."""
    def infer(rows: list) -> dict[str, list]:
        by_name = {r["file_name"]: r["path"] for r in rows}
        cols: dict[str, list] = {}
        got = infer_schema(spark, list(by_name.values()), options, headers={
            p: headers[p].columns for p in by_name.values()})
        for r in got.orderBy("file_name", "order_id").collect():
            cols.setdefault(by_name[r["file_name"]], []).append(
                (r["column_name"], r["normalised_type"]))
        return cols

    rows = list(chosen.values())
    try:
        return infer(rows), {}
    except Exception:  # noqa: BLE001 - one unreadable file must not stop the others
        broken = check_compression(spark, [r["path"] for r in rows])
        out: dict[str, list] = {}
        for r in rows:
            if r["path"] not in broken:
                try:
                    out |= infer([r])
                except Exception as exc:  # noqa: BLE001
                    broken[r["path"]] = _reason(exc)
        return out, broken


def create_entity_tables(spark: SparkSession, landing: str, warehouse: str,
                         options: dict[str, str] | None = None,
                         files: DataFrame | None = None) -> DataFrame:
    """Create each entity's table from its first landed file with a good header.

    Returns rows (entity, file_name, created, columns): one per entity, and one
    for every file that was passed over for a fault, with the reason in
    ``columns``.  An existing table keeps its schema (``CREATE TABLE IF NOT
    EXISTS``).  A file or entity with a fault stops no other one.
    """
    wh = warehouse.rstrip("/")
    files = landed_files(spark, landing) if files is None else files
    firsts = files.groupBy("entity").agg(F.min("file_name").alias("file_name")).collect()
    todo = sorted(r["entity"] for r in firsts if table_schema(spark, f"{wh}/{r['entity']}") is None)
    out = []
    candidates: dict[str, list] = {}
    if todo:
        for r in (files.where(F.col("entity").isin(todo))
                  .select("entity", "file_name", "path").orderBy("entity", "file_name")
                  .collect()):  # file names of entities without a table
            candidates.setdefault(r["entity"], []).append(r)
    left, passed = dict(candidates), set()
    while left:
        chosen, headers, faults = _first_with_header(spark, left, options, passed)
        cols, broken = _infer_chosen(spark, chosen, headers, options) if chosen else ({}, {})
        for entity, rows in list(left.items()):
            out += [(entity, r["file_name"], False, f"rejected: {faults[r['path']]}")
                    for r in rows if r["path"] in faults]
            r = chosen.get(entity)
            if r is None:
                out.append((entity, rows[0]["file_name"], False, "no header"))
            elif r["path"] in broken:  # the entity's next file may do
                out.append((entity, r["file_name"], False, f"rejected: {broken[r['path']]}"))
                passed |= {r["path"], *faults}
                continue
            else:
                columns = cols[r["path"]]
                try:
                    created = create_table_if_absent(spark, f"{wh}/{entity}",
                                                     entity_schema(columns))
                    out.append((entity, r["file_name"], created,
                                ", ".join(f"{c.upper()} {t}" for c, t in columns)))
                except Exception as exc:  # noqa: BLE001
                    out.append((entity, r["file_name"], False, f"rejected: {_reason(exc)}"))
            del left[entity]
    for r in firsts:
        if r["entity"] not in candidates:
            out.append((r["entity"], r["file_name"], False, "exists"))
    return spark.createDataFrame(out, "entity string, file_name string, created boolean, "
                                      "columns string")


# ---------------------------------------------------------------------------
# validation

def _gzip_error(path: str, stream: BinaryIO) -> tuple[str, str | None]:
    """The first error of a gzip stream, read to its end chunk by chunk."""
    if path.endswith(".gz"):
        try:
            for _ in file_chunks(path, stream):
                pass
        except EOFError as exc:
            return path, str(exc)
        except zlib.error as exc:
            return path, f"corrupt gzip stream: {exc}"
    return path, None


def check_compression(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """{path: error} for the files whose gzip stream cannot be read to the end.

    Files are streamed in 1 MiB steps inside tasks, whatever their size.  An
    empty file is not broken: it has no rows.
    """
    rows = each_file(spark, paths, _gzip_error, "path string, error string")
    return {path: error for path, error in rows if error and error != "empty gzip stream"}


def _cast_ok(c: str, dt: T.DataType) -> Column:
    v = F.col(f"`{c}`")
    if isinstance(dt, T.StringType):
        return F.lit(True)
    return v.isNull() | F.expr(f"try_cast(`{c}` AS {dt.simpleString()})").isNotNull()


# Fixed value: an open cost far above any split size, so the planner gives
# every file its own input partition.
ONE_FILE_OPEN_COST = str(1 << 40)
#: Small files share a write task up to so many (compressed) bytes.
TASK_BYTES = 1 << 25


def _write_tasks(spark: SparkSession, files: int, longest: int) -> int:
    """Tasks that write ``files`` files of up to ``longest`` bytes: some a core, more
    where the longest files together would pass ``TASK_BYTES`` (Spark deals files by size)."""
    most = min(files // (4 * spark.sparkContext.defaultParallelism), TASK_BYTES // max(1, longest))
    return -(-files // max(1, most))


def _write_load(spark: SparkSession, load_dir: str, paths: Sequence[str],
                data_fields: Sequence[T.StructField], loaded_at: _dt.datetime,
                opts: dict[str, str], longest: int) -> set[str]:
    """One parse of the files: typed rows into the load's folder; returns the
    files holding a bad row (wrong field count or a value that does not fit its
    column), collected by an Observation on the same pass.

    Gzip files are read one file per partition (the caller sets the open cost),
    so the row number in file comes from the scan position alone (no second, summary scan).  The same
    pass checks that condition; if it did not hold, the load folder is
    dropped and written again with the summary method.  Numbered partitions of
    small files (the longest has ``longest`` bytes) are then put together without
    a shuffle: a load of many small files takes few tasks and leaves few part files.
    """
    if all(p.endswith(".gz") for p in paths):
        bad = _write_pass(spark, load_dir, paths, data_fields, loaded_at, opts, True,
                          tasks=_write_tasks(spark, len(paths), longest))
        if bad is not None:
            return bad
        delete(spark, load_dir)
    return _write_pass(spark, load_dir, paths, data_fields, loaded_at, opts, False)


def _write_pass(spark: SparkSession, load_dir: str, paths: Sequence[str],
                data_fields: Sequence[T.StructField], loaded_at: _dt.datetime,
                opts: dict[str, str], one_file: bool, tasks: int | None = None
                ) -> set[str] | None:
    raw = read_landed_csv(spark, paths, [f.name for f in data_fields], opts,
                          corrupt_column="__corrupt")
    bad = F.col("__corrupt").isNotNull()
    for f in data_fields:
        bad = bad | ~_cast_ok(f.name, f.dataType)
    typed = [F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType) else
             F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name)
             for f in data_fields]
    out = with_lineage(raw.withColumn("__bad", bad), loaded_at, typed + [F.col("__bad")],
                       one_file_per_partition=one_file)
    obs = Observation(f"load_{uuid.uuid4().hex}")
    metrics = [F.collect_set(F.when(F.col("__bad"), F.col("source_file_name")))
               .alias("bad_files")]
    if one_file:  # (partition, file) pairs: one file per partition expected
        metrics.append(F.collect_set(F.struct("__pid", "source_file_name")).alias("pid_files"))
    out = out.observe(obs, *metrics).drop("__bad", "__pid")
    # behind the numbers, which are those of the uncoalesced partitions
    (out.coalesce(tasks) if tasks else out).write.parquet(load_dir)
    if one_file:
        pids = [r[0] for r in obs.get.get("pid_files") or []]
        if len(pids) != len(set(pids)):
            return None
    return set(obs.get.get("bad_files") or [])


def _manifest(spark: SparkSession, load_dir: str, key: str) -> dict[str, tuple]:
    """File name -> rows and range of the column ``key``, from two columns of the load."""
    rows = spark.read.parquet(load_dir).groupBy("source_file_name").agg(
        F.count(F.lit(1)), F.min(f"`{key}`").cast("string"), F.max(f"`{key}`").cast("string"))
    return {r[0]: tuple(r)[1:] for r in rows.collect()}  # one row per file


def _utc(at: _dt.datetime) -> _dt.datetime:
    """The load time without a zone, in UTC, as in the lineage columns."""
    return at if at.tzinfo is None else at.astimezone(_dt.timezone.utc).replace(tzinfo=None)


def load_files(spark: SparkSession, landing: str, warehouse: str,
               loaded_at: _dt.datetime, options: dict[str, str] | None = None,
               on_error: str = "continue", files: DataFrame | None = None) -> RunResult:
    """Load every landed file not yet loaded into its entity table (A10).

    Report rows: (file_name, entity, status, rows_loaded, message) with
    status LOADED, FAILED or SKIPPED.  ``on_error='abort'`` raises when any
    file fails, before anything is committed.  ``files`` (as ``landed`` gives
    them) stands for the listing of the landing folder.

    Optimistic, single parse per entity: the new files are parsed once and
    written into a fresh ``load_id`` folder; the files that held a bad row are
    known from the same pass, and the ledger does not name them as loaded.
    Headers are judged first, and files that are no gzip streams found with
    them.  Only when the pass dies are the files' streams checked one by one (``check_compression``) and the pass repeated without
    the broken ones; if it dies again, the entity's files fail with the reason
    and the next entity goes on.
    """
    wh = warehouse.rstrip("/")
    opts = dict(options or profile("ingest_csv"))
    files = landed_files(spark, landing) if files is None else files
    ledger = read_ledger(spark, warehouse, files.select("file_name"))
    same = ["file_name", "length", "modified"]
    loaded = current_loads(ledger).select(*same)
    new = files.join(loaded, same, "left_anti")
    skipped = files.join(loaded, same, "left_semi")
    todo = new.select("entity", "path", *same).collect()  # file names only

    # The skipped rows are written now: the ledger moves on below.
    skipped = stage(spark, skipped.select(
        "file_name", "entity", F.lit("SKIPPED").alias("status"),
        F.lit(0).cast("bigint").alias("rows_loaded"),
        F.lit("file already loaded").alias("message")), "skipped")
    reports: list[tuple] = []
    # File names identify files (ledger, lineage): names that occur twice under
    # the landing folder are refused, not merged.
    seen = Counter(r["file_name"] for r in todo)
    reports += [(r["file_name"], r["entity"], "FAILED", 0,
                 "file name occurs more than once under the landing folder")
                for r in todo if seen[r["file_name"]] > 1]
    todo = [r for r in todo if seen[r["file_name"]] == 1]
    by_entity: dict[str, list] = {}
    for r in todo:
        by_entity.setdefault(r["entity"], []).append(r)
    schemas = {e: table_schema(spark, f"{wh}/{e}") for e in by_entity}
    headers = read_headers(spark, [r["path"] for r in todo if schemas[r["entity"]]], opts)
    faults = {r["file_name"]: f"header: {why}" for r in todo if r["path"] in headers
              and (why := header_fault(headers[r["path"]], RESERVED))}
    # No header: the file is empty, or its bytes break off before the first record.
    none = {r["path"]: r["file_name"] for r in todo
            if schemas[r["entity"]] and r["path"] not in headers}
    faults |= {none[path]: why for path, why in check_compression(spark, list(none)).items()}

    def known_failures(names: list[str]) -> set[tuple]:
        some = spark.createDataFrame([(n,) for n in names], "file_name string")
        rows = last_failures(read_ledger(spark, warehouse, some).join(some, "file_name", "left_semi"))
        return {tuple(r) for r in rows.select(*same, "message").collect()}

    waiting: list[list[tuple]] = []
    turn = threading.Lock()

    def commit(rows: list[tuple]) -> None:
        """Commit ledger rows, with those of all entities that wait meanwhile."""
        waiting.append(rows)
        with turn:
            batch: list[tuple] = []
            while waiting:
                batch += waiting.pop()
            if bad := [r[1] for r in batch if r[7] == "FAILED"]:
                told = known_failures(bad)  # a failure that is known already adds no row
                batch = [r for r in batch if (r[1], r[2], r[3], r[8]) not in told]
            if batch:  # else another entity has taken the rows along
                append_ledger(spark, warehouse, spark.createDataFrame(
                    batch, T.StructType(LEDGER_SCHEMA.fields[:-1])))

    def load(entity: str) -> list[tuple]:
        rows = by_entity[entity]
        if schemas[entity] is None:
            return [(r["file_name"], entity, "FAILED", 0,
                     faults.get(r["file_name"], "no table for entity")) for r in rows]
        failed = {r["file_name"]: faults[r["file_name"]] for r in rows if r["file_name"] in faults}
        load_id, found = uuid.uuid4().hex, {}
        load_dir = f"{wh}/{entity}/load_id={load_id}"
        rest = [r for r in rows if r["file_name"] not in failed]
        try:
            if rest:
                bad, found = _load_entity(spark, load_dir, rest, schemas[entity].fields[6:],
                                          loaded_at, opts)
                failed |= bad
        except Exception as exc:  # noqa: BLE001 - an entity's fault stops no other one
            failed |= {r["file_name"]: _reason(exc) for r in rest}
        if failed and on_error == "abort":
            delete(spark, load_dir)
            raise RuntimeError(f"load of {entity} aborted: {failed}")
        if len(failed) == len(rows):
            delete(spark, load_dir)
        report = [(r["file_name"], entity, "FAILED", 0, failed[r["file_name"]])
                  for r in rows if r["file_name"] in failed]
        report += [(r["file_name"], entity, "LOADED", found.get(r["file_name"], (0,))[0], "loaded")
                   for r in rows if r["file_name"] not in failed]
        seen_as = {r["file_name"]: (r["length"], r["modified"]) for r in rows}
        news = [(entity, f, *seen_as[f], load_id, _utc(loaded_at), n, st, m,
                 *(found.get(f, (0, None, None))[1:] if st == "LOADED" else (None, None)))
                for f, _, st, n, m in report]
        if news:
            commit(news)
        return report

    # Jobs of some entities run side by side; what one of them meets is its own.
    with conf_for(spark, listing_conf(spark)
                  | {"spark.sql.files.openCostInBytes": ONE_FILE_OPEN_COST}), \
            ThreadPoolExecutor(1 if on_error == "abort" else ENTITIES_AT_ONCE) as pool:
        for report in pool.map(load, sorted(by_entity)):
            reports += report
    _drop_orphan_loads(spark, warehouse, [e for e in sorted(by_entity) if schemas[e]])
    msg = "SUCCESS -- load complete" if todo else NOTHING_LOADED
    return RunResult(msg, spark.createDataFrame(reports, REPORT_SCHEMA).unionByName(skipped))


def _load_entity(spark: SparkSession, load_dir: str, rows: list,
                 data_fields: Sequence[T.StructField], loaded_at: _dt.datetime,
                 opts: dict[str, str]) -> tuple[dict[str, str], dict[str, tuple]]:
    """Write one load; returns why files failed and the manifest of the others."""
    failed: dict[str, str] = {}
    longest = max(r["length"] for r in rows)
    try:
        bad = _write_load(spark, load_dir, [r["path"] for r in rows], data_fields, loaded_at,
                          opts, longest)
    except Exception:  # noqa: BLE001 - find unreadable files, then retry once
        delete(spark, load_dir)
        broken = check_compression(spark, [r["path"] for r in rows])
        if not broken:
            raise
        failed = {r["file_name"]: broken[r["path"]] for r in rows if r["path"] in broken}
        rest = [r["path"] for r in rows if r["path"] not in broken]
        bad = _write_load(spark, load_dir, rest, data_fields, loaded_at, opts,
                          longest) if rest else set()
    failed |= {f: "rows with a wrong number of fields or a value that does not fit "
                  "the column type" for f in bad}
    if len(failed) == len(rows):
        return failed, {}
    found = _manifest(spark, load_dir, data_fields[0].name)
    return failed, {f: v for f, v in found.items() if f not in failed}


def verify(report: DataFrame) -> DataFrame:
    """Per-file load verification.

    As the reference checks each file's load result: ``result_text`` is the
    file's result object as text, and ``all_loaded`` compares the number of
    ``"status":`` with the number of ``"status":"LOADED"`` in it.  One row
    per file; nothing is gathered into one group.
    """
    obj = object_text(file=F.col("file_name"), rows_loaded=F.col("rows_loaded"),
                      status=F.col("status"))
    text = F.col("result_text")
    result = array_text(F.array(obj), ", \n\t")  # an array of the file's one object
    return report.select("file_name", result.alias("result_text")).select(
        "file_name", "result_text",
        (F.regexp_count(text, F.lit('"status":'))
         == F.regexp_count(text, F.lit('"status":"LOADED"'))).alias("all_loaded"))


def verify_summary(report: DataFrame) -> DataFrame:
    """One row of counts for a run (D3): files seen, loaded, failed, skipped;
    ``zero_files_processed`` when nothing new was loaded."""
    st = F.col("status")
    return report.agg(
        F.count(F.lit(1)).alias("files"),
        F.count(F.when(st == "LOADED", 1)).alias("files_loaded"),
        F.count(F.when(st == "FAILED", 1)).alias("files_failed"),
        F.count(F.when(st == "SKIPPED", 1)).alias("files_skipped"),
    ).withColumn("zero_files_processed", F.col("files_loaded") == 0) \
        .withColumn("all_loaded", F.col("files_failed") == 0)


def read_table_rows(spark: SparkSession, warehouse: str, entity: str,
                    keys: tuple[object, object] | None = None) -> DataFrame:
    """Rows of the files that the ledger names, each from its newest load.

    ``keys`` (lowest, highest; None: open) limits the rows by the entity's
    first data column.  Files whose range in the ledger lies outside are not
    matched, and load folders without any matching file are not read.
    """
    table = f"{warehouse.rstrip('/')}/{entity}"
    rows = read_entity(spark, table)
    done = current_loads(read_ledger(spark, warehouse).where(F.col("entity") == entity))
    if keys is not None:
        field = table_schema(spark, table).fields[len(LINEAGE_FIELDS)]

        def within(low: Column, high: Column) -> Column:
            out = F.lit(True)
            if keys[0] is not None:
                out = out & (high >= F.lit(keys[0]).cast(field.dataType))
            if keys[1] is not None:
                out = out & (low <= F.lit(keys[1]).cast(field.dataType))
            return out

        done = done.where(within(F.col("key_min").cast(field.dataType),
                                 F.col("key_max").cast(field.dataType)))
        ids = [r[0] for r in done.select("load_id").distinct().collect()]  # one per load
        key = F.col(f"`{field.name}`")
        rows = rows.where(F.col("load_id").isin(ids) & within(key, key))
    done = done.select("load_id", F.col("file_name").alias("source_file_name"))
    return rows.join(done, ["load_id", "source_file_name"], "left_semi").select(*rows.columns)

"""Clean every cell of landed CSV files and rewrite them.

The reference gunzips each file on one machine, applies pandas' cleaning
and uploads the result, one file at a time.  Here all files of a header
group are one Spark job: one scan, a column projection with the cleaning
rules (JVM-side regex and ``CASE``), and a write that puts every source
file into one output file of the same name.  A gzip file is read by one
task, so its rows are already in order in one partition and the write
needs no shuffle; splittable inputs are repartitioned by file.
"""

from __future__ import annotations

import codecs
import csv
import gzip
import io
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import REPLACEMENT_CHAR, drop_invalid, null_tokens
from sluice.operators.load import check_compression
from sluice.operators.snapshot import _fs, delete, rename
from sluice.session import conf_for
from sluice.sources.files import list_files, profile, refresh
from sluice.sources.headers import distinct_names, read_headers
from sluice.sources.landing import write_named_csv
from sluice.sources.streams import each_file, file_chunks, move_files

REPORT_SCHEMA = "source_file string, target_file string, status string, reason string"


@dataclass
class CleanResult:
    summary: str          # JSON text as the reference returns it
    report: DataFrame     # one row per source file


def clean_frame(df: DataFrame, columns: Sequence[str], on_bad_utf8: str = "replace") -> DataFrame:
    """Apply the cell rules to all-string ``columns`` (header untouched)."""
    out = []
    for c in columns:
        v = F.col(f"`{c}`")
        if on_bad_utf8 == "replace":
            v = drop_invalid(v)
        out.append(null_tokens(v).alias(c))
    return df.select(*out, *[x for x in df.columns if x not in columns])


def clean_csv_files(spark: SparkSession, source: str, target: str, *,
                    on_bad_utf8: str = "skip", source_action: str = "keep",
                    archive_dir: str | None = None,
                    options: dict[str, str] | None = None) -> CleanResult:
    """Clean all CSV files under ``source`` into ``target`` (same relative names).

    * files whose name already exists in ``target`` are skipped
      (``target_exists``), never overwritten;
    * unreadable gzip streams are skipped with the decoder's message;
    * ``on_bad_utf8='skip'`` skips a file holding invalid UTF-8 (the
      reference's strict read fails on it), judged by its bytes, so a real
      U+FFFD is no fault; ``'replace'`` drops U+FFFD;
    * a file with a row of more fields than the header is skipped as a whole
      (the reference's reader fails on it): nothing is cut off; rows with
      fewer fields are filled with NULL;
    * quoted line breaks are read in gzip files (one split each anyway), in a
      header in any file; a header that does not end is a reason to skip;
    * repeated and empty header names are numbered, as a data frame reader does;
    * a file with a header and no rows gives a file with the header;
    * ``source_action``: ``'keep'`` (default), ``'delete'`` or ``'archive'``
      (move to ``archive_dir``) after a successful write.
    """
    read_opts = dict(options or profile("infer_csv"))
    src = list_files(spark, source)
    tgt = list_files(spark, target).select("relative_path")
    listing = src.join(tgt.withColumn("__exists", F.lit(True)), "relative_path", "left") \
        .select("path", "relative_path", "file_name", "__exists").collect()  # names only
    report: list[tuple] = []
    todo = []
    for r in sorted(listing, key=lambda r: r["relative_path"]):
        if r["__exists"]:
            report.append((r["path"], f"{target.rstrip('/')}/{r['relative_path']}",
                           "skipped", "target_exists"))
        else:
            todo.append(r)
    # Files are matched to their outputs by base name, so files that share a
    # name (in different sub-folders) go to separate rounds.
    rounds: list[list] = []
    seen: dict[str, int] = {}
    for r in todo:
        k = seen.get(r["file_name"], 0)
        seen[r["file_name"]] = k + 1
        if k == len(rounds):
            rounds.append([])
        rounds[k].append(r)
    for batch in rounds:
        headers = read_headers(spark, [r["path"] for r in batch], read_opts)
        none = [r["path"] for r in batch if r["path"] not in headers]
        broken = check_compression(spark, none)
        groups: dict[tuple, list] = {}
        for r in batch:
            head = headers.get(r["path"])
            if head is None or head.fault or not head.columns:
                report.append((r["path"], None, "skipped", head.fault if head and head.fault
                               else broken.get(r["path"], "no header row")))
                continue
            gzipped = r["file_name"].endswith(".gz")
            # a gzip file is one split anyway; another file is read as a whole
            # only if its header spans lines
            whole = gzipped or any("\n" in c for c in head.columns)
            groups.setdefault((tuple(distinct_names(head.columns)), gzipped, whole), []).append(r)
        for key, files in groups.items():
            def clean(some: list, key: tuple = key) -> list[tuple]:
                return _clean_group(spark, some, *key, target, read_opts, on_bad_utf8)

            try:
                done = clean(files)
            except Exception:  # noqa: BLE001 - find the unreadable files, then retry once
                broken = check_compression(spark, [r["path"] for r in files])
                if not broken:
                    raise
                report += [(path, None, "skipped", why) for path, why in broken.items()]
                done = clean([r for r in files if r["path"] not in broken])
            for r, dst, reason in done:
                report.append((r["path"], dst, "skipped" if reason else "processed", reason))
                if not reason:
                    _source_action(spark, r, source_action, archive_dir)

    refresh(spark, target)
    rep = spark.createDataFrame(report, REPORT_SCHEMA) if report else \
        spark.createDataFrame([], REPORT_SCHEMA)
    return CleanResult(summary_json(report), rep)


def _clean_group(spark: SparkSession, files: list, cols: tuple[str, ...], gzipped: bool,
                 whole: bool, target: str, read_opts: dict[str, str], on_bad_utf8: str
                 ) -> list[tuple]:
    """Clean files of one header in one job: (file, target, reason of a skip)."""
    if not files:
        return []
    pos = [f"c{i}" for i in range(len(cols))]
    # one column more than the header, and the record's text: a row that
    # fills the schema, or has more separators than that, is too long
    schema = T.StructType([T.StructField(c, T.StringType())
                           for c in [*pos, "__extra", "__record"]])
    opts = {**read_opts, "columnNameOfCorruptRecord": "__record",
            **({"multiLine": "true"} if whole else {})}
    raw = (spark.read.options(**opts).schema(schema).csv([r["path"] for r in files])
           .withColumn("__file", F.col("_metadata.file_name"))
           .withColumn("__split", F.col("_metadata.file_block_start")))
    by_name = {r["file_name"]: r for r in files}
    # file order = (split start, scan position): no exact row numbers
    # are needed, so no per-split summary pass
    numbered = raw.withColumn("__mono", F.monotonically_increasing_id())
    has_bad = F.lit(False)
    for c in pos:
        has_bad = has_bad | F.coalesce(F.instr(F.col(c), REPLACEMENT_CHAR) > 0, F.lit(False))
    obs = Observation(f"clean_{uuid.uuid4().hex}")
    # files with invalid UTF-8 are found on the same pass (Observation)
    # and their outputs dropped before they are published
    observed = numbered.observe(
        obs, F.collect_set(F.when(has_bad, F.col("__file"))).alias("bad_files"),
        F.collect_set(F.when(_too_long(opts, len(cols)), F.col("__file")))
        .alias("long_files")).drop("__extra", "__record")
    cleaned = clean_frame(observed, pos, on_bad_utf8="replace" if on_bad_utf8 == "replace"
                          else "keep")
    if len(pos) == 1:  # a lone NULL would be an empty line, which readers drop
        cleaned = cleaned.withColumn(pos[0], F.coalesce(pos[0], F.lit("")))
    staging = f"{target.rstrip('/')}/_tmp_clean_{uuid.uuid4().hex}"
    try:
        # names may differ in case alone
        with conf_for(spark, {"spark.sql.caseSensitive": "true"}):
            named = cleaned.select(*[F.col(p).alias(n) for p, n in zip(pos, cols)],
                                   "__file", "__split", "__mono")
            # a gzip file is read by one task, so its rows never need a shuffle;
            # uncompressed files may be split and are brought together by name
            written = write_named_csv(spark, named, staging, "__file",
                                      order_by=["__split", "__mono"],
                                      options=_write_options("gzip" if gzipped else "none"),
                                      shuffle=not gzipped, drop=["__split", "__mono"])
        bad = set(obs.get.get("bad_files") or []) if on_bad_utf8 == "skip" else set()
        if bad:  # a replacement character may be real: judge the bytes of those files
            bad = invalid_utf8(spark, [by_name[n]["path"] for n in bad])
        too_long = set(obs.get.get("long_files") or [])
        out, moves = [], []
        for name, r in sorted(by_name.items()):
            if r["path"] in bad:
                out.append((r, None, "invalid UTF-8 bytes"))
            elif name in too_long:
                out.append((r, None, "rows with more fields than the header"))
            else:
                if name not in written:  # a header and nothing else
                    _write_header(spark, f"{staging}/{name}", cols, gzipped)
                out.append((r, f"{target.rstrip('/')}/{r['relative_path']}", None))
                moves.append((f"{staging}/{name}", out[-1][1]))
        move_files(spark, moves)
    finally:
        delete(spark, staging)
    return out


def _too_long(opts: dict[str, str], n: int) -> Column:
    """Whether a row read with one column more than the header's ``n`` has
    more than ``n`` fields (the record's text is NULL if it fills the schema)."""
    sep, quote = opts.get("sep", ","), opts.get("quote", '"')
    record = F.col("__record")

    def fields(c: Column) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(sep), F.lit(""))) + 1

    bare = F.regexp_replace(record, f"{quote}(?:[^{quote}]|{quote}{quote})*{quote}", "")
    return F.when(record.isNull(), F.lit(True)).otherwise(
        F.when(F.col("__extra").isNotNull(), F.lit(True)).otherwise(
            (fields(record) > n) & (fields(bare) > n)))


def _utf8_fault(path: str, stream: BinaryIO) -> tuple[str, bool]:
    """Whether the file's (inflated) bytes are not UTF-8."""
    decoder = codecs.getincrementaldecoder("utf-8")("strict")
    try:
        for data in file_chunks(path, stream):
            decoder.decode(data)
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return path, True
    return path, False


def invalid_utf8(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Which of the files hold bytes that are not UTF-8; files are streamed."""
    return {path for path, bad in each_file(spark, paths, _utf8_fault, "path string, bad boolean")
            if bad}


def _write_header(spark: SparkSession, path: str, cols: Sequence[str], gzipped: bool) -> None:
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerow(cols)
    data = buf.getvalue().encode("utf-8")
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(gzip.compress(data) if gzipped else data))
    finally:
        out.close()


def _write_options(compression: str = "gzip") -> dict[str, str]:
    return profile("export_csv", ignoreLeadingWhiteSpace="false",
                   ignoreTrailingWhiteSpace="false", compression=compression)


def _source_action(spark: SparkSession, r, action: str, archive_dir: str | None) -> None:
    if action == "delete":
        delete(spark, r["path"], recursive=False)
    elif action == "archive":
        if not archive_dir:
            raise ValueError("archive_dir is required for source_action='archive'")
        rename(spark, r["path"], f"{archive_dir.rstrip('/')}/{r['relative_path']}")


def summary_json(report: Sequence[tuple]) -> str:
    """``{"processed_files": [...], "skipped_files": [...]}``, indented, sorted keys."""
    if not report:
        return json.dumps({"processed_files": [], "note": "nothing to clean under the source folder"})
    # The keys of the report that callers of the reference read.
    processed = [{"source file": s, "target file": t} for s, t, st, _ in report if st == "processed"]
    skipped = [{"skipped file": s, "reason": why} for s, _, st, why in report if st == "skipped"]
    return json.dumps({"processed_files": processed, "skipped_files": skipped},
                      indent=2, sort_keys=True)

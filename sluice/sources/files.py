"""File sets: listing, discovery, name filters, reader profiles, guards.

SURVEY A1, A2, A6, A11, A18, A20-A22.  A file listing is an ordinary
DataFrame (``binaryFile`` with the content column pruned, so no file body
is read), which lets the later steps join and filter it like any table.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import regexp_full_match
from sluice.operators.snapshot import _fs, path_exists

# Named reader/writer option sets (A11).  The reference names its file
# formats but does not show their options; these are the options its data
# needs: header row, comma, gzip by extension.
PROFILES: dict[str, dict[str, str]] = {
    "infer_csv": {"header": "true", "sep": ",", "quote": '"', "escape": '"',
                  "mode": "PERMISSIVE"},
    "ingest_csv": {"header": "true", "sep": ",", "quote": '"', "escape": '"',
                   "mode": "PERMISSIVE"},
    "export_csv": {"header": "true", "sep": ",", "quote": '"', "escape": '"',
                   "compression": "gzip", "ignoreLeadingWhiteSpace": "false",
                   "ignoreTrailingWhiteSpace": "false",
                   # keep microseconds (the default text form stops at millis)
                   "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"},
    "unload_json": {"compression": "gzip"},
}


def profile(name: str, **overrides: str) -> dict[str, str]:
    opts = copy.deepcopy(PROFILES[name])
    opts.update({k: str(v) for k, v in overrides.items()})
    return opts


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """``SELECT relative_path, size, last_modified FROM DIRECTORY(@stage)`` (A1).

    Columns: ``path`` (qualified), ``relative_path``, ``file_name``,
    ``length``, ``modification_time``.  Empty when the folder is missing.
    """
    schema = ("path string, relative_path string, file_name string, length bigint, "
              "modification_time timestamp")
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    root = qualified(spark, path).rstrip("/") + "/"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path).select("path", "length", "modificationTime")
    return df.select(
        "path",
        F.expr(f"substring(path, {len(root) + 1})").alias("relative_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").cast("bigint").alias("length"),
        F.col("modificationTime").alias("modification_time"),
    )


def ordered(listing: DataFrame) -> DataFrame:
    """Listing ordered by relative path (F3); for small outputs and reports."""
    return listing.orderBy("relative_path")


def filter_names(listing: DataFrame, pattern: str | None = None,
                 names: Iterable[str] | None = None, exclude: str | None = None,
                 column: str = "file_name") -> DataFrame:
    """Keep files matching ``pattern`` (full-match regex) or in ``names``.

    ``names`` are matched literally: the reference passed a file name as a
    regex, where ``.`` matches any character.  ``exclude`` drops names
    fully matching a regex (B5).
    """
    out = listing
    if pattern is not None:
        out = out.where(regexp_full_match(F.col(column), pattern))
    if names is not None:
        names = list(names)
        out = out.where(F.col(column).isin(names) if names else F.lit(False))
    if exclude is not None:
        out = out.where(~regexp_full_match(F.col(column), exclude))
    return out


def discover_files(spark: SparkSession, paths: Sequence[str] | str,
                   options: dict[str, str] | None = None) -> DataFrame:
    """Names of files that have a first data row, ordered (A2).

    With ``header=true`` a header-only or empty file has no data row and is
    not returned; with ``header=false`` the header itself is row 1.  The
    distinct is combined map-side (one row per file per task).
    """
    opts = options or profile("ingest_csv")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], "file_name string")
    df = spark.read.options(**opts).schema("__c0 string").csv(paths)
    return (df.select(F.col("_metadata.file_name").alias("file_name"))
            .distinct().orderBy("file_name"))


def guard_new_dir(spark: SparkSession, path: str) -> None:
    """Stop if the output folder exists (A18): never overwrite an export."""
    if path_exists(spark, path):
        raise FileExistsError(f"Directory already exists at {path}; "
                              "stopping to prevent overwriting existing files")


def refresh(spark: SparkSession, path: str) -> None:
    """Drop cached listings of ``path`` (A22); a fresh read lists anyway."""
    spark.catalog.refreshByPath(path)

"""Materialised intermediates and file-system helpers.

A staged table is written as parquet under the shared checkpoint folder and
read back: it cuts lineage (a lost executor does not force the whole chain
to be recomputed) and the snapshot cannot change underneath later steps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice.session import scratch_path
from sluice.sources.streams import NoStream, list_store, move_files


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def rename(spark: SparkSession, src: str, dst: str, overwrite: bool = False) -> None:
    """Move one file or folder (a rename on HDFS, a copy on object stores).

    Raises unless the target is there afterwards, so a caller may remove what
    it came from.
    """
    fs, s = _fs(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if not fs.exists(d.getParent()):
        fs.mkdirs(d.getParent())
    if overwrite and fs.exists(d):
        fs.delete(d, True)
    if not fs.rename(s, d) or not fs.exists(d):
        raise OSError(f"could not move {src} to {dst}")


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def list_status(spark: SparkSession, path: str):
    """(name, full path, length, is_dir) of the direct children of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    root = fs.makeQualified(p).toString().rstrip("/")
    try:  # one call for the folder; the JVM's statuses take some calls each
        return [(name, f"{root}/{name}", length, is_dir)
                for name, length, is_dir in list_store(root)]
    except NoStream:
        pass
    return [(s.getPath().getName(), s.getPath().toString(), int(s.getLen()), bool(s.isDirectory()))
            for s in fs.listStatus(p)]


def stage(spark: SparkSession, df: DataFrame, purpose: str = "stage",
          path: str | None = None) -> DataFrame:
    """``CREATE OR REPLACE TEMPORARY TABLE x AS <query>``.

    Writes ``df`` once to the shared scratch folder and returns a DataFrame
    reading it back.
    """
    path = path or scratch_path(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def append_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Append to a parquet table so that a broken-off append can be mended.

    The rows are first written whole to a hidden folder ``_append_<id>`` of
    the table (readers skip it), then a ``_ready`` marker is set, then the
    files are moved into the table.  ``mend_appends`` finishes a marked
    append and drops an unmarked one; file names are unique, so moving twice
    is harmless.  One writer per table at a time.
    """
    staging = f"{path.rstrip('/')}/{_APPEND}{uuid.uuid4().hex}"
    df.write.parquet(staging)
    fs, marker = _fs(spark, f"{staging}/_ready")
    fs.create(marker, True).close()
    _finish_append(spark, path, staging)


_APPEND = "_append_"


def _finish_append(spark: SparkSession, path: str, staging: str) -> None:
    move_files(spark, [(full, f"{path.rstrip('/')}/{name}")
                       for name, full, _, _ in list_status(spark, staging)
                       if name.startswith("part-")])
    delete(spark, staging)


def mend_appends(spark: SparkSession, path: str) -> None:
    """Finish or drop what earlier appends to the table have left."""
    for name, full, _, is_dir in list_status(spark, path):
        if is_dir and name.startswith(_APPEND):
            if path_exists(spark, f"{full}/_ready"):
                _finish_append(spark, path, full)
            else:
                delete(spark, full)


def create_table_as_if_absent(spark: SparkSession, path: str, query: DataFrame) -> bool:
    """``CREATE TABLE IF NOT EXISTS t AS SELECT ...`` (A24).  True if created."""
    if path_exists(spark, path):
        return False
    query.write.mode("errorifexists").parquet(path)
    return True


def create_table(spark: SparkSession, path: str, schema) -> bool:
    """``CREATE TABLE IF NOT EXISTS t (<columns>)`` for a parquet path table.

    ``schema`` is a DDL string or StructType; an existing table is left as
    it is (``mode('ignore')``).  Returns True when the table was created.
    """
    existed = path_exists(spark, path)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return not existed


def _parts(spark: SparkSession, path: str) -> dict[str, list[tuple[str, int]]]:
    """Folder in ``path`` -> (full path, length) of its part files."""
    fs, p = _fs(spark, path)
    root = fs.makeQualified(p).toString().rstrip("/")
    try:
        found = list_store(root, recursive=True)
    except NoStream:
        return {d: [(f[1], f[2]) for f in list_status(spark, full) if f[0].startswith("part-")]
                for d, full, _, is_dir in list_status(spark, path) if is_dir}
    out: dict[str, list[tuple[str, int]]] = {
        name: [] for name, _, is_dir in found if is_dir and "/" not in name}
    for name, length, _ in found:
        d, _, part = name.partition("/")
        if part.startswith("part-") and "/" not in part:
            out[d].append((f"{root}/{name}", length))
    return out


def publish_named(spark: SparkSession, tmp: str, out_dir: str, column: str,
                  overwrite: bool = False) -> list[tuple[str, int]]:
    """Move the single part file of each ``<column>=<name>`` folder written
    under ``tmp`` to ``<out_dir>/<name>`` (metadata only), then drop ``tmp``.

    Returns (name, length) per published file.  More than one part file for
    a name means the rows of one name were not kept in one task: an error.
    """
    from urllib.parse import unquote
    prefix = f"{column}="
    out, moves = [], []
    for d, parts in _parts(spark, tmp).items():
        if not d.startswith(prefix):
            continue
        name = unquote(d[len(prefix):])
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file for {name}, found {len(parts)}")
        moves.append((parts[0][0], f"{out_dir.rstrip('/')}/{name}"))
        out.append((name, parts[0][1]))
    move_files(spark, moves, overwrite)
    delete(spark, tmp)
    return sorted(out)

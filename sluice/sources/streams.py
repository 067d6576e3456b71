"""Single files, handled inside tasks: streamed bytes, renames.

``each_file`` runs a function over the open byte stream of every file of a
list, one file a row, spread over the executors; a task holds one chunk of a
file, whatever its size, and stops where the function stops.  Stores that
pyarrow can open (shared folders, HDFS, S3, GCS) are streamed; files of any
other store come as whole rows of Spark's ``binaryFile`` source, which takes
files of up to 2 GiB.

``move_files`` renames many files in a job.  Hadoop keeps a checksum file
``.<name>.crc`` beside a local file and refuses to read what does not match it;
so renames take it along, and one of a replaced file goes.  ``inflated`` undoes gzip (several members too) chunk by chunk.
"""

from __future__ import annotations

import contextlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from sluice.session import conf_for, ship_package

CHUNK = 1 << 20
_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)")


class NoStream(Exception):
    """The file's store cannot be opened from here."""


def _store(path: str):
    """pyarrow's file system for a path, and the path in it."""
    from pyarrow import fs as pafs

    m = _URI.fullmatch(path)
    try:
        if m is None or m[1].lower() == "file":
            store, name = pafs.LocalFileSystem(), m[3] if m else path
        else:
            store = pafs.FileSystem.from_uri(f"{m[1]}://{m[2] or ''}/")[0]
            name = m[3] if m[1].lower() in ("hdfs", "viewfs") else (m[2] or "") + m[3]
    except (ValueError, OSError, NotImplementedError, ImportError) as exc:
        raise NoStream(str(exc)) from exc
    return store, name


def can_open(path: str) -> bool:
    """Whether tasks can open files of the path's store."""
    try:
        _store(path)
    except NoStream:
        return False
    return True


def open_stream(path: str) -> BinaryIO:
    """The file's bytes from the start; ``NoStream`` if only Spark reads its store."""
    store, name = _store(path)
    return store.open_input_stream(name, compression=None)


def write_whole(path: str, data: bytes) -> None:
    """Write a file so that it is there whole or not at all."""
    store, name = _store(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as out:
        out.write(data)
    _replace(store, part, name)


def _checksum(name: str) -> str:
    """The checksum file that Hadoop writes beside a local file."""
    folder, _, base = name.rpartition("/")
    return f"{folder}/.{base}.crc"


def _replace(store, old: str, new: str) -> None:
    """Rename one file.  The target's checksum goes first and the file's own one
    comes last, so a broken-off rename never leaves a wrong one."""
    from pyarrow import fs as pafs

    local = isinstance(store, pafs.LocalFileSystem)
    if local:
        with contextlib.suppress(FileNotFoundError):
            store.delete_file(_checksum(new))
    store.move(old, new)
    if local:
        with contextlib.suppress(FileNotFoundError):
            store.move(_checksum(old), _checksum(new))


def list_store(path: str, recursive: bool = False) -> list[tuple[str, int, bool]]:
    """(path below ``path``, length, is a folder) of what a folder holds, without
    checksum files; ``NoStream`` if only Spark reads its store."""
    from pyarrow import fs as pafs

    store, name = _store(path)
    local, name = isinstance(store, pafs.LocalFileSystem), name.rstrip("/")
    found = store.get_file_info(pafs.FileSelector(name, allow_not_found=True, recursive=recursive))
    return [(i.path[len(name) + 1:], i.size or 0, i.type == pafs.FileType.Directory)
            for i in found
            if not (local and i.base_name.startswith(".") and i.base_name.endswith(".crc"))]


def inflated(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[bytes]:
    """Bytes of a gzip stream, ``chunk`` at most at a time; ``EOFError`` where a
    member is cut off, ``zlib.error`` where the bytes are no gzip."""
    z, members = None, 0
    while data := stream.read(chunk):
        while data:
            if z is None:
                data = data.lstrip(b"\0") if members else data  # padding between members
                if not data:
                    break
                z = zlib.decompressobj(16 + zlib.MAX_WBITS)
            out = z.decompress(data, chunk)
            data = z.unconsumed_tail
            if out:
                yield out
            if z.eof:
                data, z, members = z.unused_data, None, members + 1
    while z is not None:
        out = z.decompress(b"", chunk)
        if not out and not z.eof:
            raise EOFError("truncated gzip stream")
        if out:
            yield out
        if z.eof:
            return
    if not members:
        raise EOFError("empty gzip stream")


def file_chunks(path: str, stream: BinaryIO, chunk: int = CHUNK) -> Iterator[bytes]:
    """The file's content, inflated if its name ends in ``.gz``."""
    if path.endswith(".gz"):
        yield from inflated(stream, chunk)
        return
    while data := stream.read(chunk):
        yield data


def each_file(spark: SparkSession, paths: Sequence[str],
              judge: Callable[[str, BinaryIO], tuple], schema: str) -> list[tuple]:
    """``judge(path, stream)`` for every file: rows of ``schema``, whose first
    column is the path.  For small facts about files; all rows are collected."""
    if not paths:
        return []
    ship_package(spark)
    columns = [c.strip().split(" ")[0] for c in re.split(r",(?![^<]*>)", schema)]

    def rows(found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(found, columns=[*columns, "streamed"], dtype=object)

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                try:
                    with open_stream(path) as stream:
                        yield rows([(*judge(path, stream), True)])
                except NoStream:
                    yield rows([(path, *[None] * (len(columns) - 1), False)])

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield rows([(*judge(path, io.BytesIO(content)), True)
                        for path, content in zip(pdf["path"], pdf["content"])])

    out = f"{schema}, streamed boolean"
    tasks = min(len(paths), max(spark.sparkContext.defaultParallelism, len(paths) // 32))
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    got = listed.mapInPandas(streamed, out).collect()
    rest = [r[0] for r in got if not r["streamed"]]
    if rest:
        with conf_for(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
            raw: DataFrame = spark.read.format("binaryFile").load(rest).select("path", "content")
            late = raw.mapInPandas(whole, out).collect()
        # Spark may spell a path in another way than it was given
        by_name = {r[0]: r for r in late} | {r[0].rsplit("/", 1)[-1]: r for r in late}
        got = [r for r in got if r["streamed"]] + [
            (p, *(by_name.get(p) or by_name[p.rsplit("/", 1)[-1]])[1:]) for p in rest]
    return [tuple(r)[:-1] for r in got]


#: Up to so many files the driver renames itself; more are a job.
DRIVER_MOVES = 64


def _move(src: str, dst: str, overwrite: bool) -> str | None:
    """Rename one file, also when an earlier try has already done it."""
    from pyarrow import fs as pafs

    (store, old), (_, new) = _store(src), _store(dst)
    there = [i.type != pafs.FileType.NotFound for i in store.get_file_info([old, new])]
    if there == [False, True]:
        return None
    if there == [True, True] and not overwrite:
        return f"{dst} exists already"
    if not there[0]:
        return f"{src} is gone"
    store.create_dir(new.rsplit("/", 1)[0], recursive=True)
    _replace(store, old, new)
    return None


def move_files(spark: SparkSession, moves: Sequence[tuple[str, str]], overwrite: bool = False
               ) -> None:
    """Rename files ``(from, to)`` within their store, spread over tasks.

    A task that runs twice finds the files it has moved.  Stores that pyarrow
    cannot open are left to the driver, which keeps some renames under way.
    Raises if a file could not be moved.
    """
    from sluice.operators.snapshot import rename

    def by_driver(pair: tuple[str, str]) -> None:
        rename(spark, *pair, overwrite=overwrite)

    if len(moves) <= DRIVER_MOVES:
        for pair in moves:
            by_driver(pair)
        return
    ship_package(spark)

    def moved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for src, dst in zip(pdf["src"], pdf["dst"]):
                try:
                    error = _move(src, dst, overwrite)
                except NoStream:
                    found.append((src, dst, None))
                except OSError as exc:
                    found.append((src, dst, str(exc)))
                else:
                    if error:
                        found.append((src, dst, error))
            yield pd.DataFrame(found, columns=["src", "dst", "error"], dtype=object)

    listed = spark.createDataFrame(list(moves), "src string, dst string").repartition(
        min(len(moves) // 16 + 1, 4 * spark.sparkContext.defaultParallelism))
    left = listed.mapInPandas(moved, "src string, dst string, error string").collect()
    if bad := [r for r in left if r["error"]]:
        raise OSError(f"could not move {len(bad)} files, first {bad[0]['src']}: {bad[0]['error']}")
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(by_driver, [(r["src"], r["dst"]) for r in left]))

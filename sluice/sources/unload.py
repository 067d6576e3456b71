"""Unload a variant column to gzip JSON-lines files.

The reference copies each feed's responses into one file
``<feed>_<yyyymmdd>.json.gz`` with a 16 MiB cap.  Here every feed is
written by one job: the bytes of a feed's lines are added up within each
input partition and a new file starts before the cap (of uncompressed bytes)
is passed, so every file is under it however large the feed is, equal rows
are split like any others, and each file is written by one task.  Only a line
longer than the cap makes a larger file.  A feed that fits in one file keeps the
reference's exact name; larger feeds get ``<feed>_<yyyymmdd>_<nnnn>.json.gz``
(more digits from 10,000 files on).  A rerun on the same day replaces the
feed's files of that day.  ``single=True`` demands one file per feed and
raises when a feed exceeds the cap, as the reference's single-file copy does.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators.snapshot import delete, list_status, publish_named, stage
from sluice.sources.files import profile

MAX_FILE_SIZE = 16_777_216  # bytes per unloaded file, as in the reference

UNLOADED_NAME = r"^(.*)_(\d{8})(?:_\d{4,})?\.json\.gz$"


def unload_json(spark: SparkSession, responses: DataFrame, out_dir: str, run_date: _dt.date,
                feed_col: str = "api_name", value_col: str = "json_response",
                feeds: Sequence[str] | None = None, max_file_size: int = MAX_FILE_SIZE,
                single: bool = False) -> DataFrame:
    """Write one or more files per feed; returns one row per feed:
    (feed, rows_unloaded, input_bytes, output_bytes, files).

    Rows without a feed belong to no file, as a filter by feed name leaves them
    out; a report row without a feed gives their bytes."""
    src = responses
    if feeds is not None:
        src = src.where(F.col(feed_col).isin(list(feeds)))
    # places are written with the lines: every later step reads the same ones
    staged = stage(spark, src.select(F.col(feed_col).cast("string").alias("__feed"),
                                     F.to_json(F.col(value_col)).alias("value"),
                                     F.spark_partition_id().alias("__pid"),
                                     F.monotonically_increasing_id().alias("__mono")),
                   "unload-lines").withColumn("__bytes", F.octet_length("value") + 1)
    lines = staged.where(F.col("__feed").isNotNull())
    sizes = (staged.groupBy("__feed")
             .agg(F.sum("__bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                  F.max("__bytes").alias("longest"))
             .collect())  # one row per feed
    left = sum(r["bytes"] for r in sizes if r["__feed"] is None)
    sizes = [r for r in sizes if r["__feed"] is not None]
    for r in sizes:
        if single and r["bytes"] > max_file_size:
            raise ValueError(f"feed {r['__feed']}: {r['bytes']} bytes exceed the single-file "
                             f"cap of {max_file_size} bytes")
    stamp = f"{run_date:%Y%m%d}"
    # files of a partition: a line belongs to the file in whose room it ends; with the longest
    # line kept free, no file passes the cap.  A feed below the cap is one file.
    room = _per_feed({r["__feed"]: 0 if r["bytes"] <= max_file_size else
                      max(1, max_file_size - int(r["longest"])) for r in sizes})
    upto = F.sum("__bytes").over(Window.partitionBy("__feed", "__pid").orderBy("__mono")
                                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = lines.withColumn("__room", room).withColumn(
        "__in", F.when(F.col("__room") == 0, F.lit(0).cast("bigint")).otherwise(
            F.floor((upto - 1) / F.col("__room")))) \
        .withColumn("__pid", F.when(F.col("__room") == 0, F.lit(0)).otherwise(F.col("__pid")))
    numbers = placed.select("__feed", "__pid", "__in").distinct().withColumn(
        "__n", F.row_number().over(Window.partitionBy("__feed").orderBy("__pid", "__in")) - 1)
    idx = F.col("__n").cast("string")
    idx = F.lpad(idx, F.greatest(F.lit(4), F.length(idx)), F.lit("0"))
    name = F.when(F.col("__room") == 0, F.concat("__feed", F.lit(f"_{stamp}.json.gz"))) \
        .otherwise(F.concat(F.col("__feed"), F.lit(f"_{stamp}_"), idx, F.lit(".json.gz")))
    named = placed.join(numbers, ["__feed", "__pid", "__in"]).withColumn("__name", name)
    tmp = f"{out_dir.rstrip('/')}/_tmp_unload_{uuid.uuid4().hex}"
    (named.select("__name", "value").repartition("__name")
     .write.partitionBy("__name").options(**profile("unload_json")).text(tmp))
    written: dict[str, list[tuple[str, int]]] = {}
    for fname, length in publish_named(spark, tmp, out_dir, "__name", overwrite=True):
        written.setdefault(fname.rsplit(f"_{stamp}", 1)[0], []).append((fname, length))
    # files of an earlier run of the day that this run did not write again
    mine = {r["__feed"]: {f for f, _ in written.get(r["__feed"], [])} for r in sizes}
    for old, full, _, _ in list_status(spark, out_dir):
        m = re.match(UNLOADED_NAME, old)
        if m and m[1] in mine and m[2] == stamp and old not in mine[m[1]]:
            delete(spark, full, recursive=False)
    # per feed, as the dialect's unload result: rows, input and output bytes
    # (from the size pass and the written files' lengths; no extra data pass)
    report = [(r["__feed"], int(r["rows"]), int(r["bytes"]),
               sum(n for _, n in written.get(r["__feed"], [])),
               sorted(f for f, _ in written.get(r["__feed"], [])))
              for r in sizes]
    if left:
        report.append((None, 0, int(left), 0, []))
    return spark.createDataFrame(
        report, "feed string, rows_unloaded bigint, input_bytes bigint, output_bytes bigint, "
                "files array<string>")


def _per_feed(values: dict):
    """A literal map from feed to value."""
    if not values:
        return F.lit(0)
    return F.element_at(F.create_map(*[x for k, v in values.items()
                                       for x in (F.lit(k), F.lit(v).cast("bigint"))]),
                        F.col("__feed"))


def read_unloaded(spark: SparkSession, out_dir: str) -> DataFrame:
    """Read unloaded files back: (feed, file_date, file_name, value variant)."""
    # a filter, not a glob: the folder is listed once, not every file by itself
    df = spark.read.option("pathGlobFilter", "*.json.gz").text(out_dir)
    name = F.col("_metadata.file_name")
    return df.select(
        F.regexp_extract(name, UNLOADED_NAME, 1).alias("feed"),
        F.to_date(F.regexp_extract(name, UNLOADED_NAME, 2), "yyyyMMdd").alias("file_date"),
        name.alias("file_name"),
        F.parse_json("value").alias("value"),
    )

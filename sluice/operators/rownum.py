"""Row numbers without a single-partition sort.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY sends every row to
one task.  ``global_row_number`` gives the same numbers in parallel:

1. one range shuffle on the sort keys (Spark samples the bounds itself, 100
   keys a partition) and a sort inside each range, which spills;
2. the sorted ranges are written once with their range number and the row's
   place in its range, both taken from the scan order: no window;
3. rows are counted by range (one narrow column; as many counts as ranges
   reach the driver), and the running sum of the counts is each range's offset;
4. number = place + offset, a broadcast join with one row per range.

Writing the ranges makes the numbers firm: bounds are drawn anew by each run
of the range shuffle, so counting one run and numbering another would not
agree, and a lost executor reads the table again instead of the input.

The ordering includes a tie-breaker over the remaining columns, so one very
frequent key value is still split across ranges by the bounds.

``file_row_number`` numbers rows inside their source file from the scan
order alone (no shuffle of the data, only a per-split aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _tiebreak(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in keys and isinstance(f.dataType, _ORDERABLE)]


def _ranges(df: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """The rows sorted and written by key range, with ``__range`` and the
    1-based ``__place`` in it; both from the order of the sorted rows, so a
    task that runs again writes the same."""
    from sluice.operators.snapshot import stage

    sort = [F.col(f"`{c}`").asc_nulls_last() for c in order]
    pid = F.spark_partition_id()
    # the id counts a partition's rows in its lower 33 bits
    place = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33) + 1
    cut = (df.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort)
           .withColumns({"__range": pid, "__place": place}))
    return stage(df.sparkSession, cut, "rownum-ranges")


def global_row_number(df: DataFrame, keys: Sequence[str], name: str = "row_number", *,
                      buckets: int | None = None, tiebreak: Sequence[str] | None = None,
                      stage: bool = False) -> DataFrame:
    """Add ``name`` = 1-based position of the row in ``ORDER BY keys`` (asc, nulls last).

    ``buckets`` key ranges are made (``spark.sql.shuffle.partitions`` if not
    given).  Rows equal in the keys are ordered by ``tiebreak`` (all other
    columns with an order, if not given); rows equal in those too get their
    numbers in any order.  No rows give no rows.

    The input is read twice (bounds, rows).  ``stage=True`` first writes it to
    the shared checkpoint folder, so that an expensive one (parsing,
    exploding) is computed once; the bounds then read only the key columns,
    and equal rows are split over ranges by their place in the written files
    (without it they lie in one range, which sorts on disk).
    """
    spark = df.sparkSession
    order = list(keys) + list(tiebreak if tiebreak is not None else _tiebreak(df, keys))
    if stage:
        from sluice.operators.snapshot import stage as _stage
        df = _stage(spark, df, "rownum-input").withColumns(
            {"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")})
        order += ["__file", "__row"]
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _ranges(df, order, buckets)
    offsets, before = [], 0
    for part, n in sorted(rows.groupBy("__range").count().collect()):  # a row per range
        offsets.append((part, before))
        before += n
    offsets = spark.createDataFrame(offsets, "__range int, __before bigint")
    return (rows.join(F.broadcast(offsets), "__range")  # a row per range
            .withColumn(name, F.col("__place") + F.col("__before"))
            .drop("__range", "__place", "__before", *(["__file", "__row"] if stage else [])))


def single_partition_row_number(df: DataFrame, keys: Sequence[str],
                                name: str = "row_number") -> DataFrame:
    """The plain window, one task for all rows.  For comparison only."""
    order = list(keys) + _tiebreak(df, keys)
    return df.withColumn(name, F.row_number().over(Window.orderBy(
        *[F.col(f"`{c}`").asc_nulls_last() for c in order])).cast("bigint"))


def file_row_number_one_file_per_partition(df: DataFrame,
                                           name: str = "source_file_row_number") -> DataFrame:
    """Row number in file when every input partition holds exactly one whole
    file (e.g. gzip files read with a large ``spark.sql.files.openCostInBytes``).

    ``monotonically_increasing_id`` puts the partition id in the upper 31
    bits and the record number within the partition in the lower 33, so the
    row number is the lower part + 1: one scan, no summary, no join.  The
    caller must make sure the one-file-per-partition condition holds (adds
    ``__pid`` for that check).
    """
    mono = F.monotonically_increasing_id()
    pid = F.spark_partition_id()
    return (df.withColumn("__pid", pid)
            .withColumn(name, (mono - F.shiftleft(pid.cast("bigint"), 33) + 1).cast("bigint")))


def file_row_number(df: DataFrame, name: str = "source_file_row_number",
                    file_col: str = "__file", split_col: str = "__split") -> DataFrame:
    """1-based row number of each row inside its file, in file order.

    ``df`` must come straight from a file scan and carry the file name in
    ``file_col`` and ``_metadata.file_block_start`` in ``split_col``.  Rows of
    one split are read in order by one task, so within a split the
    monotonically increasing id is consecutive; the row number is the id
    minus the split's first id plus the rows of the earlier splits of the
    same file.  Only the tiny per-split summary is aggregated and joined
    back; a gzip file is one split, so then the offset is 0.
    """
    tagged = df.withColumn("__mono", F.monotonically_increasing_id())
    splits = (tagged.groupBy(file_col, split_col)
              .agg(F.min("__mono").alias("__first"), F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(file_col).orderBy(split_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    out = tagged.join(splits.select(file_col, split_col, "__first", "__before"),
                      on=[file_col, split_col], how="inner")
    return (out.withColumn(name, (F.col("__mono") - F.col("__first") + F.col("__before") + 1)
                           .cast("bigint"))
            .drop("__mono", "__first", "__before"))

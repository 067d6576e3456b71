"""Landed CSV files: names, positional reads, lineage columns, named writes.

SURVEY A3, A4, A5, B6, E2, §1.3.  A landed file is named
``<entity>_<yyyyMMddHHmmss>_UTC.csv.gz``; the entity (upper-cased) is the
table it loads into and the 8 date digits are the file's date.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.dates import ntz_literal
from sluice.functions.keys import concat_key
from sluice.functions.text import regexp_group
from sluice.operators.rownum import file_row_number, file_row_number_one_file_per_partition
from sluice.operators.snapshot import publish_named
from sluice.sources.files import profile

# Landed file name rules.  Dots are escaped and the end is
# anchored (the reference left both open, so ``.`` matched any character).
ENTITY_PATTERN = r"^(.*)_\d{14}_UTC\.csv\.gz$"
# What the loader accepts: also the numbered parts of a multi-part export.
LANDED_PATTERN = r"^(.*)_\d{14}_UTC(?:_\d{5,})?\.csv\.gz$"
FILE_DATE_PATTERN = r"_(\d{8})\d{6}_UTC"

# The six lineage columns in front of every entity table, in
# the reference's order (types chosen here).
LINEAGE_FIELDS = [
    ("source_file_loaded_at_utc", T.TimestampNTZType()),
    ("source_file_date_utc", T.DateType()),
    ("source_file_name", T.StringType()),
    ("source_file_unique_key", T.StringType()),
    ("source_file_row_number", T.LongType()),
    ("source_file_record_unique_key", T.StringType()),
]


def entity_from_file(c, pattern: str = ENTITY_PATTERN) -> Column:
    """``UPPER(REGEXP_SUBSTR(name, '^(.*)_\\d{14}_UTC.csv.gz', 1, 1, 'e', 1))``; NULL if no match."""
    col = c if isinstance(c, Column) else F.col(c)
    return F.upper(regexp_group(col, pattern, 1))


def date_from_file(c) -> Column:
    """``TO_DATE(REGEXP_SUBSTR(name, '_(\\d{8})\\d{6}_UTC', ...), 'YYYYMMDD')``."""
    col = c if isinstance(c, Column) else F.col(c)
    return F.try_to_date(F.regexp_extract(col, FILE_DATE_PATTERN, 1), "yyyyMMdd")


def loaded_at_key_text(loaded_at: _dt.datetime) -> str:
    """The load time as text inside the file key (dialect default format)."""
    if loaded_at.tzinfo is not None:
        loaded_at = loaded_at.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return loaded_at.strftime("%Y-%m-%d %H:%M:%S.") + f"{loaded_at.microsecond // 1000:03d} +0000"


def read_landed_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str],
                    options: dict[str, str] | None = None,
                    corrupt_column: str | None = None) -> DataFrame:
    """Read landed CSV files by position as all-string columns (A4).

    The header row is skipped, not matched: column i of every file is
    ``columns[i]`` (``$1..$n``).  Adds ``__file`` and ``__split`` from the
    hidden ``_metadata`` column.  One read covers all files of an entity.
    """
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType()))
    opts = dict(options or profile("ingest_csv"))
    if corrupt_column:
        opts["columnNameOfCorruptRecord"] = corrupt_column
    if all(p.endswith(".gz") for p in paths):
        # a gzip file is one split anyway, so quoted line breaks cost nothing
        opts.setdefault("multiLine", "true")
    df = spark.read.options(**opts).schema(T.StructType(fields)).csv(list(paths))
    return df.select("*", F.col("_metadata.file_name").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__split"))


def with_lineage(df: DataFrame, loaded_at: _dt.datetime, data_columns: Sequence[Column] | None = None,
                 one_file_per_partition: bool = False) -> DataFrame:
    """Six lineage columns in front of the data (A5, B6, §1.3).

    ``df`` comes from ``read_landed_csv``.  ``loaded_at`` is one value per
    run, passed in so reruns and tests are repeatable.
    ``one_file_per_partition`` takes the row number from the scan position
    alone (see ``file_row_number_one_file_per_partition``) and keeps a
    ``__pid`` column for the caller's check.
    """
    numbered = (file_row_number_one_file_per_partition(df) if one_file_per_partition
                else file_row_number(df))
    file_key = concat_key(F.lit(loaded_at_key_text(loaded_at)), F.col("__file"))
    rn = F.col("source_file_row_number")
    data = data_columns if data_columns is not None else [
        F.col(f"`{c}`") for c in df.columns if c not in ("__file", "__split")]
    return numbered.select(
        ntz_literal(loaded_at).alias("source_file_loaded_at_utc"),
        date_from_file(F.col("__file")).alias("source_file_date_utc"),
        F.col("__file").alias("source_file_name"),
        file_key.alias("source_file_unique_key"),
        rn,
        concat_key(file_key, rn).alias("source_file_record_unique_key"),
        *data,
        *([F.col("__pid")] if one_file_per_partition else []),
    )


def write_named_csv(spark: SparkSession, df: DataFrame, out_dir: str, name_col: str,
                    order_by: Sequence[str] = (), options: dict[str, str] | None = None,
                    shuffle: bool = True, drop: Sequence[str] = (), overwrite: bool = False
                    ) -> list[str]:
    """Write one gzip CSV file per distinct ``name_col`` value, named by it.

    Rows of one name go to one task (``repartition(name)``), sorted by
    ``order_by`` inside the file; the part file is then renamed (metadata
    only).  Callers keep each name's row count bounded (a key range per
    file), so no file is unboundedly large.  ``shuffle=False`` is for data
    whose names are already confined to one partition each (rows read
    from one non-splittable file).  ``drop`` columns are removed after the
    sort.  ``overwrite`` replaces files of the same name.  Returns the written
    names.
    """
    opts = dict(options or profile("export_csv"))
    tmp = f"{out_dir.rstrip('/')}/_tmp_write_{uuid.uuid4().hex}"
    ordered = (df.repartition(name_col) if shuffle else df) \
        .sortWithinPartitions(name_col, *order_by)
    if drop:
        ordered = ordered.drop(*drop)
    ordered.write.partitionBy(name_col).options(**opts).csv(tmp)
    return [name for name, _ in publish_named(spark, tmp, out_dir, name_col, overwrite)]

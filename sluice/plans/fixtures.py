"""Landed-file fixtures written by Spark from the driver tables.

A table becomes gzip CSV files named ``<entity>_2025010200HHMMSS``-style:
``<entity>_20250102<nnnnnn>_UTC.csv.gz`` where ``nnnnnn`` is the key range
``key // rows_per_file``.  Each file holds one range of a unique key, so its
size is bounded however large the table grows, and the file count grows
with the table.  Doubles are written as ``decimal(18,2)`` so their text is
fixed (``901.00``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.snapshot import publish_named
from sluice.session import scratch_path
from sluice.sources.landing import write_named_csv

FILE_DATE = "20250102"


def file_name_col(entity: str, key: str, rows_per_file: int, date: str = FILE_DATE) -> Column:
    idx = F.floor(F.col(key) / F.lit(rows_per_file)).cast("bigint")
    text = idx.cast("string")  # more digits from a million files on, never fewer
    return F.concat(F.lit(f"{entity}_{date}"),
                    F.lpad(text, F.greatest(F.lit(6), F.length(text)), F.lit("0")),
                    F.lit("_UTC.csv.gz"))


def file_name_sql(entity: str, key: str, rows_per_file: int, date: str = FILE_DATE) -> str:
    """The same name in DuckDB SQL."""
    idx = f"CAST({key} // {rows_per_file} AS VARCHAR)"
    return (f"('{entity}_{date}' || lpad({idx}, greatest(6, length({idx}))::INT, '0')"
            f" || '_UTC.csv.gz')")


def csv_ready(df: DataFrame) -> DataFrame:
    """Doubles -> decimal(18,2) so the CSV text of every value is fixed."""
    return df.select(*[F.col(f.name).cast("decimal(18,2)").alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def land_table(spark: SparkSession, df: DataFrame, landing: str, entity: str, key: str,
               rows_per_file: int, date: str = FILE_DATE,
               options: dict[str, str] | None = None, overwrite: bool = False) -> list[str]:
    """Write ``df`` as landed files sorted by ``key``; returns the file names."""
    named = csv_ready(df).withColumn("__name", file_name_col(entity, key, rows_per_file, date))
    return write_named_csv(spark, named, landing, "__name", order_by=[key], options=options,
                           overwrite=overwrite)


def land_lines(spark: SparkSession, lines: DataFrame, landing: str) -> list[str]:
    """Write ``name, at, line`` rows as gzip files of these lines in the order
    of ``at``, header lines included: files that no CSV writer would make."""
    tmp = scratch_path(spark, "lines")
    lines.repartition("name").sortWithinPartitions("name", "at").select("name", "line") \
        .write.partitionBy("name").option("compression", "gzip").text(tmp)
    return [name for name, _ in publish_named(spark, tmp, landing, "name")]


def new_landing(spark: SparkSession, purpose: str = "landing") -> str:
    return scratch_path(spark, purpose)

"""Corpus pipeline: five stages over ``documents``.

``run(spark, sf_dir)`` writes each stage's documents as Parquet under the
shared checkpoint folder and reads them again as the next stage's input, so
no stage depends on the lineage of the ones before it.  All stages but the
last return the columns of ``documents``.  SQL cannot express the first
three stages; the tests hold ``run`` against a brute-force version.

Defined cases are those of the operators.  A document whose whole text the
line dedup deletes is dropped with its last line; one that came empty stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate as _decontaminate
from sluice.llm import line_dedup as _line_dedup
from sluice.llm import mixing as _mixing
from sluice.llm import simhash as _simhash
from sluice.llm import toxicity as _toxicity
from sluice.llm._names import fresh
from sluice.session import read_table, scratch_path

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine does not reject."""
    return _toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier one holds."""
    gone = fresh(docs, "removed")
    left = _line_dedup.dedup_lines(docs, out=gone).filter(
        F.col(gone).isNull() | F.col("text").rlike(r"\S"))
    return left.select(*[F.char_length("text").cast("long").alias(c)
                         if c == "n_chars" else F.col(c) for c in docs.columns])


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return _simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return _decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus, a row per document and repetition."""
    return _mixing.mix(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash),
          ("decontaminate", decontaminate), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

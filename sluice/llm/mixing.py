"""Mixing sources to target weights by capped water-filling.

1. One row per source: its size (words) and its weight.
2. Water-filling: the total is shared by weight; a source whose share is
   above ``max_epochs`` times its size is clamped there and the excess goes
   to the others by weight, until none is above.  Each round is one small
   aggregate over the per-source rows; only two sums return to the driver
   and the arithmetic is exact (decimals, Python integers).
3. Seeded repetitions: a source at ``r`` times its size takes every document
   ``floor(r)`` times and a fraction of one further epoch: documents in the
   order of a seeded hash until the words left are used up; the document
   there gives only the words still missing, so a source takes exactly its
   rounded target.  No document exceeds ``max_epochs`` times its size.

The running word count within a source uses hash buckets (sums per bucket,
their prefix sums, then a window within each bucket), so a source with a
third of all rows spreads over many tasks.  Only ids, sources and sizes are
shuffled, never texts.

Defined cases: a null text has size 0; a null source is a source of its own
behind all others; documents without words take 0; equal ids are ordered by
size; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm._names import fresh
from sluice.operators.rownum import global_row_number
from sluice.session import scratch_path

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
_DEC = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def seeded_order(doc_id: Column, seed: int) -> Column:
    """60-bit hash of (seed, id), the same in any SQL dialect with md5."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def _source_key(source: Column) -> Column:
    """A key that is never null, so that joins and windows share one shuffle."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Water-filled target of every source.

    ``sizes`` has ``source`` and ``size``; weights repeat over the sources in
    code point order, null last.  Returns ``source, source_size, target``.
    """
    spark = sizes.sparkSession
    first, table = scratch_path(spark, "mix-sources"), scratch_path(spark, "mix-weights")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per.withColumn("null_last", F.col("source").isNull()).write.parquet(first)
    numbered = global_row_number(spark.read.parquet(first), ["null_last", "source"], "n",
                                 tiebreak=[])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    numbered.select("source", "source_size", weight.cast(_DEC).alias("w"),
                    (F.col("source_size") * max_epochs).cast(_DEC).alias("cap")) \
        .write.parquet(table)
    per = spark.read.parquet(table)

    total = per.agg(F.sum(F.col("source_size").cast(_DEC))).first()[0] or Decimal(0)
    total_w = per.agg(F.sum("w")).first()[0] or Decimal(0)
    left, left_w = total, total_w
    while True:
        # clamped: cap * weights left < own weight * words left (exact)
        over = F.col("cap") * F.lit(left_w).cast(_DEC) < F.col("w") * F.lit(left).cast(_DEC)
        got = per.filter(over).agg(F.sum("cap"), F.sum("w")).first()
        caps, ws = got[0] or Decimal(0), got[1] or Decimal(0)
        if (total - caps, total_w - ws) == (left, left_w) or total_w == ws:
            break
        left, left_w = total - caps, total_w - ws
    share = (F.col("w") * F.lit(left).cast(_DEC)).cast("double") / F.lit(float(left_w or 1))
    return per.select("source", "source_size",
                      F.when(over, F.col("cap").cast("double")).otherwise(share).alias("target"))


def _ordered(docs: DataFrame, doc_id: str, source: str, size: str, weights, max_epochs: int,
             seed: int, rows_per_bucket: int) -> DataFrame:
    """Every row with its source's target, whole epochs and words left, and
    the words of its source before it in hash order."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       F.col(size).alias("size"))
    table = scratch_path(spark, "mix-rows")
    rows.withColumn("h", seeded_order(F.col("doc_id"), seed)) \
        .withColumn("k", _source_key(F.col("source"))).write.parquet(table)
    rows = spark.read.parquet(table)
    targets = source_targets(rows, weights, max_epochs)
    want = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))) \
        .otherwise(0).cast("long")
    targets = targets.select(_source_key(F.col("source")).alias("k"), "source_size", "target",
                             whole.alias("whole"),
                             (want - whole * F.col("source_size")).alias("rest"))

    # prefix sums of words within a source, in hash order, bucket by bucket
    buckets, n = 1, rows.count()
    while buckets * rows_per_bucket < n:
        buckets *= 2
    rows = rows.withColumn("b", F.floor(F.col("h") / F.lit((1 << 60) // buckets)).cast("long"))
    before = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("k", "b").agg(F.sum("size").alias("words")).select(
        "k", "b", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")) \
        .join(targets, "k")
    inside = Window.partitionBy("k", "b").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = rows.withColumn("upto", F.sum("size").over(inside)).join(base, ["k", "b"])
    return joined.withColumn("before", F.col("start") + F.col("upto") - F.col("size"))


def take(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size",
         weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
         rows_per_bucket: int = 2_000) -> DataFrame:
    """Words the mix takes of every document.

    Returns ``doc_id, source, size, source_size, target, taken, epochs``;
    ``epochs`` counts the repetitions a document appears in, the last perhaps
    in part.
    """
    joined = _ordered(docs, doc_id, source, size, weights, max_epochs, seed, rows_per_bucket)
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    joined = joined.withColumn("extra", extra)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.col("whole") + (F.col("extra") > 0).cast("long"))
        .otherwise(0).cast("long").alias("epochs"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        rows_per_bucket: int = 2_000) -> DataFrame:
    """The mixed corpus: a row per document and repetition, with the columns
    of ``docs``, ``copy`` (from 1) and ``words``, the words of it that count
    (fewer than it has only in the cut document of each source).

    A source's fractional epoch ends at one document, so texts need only a
    join with the small table of those cuts and are never put in order.
    Documents without words are in no repetition.  Rows that repeat id and
    size at a cut are treated alike.
    """
    n, c = fresh(docs, "words"), fresh(docs, "copy")
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        word_count(F.col(text)).alias("size"))
    rows = _ordered(sizes, "doc_id", "source", "size", weights, max_epochs, seed,
                    rows_per_bucket)
    cut = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size"))
    table = scratch_path(docs.sparkSession, "mix-cuts")  # its size is known to the planner
    rows.filter(cut).select(
        "k", "whole", F.struct("h", "doc_id", "size").alias("cut"),
        (F.col("rest") - F.col("before")).alias("left")).dropDuplicates(["k"]) \
        .write.parquet(table)
    cuts = docs.sparkSession.read.parquet(table)
    size = word_count(F.col(text))
    here = F.struct(seeded_order(F.col(doc_id), seed).alias("h"),
                    F.col(doc_id).alias("doc_id"), size.alias("size"))
    joined = docs.select(F.struct("*").alias("row"), _source_key(F.col(source)).alias("k"),
                         here.alias("here")).join(cuts, "k")
    extra = F.when(F.col("here") < F.col("cut"), F.col("here.size")).when(
        F.col("here").eqNullSafe(F.col("cut")), F.col("left")).otherwise(0)
    joined = joined.filter(F.col("here.size") > 0).withColumn("extra", extra)
    epochs = F.col("whole") + (F.col("extra") > 0).cast("long")
    many = joined.filter(epochs > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), epochs)))
    return many.select(
        "row.*", F.col("copy").alias(c),
        F.when(F.col("copy") > F.col("whole"), F.col("extra")).otherwise(F.col("here.size"))
        .alias(n))

"""What each corpus filter removes, alone and in every order with the others.

Five filters fail a document: **A** few words, **B** few distinct words,
**C** many capitals, **D** a mark character, **E** the whole text of a document
with a smaller id.  ``flags`` gives a document's failures as a bit mask (bit 0
is A), ``audit`` counts masks per part and lays them out for all orders.

E needs the least id of every text.  A counting Bloom prepass spares the
shuffle of texts that stand once: each task adds its texts' hashes into a
sketch (counters stop at 2), the sketches of one range of counters are added
up where that range is dealt to, and the merged bits "counter is 2" go to all
tasks.  A text with a counter below 2 stands once, for certain.  Only the
others are grouped by their full text for its least id, pre-aggregated, so
copies of one text make one row a task.  Rows meet it by hash and id, without
their text; texts that share a hash are told apart by text.

The merged bits have one bit a counter, ``COUNTERS`` counters a document and
``max_counters`` at most (2**29 is 64 MB), which bounds what is broadcast and
held on the driver.  Beyond about 30 million documents more unique texts pass
for possible repeats and are shuffled; no count changes.

Counts are additive, so the rest works on masks: at most 32 rows a part.

Defined cases: a null text is empty; a null source is the part ``''``; a null
id counts as larger than every other id; rows with one id and text are no
repeat of each other; of several label rows for one id any 1 counts; an id
without labels is neither good nor toxic; an empty table gives no rows; other
columns are not read.  The input has to give the same rows when a task runs
again (a table, or a checkpoint).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path, ship_package

NAMES = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITAL_PCT = 2
MARKS = b"#$%&*|"

COUNTERS = 16
MAX_COUNTERS = 1 << 29
HASHES = 4
_RANGE = 1 << 20
_CHUNK = 1 << 21
_CAPITALS = bytes(range(65, 91))


def text_failures(text: bytes, n_chars: int) -> int:
    """Bits A to D of one text."""
    words = text.split()  # of bytes: at blanks and \x09-\x0D alone
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PCT * len(words)) << 1
            | (100 * capitals > MAX_CAPITAL_PCT * n_chars) << 2
            | (len(text.translate(None, MARKS)) != len(text)) << 3)


def _places(hashes: np.ndarray, counters: int) -> np.ndarray:
    """``HASHES`` counters of each hash, a row each."""
    out = np.empty((HASHES, len(hashes)), np.uint64)
    for k in range(HASHES):
        x = hashes.view(np.uint64) + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[k] = (x ^ (x >> np.uint64(31))) & np.uint64(counters - 1)
    return out


def _counters(n_docs: int, max_counters: int) -> int:
    return min(max_counters, max(_RANGE, 1 << (COUNTERS * n_docs).bit_length()))


def repeat_bits(hashes: DataFrame, counters: int) -> bytes:
    """Merged counting sketch of a column ``h``: one bit a counter, set from 2 on."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sketch() -> Iterator[pa.RecordBatch]:
            places, times = np.unique(np.concatenate(held), return_counts=True)
            rows = (places // _RANGE).astype(np.int64)
            cut = np.flatnonzero(np.diff(rows)) + 1
            for a, b in itertools.pairwise([0, *cut.tolist(), len(rows)]):
                if a < b:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows[a]]),
                         pa.array([(places[a:b] % _RANGE).astype("<u4").tobytes()], pa.binary()),
                         pa.array([np.minimum(times[a:b], 2).astype("u1").tobytes()], pa.binary())],
                        ["range", "places", "times"])

        for batch in batches:
            all_ = np.unique(_places(batch.column("h").to_numpy(), counters), return_counts=True)
            held.append(np.repeat(all_[0], np.minimum(all_[1], 2)))
            size += len(held[-1])
            if size >= _CHUNK:
                yield from sketch()
                held, size = [], 0
        if held:
            yield from sketch()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, np.zeros(_RANGE, np.uint8)

        def done() -> pa.RecordBatch:
            bits = np.packbits(sums >= 2, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([bits], pa.binary())], ["range", "bits"])

        for batch in batches:
            for r, places, times in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if at is not None and r != at:
                    yield done()
                    sums[:] = 0
                at = r
                where = np.frombuffer(places, "<u4")  # no place twice in a sketch
                sums[where] = np.minimum(sums[where] + np.frombuffer(times, "u1"), 2)
        if at is not None:
            yield done()

    merged = hashes.mapInArrow(local, "range long, places binary, times binary").repartition(
        "range").sortWithinPartitions("range").mapInArrow(merge, "range long, bits binary")
    out = bytearray(counters // 8)
    for r in merged.toLocalIterator():
        out[r["range"] * _RANGE // 8:(r["range"] + 1) * _RANGE // 8] = r["bits"]
    return bytes(out)


def flags(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source",
          max_counters: int = MAX_COUNTERS, hash_bits: int = 64) -> DataFrame:
    """``doc_id, part, mask`` of every row; ``hash_bits`` is for tests of equal hashes."""
    spark = docs.sparkSession
    ship_package(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    h = F.xxhash64(body).bitwiseAND(F.lit((1 << hash_bits) - 1 if hash_bits < 64 else -1))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       h.alias("h"), body.alias("body"))
    counters = _counters(docs.count(), max_counters)
    bits = spark.sparkContext.broadcast(repeat_bits(rows.select("h"), counters))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            texts = batch.column("body")
            n = pc.utf8_length(texts).to_pylist()
            mask = [text_failures(t, k) for t, k in zip(texts.cast(pa.binary()).to_pylist(), n)]
            places = _places(batch.column("h").to_numpy(), counters)
            maybe = ((twice[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)
                      ) & 1).all(axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("h"),
                 pa.array(mask, pa.int32()),
                 pc.if_else(pa.array(maybe), texts, pa.scalar(None, texts.type))],
                ["doc_id", "part", "h", "mask", "body"])

    path = scratch_path(spark, "audit-flags")
    rows.mapInArrow(judge, "doc_id long, part string, h long, mask int, body string"
                    ).write.parquet(path)
    judged = spark.read.parquet(path)
    once = judged.filter("body IS NULL").select("doc_id", "part", "mask")
    maybe = judged.filter("body IS NOT NULL")

    path = scratch_path(spark, "audit-texts")
    maybe.groupBy("h", "body").agg(F.min("doc_id").alias("lo")).write.parquet(path)
    texts = spark.read.parquet(path)
    by_hash = texts.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"))
    def with_e(rows: DataFrame, least: DataFrame, same) -> DataFrame:
        # Only the least id finds its text: the key holds the id, so copies of one text spread.
        least = least.select(*[F.col(c).alias(f"{c}_") for c in least.columns])
        on = (F.col("h") == F.col("h_")) & F.col("doc_id").eqNullSafe(F.col("lo_")) & same
        bit = F.when(F.col("h_").isNull(), 1 << 4).otherwise(0)
        return rows.join(least, on, "left").select(
            "doc_id", "part", (F.col("mask") + bit).alias("mask"))

    shared = by_hash.filter("n > 1").select("h")
    if shared.isEmpty():
        return once.unionByName(with_e(maybe, by_hash, F.lit(True)))
    return once.unionByName(with_e(
        maybe.join(shared, "h", "left_anti"), by_hash.filter("n = 1"), F.lit(True))).unionByName(
        with_e(maybe.join(shared, "h", "left_semi"), texts.join(shared, "h", "left_semi"),
               F.col("body") == F.col("body_")))


def interactions(masks: DataFrame, names: str = NAMES) -> DataFrame:
    """Report of ``part, mask, n, good, toxic`` rows: every order, every step."""
    orders = ["".join(p) for p in itertools.permutations(names)]
    cells = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic"))
                                      .alias("cells"))
    steps = cells.select("part", "cells", F.explode(F.array(*map(F.lit, orders)))
                         .alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step"))

    def bits(letters: str) -> str:
        return " + ".join(f"if(instr({letters}, '{c}') > 0, {1 << i}, 0)"
                          for i, c in enumerate(names))

    steps = steps.withColumn("here", F.expr(bits("substring(filter_order, step, 1)"))).withColumn(
        "before", F.expr(bits("substring(filter_order, 1, step - 1)")))

    def total(value: str, where: str) -> F.Column:
        return F.expr(f"aggregate(filter(cells, c -> {where}), 0L, (s, c) -> s + {value})")

    fails, passed = "(c.mask & here) > 0", "(c.mask & before) = 0"
    n_orders = len(orders)
    return steps.select(
        "part", "filter_order", "step",
        total("c.n", "(c.mask & (before | here)) = 0").alias("kept"),
        total("c.n", f"{fails} AND {passed}").alias("removed"),
        total("c.n", f"{fails} AND NOT {passed}").alias("redundant"),
        total("c.n", "c.mask = here").alias("unique_fails"),
        total("c.good", f"{fails} AND {passed}").alias("good_lost"),
        total("c.toxic", f"{fails} AND {passed}").alias("toxic_lost"),
        # In n_orders / k orders a filter is first of the k that a document fails.
        total(f"c.n * ({n_orders} div bit_count(c.mask))", fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          part: str = "source", **kw) -> DataFrame:
    """One row per part, order and step."""
    found = flags(docs, text, doc_id, part, **kw)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    masks = found.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")])
    return interactions(masks)

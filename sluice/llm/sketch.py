"""Threshold-scaled document sketches (DataFrame functions only).

A document's sketch holds the hash of every distinct five-word shingle that
lies below a fixed fraction of the hash range.  The threshold is the same
for every document, so sketches of very unequal documents stay comparable:
the shared hashes over those of the smaller one estimate containment, and
the sketch of a union is the union of the sketches (``merge``).  A text
whose shingles all lie above the threshold keeps its smallest hash alone;
merging drops such a hash again when any other lies below, so merging stays
exact.  Such a lone hash says whether texts are equal and no more: at one half
of the range a text of four shingles has one in 16 cases, one of eight
shingles in 256 (``lone_hash`` of the report).  Fewer than five words make one
shingle; no words, none.

Words are the lower-cased text's runs between white space.  A shingle hash
is XXH64 over the XXH64 values of its words.  As a string a sketch is its
hashes ascending, 16 hexadecimal digits each.

Defined cases: a null text is empty and has an empty sketch; two empty
sketches are alike (1.0), an empty and another are not (0.0); repeated rows
and ties have equal sketches; an empty table gives no rows; other columns
are ignored.  Long texts take time and memory in proportion to their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
FRACTION = 1 / 2


def _limit(fraction: float) -> int:
    """Signed bound: hashes from the least long up to here are retained."""
    return -(1 << 63) + int(fraction * (1 << 64)) - 1


def sketch(text: Column, words: int = SHINGLE_WORDS, fraction: float = FRACTION) -> Column:
    """Sorted array of retained hashes (signed longs)."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+", -1),
                      lambda w: w != "")

    def shingles(hs: Column) -> Column:  # hs: the words' hashes, computed once
        last = F.size(hs) - (words - 1)
        full = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(
            *[F.element_at(hs, i + k) for k in range(words)]))
        short = F.array(F.xxhash64(hs))
        return F.when(F.size(hs) >= words, full).when(F.size(hs) > 0, short).otherwise(
            F.array().cast("array<bigint>"))

    def retained(all_hashes: Column) -> Column:
        below = F.filter(all_hashes, lambda h: h <= F.lit(_limit(fraction)))
        return F.when((F.size(below) > 0) | (F.size(all_hashes) == 0), below).otherwise(
            F.array(F.array_min(all_hashes)))

    # one-element arrays bind an intermediate array once instead of per element
    hashed = F.array(F.transform(tokens, lambda w: F.xxhash64(w)))
    kept = F.transform(F.transform(hashed, shingles), retained)
    return F.array_sort(F.array_distinct(F.element_at(kept, 1)))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of both texts' shingles together."""
    both = F.array(F.array_sort(F.array_union(a, b)))
    below = F.transform(both, lambda x: F.filter(x, lambda h: h <= F.lit(_limit(fraction))))
    pick = F.when(F.size(F.element_at(below, 1)) > 0, F.element_at(below, 1))
    return F.coalesce(pick, F.slice(F.element_at(both, 1), 1, 1))


def fingerprint(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller document's shingles in the other one."""
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(least > 0, shared / least).otherwise(
        F.when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(1.0))


def with_next(docs: DataFrame, doc_id: str, carry: list[str], parts: int) -> DataFrame:
    """Add ``next_<c>`` of the next row by id (then text); after the last, the first.

    The id range is cut at ``parts`` quantiles of the ids.  A row whose id is
    a cut is also sent, marked, to the part before (the very first to the
    last part), so each part finds its last row's successor itself and one
    shuffle moves the texts.
    """
    got = docs.agg(F.percentile_approx(doc_id, [i / parts for i in range(1, parts)] or [0.5],
                                       F.lit(max(10_000, 20 * parts))).alias("q"),
                   F.min(doc_id).alias("lo"),
                   F.sum(F.col(doc_id).isNull().cast("long")).alias("nulls")).first()
    cuts = sorted({c for c in (got["q"] or []) if c > got["lo"]}) if parts > 1 else []
    cuts_col = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    # cuts up to the id, by halving steps: a step is taken if the cut there is not above the id
    found = F.aggregate(F.array(*map(F.lit, steps)) if steps else F.array().cast("array<int>"),
                        F.lit(0), lambda at, step: at + F.when(
                            F.get(cuts_col, at + step - 1) <= F.col(doc_id), step).otherwise(0))
    docs = docs.select("*", found.alias("part__"))
    part = F.col("part__")
    first = F.col(doc_id).isNull() if got["nulls"] else F.col(doc_id) == F.lit(got["lo"])
    here = F.struct(part.alias("part"), F.lit(False).alias("guest"), F.lit(False).alias("wrap"))
    to_previous = F.struct((part - 1).alias("part"), F.lit(True).alias("guest"),
                           F.lit(False).alias("wrap"))
    to_last = F.struct(F.lit(len(cuts)).alias("part"), F.lit(True).alias("guest"),
                       F.lit(True).alias("wrap"))
    places = F.filter(F.array(
        here, F.when(F.get(cuts_col, part - 1) == F.col(doc_id), to_previous),
        F.when(first, to_last)), lambda p: p.isNotNull())
    rows = docs.select("*", F.explode(places).alias("at__"))
    order = Window.partitionBy("at__.part").orderBy(
        "at__.wrap", F.col(doc_id).asc_nulls_first(), *[F.col(c) for c in carry])
    return rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry]) \
        .filter(~F.col("at__.guest")).drop("at__", "part__")


def sketch_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  words: int = SHINGLE_WORDS, fraction: float = FRACTION,
                  parts: int | None = None) -> DataFrame:
    """Sketch of every document, of its edited text and its likeness to the next."""
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("sk", sketch(F.col("text"), words, fraction))
    rows = with_next(rows, "doc_id", ["text", "sk"], parts)
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut),
                      F.substr("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sk", "next_sk",
                       edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sk", "next_sk",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       sketch(F.col("edited"), words, fraction).alias("ed"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sk")).alias("fingerprint"),
        fingerprint(F.col("ed")).alias("edited_fingerprint"),
        containment(F.col("sk"), F.col("ed")).alias("near_edited"),
        containment(F.col("sk"), F.col("next_sk")).alias("near_next"),
        jaccard(F.col("sk"), F.col("ed")).alias("jaccard_edited"),
        jaccard(F.col("sk"), F.col("next_sk")).alias("jaccard_next"),
        F.coalesce(F.get("sk", F.lit(0)) > _limit(fraction), F.lit(False)).alias("lone_hash"))

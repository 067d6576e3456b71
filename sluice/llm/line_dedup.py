"""Line dedup by pairwise alignment.

1. Every line is hashed.  A run of consecutive lines is distinctive if it
   has ``min_chars`` characters or more in total and no shorter run in it
   has: one long line, or several short ones (verse, code, lists).
   Documents hardly share it by chance.  Where a run starts and ends depends
   on its lines alone, so every common block of ``min_chars`` characters
   holds a whole one.
2. Candidates: each distinctive run links every later document that holds
   it to the first one that does (smallest id), however many there are.  So
   a run in k documents gives k - 1 pairs, the rarest and the most frequent
   alike, and every repeated distinctive run of a document is covered by a
   pair with an earlier document that holds it.
3. Each pair's line hashes are aligned by patience diff: common head and
   tail, then the lines unique on both sides in longest increasing order,
   then the gaps between them again.
4. An alignment keeps the order and needs unique lines, so it can miss lines
   that the earlier document does hold: moved blocks, passages that stand
   twice.  For each distinctive run missed so, the longest runs around it
   that stand anywhere in the earlier document are common blocks too.
5. Common blocks that hold a distinctive run are deleted
   from the later document; the earlier keeps them.  Blocks are found in the
   documents as given, not in what other pairs have left.

Only line hashes are shuffled.  Frequent lines meet their counts through
partial aggregates, and joins on hot keys are plain equi-joins that Spark
can split.

Defined cases: lines compare without surrounding white space; empty lines
are deleted only inside a block; rows with the same id and text are one
document and are treated alike; other rows with the same id are ordered by
a hash of the text; a null id comes before all others; a null text has no
lines and stays null; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._names import fresh
from sluice.session import scratch_path, ship_package

MIN_CHARS = 40
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def distinctive_runs(chars: np.ndarray, min_chars: int) -> np.ndarray:
    """For every line: the number of lines of the distinctive run that starts
    there (0: none)."""
    upto = np.cumsum(chars)
    end = np.searchsorted(upto, upto - chars + min_chars)  # last line of the run
    sole = np.append(end[:-1] < end[1:], True) & (end < len(chars))  # none shorter in it
    return np.where(sole, end - np.arange(len(chars)) + 1, 0)


def run_keys(hs: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Distinct hashes of the distinctive runs; equal runs have equal ones."""
    at = np.flatnonzero(runs)
    h = hs.view(np.uint64)
    upto = np.append(np.uint64(0), np.cumsum(h * _powers(_BASE, len(h)), dtype=np.uint64))
    key = (upto[at + runs[at]] - upto[at]) * _powers(_BACK, len(h))[at]
    return np.unique(key).view(np.int64)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs increasing on both sides (given by the first)."""
    piles: list[int] = []
    top: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(piles, b)
        back.append(top[k - 1] if k else -1)
        if k == len(piles):
            piles.append(b)
            top.append(i)
        else:
            piles[k], top[k] = b, i
    out, i = [], top[-1] if top else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, ascending."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        at_a: dict[int, int] = {}
        for i in range(a0, a1):
            at_a[a[i]] = -1 if a[i] in at_a else i
        at_b: dict[int, int] = {}
        for j in range(b0, b1):
            at_b[b[j]] = -1 if b[j] in at_b else j
        anchors = _increasing([(i, at_b[x]) for x, i in at_a.items()
                               if i >= 0 and at_b.get(x, -1) >= 0])
        if not anchors:
            continue
        for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            todo.append((i + 1, i2, j + 1, j2))
        out += anchors
    return sorted(out)


def _held_runs(earlier: list[int], later: list[int]) -> list[int]:
    """For every line of ``later``: the length of the longest run of lines
    that ends with it and stands anywhere in ``earlier`` (suffix automaton,
    linear in both)."""
    step: list[dict[int, int]] = [{}]
    size, link = [0], [-1]
    last = 0
    for x in earlier:
        new = len(size)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p, last = last, new
        while p >= 0 and x not in step[p]:
            step[p][x] = new
            p = link[p]
        if p >= 0:
            q = step[p][x]
            if size[q] != size[p] + 1:
                twin = len(size)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(x) == q:
                    step[p][x] = twin
                    p = link[p]
                link[q] = q = twin
            link[new] = q
    out, at, n = [], 0, 0
    for x in later:
        while at and x not in step[at]:
            at = link[at]
            n = size[at]
        if x in step[at]:
            at, n = step[at][x], n + 1
        out.append(n)
    return out


def _latest_start(runs: list[int], out: list[bool]) -> list[int]:
    """For every line: the last start of a distinctive run that ends up to it
    and is not wholly ``out`` (-1: none)."""
    got = [-1] * len(runs)
    left = [0]  # lines not out before each line
    for o in out:
        left.append(left[-1] + (not o))
    for j, r in enumerate(runs):
        if r and left[j + r] > left[j]:
            got[j + r - 1] = j
    for j in range(1, len(got)):
        got[j] = max(got[j], got[j - 1])
    return got


def common_lines(earlier: list[int], later: list[int], runs: list[int]) -> list[int]:
    """Lines of the later document in common blocks with a distinctive run
    (``runs``: lines of the one that starts at each line, 0: none): the
    aligned blocks first; then, for each run that the earlier document holds
    and the alignment missed (moved, or not unique), the longest runs around
    it that stand anywhere in the earlier one."""
    out = [False] * len(later)
    whole = _latest_start(runs, out)
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(earlier, later), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if block and whole[block[-1]] >= block[0]:
                for k in block:
                    out[k] = True
            block = []
        block.append(j)
        last = (i, j)
    held = set(earlier)
    missed = _latest_start(runs, out)
    if any(g >= 0 and later[j] in held for j, g in enumerate(missed)):
        upto, found = len(later), _held_runs(earlier, later)
        for j in range(len(later) - 1, -1, -1):
            first = j - found[j] + 1
            if missed[j] >= first:
                for k in range(first, min(j + 1, upto)):
                    out[k] = True
                upto = min(upto, first)
    return [j for j, o in enumerate(out) if o]


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """``d, t, removed``: id, text hash and deleted line numbers (from 0) of
    every document that loses lines."""
    spark = docs.sparkSession
    ship_package(spark)
    table = scratch_path(spark, "line-hashes")
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda s: F.trim(
        F.regexp_replace(s, r"^\s+|\s+$", "")))
    hashed = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("d"), F.xxhash64(F.col(text)).alias("t"), lines.alias("ls")).select(
        "d", "t", F.transform("ls", lambda s: F.xxhash64(s)).alias("hs"),
        F.transform("ls", lambda s: F.char_length(s)).alias("chars"))

    def find_runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            runs = [distinctive_runs(np.asarray(c, np.int64), min_chars) for c in f["chars"]]
            keys = [run_keys(np.asarray(h, np.int64), r) for h, r in zip(f["hs"], runs)]
            yield pd.DataFrame({"id": f["id"], "none": f["none"], "t": f["t"], "hs": f["hs"],
                                "runs": runs, "keys": keys})

    # a null id beside its own column: never floats, ids are exact
    found = hashed.select(F.coalesce(F.col("d").cast("long"), F.lit(0)).alias("id"),
                          F.col("d").isNull().alias("none"), "t", "hs", "chars").mapInPandas(
        find_runs, "id long, none boolean, t long, hs array<long>, runs array<int>, "
                   "keys array<long>")
    found.select(F.when(~F.col("none"), F.col("id")).alias("d"), "t", "hs", "runs", "keys") \
        .write.parquet(table)
    rows = spark.read.parquet(table)

    key = F.struct("d", "t")
    held = rows.select(key.alias("doc"), F.explode("keys").alias("h"))
    first = held.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
        .filter(~F.col("first").eqNullSafe(F.col("last"))).select("h", "first")
    pairs = held.join(first, "h").filter(F.col("doc") > F.col("first")) \
        .select("doc", "first").distinct()

    one = rows.dropDuplicates(["d", "t"])
    late = one.select(F.col("d").alias("ld"), F.col("t").alias("lt"),
                      F.col("hs").alias("late"), "runs")
    early = one.select(F.col("d").alias("ed"), F.col("t").alias("et"),
                       F.col("hs").alias("early"))
    both = pairs.join(late, F.col("doc.d").eqNullSafe(F.col("ld"))
                      & (F.col("doc.t") == F.col("lt"))) \
        .join(early, F.col("first.d").eqNullSafe(F.col("ed"))
              & (F.col("first.t") == F.col("et"))) \
        .select("ld", "lt", "late", "runs", "early")

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [common_lines(e.tolist(), x.tolist(), g.tolist())
                   for e, x, g in zip(f["early"], f["late"], f["runs"])]
            yield pd.DataFrame({"d": f["ld"].astype("Int64"), "t": f["lt"], "lines": got})

    found = both.mapInPandas(align, "d long, t long, lines array<int>") \
        .filter(F.size("lines") > 0)
    return found.groupBy("d", "t").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_chars: int = MIN_CHARS, out: str = "removed") -> DataFrame:
    """``docs`` with common blocks deleted from ``text`` and a column ``out``
    with the numbers of the deleted lines (null: none)."""
    name = fresh(docs, out)
    gone = removed_lines(docs, doc_id, text, min_chars)
    joined = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"),
                         F.xxhash64(F.col(text)).alias("hash")).join(
        gone, F.col("id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("t")), "left")
    old = F.col("row").getField(text)
    kept = F.element_at(F.transform(
        F.array(F.split(old, "\n", -1)), lambda ls: F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("removed")),
            lambda i: F.element_at(ls, i + 1)), "\n")), 1)
    return joined.select(
        *[F.when(F.col("removed").isNull(), old).otherwise(kept).alias(c) if c == text
          else F.col("row").getField(c).alias(c) for c in docs.columns],
        F.col("removed").alias(name))

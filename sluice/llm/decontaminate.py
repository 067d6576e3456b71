"""Benchmark decontamination by a broadcast set of test n-grams.

Benchmark items are normalised (A-Z lower-cased; words are runs of ASCII
letters, digits and non-ASCII characters) and cut into windows of ten
words; a shorter item is one window.  A block of windows is sorted by hash
and broadcast; every document window is looked up by hash and each hit is
verified word by word.  The benchmark is taken in blocks of at most
``block_words`` words, which bounds the broadcast; each further block scans
the documents once more and adds its hits to those found so far, so any
benchmark size gives the same result.

``hits`` finds the hit words, ``remove_documents`` and ``remove_spans`` act
on them.

Defined cases: null and empty texts have no words and no hits; items
without words are skipped; a null item id is named ``null``; repeated items
and repeated rows are each judged alike; an empty benchmark hits nothing and
an empty document table gives no rows; other columns are kept untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._names import fresh
from sluice.session import scratch_path, ship_package

NGRAM = 10
BLOCK_WORDS = 500_000
HITS = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
              else 32 for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every window of ``length`` word numbers."""
    n = len(ids) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        wide = ids.astype(np.uint64)
        for k in range(length):
            out = out * _BASE + wide[k:k + n]
        out ^= out >> np.uint64(29)
    return out


class NgramIndex:
    """Windows of one block of items, sorted by hash, for each window length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], ngram: int = NGRAM):
        self.vocab: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        ids: list[int] = []
        starts: dict[int, list[int]] = {}
        owners: dict[int, list[int]] = {}
        for name, words in items:
            at = len(ids)
            ids += [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            length = min(ngram, len(words))
            for p in range(len(words) - length + 1):
                starts.setdefault(length, []).append(at + p)
                owners.setdefault(length, []).append(number[name])
        self.ids = np.array(ids, np.int32)
        self.tables = {}
        for length, at in starts.items():
            pos = np.array(at)
            hashes = np.zeros(len(pos), np.uint64)
            wide = self.ids.astype(np.uint64)
            for k in range(length):
                hashes = hashes * _BASE + wide[pos + k]
            hashes ^= hashes >> np.uint64(29)
            order = np.argsort(hashes, kind="stable")
            self.tables[length] = (hashes[order], pos[order],
                                   np.array(owners[length], np.int32)[order])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word spans (not merged) and the names of the items that hit."""
        get = self.vocab.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        spans, items = [], set()
        for length, (hashes, pos, owner) in self.tables.items():
            mine = _window_hashes(ids, length)
            if not len(mine):
                continue
            at = np.searchsorted(hashes, mine)
            at[at == len(hashes)] = 0
            for p in np.flatnonzero(hashes[at] == mine).tolist():
                found = False
                k = int(at[p])
                while k < len(hashes) and hashes[k] == mine[p]:
                    q = pos[k]
                    if np.array_equal(self.ids[q:q + length], ids[p:p + length]):
                        items.add(self.names[owner[k]])
                        found = True
                    k += 1
                if found:
                    spans.append((p, p + length))
        return spans, items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int
            ) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of bounded size, streamed partition by partition."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        words = words_of(row[1])
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0] if row[0] is not None else "null", words))
        size += len(words)
    if block:
        yield block


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", ngram: int = NGRAM, block_words: int = BLOCK_WORDS,
         out: str = "hits") -> DataFrame:
    """``docs`` with a column ``out``: ``struct<n_words, spans, items>``.

    ``spans`` are the merged word ranges ``[start, end)`` inside any
    occurrence of a window, ``items`` the sorted ids of the items found.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def scanner(shared):
        @F.pandas_udf(HITS)
        def scan(texts: pd.Series, before: pd.Series) -> pd.DataFrame:
            index, rows = shared.value, []
            for t, old in zip(texts, before):
                words = words_of(t)
                spans, items = index.scan(words) if words else ([], set())
                if old:
                    for span in old.split(";")[0].split(",") if old[0] != ";" else []:
                        a, b = span.split("-")
                        spans.append((int(a), int(b)))
                rows.append((len(words), [{"start": a, "end": b} for a, b in merge_spans(spans)],
                             sorted(items)))
            return pd.DataFrame(rows, columns=["n_words", "spans", "items"])
        return scan

    def earlier(name: str):
        return F.concat(F.array_join(F.transform(F.col(f"{name}.spans"), lambda s: F.concat(
            s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ","), F.lit(";"))

    name, done = fresh(docs, out), False
    for block in _blocks(benchmark, item_id, item_text, block_words):
        shared = spark.sparkContext.broadcast(NgramIndex(block, ngram))
        scan = scanner(shared)
        if not done:
            docs = docs.withColumn(name, scan(F.col(text), F.lit(None).cast("string")))
        else:
            path = scratch_path(spark, "decontaminate")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            step = fresh(docs, "step")
            docs = docs.withColumn(step, scan(F.col(text), earlier(name)))
            items = F.array_sort(F.array_union(F.col(f"{name}.items"), F.col(f"{step}.items")))
            docs = docs.withColumn(name, F.struct(
                F.col(f"{step}.n_words"), F.col(f"{step}.spans"), items.alias("items"))).drop(step)
        done = True
    if not done:
        shared = spark.sparkContext.broadcast(NgramIndex([], ngram))
        docs = docs.withColumn(name, scanner(shared)(F.col(text), F.lit(None).cast("string")))
    return docs


def n_hit(name: str):
    """Number of hit words of a ``hits`` column."""
    return F.aggregate(F.col(f"{name}.spans"), F.lit(0).cast("long"),
                       lambda a, s: a + (s["end"] - s["start"]))


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw
                     ) -> DataFrame:
    """Documents without any hit word, columns as they were."""
    name = fresh(docs, "hits")
    return hits(docs, benchmark, text, out=name, **kw).filter(
        F.size(F.col(f"{name}.spans")) == 0).drop(name)


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """All documents, hit spans cut out of their texts."""
    name, cols = fresh(docs, "hits"), docs.columns
    found = hits(docs, benchmark, text, out=name, **kw)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(a) else cut_spans(t, list(zip(a, b)))
                          for t, a, b in zip(texts, starts, ends)], dtype=object)

    return found.withColumn(text, cut(
        F.col(text), F.col(f"{name}.spans.start"), F.col(f"{name}.spans.end"))).select(*cols)

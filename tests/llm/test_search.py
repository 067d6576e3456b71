"""Op 12: the pipeline of term owners against a score of every pair."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import term_search as se

from .common import awkward, frame, prose, with_clashes

ITEMS = "item_id string, text string"


def _terms(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def _brute(docs, items, top=10):
    bags = [(i, Counter(_terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = Counter()
    for item, text in items:
        query, scored = Counter(_terms(text)), []
        for i, bag, n in bags:
            m = 100 - 75 + 75 * n * n_docs // n_terms
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * (1_000_000_000 * bag[w] // (1000 * bag[w] + 8 * m))
                        for w, k in query.items() if w in bag)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, None if null else i, -score] += 1
    return out


def _zipf(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{min(int(rng.paretovariate(0.5)), 3000)}" for _ in range(n))


def _docs():
    rows = awkward()
    rows += [(1000 + k, _zipf(k, 40), "en", "s", 0) for k in range(300)]
    rows += [(2000 + k, _zipf(7, 40), "en", "s", 0) for k in range(25)]  # ties
    return rows


def _items():
    rng = random.Random(4)
    out = [(f"i{k}", _zipf(k, rng.randint(1, 30))) for k in range(60)]
    return out + [("i0", _zipf(0, 12)), ("none", None), ("empty", ""), ("gaps", "?! ..."),
                  ("absent", "qqqq zzzz"), (None, prose(2, 9)), ("Caps", "X AAAA Aaaa éa 😀É"),
                  ("often", "w1 " * 50 + "w2")]


@pytest.mark.parametrize("kw", [{}, {"stages": 1, "slice_docs": 16}, {"slice_docs": 50, "top": 3},
                                {"stages": 6, "slice_docs": 64, "bundle_items": 5},
                                {"block_words": 200, "slice_docs": 128}])
def test_against_all_pairs(spark, kw):
    docs, items = _docs(), _items()
    df = with_clashes(frame(spark, docs)).withColumn("slice", F.lit(1)).withColumn(
        "item", F.lit(2)).repartition(4)
    table = spark.createDataFrame(items, ITEMS).withColumn("rank", F.lit(1))
    got = Counter(tuple(r) for r in se.search(df, table, **kw).collect())
    assert got == _brute([(r[0], r[1]) for r in docs], items, kw.get("top", 10))


def test_accumulators_are_dropped(spark, monkeypatch):
    """The floor thins out what the bundles carry, and no result changes."""
    docs, items = _docs(), _items()[:20]
    kept = []
    real = se._floors

    def spy(bundles, *rest):
        kept.append(bundles.select(F.sum(F.octet_length("items") / 4)).first()[0])
        return real(bundles, *rest)

    monkeypatch.setattr(se, "_floors", spy)
    got = se.search(frame(spark, docs), spark.createDataFrame(items, ITEMS)).collect()
    assert Counter(map(tuple, got)) == _brute([(r[0], r[1]) for r in docs], items)
    pairs = sum(bool(set(_terms(t)) & set(_terms(q))) for _, q in items for _, t, *_ in docs)
    assert kept[-1] < pairs / 2


def test_empty_tables(spark):
    docs, items = frame(spark), spark.createDataFrame(_items()[:3], ITEMS)
    assert se.search(frame(spark, []), items).collect() == []
    assert se.search(docs.filter("text IS NULL"), items).collect() == []
    empty = se.search(docs, items.limit(0))
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.collect() == []

"""Op 13: the report against a count over every document and order."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import filter_audit as fa

from .common import awkward, frame, prose, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def _rows():
    rows = awkward()
    ok = prose(500, 240)
    rows += [(100 + k, t, None, s, None) for k, (t, s) in enumerate([
        (ok, "s0"), (ok, "s1"), (ok.upper(), "s0"), (ok + " A & B", "s0"), (ok + "|", "s9"),
        ("wörd " * 250, "s0"), ("É" * 50, ""), ("a b", "s1"), (" ", "s1"), ("\x1c\x85 a", "s2"),
        ("ABC " + "x" * 147, "s2"), ("ABC " + "x" * 146, "s2")])]
    rows += [(90, ok, None, "s1", None), (90, ok, None, "s2", None), (None, ok, None, "s1", None),
             (None, "only null ids", None, "s1", None), (None, "only null ids", None, "s1", None)]
    return rows


def _brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least: dict = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    docs = []
    for i, t, _, s, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {c for c, bad in zip("ABCDE", [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)),
            t in least and (i is None or i > least[t])]) if bad}
        docs.append((s or "", fails, i in good, i in toxic))
    out = set()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        removed_of = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                here = [d for d in left if c in d[1]]
                left = [d for d in left if c not in d[1]]
                removed_of[c] += len(here)
                lines.append((part, "".join(order), step, len(left), len(here),
                              sum(c in d[1] for d in mine) - len(here),
                              sum(d[1] == {c} for d in mine),
                              sum(d[2] for d in here), sum(d[3] for d in here), c))
        out |= {(*x[:-1], removed_of[x[-1]]) for x in lines}
    return out


def _labels(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    return [(i, i % 2, int(i % 3 == 0)) for i in ids[::2]] + [
        (ids[0], 1, None), (ids[0], 0, 1), (None, 1, 1), (9999, 1, 1), (ids[2], None, None)]


@pytest.mark.parametrize("hash_bits, parts", [(64, 4), (2, 1)])
def test_report_against_brute_force(spark, hash_bits, parts):
    rows = _rows()
    labels = _labels(rows)
    docs = with_clashes(frame(spark, rows)).withColumn("mask", F.lit("m")).withColumn(
        "part", F.lit(3)).withColumn("body", F.lit(3)).withColumn("good", F.lit(1)).repartition(parts)
    got = fa.audit(docs, spark.createDataFrame(labels, LABELS), hash_bits=hash_bits)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant",
                           "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(rows, labels)


def test_full_sketch_changes_no_count(spark, monkeypatch):
    monkeypatch.setattr(fa, "_CHUNK", 8)
    rows = _rows()
    monkeypatch.setattr(fa, "_places", lambda h, c: np.zeros((fa.HASHES, len(h)), np.uint64))
    got = fa.audit(frame(spark, rows).repartition(3), spark.createDataFrame([], LABELS))
    assert {tuple(r) for r in got.collect()} == _brute(rows, [])


def test_sketch_clears_unique_texts_only(spark):
    n = 5000
    h = spark.range(n).select((F.xxhash64(F.col("id") % (n - 300))).alias("h")).repartition(5)
    counters = fa._counters(n, fa.MAX_COUNTERS)
    bits = np.unpackbits(np.frombuffer(fa.repeat_bits(h, counters), np.uint8),
                         bitorder="little")
    values = [r["h"] for r in h.collect()]
    maybe = bits[fa._places(np.array(values, np.int64), counters)].all(axis=0)
    often = {v for v in values if values.count(v) > 1} if n <= 5000 else set()
    assert all(m for v, m in zip(values, maybe) if v in often)
    assert sum(m for v, m in zip(values, maybe) if v not in often) < n / 100


def test_unique_texts_are_not_grouped(spark, tmp):
    rows = [(k, prose(k, 30), "en", "s", 0) for k in range(300)] + [(900, prose(7, 30), "en", "s", 0)]
    got = fa.flags(frame(spark, rows))
    assert {(r["doc_id"], r["mask"] >> 4) for r in got.collect()} == {
        (k, int(k == 900)) for k in [*range(300), 900]}


def test_empty_table(spark):
    assert fa.audit(frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []

"""The pipeline and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from sluice.llm import mixing
from sluice.llm import queries as q
from sluice.llm import toxicity as tx
from tests.conftest import SF_SMALL
from tests.llm.common import awkward, frame, line_brute, prose, with_clashes, write_tables
from tests.llm.test_dedup import _components, _fingerprint, _lined
from tests.llm.test_filters import BENCH, LABELS, _bench, _hits, _labelled, _leaky
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Awkward rows, toxic and clean documents, shared lines, copies, leaks."""
    toxic, labels = _labelled()
    rows = awkward() + [(1000 + r[0], *r[1:]) for r in toxic]
    rows += [(2000 + r[0], r[1], "en", "s2", 0) for r in _lined(n=30)]
    rows += [(3000 + r[0], r[1], "en", "s1", 0) for r in _leaky()[-40:]]
    rows += [(4000 + k, prose(40, 300) + f" end{k % 3}", "de", None, 0) for k in range(9)]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s, _ in rows]
    lab = [(1000 + i, a, b) for i, a, b in labels]
    at = str(tmp_path_factory.mktemp("tables"))
    write_tables(with_clashes(frame(spark, rows)), at,
                 labels=spark.createDataFrame(lab, LABELS),
                 benchmark=spark.createDataFrame(_bench(), BENCH))
    return at


def test_pipeline_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    done = cp.run(spark, folder)
    assert done.columns[:len(names)] == names
    got = Counter((r["doc_id"], r["text"], r["n_chars"], r[-2], r[-1]) for r in done.collect())

    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    model = tx.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    p = model.probability(np.array(tx.text_margins(model, [r[1] for r in rows])))
    rows = [r for r, x in zip(rows, p) if x < 0.5]

    lined = {}
    for r in {(r[0], r[1]) for r in rows}:
        lined[r] = None
    for (i, new), old in zip(line_brute([r[:2] for r in rows]), rows):
        lined[old[0], old[1]] = new
    rows = [(i, lined[i, t], s) for i, t, s in rows
            if lined[i, t] == t or lined[i, t].strip()]

    fps = [_fingerprint(t) for _, t, _ in rows]
    root = _components(fps)
    import xxhash

    def order(r):
        h = 0 if r[1] is None else xxhash.xxh64_intdigest(r[1].encode(), 42)
        return (r[0] is None, r[0] or 0, h - (1 << 64) if h >> 63 else h)

    best = {}
    for r, f in zip(rows, fps):
        k = root[f]
        best[k] = min(best.get(k, r), r, key=order)
    rows = [r for r in best.values() if not _hits(r[1], _bench())[1]]

    sized = spark.createDataFrame(
        [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows],
        "doc_id long, source string, size long")
    want: Counter = Counter()
    text = {(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): t for i, t, s in rows}
    for r in mixing.take(sized).collect():
        left = r["taken"]
        t = text[r["doc_id"], r["source"], r["size"]]
        for copy in range(1, r["epochs"] + 1):
            want[r["doc_id"], t, len(t), copy, min(left, r["size"])] += 1
            left -= r["size"]
    assert got == want


def test_stages_keep_columns_and_empty_tables(spark, tmp):
    docs = with_clashes(frame(spark, []))
    at = write_tables(docs, f"{tmp}/t", labels=spark.createDataFrame([], LABELS),
                      benchmark=spark.createDataFrame([], BENCH))
    rows = spark.read.parquet(f"{at}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, rows, at).columns == docs.columns, name
    assert cp.run(spark, at).collect() == []


def test_run_twice_is_the_same(spark, folder):
    one, two = (Counter(map(str, cp.run(spark, folder).collect())) for _ in range(2))
    assert one == two


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, name, q.QUERIES[name], q.ORACLES[name], duck(SF_SMALL))
    assert res["status"] == "ok", res


def test_queries_are_registered():
    import __spark_entry__ as entry

    mine = {n: f for n, f in entry.queries().items() if re.match(r"op\d+_|pipeline$", n)}
    assert sorted(int(n[2:].split("_")[0]) for n in mine if n != "pipeline") == list(range(1, 14))
    assert set(q.ORACLES) <= set(entry.oracle_sql())


def test_queries_return_every_document(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op1_suffix_dedup", "op4_line_dedup", "op5_simhash", "op6_toxicity",
                 "op8_sketch"):
        assert q.QUERIES[name](spark, SF_SMALL).count() == n, name
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    got = q.QUERIES["op2_html_extract"](spark, SF_SMALL)
    assert got.count() == pages and got.filter("n_chars = 0").count() == 0
    assert q.QUERIES["op7_licenses"](spark, SF_SMALL).filter("not exact").count() == 0

"""Suffix dedup, line dedup, SimHash groups: against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import components as cc
from sluice.llm import line_dedup as ld
from sluice.llm import simhash as sh
from sluice.llm import suffix_dedup as sd
from sluice.llm.suffix_array import InducedSorter, Space, repeated
from tests.llm.common import awkward, frame, line_brute, prose, with_clashes


# --- suffix array ------------------------------------------------------------------------

def _strings(rng: random.Random) -> list[bytes]:
    letters = rng.choice([b"ab", b"abc\x00\xff", bytes(range(256))])
    base = bytes(rng.choice(letters) for _ in range(60))
    out = []
    for _ in range(rng.randint(1, 12)):
        x = rng.random()
        a = rng.randrange(50)
        out.append(base[a:a + rng.randint(1, 40)] if x < 0.5 else
                   bytes([rng.choice(letters)]) * rng.randint(0, 30) if x < 0.7 else
                   bytes(rng.choice(letters) for _ in range(rng.randint(0, 40))))
    return out


@pytest.mark.parametrize("memory", [64, 1 << 30])  # nearly all on disk, all in memory
def test_repeated_places(memory):
    rng = random.Random(1)
    for _ in range(150):
        depth, snippets = rng.choice([3, 5, 8, 12]), _strings(rng)
        want: dict[bytes, list] = {}
        for i, s in enumerate(snippets):
            for o in range(len(s) - depth + 1):
                want.setdefault(s[o:o + depth], []).append((i, o))
        got: dict[int, list] = {}
        for g, i, o in zip(*repeated(snippets, depth, memory)):
            got.setdefault(int(g), []).append((int(i), int(o)))
        assert sorted(map(sorted, got.values())) == sorted(
            v for v in want.values() if len(v) > 1)


def test_suffix_order_and_prefixes():
    """Order and carried common prefixes of a text without inner separators."""
    rng = random.Random(3)
    for _ in range(60):
        s = bytes(rng.choice(b"ab" if rng.random() < 0.5 else b"abcdef") for _ in range(80))
        text = np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, np.uint16(0))
        got = InducedSorter(text, 200, Space(50)).sort()
        want = sorted(range(len(s) + 1), key=lambda i: s[i:])
        assert got.order.tolist() == want
        for a, b, n in zip(want, want[1:], got.lcp[1:].tolist()):
            k = 0
            while a + k < len(s) and b + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert n == k


def test_anchors_cover_all_starts_and_depend_on_content():
    t = prose(5, 400).encode()
    x = b"q" * 37 + t + b"zz" + t[100:900]
    _, h, a, b = sd.anchors([x, t])
    spans = sorted((int(s), int(e)) for k, s, e in zip(_, a, b) if k == 0)
    assert spans[0][0] == 0 and spans[-1][1] == len(x)
    for (s, e), (s2, _e) in zip(spans, spans[1:]):
        assert s2 == e - sd.DEPTH + 1  # every start in exactly one snippet
    mine = {(int(k), x[s:e]) for k, s, e, i in zip(h, a, b, _) if i == 0}
    theirs = {(int(k), t[s:e]) for k, s, e, i in zip(h, a, b, _) if i == 1}
    assert len(theirs & mine) > len(theirs) * 0.9


def test_long_texts_are_read_in_chunks(monkeypatch):
    t = prose(6, 3000).encode()
    whole = sd.anchors([t, b"short", t[50:5000]])
    monkeypatch.setattr(sd, "_CHUNK", 700)
    parts = sd.anchors([t, b"short", t[50:5000]])

    def starts(got):
        return {(int(i), int(s), int(h)) for i, h, a, b in zip(*got)
                for s in range(int(a), int(b) - sd.DEPTH + 1)}

    assert starts(whole) == starts(parts)


# --- suffix dedup ------------------------------------------------------------------------

def _brute(rows, depth=100):
    """By the rule as written; rows with equal id and text are one document."""
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    docs.sort(key=lambda r: (r[0], r[1]))
    seen, out = set(), {}
    for known, i, t in docs:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - depth + 1):
            w = b[s:s + depth]
            if w in seen:
                gone[s:s + depth] = True
            seen.add(w)
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i if known else None, t] = (len(b), int(gone.sum()), int((edges == 1).sum()),
                                        hashlib.sha256(kept).hexdigest())
    return Counter((i, *out[i, t or ""]) for i, t in rows)


def _report(df, **kw):
    return Counter((r[0], *r[1:5]) for r in sd.dedup(df, **kw).drop("kept").collect())


def test_suffix_dedup_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] not in (26, None) or r[0] is None]
    rows = [r for r in rows if not (r[0] is None and r[3] is None)]  # one text per id
    assert _report(with_clashes(frame(spark, rows))) == _brute([r[:2] for r in rows])


def _passages(n=60, seed=9):
    rng, shared = random.Random(seed), [prose(900 + k, 40) for k in range(4)]
    rows = []
    for i in range(n):
        parts = [prose(1000 + 50 * i + k, rng.randint(1, 30)) for k in range(3)]
        parts.insert(rng.randrange(3), shared[0])
        if i % 3 == 0:
            parts.insert(1, shared[rng.randrange(4)][rng.randrange(30):])
        if i % 7 == 0 and rows:
            parts = [rows[rng.randrange(len(rows))][1], "end"]
        rows.append((i, " ".join(parts), "en", "s", 0))
    rows.append((n, "ab" * 300, "en", "s", 0))
    rows.append((n + 1, "x" + "ab" * 100 + "y", "en", "s", 0))
    return rows


@pytest.mark.parametrize("kw", [{}, {"crowded": 5, "shard_bytes": 2000, "memory": 5000},
                                {"crowded": 5, "broadcast_rows": 0}])
def test_suffix_dedup_shared_passages(spark, kw):
    rows = _passages()
    df = frame(spark, rows).repartition(7)
    assert _report(df, **kw) == _brute([r[:2] for r in rows])


def test_grams_of_texts_that_share_a_hash():
    """Two texts with one hash both give their grams; a repeated row gives them once."""
    a, b = prose(65, 90), prose(66, 90)
    run = sd._gram_rows(100)

    def grams(rows):
        import pandas as pd
        got = pd.concat(run(iter([pd.DataFrame(rows, columns=["u", "text"])])))
        return sorted(got[["h", "u", "kind"]].itertuples(index=False, name=None))

    assert grams([(7, a), (7, b)]) == sorted(grams([(7, a)]) + grams([(7, b)]))
    assert grams([(7, a), (7, a), (8, b)]) == sorted(grams([(7, a)]) + grams([(8, b)]))


def test_long_lists_of_crowded_grams_are_joined_by_salts(spark):
    """Both ways give every row its salts once; a hot gram's rows spread."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 4 > 0, F.lit(5)).otherwise(F.col("id")).cast("long").alias("h"),
        F.col("id").alias("d"), F.lit(1).cast("long").alias("u"),
        F.lit(0).cast("long").alias("start"))
    crowd = spark.createDataFrame([(5, 3), (8, 2), (12, 9)], "h long, salts long")
    want = sorted((r["d"], {5: 3, 8: 2, 12: 9}.get(r["h"])) for r in rows.collect())
    for most in (3, 2, 0):
        got = sd.with_salts(rows, crowd, most)
        assert got.columns == ["h", "d", "u", "start", "salts"]
        assert sorted((r["d"], r["salts"]) for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (most == 3)
        assert ("hashpartitioning(h" in plan and "part" in plan) == (most < 3)


def test_suffix_dedup_repeated_rows_keep_their_first_place(spark):
    """A repeated row is no earlier holder: in one batch, or in several that
    meet after the shuffle."""
    alone, shared = prose(61, 80), prose(62, 80)
    rows = [(1, alone), (2, shared + prose(63, 30)), (2, shared + prose(63, 30)), (1, alone),
            (3, prose(64, 30) + shared)]
    df = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert _report(df.coalesce(1)) == _brute(rows)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _report(df.repartition(len(rows))) == _brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_copies_of_a_hot_string_are_spread(spark):
    string, salts = bytes(range(100)), 20
    rows = [(7, salts, i, 1000 + i, 3, 104 + i % 2, string + b"xy"[:1 + i % 2])
            for i in range(400)]
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, "h long, salts long, d long, u long, start long, end long, "
                                     "snippet binary").repartition(4)
    places = sd.string_places(df, 100)
    assert max(len(r["places"]) for r in places.collect()) < 60
    late = Counter(tuple(r) for r in sd.late_strings(places, 100).collect())
    want = Counter()
    for _, _, d, u, start, end, _ in rows:
        for s in range(start, end - 99):
            if d > (1 if s == 5 else 0):  # the third string is in odd documents only
                want[d, u, s, s + 100] += 1
    assert late == want


def test_suffix_dedup_empty_table(spark):
    assert sd.dedup(frame(spark, [])).collect() == []


def test_repeated_rows_stream():
    import pandas as pd

    rows = [(5, 1, 0), (7, 2, 0), (7, 3, 0), (8, 4, 0), (9, 0, 1), (9, 6, 0), (9, 7, 2),
            (11, 0, 1), (12, 8, 0), (12, 9, 0), (12, 10, 0)]
    for size in (1, 2, 3, 20):
        frames = [pd.DataFrame([{"key": k, "h": k, "u": u, "kind": x} for k, u, x in rows[a:a + size]])
                  for a in range(0, len(rows), size)]
        got = {(int(u), int(h)) for f in sd._repeated_rows(iter(frames))
               for u, h in zip(f["u"], f["h"])}
        assert got == {(2, 7), (3, 7), (6, 9), (7, 9), (8, 12), (9, 12), (10, 12)}


# --- line dedup --------------------------------------------------------------------------

def test_patience():
    assert ld.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert ld.patience([], [1]) == [] and ld.patience([5, 5], [5]) == [(0, 0)]
    a, b = [1, 9, 2, 3, 4, 8], [7, 2, 3, 0, 4, 1]
    assert ld.patience(a, b) == [(2, 1), (3, 2), (4, 4)]
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randrange(8) for _ in range(rng.randrange(12))]
        b = [rng.randrange(8) for _ in range(rng.randrange(12))]
        got = ld.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x < y and u < v for (x, u), (y, v) in zip(got, got[1:]))


def test_common_lines_covers_what_the_alignment_misses():
    p, a, b = [10, 11, 12], [1, 2, 3, 4], [5, 6]
    for earlier, later, want in [
            ([90, *p, 91, *p, 92], [80, *p, 81], {1, 2, 3}),  # twice in the earlier
            ([90, *p, 92], [80, *p, 81, *p], {1, 2, 3, 5, 6, 7}),  # twice in the later
            ([*a, *b], [*b, *a], {0, 1, 2, 3, 4, 5}),  # moved
            ([7, 7, 7, 8], [8, 9, 7, 7], {0, 2, 3})]:
        assert set(ld.common_lines(earlier, later, [True] * len(later))) == want
    rng = random.Random(6)
    for _ in range(300):
        earlier = [rng.randrange(6) for _ in range(rng.randrange(14))]
        later = [rng.randrange(7) for _ in range(rng.randrange(14))]
        big = [rng.random() < 0.4 for _ in later]
        got = set(ld.common_lines(earlier, later, big))
        assert {j for j, x in enumerate(later) if big[j] and x in earlier} <= got
        here = {tuple(earlier[i:k]) for i in range(len(earlier)) for k in range(i + 1, 15)}
        runs = [(i, k) for i in range(len(later)) for k in range(i + 1, len(later) + 1)
                if tuple(later[i:k]) in here and any(big[i:k])]
        assert got <= {j for i, k in runs for j in range(i, k)}


def test_line_dedup_passage_twice_in_its_first_holder(spark):
    passage = "\n".join(prose(800 + k, 20) for k in range(3))
    a, b = "\n".join(prose(810 + k, 20) for k in range(4)), prose(820, 20)
    rows = [(1, f"x\n{passage}\ny\n{passage}\nz"), (2, f"u\n{passage}\nv"),
            (3, f"w\n{passage}\nq"), (4, f"{a}\n{b}"), (5, f"{b}\n{a}\nend")]
    got = ld.dedup_lines(frame(spark, [(i, t, "en", "s", 0) for i, t in rows]))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {
        1: rows[0][1], 2: "u\nv", 3: "w\nq", 4: rows[3][1], 5: "end"}


def test_distinctive_runs():
    assert ld.distinctive_runs(np.array([50, 0, 20, 0, 20, 10, 39, 41, 5]), 40).tolist() == [
        1, 0, 3, 0, 0, 2, 0, 1, 0]
    rng = np.random.default_rng(5)
    for _ in range(200):
        chars = rng.integers(0, 15, rng.integers(1, 14))
        n = len(chars)
        full = {(i, k) for i in range(n) for k in range(i + 1, n + 1) if chars[i:k].sum() >= 20}
        least = {(i, k) for i, k in full if not {(i + 1, k), (i, k - 1)} & full}
        runs = ld.distinctive_runs(chars, 20)
        assert {(i, i + int(r)) for i, r in enumerate(runs) if r} == least
        hs = rng.integers(-2**63, 2**63 - 1, n)
        a = ld.run_keys(np.concatenate([hs[:3], hs]), np.concatenate([[0] * len(hs[:3]), runs]))
        assert a.tolist() == ld.run_keys(hs, runs).tolist() and len(a) == len(least)


def test_line_dedup_of_short_lines(spark):
    verse = "\n".join(prose(830 + k, 4)[:30] for k in range(20))
    long = prose(870, 20)
    rows = [(1, f"a\n{verse}\nb"), (2, f"c\n{verse}\nd"), (3, f"{long}\ne\n{verse}"),
            (4, f"{verse[:60]}\nf"), (5, f"g\n{long}\nh\nb"), (6, "a\nx\nb")]
    got = ld.dedup_lines(frame(spark, [(i, t, "en", "s", 0) for i, t in rows]))
    left = {r["doc_id"]: r["text"] for r in got.collect()}
    assert left.pop(4).endswith("f") and "\n".join(verse.split("\n")[:2]) not in left.values()
    assert left == {1: rows[0][1], 2: "c\nd", 3: f"{long}\ne", 5: "g\nh\nb", 6: "a\nx\nb"}


def _lined(seed=3, n=50):
    rng, lines = random.Random(seed), [prose(300 + k, 9) for k in range(30)]
    verse = [prose(880 + k, 3)[:rng.randint(3, 25)].strip() for k in range(18)]
    rows = []
    for i in range(n):
        own = [prose(5000 + 40 * i + k, rng.randint(1, 14)) for k in range(rng.randint(1, 6))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(28)
            own[rng.randrange(len(own)):0] = lines[a:a + rng.randint(1, 3)]
        own[1:1] = ["", "a b", lines[0]]
        if i % 4 == 0:  # a run of short lines, its parts moved, one of them twice
            cut = [verse[:9], verse[9:]][::1 if i % 8 else -1]
            own[len(own) // 2:0] = [*cut[0], *cut[1], *(verse[4:12] if i % 12 == 0 else [])]
        rows.append((i, ("  \n" if i % 9 == 0 else "\n").join(own), "en", "s", 0))
    return rows


def test_line_dedup(spark):
    rows = _lined() + [(100 + r[0] if r[0] is not None else None, *r[1:]) for r in awkward()]
    docs = with_clashes(frame(spark, rows))
    got = ld.dedup_lines(docs, out="gone")
    assert got.columns == [*docs.columns, "gone"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(line_brute(
        [r[:2] for r in rows]))
    assert ld.dedup_lines(frame(spark, [])).collect() == []


# --- SimHash -----------------------------------------------------------------------------

def _fingerprint(text):
    import re

    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _components(fps, bits=4):
    name = {f: f for f in fps}

    def find(f):
        while name[f] != f:
            name[f] = name[name[f]]
            f = name[f]
        return f

    every = sorted(name)
    for k, a in enumerate(every):
        for b in every[k + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                name[find(a)] = find(b)
    return {f: find(f) for f in every}


def _near_rows():
    rows = [(200 + k, prose(40, 300) + f" end{k % 5}", "en", "s", 0) for k in range(10)]
    rows += [(300 + k, prose(41, 400).replace("ka", "KA", k), "en", "s", 0) for k in range(5)]
    return awkward() + rows


@pytest.mark.parametrize("block", [4096, 3])
def test_near_groups(spark, block):
    rows = _near_rows()
    got = sh.near_groups(with_clashes(frame(spark, rows)), block=block).collect()
    fps = {r[1]: _fingerprint(r[1]) for r in rows}
    root = _components(fps.values())
    least = {}
    for r in rows:
        if r[0] is not None:
            k = root[fps[r[1]]]
            least[k] = min(least.get(k, r[0]), r[0])
    assert Counter((r[0], r[1], r[2]) for r in got) == Counter(
        (r[0], f"{fps[r[1]]:016x}", least.get(root[fps[r[1]]])) for r in rows)
    assert sh.near_groups(frame(spark, [])).collect() == []


def test_links_keep_components_of_random_bits(spark):
    rng = random.Random(8)
    fps = []
    for _ in range(40):  # chains and tight groups around random centres
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            fps.append(f)
            for _ in range(rng.randint(0, 4)):
                f ^= 1 << rng.randrange(64)
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in set(fps)]
    df = spark.createDataFrame(signed, "fp long")
    for bits in (1, 3, 4):
        found = {(r[0], r[1]) for r in cc.components(sh.links(df, bits, 64)).collect()}
        want = _components([f for f, in signed], bits)
        groups: dict[int, set] = {}
        for f, r in want.items():
            groups.setdefault(r, set()).add(f)
        assert found == {(f, min(g)) for g in groups.values() for f in g if f != min(g)}


def test_thresholds_satisfy_the_pigeonhole():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (500, 64))
    x[:, 1] = x[:, 0]
    groups = sh.group_bits(500, (x.T @ x).astype(float), 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({0, 1} <= set(g) for g in groups)  # correlated bits stand together
    cost, ts = sh.allocate(500, x.mean(0), groups, [3.0, 9.0, 1.0, 2.0], 4)
    assert sum(t + 1 for t in ts) >= 5 and np.isfinite(cost)


def test_keep_one(spark):
    rows = _near_rows()
    docs = with_clashes(frame(spark, rows))
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    root = _components([_fingerprint(r[1]) for r in rows])
    got = [root[_fingerprint(r["text"])] for r in kept.select("text").collect()]
    assert sorted(got) == sorted(set(root.values()))
    assert kept.filter("doc_id is null").count() == 1  # the group with no other id

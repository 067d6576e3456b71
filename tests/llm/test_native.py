"""Chat formatting, sketches, mixing."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import chat_format as cf
from sluice.llm import mixing
from sluice.llm import sketch as sk
from tests.llm.common import awkward, frame, prose, with_clashes

CONV = "conv_id long, turn long, role string, text string"


# --- chat formatting ---------------------------------------------------------------------

TURNS = [(1, 0, "system", "be <|im_start|> kind"), (1, 1, "user", "a<|b\\|c<\\|d[INST]"),
         (1, 2, "assistant", "<|im_end|>\n<|im_start|>user\nno"), (1, 3, "user", None),
         (1, 4, "assistant", ""), (1, 5, "user", "tail"), (2, 0, "user", "no reply"),
         (3, 0, "assistant", "</s><s>[/INST]"), (None, 0, "assistant", "x\r\n\\n"),
         (None, None, None, None), (4, 0, "a\\b\nc\\nd", "odd role"),
         (4, 1, "assistant", "y" * 50_000), (5, 0, "user", "t1"), (5, 0, "user", "t0"),
         (5, 1, "assistant", "same"), (5, 1, "assistant", "same")]


def _expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
                       for r in rows if r[0] == c)
        flat = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[c] = (len(turns), hashlib.sha256(flat.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, CONV).withColumn("example", F.lit(1))
    got = {r[0]: tuple(r[1:5]) for r in cf.digest(cf.read_back(cf.format_examples(df))).collect()}
    assert got == _expected(TURNS)


def test_chat_examples(spark):
    ex = cf.format_examples(spark.createDataFrame(TURNS, CONV))
    rows = ex.filter("conv_id = 1").orderBy("example").collect()
    assert [(r["target_turn"], r["is_tail"]) for r in rows] == [(2, False), (4, False), (5, True)]
    for r in rows:
        assert r["text"].count("<|im_start|>") == r["target_turn"] + 1  # only the template's
    assert rows[0]["text"] == rows[1]["text"][:len(rows[0]["text"])]
    first = rows[0]["text"][rows[0]["loss_start"]:rows[0]["loss_end"]]
    assert first == "<\\|im_end|>\n<\\|im_start|>user\nno"
    assert rows[2]["loss_start"] == rows[2]["loss_end"]


def test_chat_empty(spark):
    df = spark.createDataFrame([], CONV)
    assert cf.digest(cf.read_back(cf.format_examples(df))).collect() == []


# --- sketches ----------------------------------------------------------------------------

def test_sketch_report(spark):
    rows = [r for r in awkward() if r[0] is not None]
    got = sk.sketch_report(with_clashes(frame(spark, rows)), parts=5).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = []
    for k, t in enumerate(texts):
        nxt, cut = texts[(k + 1) % len(texts)], len(t) // 4
        want.append((order[k][0], len(t),
                     hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == Counter(want)
    by_text = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_text[20] == by_text[21] == {""}
    assert by_text[25] == by_text[0]  # equal texts


def test_sketch_null_ids_and_one_row(spark):
    got = sk.sketch_report(frame(spark)).filter("doc_id is null").count()
    assert got == 2
    one = sk.sketch_report(frame(spark, [(5, "a b c d e f g h", "en", "s", 1)])).collect()[0]
    assert one["near_next"] == 1.0 and one["n_chars"] == 15
    assert sk.sketch_report(frame(spark, [])).collect() == []


def test_sketch_estimates_and_merge(spark):
    big = " ".join(f"w{i}" for i in range(4000))
    small = " ".join(f"w{i}" for i in range(1000, 2000))
    other = " ".join(f"v{i}" for i in range(500))
    df = spark.createDataFrame([(big, small, other)], "a string, b string, c string")
    a, b, c = (sk.sketch(F.col(x)) for x in "abc")
    both = sk.sketch(F.concat_ws(" ", "a", "c"))
    r = df.select(sk.containment(a, b).alias("ab"), sk.jaccard(a, b).alias("j"),
                  sk.containment(a, c).alias("ac"), sk.merge(a, c).alias("m"),
                  both.alias("both"), F.size(a).alias("n")).first()
    assert r["ab"] == 1.0 and r["ac"] == 0.0 and abs(r["j"] - 0.25) < 0.05
    assert abs(r["n"] - 4000 * sk.FRACTION) < 120
    assert set(r["m"]) <= set(r["both"]) and len(set(r["both"]) - set(r["m"])) <= 4  # at the seam


def _sketch_brute(text):
    """Hashes of the distinct shingles below the bound, or the least one."""
    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(struct.pack("<Q", v), h)
        return h

    words = [xxhash.xxh64_intdigest(w.encode(), 42)
             for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
    n = sk.SHINGLE_WORDS
    grams = [words[i:i + n] for i in range(len(words) - n + 1)] or ([words] if words else [])
    signed = {h - (1 << 64) if h >> 63 else h for h in map(chain, grams)}
    below = {h for h in signed if h + (1 << 63) < sk.FRACTION * (1 << 64)}
    return below or ({min(signed)} if signed else set())


def test_sketch_report_against_brute_force(spark):
    rows = [r for r in awkward() if r[0] is not None]
    rows += [(100 + k, prose(900 + k, 8 if k % 2 else 60), "en", "s", 0) for k in range(40)]
    rows += [(200 + k, prose(700, 300 - 10 * k), "en", "s", 0) for k in range(20)]
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    texts = [r[1] or "" for r in order]

    def like(a, b):
        least = min(len(a), len(b))
        return len(a & b) / least if least else float(len(a) == len(b))

    def name(hashes):
        return "".join(f"{h & (1 << 64) - 1:016X}" for h in sorted(hashes))

    want = Counter()
    for k, t in enumerate(texts):
        nxt, cut = texts[(k + 1) % len(texts)], len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        own, ed, beside = map(_sketch_brute, (t, edited, nxt))
        want[order[k][0], len(t), hashlib.sha256(edited.encode()).hexdigest(), name(own), name(ed),
             like(own, ed), like(own, beside)] += 1
    for parts in (1, 2, 7, 64):
        got = sk.sketch_report(frame(spark, rows).repartition(3), parts=parts).collect()
        assert Counter(tuple(r)[:7] for r in got) == want, parts


def test_contained_short_texts(spark):
    pairs = [(prose(3000 + k, 8), prose(4000 + k, 150) + " " + prose(3000 + k, 8)) for k in range(200)]
    df = spark.createDataFrame(pairs, "x string, y string")
    a, b = sk.sketch(F.col("x")), sk.sketch(F.col("y"))
    got = [r[0] for r in df.select(sk.containment(a, b)).collect()]
    assert set(got) <= {0.0, 1.0} and got.count(1.0) >= 175  # a lone hash: one case in 16


def test_sketch_keeps_one_hash(spark):
    df = spark.createDataFrame([(f"word{i}",) for i in range(40)], "t string")
    sizes = [r[0] for r in df.select(F.size(sk.sketch(F.col("t")))).collect()]
    assert sizes == [1] * 40
    a, b = sk.sketch(F.col("x")), sk.sketch(F.col("y"))
    df = spark.createDataFrame([("one two", " ".join(f"w{i}" for i in range(300)))],
                               "x string, y string")
    r = df.select(sk.merge(a, b).alias("m"), b.alias("b"), a.alias("a")).first()
    assert set(r["m"]) - set(r["a"]) == set(r["b"]) - set(r["a"])


# --- mixing ------------------------------------------------------------------------------

def _fill(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    """Water-filling by the rule as written."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in clamped)
        ws = sum(w[s] for s in order if s not in clamped)
        share = {s: cap * sizes[s] if s in clamped else left * w[s] / ws for s in order}
        over = {s for s in order if s not in clamped and share[s] > cap * sizes[s]}
        if not over:
            return share
        clamped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 500}, {"a": 1, "b": 1, "c": 1, "d": 100_000},
    {"a": 0, "b": 7}, {"a": 0}, {None: 50, "z": 10, "é": 900, "Z": 3}])
def test_water_filling(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(_fill(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0))


def test_take_sums_and_caps(spark):
    docs = frame(spark).select("*", mixing.word_count(F.col("text")).alias("size"))
    got = mixing.take(docs, rows_per_bucket=3).collect()
    again = mixing.take(docs.repartition(5), rows_per_bucket=3).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert len(got) == len(awkward())
    sums, targets, sizes = Counter(), {}, Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sums[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
    assert {s: round(t) for s, t in targets.items()} == pytest.approx(dict(sums), abs=1)
    assert targets == pytest.approx(_fill(dict(sizes)))


def test_mix_repeats_documents(spark):
    rows = [r for r in awkward() if r[0] is not None and r[0] != 25]
    docs = with_clashes(frame(spark, rows))
    mixed = mixing.mix(docs, rows_per_bucket=3)
    assert mixed.columns[:len(docs.columns)] == docs.columns
    copies, words = mixed.columns[-2:]
    assert {copies, words}.isdisjoint(docs.columns)
    got = mixed.groupBy("doc_id", "source", "n_chars").agg(F.sum(words)).collect()
    want = mixing.take(frame(spark, rows).select(
        "*", mixing.word_count(F.col("text")).alias("size"))).filter("taken > 0").collect()
    assert Counter((r[0], r[1], r[3]) for r in got) == Counter(
        (r["doc_id"], r["source"], r["taken"]) for r in want)
    assert mixing.mix(frame(spark, [])).collect() == []

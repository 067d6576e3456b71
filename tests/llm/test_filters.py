"""Decontamination, toxicity, license scan, HTML extraction."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import decontaminate as dc
from sluice.llm import html_extract as hx
from sluice.llm import licenses as li
from sluice.llm import toxicity as tx
from sluice.llm.block_lstm import BiLSTM, pad
from sluice.llm.html_blocks import DIMS, blocks_of, features
from tests.llm.common import awkward, frame, prose, with_clashes

BENCH = "item_id long, text string"


# --- decontamination ---------------------------------------------------------------------

def _words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _hits(text, items):
    words, cover, names = _words(text), set(), set()
    for name, t in items:
        item = _words(t)
        n = min(10, len(item))
        windows = {tuple(item[p:p + n]) for p in range(len(item) - n + 1)} if n else set()
        for p in range(len(words) - n + 1 if n else 0):
            if tuple(words[p:p + n]) in windows:
                cover |= set(range(p, p + n))
                names.add("null" if name is None else str(name))
    return len(words), len(cover), sorted(names)


def _bench():
    items = [(k, prose(700 + k, 8 + k)) for k in range(12)]
    return items + [(50, "two words"), (51, None), (52, " .,"), (53, items[11][1]), (None, "ÀÉ x9")]


def _leaky():
    items, rng, rows = _bench(), random.Random(2), awkward()
    for i in range(60):
        parts = prose(9000 + i, 40).split()
        item = _words(items[rng.randrange(12)][1])
        a = rng.randrange(len(item))
        cut = item if i % 2 else item[a:a + rng.randint(5, 15)]
        parts[rng.randrange(40):0] = [w.upper() if i % 3 else w for w in cut]
        sep = rng.choice([" ", "\n", " - ", "\t"])
        rows.append((100 + i, sep.join(parts) + rng.choice(["", " Two, words", " àÉ x9 ÀÉ X9"]),
                     "en", "s", 0))
    return rows


@pytest.mark.parametrize("block", [500_000, 30])
def test_decontaminate_hits(spark, block):
    rows = _leaky() if block > 30 else _leaky()[-25:]
    docs = with_clashes(frame(spark, rows))
    found = dc.hits(docs, spark.createDataFrame(_bench(), BENCH), block_words=block, out="hits")
    assert found.columns[:-1] == docs.columns and found.columns[-1] == "hits_"
    got = found.select("doc_id", "hits_.n_words", dc.n_hit("hits_"), "hits_.items").collect()
    assert Counter((r[0], r[1], r[2], tuple(r[3])) for r in got) == Counter(
        (r[0], n, k, tuple(names)) for r in rows for n, k, names in [_hits(r[1], _bench())])


def test_decontaminate_actions(spark):
    rows, items = _leaky(), _bench()
    docs, bench = with_clashes(frame(spark, rows)), spark.createDataFrame(items, BENCH)
    kept = dc.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        r[0] for r in rows if not _hits(r[1], items)[1])
    cut = dc.remove_spans(docs, bench)
    assert cut.columns == docs.columns
    for r in cut.select("doc_id", "text").collect():
        old = next(x[1] for x in rows if x[0] == r[0]) if r[0] is not None else None
        if old is not None and r[0] < 100 and not _hits(old, items)[1]:
            assert r["text"] == old or r[0] in (25, 26)
    left = {r["doc_id"]: len(_words(r["text"])) for r in cut.collect()}
    for r in rows:
        if r[0] is not None and r[0] >= 100:
            n, k, _ = _hits(r[1], items)
            assert left[r[0]] == n - k
    none = spark.createDataFrame([], BENCH)
    assert dc.remove_documents(docs, none).count() == len(rows)
    assert dc.hits(frame(spark, []), bench).collect() == []


# --- toxicity ----------------------------------------------------------------------------

INSULTS = ["blorgface", "snitwad", "krumpkin", "vextoad"]


def _labelled(n=260, seed=5):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = prose(20_000 + i, rng.randint(20, 80)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words) + ".", "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_held_out_and_obfuscated():
    rows, labels = _labelled()
    model = tx.train([r[1] for r in rows[:200]], [x[2] for x in labels[:200]])
    p = model.probability(np.array(tx.text_margins(model, [r[1] for r in rows[200:]])))
    assert ((p >= 0.5).astype(int) == [x[2] for x in labels[200:]]).mean() >= 0.97
    hidden = ["so b.l.o.r.g.f.a.c.e there", "s n i t w a d", "krump-kin", "vextoads", "Blorgface!",
              "x " * 40 + "krumpxkin " + "ka lo " * 30]
    plain = ["ka lo mi", "a b c d e", "", "a fair wide town, told kindly", prose(5, 50)]
    q = model.probability(np.array(tx.text_margins(model, [*hidden, *plain])))
    assert (q[:len(hidden)] >= 0.5).all() and (q[len(hidden):] < 0.5).all()


def test_string_kernel():
    k = tx.kernel(["idiot", "idixot", "table", "abc"], ["idiot", "table"])
    assert k[0, 0] == pytest.approx(1, abs=1e-5) and k[2, 1] == pytest.approx(1, abs=1e-5)
    assert k[1, 0] > 0.5 > k[2, 0]

    def brute(s, t):  # all common subsequences of length 2 and 3
        from itertools import combinations

        def phi(x):
            out = Counter()
            for n in (2, 3):
                for c in combinations(range(len(x)), n):
                    out["".join(x[i] for i in c)] += tx.DECAY ** (c[-1] - c[0] + 1)
            return out

        a, b = phi(s), phi(t)
        dot = sum(v * b[g] for g, v in a.items())
        return dot / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5

    for s, t in [("idixot", "idiot"), ("banana", "bandana"), ("aaaaaa", "aaaaa")]:
        assert tx.kernel([s], [t])[0, 0] == pytest.approx(brute(s, t), abs=1e-4)


def test_toxicity_scores_rows(spark):
    rows, labels = _labelled()
    rows = [*awkward(), *[(1000 + r[0], *r[1:]) for r in rows]]
    labels = [(1000 + i, q, t) for i, q, t in labels] + [(None, 1, 1), (0, 1, None)]
    docs = with_clashes(frame(spark, rows))
    lab = spark.createDataFrame(labels, LABELS)
    model = tx.fit(docs, lab)
    got = tx.score(docs, model, out="score")
    assert got.columns == [*docs.columns, "score_"]
    got = got.collect()
    assert len(got) == len(rows) and all(0 <= r["score_"] <= 1 for r in got)
    true = {i: t for i, _, t in labels if i is not None and i >= 1000}
    pred = [int(r["score_"] >= 0.5) == true[r["doc_id"]] for r in got
            if r["doc_id"] in true]
    assert np.mean(pred) > 0.95
    assert all(r["score_"] < 0.5 for r in got if r["text"] in (None, ""))
    kept = tx.keep_clean(docs, lab)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id is null").count() == 2
    assert kept.count() == sum(r["score_"] < 0.5 for r in got)
    again = tx.fit(docs.repartition(3), lab.repartition(2))
    assert again.key == model.key


def test_toxicity_without_labels(spark):
    docs, none = frame(spark), spark.createDataFrame([], LABELS)
    assert {r["score"] for r in tx.score(docs, tx.fit(docs, none)).collect()} == {0.0}
    assert tx.keep_clean(frame(spark, []), none).collect() == []
    held = docs.select(tx.held_out(F.col("doc_id"))).distinct().count()
    assert held == 2


# --- license scan ------------------------------------------------------------------------

MIT = next(t for n, k, t in li.TEMPLATES if k == "permission granted" and n == "MIT")


def test_licenses(spark):
    p = prose(3, 200)
    rows = [(1, p + "\nLicensed under CC BY-NC 4.0.\n" + p), (2, "Licensed under CC BY 4.0."),
            (3, p + "\n\n" + MIT.replace("furnished", "given").replace(" of ", "\nof ") + "\n" + p),
            (4, "The license of the castle was old. Permission to speak, said the king."),
            (5, "released   UNDER the\tMIT license"), (6, None), (7, ""), (8, p),
            (9, "This work is licensed under the GNU General Public License, version 2. "
                "Licensed under the Apache License, Version 2.0. " + p),
            (9, "This work is licensed under the GNU General Public License, version 7."),
            (None, "Released under the MIT License."),
            (10, p + " Licensed under the Apache License, Version 2.0. " + p)]
    rows = [(i, t, "en", "s", 0) for i, t in rows]
    docs = with_clashes(frame(spark, rows))
    got = sorted((r["doc_id"] or 0, r["block"], r["license"], r["exact"])
                 for r in li.scan_licenses(docs).collect())
    assert got == [(0, 0, "MIT", True), (1, 0, "CC-BY-NC-4.0", True), (2, 0, "CC-BY-4.0", True),
                   (3, 0, "MIT", False), (5, 0, "MIT", True), (9, 0, "GPL-2.0", True),
                   (9, 1, "Apache-2.0", True), (10, 0, "Apache-2.0", True)]
    r = li.scan_licenses(docs).filter("doc_id = 3").first()
    assert (r["missing"], r["added"]) == ("furnished", "given")
    assert r["size_given"] < r["size_alone"]
    assert li.scan_licenses(frame(spark, [])).collect() == []


def test_word_diff():
    for a, b in [("a b c", "a x b c"), ("a b", "c"), ("a a b", "a b a b"), ("", "a")]:
        missing, added, at = li.word_diff(a.split(), b.split())
        assert len(at) + len(missing) == len(a.split())
    assert li.word_diff("a b c d".split(), "z a b x d z".split()) == (["c"], ["x"], [1, 2, 4])
    assert li.word_diff("a b".split(), "a z z a b z b".split()) == ([], [], [3, 4])


def test_licenses_that_stand_close_together():
    mit = "\n".join(" ".join(MIT.split()[k:k + 9]) for k in range(0, 80, 9)).strip()
    apache = "Licensed under the Apache\nLicense,\nVersion 2.0."
    gpl = "This work is licensed\nunder the GNU General\nPublic License, version 3."
    scanner = li.Scanner()
    for parts, want in [([mit, apache], ["MIT", "Apache-2.0"]),
                        ([apache, mit, gpl], ["Apache-2.0", "MIT", "GPL-3.0"]),
                        ([apache, "and\nalso", apache], ["Apache-2.0"] * 2),
                        ([mit, mit], ["MIT"] * 2)]:
        found = scanner.scan("\n".join([prose(6, 40), *parts, prose(7, 40)]))
        assert [f.license for f in found] == want


def test_license_in_a_long_sentence():
    text = prose(4, 3000).replace(".", "") + " licensed under cc by 4.0 " + prose(5, 3000)
    found = li.Scanner().scan(text)
    assert [f.license for f in found] == ["CC-BY-4.0"]


def _varied_blocks(n):
    """Texts with notices of every template: whole, reworded a little or a lot,
    wrapped, two at a time, and with cues only."""
    import random
    rnd = random.Random(8)
    for k in range(n):
        parts = [prose(60_000 + k, rnd.randint(0, 60))]
        for _ in range(rnd.randint(1, 2)):
            words = rnd.choice(li.TEMPLATES)[2].split()
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                at = rnd.randrange(len(words))
                words[at:at + rnd.randint(0, 1)] = rnd.choice([[], ["dune"], ["license"]])
                words = words or ["license"]
            if rnd.random() < 0.4:
                words = [w + rnd.choice(["", "", "\n"]) for w in words]
            parts += [" ".join(words), prose(70_000 + k, rnd.randint(0, 30))]
        yield "\n".join(parts)


def test_license_ranking_against_all_templates():
    """Every template is tried on every block by its wording alone: the
    scanner finds something wherever one is confirmed, what it finds is
    confirmed, and no confirmed template of another license matches more of
    the same words.  One of the same license can by a byte of compression (one
    block of 474 when measured)."""
    scanner, blocks, winners, close = li.Scanner(), 0, 0, 0
    for text in _varied_blocks(150):
        spans = [m.span() for m in li._WORD.finditer(text)]
        for lo, hi in scanner.blocks(text, spans):
            words = [text[a:b].lower() for a, b in spans[lo:hi]]
            want = {}
            for k, (_, keys, wording) in enumerate(li.TEMPLATES):
                mine = li.words_of(wording)
                missing, added, at = li.word_diff(mine, words)
                if max(len(missing), len(added)) <= li.MAX_DIFF * len(mine) \
                        and not set(keys.split()) & set(missing):
                    want[k] = (spans[lo + at[0]][0], spans[lo + at[-1]][1], len(at))
            found = scanner.judge(text, spans[lo:hi])
            blocks += 1
            winners += len(found)
            assert all(any(f.start < b and a < f.end for f in found)
                       for a, b, _ in want.values()), text
            if found:
                assert found[0].template in want  # of the block itself
                a, b, n = want[found[0].template]
                assert (a, b, n) == (found[0].start, found[0].end, found[0].n_shared)
                more = [k for k, (x, y, m) in want.items() if x < b and a < y and m > n]
                assert {li.TEMPLATES[k][0] for k in more} <= {found[0].license}, text
                close += bool(more)
    assert blocks > 200 and winners > 100 and close <= winners / 50


def test_license_ranking_decides():
    """With compression switched off (every template saves the same) blocks
    get other, worse names."""
    class Same:
        def compress(self, raw):
            return b""

    texts = ["Licensed under the MIT License.", li.TEMPLATES[1][2], *_varied_blocks(150)]
    scanner = li.Scanner()
    on = [scanner.scan(t) for t in texts]
    scanner.given = [Same()] * len(scanner.given)
    scanner.own = [1] * len(scanner.own)
    off = [scanner.scan(t) for t in texts]
    names = lambda found: [(f.template, f.start, f.end) for f in found]
    changed = [(a, b) for a, b in zip(on, off) if names(a) != names(b)]
    assert names(on[0]) != names(off[0]) and names(on[1]) != names(off[1]) and len(changed) >= 4
    shared = lambda found: sum(f.n_shared for f in found)
    assert all(shared(a) >= shared(b) for a, b in changed)


def test_license_tags_and_long_texts():
    import time
    scanner = li.Scanner()
    got = scanner.scan("// SPDX-License-Identifier: Apache-2.0\nimport x\n"
                       "# SPDX-License-Identifier: GPL-3.0-or-later\n"
                       "The GNU General Public License v3 applies.\n")
    assert [f.license for f in got] == ["Apache-2.0", "GPL-3.0-or-later", "GPL-3.0"]
    whole = "\n\n".join(["The MIT License", "Copyright (c) 2020 A"]
                        + [t for n, k, t in li.TEMPLATES
                           if n == "MIT" and k.split()[0] in ("permission", "warranty")])
    got = scanner.scan(whole)
    assert [f.license for f in got] == ["MIT"] * 3 and not any(f.missing + f.added for f in got)
    t = time.time()  # one sentence of cues: windows, not a block for every cue
    assert scanner.scan("license copyright permission " * 10_000) == []
    assert time.time() - t < 60


# --- HTML extraction ---------------------------------------------------------------------

def _page(k, plain=False):
    paragraphs = [prose(40_000 + 10 * k + j, 30 + 7 * j).capitalize() + "." for j in range(4)]
    body = "".join(f"<p>{x.replace(' ', chr(10), 1)}<br></p>" for x in paragraphs)
    main = ("div class='entry-content'", "div") if plain else ("article", "article")
    return (f"<html><head><title>t {k}</title><style>p{{}}</style><script>var a='</p>';</script>"
            "</head><body><nav><ul><li><a href='/'>Home</a><li><a href='/x'>News</a></ul></nav>"
            "<div class='ad'>Buy now, click here</div>"
            f"<{main[0]}><h1>Tom &amp; Jerry {k}</h1>{body}</{main[1]}>"
            "<div id='comments'><div class='comment'><p>great post, thanks!</p></div></div>"
            "<form><label>Email address</label><select><option>a</option></select></form>"
            "<footer>&copy; 2024 all rights reserved</footer>",
            "\n\n".join([f"Tom & Jerry {k}", *paragraphs]))


PAGES = "page_id long, url string, html string"


def test_extract_pages(spark):
    rows = [(k, f"u{k}", _page(k)[0]) for k in range(60)]
    rows += [(100, "u", None), (101, "u", ""), (102, "u", "<br><p> <p>"), (None, None, rows[0][2]),
             (0, "u0", rows[0][2]), (103, "u", "<p>" + prose(9, 30_000))]
    pages = spark.createDataFrame(rows, PAGES).select("*", F.lit(1).alias("text"))
    net = hx.fit(pages)
    got = hx.extract(pages, net)
    assert got.columns[-1] == "text_"
    got = got.collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text_"] for r in got}
    right = [by[k] == _page(k)[1] for k in range(60)]
    assert np.mean(right) >= 0.95
    assert by[100] == by[101] == by[102] == "" and by[None] == by[0]
    assert set(_words(by[103])) <= set(_words(prose(9, 30_000)))
    plain = [hx.page_texts(net, [_page(k, True)[0]])[0] == _page(k, True)[1] for k in range(60, 100)]
    assert np.mean(plain) >= 0.95  # another layout than any page of the sample
    assert hx.extract(spark.createDataFrame([], PAGES), hx.train([], drawn=20)).collect() == []


def test_blocks():
    got = blocks_of("<div>a &lt;b&gt; &eacute;<b>c</b>\n d<p>e<p>f<!-- x --><script>g</script>"
                    "<ul><li>h<li>i</ul><table><tr><td>j<td>k</table>l</div>m &#65")
    assert [b.text for b in got] == ["a <b> éc d", "e", "f", "h", "i", "j", "k", "l", "m A"]
    assert [b.path.tag for b in got] == ["div", "p", "p", "li", "li", "td", "td", "div", ""]
    assert got[4].path.elements() == [("div", ""), ("ul", ""), ("li", "")]
    assert blocks_of(None) == blocks_of("") == [] and features([]).shape == (0, DIMS)


MARKUP = ["<", ">", "</", "<!", "<![", "<![foo]>", "<!--", "-->", "--", "<!doctype", "<?", "/>", "=",
          '"', "'", " ", "&", "&#", "&#x41;", "&amp", ";", "a", "p", "div", "script", "</script", "é",
          "class", "\x00", "\n", "<p", "<div class='x'>", "<b>", "</p>", "<ul><li>", "</b>", "<br/>",
          "]]>", "<a href=", "<title>", "<select>", "<table><tr><td>"]


def test_blocks_of_broken_markup():
    texts = [([b.text for b in blocks_of(h)], want) for h, want in [
        ("<![foo]>x", ["x"]), ("<p>a<!-- unclosed <p>b", ["a"]), ("a<!-->b<!--->c<!--x--!>d", ["abcd"]),
        ("<p>a<div class='x", ["a"]), ("<p>a</", ["a"]), ("<p>a<", ["a<"]), ("1 < 2 <3", ["1 < 2 <3"]),
        ("<p title='>'>a</p x='1'>b", ["a", "b"]), ("</>a</ b>c", ["ac"]), ("<script>a</scriptb>c", []),
        ("a<script>b</SCRIPT >c", ["a", "c"]), ("<div/>a<p/>b", ["a", "b"]), ("<!x>a<?y>b", ["ab"]),
        ('<p class="a>b', ["b"]), ("<p =x 'y>a", ["a"]), ("a\x00b", ["a\x00b"])]]
    assert [got for got, _ in texts] == [want for _, want in texts]
    block = blocks_of("<p CLASS = 'a &amp; b' data-id=\"c\" id=d title='class=e' role>x")[0]
    assert block.path.elements() == [("p", "a & b d")]
    rng = random.Random(8)
    for _ in range(4000):
        blocks = blocks_of("".join(rng.choices(MARKUP, k=rng.randint(1, 30))))
        assert np.isfinite(features(blocks)).all() and all(b.text.strip() for b in blocks)


@pytest.mark.parametrize("page", [
    "<div>x" * 100_000, "<p>x" * 100_000, "<b>x" * 100_000, "<ul><li>x" * 50_000, "<" * 300_000,
    "</" * 200_000, "<!--" * 100_000, "<!" * 200_000, "&#" * 200_000, "<script>" * 100_000,
    "<a x='" * 100_001, '<p class="' * 100_001, "<div>" * 50_000 + "</b></section>" * 50_000,
    "".join(f"<div class='c{k} k{k}'>x" for k in range(20_000)), "<p a" + "=" * 100_000 + " />x"])
def test_time_grows_with_the_page(page):
    began = time.process_time()
    blocks = blocks_of(page)
    features(blocks)
    hx.self_labels(blocks)
    assert time.process_time() - began < 30  # seconds at most where squares take hours


def test_network_gradients_and_padding():
    rng = np.random.default_rng(0)
    net = BiLSTM(5, hidden=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    seqs = [rng.normal(size=(n, 5)).astype(np.float32) for n in (4, 2, 7)]
    x, mask = pad(seqs)
    y = (rng.random(mask.shape) < 0.5) * mask

    def loss():
        z = net.logits(x, mask)
        return float((np.where(mask, np.logaddexp(0, z) - y * z, 0)).sum() / mask.sum())

    grads = net.gradients(x, mask, y.astype(np.float32))
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = loss()
        net.p[name][at] = old - 1e-3
        down = loss()
        net.p[name][at] = old
        assert g[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)
    alone = [net.predict([s])[0] for s in seqs]
    for a, b in zip(alone, net.predict(seqs)):
        assert a == pytest.approx(b, abs=1e-5)

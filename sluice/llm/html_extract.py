"""Main text of HTML pages by a recurrent block labeller.

Every leaf block of a page is a vector (hashed tag path with class and id
tokens, hashed words, length, link density, place); a bidirectional LSTM
reads the page's sequence and labels each block with the whole document as
context.  The text is the blocks labelled as content, in page order.

Training (driver, on a bounded sample: the first ``sample`` pages of at most
``sample_chars`` characters in the order of a hash of the id): pages that mark their parts by HTML elements
label themselves (inside ``article`` or ``main``, and not inside a menu,
footer, form and the like).  Their content and other blocks are also dealt
out into pages drawn from a grammar of layouts, with other containers and
names, sidebars, notices, comments and forms, so that the labeller does not
depend on one layout.  Nothing of the model is stored in the repository.

Defined cases: null and empty pages and pages without blocks give an empty
text; every row is read by itself; nothing is cut or dropped from a content
block; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._names import fresh
from sluice.llm.block_lstm import BiLSTM
from sluice.llm.html_blocks import DIMS, Block, Path, blocks_of, features, path_tokens
from sluice.session import ship_package

SAMPLE = 240
SAMPLE_CHARS = 1_000_000
DRAWN = 1000
SEED = 3
#: Tokens of elements, classes and ids that mark a part as not the article.
ASIDE = frozenset("""<nav <footer <aside <form <header nav menu footer sidebar aside ad ads advert
    advertisement banner cookie cookies consent notice comment comments reply respond share social
    related promo widget breadcrumb breadcrumbs pagination pager subscribe newsletter login
    search""".split())

# The grammar of drawn layouts: names of containers, and words of their texts.
ARTICLE = ["article", "main", "div.content", "div#content", "div.post-content", "div.entry-content",
           "div.article-body", "div#main", "section.story", "div.text", "td.main", "div.post",
           "div#article", "section.article__text", "div.body", "div.page-content"]
SHELL = ["", "", "div.wrapper", "div#page", "div.container", "section", "div.row/div.col",
         "table/tr/td", "main", "div.layout/div.column"]
PARTS = {
    "menu": (["nav/ul/li", "div.menu/ul/li", "header/nav/ul/li", "div#navigation/ul/li",
              "ul.nav/li", "div.topbar/a", "header/div.navbar/a"],
             "home about contact news blog products services login help faq sitemap archive shop "
             "sports world politics tech opinion team careers events more start accueil inicio"),
    "header": (["header", "header/div.site-title", "div.header", "div#masthead/h1",
                "header/h1", "header/div.tagline", "div#header/p"],
               "welcome to the official site daily news journal your source for online since"),
    "footer": (["footer", "footer/p", "div.footer", "div#footer/ul/li", "footer/div.legal",
                "div.site-info", "div#colophon/p"],
               "copyright © 2024 2023 all rights reserved privacy policy terms of use imprint "
               "contact powered by · impressum datenschutz mentions légales"),
    "sidebar": (["aside/ul/li", "aside/p", "div.sidebar/ul/li", "div#sidebar/div.widget/p",
                 "div.widget/h3", "div.sidebar/h3", "aside/h3", "div.sidebar/div.widget/h4",
                 "aside.related/ul/li", "div.right-column/p"],
                "popular recent posts categories archives tags most read related articles you may "
                "also like latest trending follow us top stories"),
    "notice": (["div.cookie-banner/p", "div#consent", "div.notice", "div.alert/p",
                "div.cookies", "section.gdpr/p", "div.modal/p"],
               "we use cookies to improve your experience by continuing you accept our policy "
               "accept all settings this site uses notice javascript is required please enable"),
    "advert": (["div.ad", "div.ads", "div.advert/p", "div#banner-ad", "aside.sponsored",
                "div.promo/p", "div.advertisement"],
               "advertisement sponsored buy now free shipping save 50% off limited offer click "
               "here sale best price order today deal"),
    "form": (["form/p", "form/label", "div.newsletter/form/div", "form.search/div",
              "div.login/form/p", "form/fieldset/legend"],
             "email address password sign up subscribe to our newsletter search your name submit "
             "login forgot send message required field"),
    "comment": (["div.comments/div.comment/p", "section#comments/article.comment/p",
                 "ol.commentlist/li.comment/div/p", "div#disqus_thread/div/p",
                 "div.comments/h3", "ul.replies/li/p", "section.discussion/div.reply/p"],
                "reply posted by says 2 hours ago i agree thanks for sharing great post nice "
                "article comments leave a comment like report user guest first lol really"),
    "extra": (["div.share/ul/li", "div.social/a", "div.breadcrumb/span", "ul.pagination/li",
               "div.author-box/p", "p.byline", "div.tags/a", "div.meta/span"],
              "share tweet facebook whatsapp email print next previous page 1 2 3 home › by "
              "admin updated published min read tags"),
}


def self_labels(blocks: list[Block]) -> list[int] | None:
    """Labels from the page's own elements; None if it marks no article."""
    known: dict[Path, tuple[bool, bool]] = {}  # path -> inside an article, inside a part to skip

    def judge(path: Path) -> tuple[bool, bool]:
        todo = []
        while path.parent is not None and path not in known:
            todo.append(path)
            path = path.parent
        inside, bad = known.get(path, (False, False))
        for node in reversed(todo):
            inside |= node.tag in ("article", "main")
            tokens = set(path_tokens(node.tag, node.names))
            if node.tag == "header" and inside:  # an article's own head holds its title
                tokens.discard("<header")
            bad |= bool(tokens & ASIDE)
            known[node] = inside, bad
        return inside, bad

    found = [judge(b.path) for b in blocks]
    if not any(inside for inside, _ in found):
        return None
    return [int(inside and not bad) for inside, bad in found]


def _path(spec: str, rng: random.Random, plain: float) -> list[tuple[str, str]]:
    """Elements of a container; now and then without or with other names."""
    out = []
    for part in filter(None, spec.split("/")):
        tag = part.replace("#", ".").split(".")[0]
        names = part[len(tag) + 1:]
        x = rng.random()
        if names and x < plain:
            names = ""
        elif x < plain + 0.15:
            names = (names + " " if names and rng.random() < 0.5 else "") + "".join(
                rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 6)))
        out.append((tag, names))
    return out


def draw_page(rng: random.Random, content: list[str], other: list[str]
              ) -> tuple[list[Block], list[int]]:
    """A page of the grammar around paragraphs of real content."""
    blocks: list[Block] = []
    labels: list[int] = []
    root = Path()
    plain = rng.choice([0.0, 0.1, 0.6])
    shell = _path(rng.choice(SHELL), rng, plain)
    top = [("html", ""), ("body", "")]

    def put(path, text, label, linked=0):
        text = " ".join(text.split())
        if text:
            blocks.append(Block(text, root.below(path), min(linked, len(text))))
            labels.append(label)

    def part(kind: str, inside=()):
        specs, words = PARTS[kind]
        path = top + list(inside) + _path(rng.choice(specs), rng, plain)
        vocab = words.split()
        n = {"menu": rng.randint(3, 9), "comment": rng.randint(1, 6)}.get(kind, rng.randint(1, 4))
        for _ in range(n):
            k = rng.randint(1, 3) if kind in ("menu", "extra") else rng.randint(2, 18)
            text = " ".join(rng.choice(vocab) for _ in range(k))
            x = rng.random()
            if x < 0.35 and other:
                text = rng.choice(other)
            elif x < (0.75 if kind in ("comment", "sidebar", "notice", "advert") else 0.45) \
                    and content:  # prose like that of articles
                got = rng.choice(content).split()
                a = rng.randrange(len(got))
                text = (" ".join(got[a:a + rng.randint(3, 40)]) + " " + text
                        if rng.random() < 0.4 else " ".join(got[a:a + rng.randint(3, 60)]))
            linked = len(text) if kind in ("menu", "extra", "sidebar") and rng.random() < 0.8 \
                else 0
            put(path, text, 0, linked)

    for kind in ("notice", "header", "menu", "advert", "extra"):
        if rng.random() < {"menu": 0.8, "header": 0.4}.get(kind, 0.3):
            part(kind, shell if rng.random() < 0.4 else ())
    if rng.random() < 0.25:
        part("sidebar", shell)
    body = top + shell + _path(rng.choice(ARTICLE), rng, plain)
    if rng.random() < 0.7:
        words = rng.choice(content).split()
        head = [("header", "")] if rng.random() < 0.2 else []
        put(body + head + [(rng.choice(["h1", "h1", "h2"]), "")], " ".join(
            words[:rng.randint(3, 12)]), 1)
    if rng.random() < 0.2:
        part("extra", shell)
    for k in range(rng.randint(1, 14)):
        x, text = rng.random(), rng.choice(content)
        if other and x > 0.9:  # what stands in menus and footers may stand in articles
            text = rng.choice(other)
        if x < 0.5:
            got = text.split()
            text = " ".join(got[:rng.randint(1, max(1, len(got)))])
        leaf = rng.choice(["p"] * 9 + ["h2", "blockquote", "ul/li", "div", "pre", "section/p"])
        put(body + _path(leaf, rng, 0), text, 1,
            rng.randint(0, len(text) // 3) if rng.random() < 0.2 else 0)
        if rng.random() < 0.05:
            part("advert", shell + _path("div", rng, 0))
    for kind, chance in (("extra", 0.3), ("form", 0.3), ("comment", 0.45), ("sidebar", 0.35),
                         ("advert", 0.2), ("notice", 0.15), ("footer", 0.8)):
        if rng.random() < chance:
            part(kind, shell if rng.random() < 0.4 else ())
    return blocks, labels


def train(pages: list[str | None], drawn: int = DRAWN, seed: int = SEED) -> BiLSTM:
    """Fit the labeller on pages (a bounded list) and drawn layouts."""
    rng = random.Random(seed)
    seqs, labels, content, other = [], [], [], []
    for html in pages:
        blocks = blocks_of(html)
        own = self_labels(blocks) if blocks else None
        if own is None:
            continue
        for b, y in zip(blocks, own):
            (content if y else other).append(b.text)
        if any(own):
            seqs.append(blocks)
            labels.append(own)
    for k in range(len(seqs)):  # the same pages with texts of the other kind here and there
        seqs.append([replace(b, text=rng.choice(other)) if y and other and rng.random() < 0.2
                     else b for b, y in zip(seqs[k], labels[k])])
        labels.append(labels[k])
    if not content:
        vocab = "the of and to in a is that for it as was with be by on not he his but at".split()
        content = [" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 80))) + "."
                   for _ in range(200)]
    for _ in range(drawn):
        blocks, own = draw_page(rng, content, other)
        seqs.append(blocks)
        labels.append(own)
    for blocks in seqs[:len(seqs) - drawn]:  # some real pages without any names
        if rng.random() < 0.2:
            root = Path()
            blocks[:] = [replace(b, path=root.below((t, "") for t, _ in b.path.elements()))
                         for b in blocks]
    net = BiLSTM(DIMS)
    net.fit([features(b) for b in seqs], [np.array(y, np.float32) for y in labels])
    return net


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE,
        sample_chars: int = SAMPLE_CHARS) -> BiLSTM:
    """Train on a bounded sample of the pages: ``sample`` of those of at most
    ``sample_chars`` characters."""
    rows = pages.select(F.xxhash64(F.col(page_id)).alias("i"), F.col(html).alias("h")) \
        .filter(F.char_length("h") <= sample_chars).withColumn("k", F.xxhash64("h"))
    picked = rows.select("i", "k").distinct().orderBy("i", "k").limit(sample)
    got = rows.join(F.broadcast(picked), ["i", "k"])  # at most ``sample`` pairs
    got = got.dropDuplicates(["i", "k"]).collect()
    return train([r["h"] for r in sorted(got, key=lambda r: (r["i"], r["k"]))])


def page_texts(net: BiLSTM, pages) -> list[str]:
    """Main text of each page."""
    blocks = [blocks_of(h) for h in pages]
    probs = net.predict([features(b) for b in blocks])
    return ["\n\n".join(b.text for b, q in zip(bs, p) if q >= 0.5)
            for bs, p in zip(blocks, probs)]


def extract(pages: DataFrame, net: BiLSTM, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with a column ``out``: the main text."""
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("string")
    def main_text(htmls: pd.Series) -> pd.Series:
        got = []
        for lo in range(0, len(htmls), 64):
            got += page_texts(shared.value, htmls[lo:lo + 64])
        return pd.Series(got, dtype=object)

    return pages.withColumn(fresh(pages, out), main_text(F.col(html)))

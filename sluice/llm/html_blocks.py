"""Leaf blocks of an HTML page and their feature vectors.

A block is the text between two block-level tags; inline tags only mark it
up and ``<br>`` is white space.  Scripts, styles, heads and the choices and
values inside form controls are never text.  Character references are
decoded, white space becomes one space.

Every string is a page.  Markup that does not end (a comment, a tag, a
script) reaches to the end of the page and is no text; declarations, unknown
``<!...>`` parts and end tags without a name are skipped; a ``<`` that starts
no markup is text.  Time grows with the length of the page, whatever is left
open: the reader is one pattern, open elements are found by name, and a
block's path is a node that shares its parents.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass
from html import unescape

import numpy as np

# Element names of HTML by their role.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins
    kbd label mark q s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("""area base br col embed hr img input link meta param source track
    wbr""".split())
HIDDEN = frozenset("""script style noscript template head title svg math iframe object select
    option textarea button canvas video audio datalist""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("ul ol dl table body html article section div nav aside footer".split())

PATH_DIMS = 128
WORD_DIMS = 128
NUMBERS = 12
DIMS = PATH_DIMS + WORD_DIMS + NUMBERS
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WORDS = re.compile(r"[^\W_]+")


_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style")}

#: Possessive throughout: no part is read twice.
_MARKUP = re.compile(r"""<(?:
    !--(?:-?>|(?s:.*?)(?:--!?>|\Z))
  | [!?][^>]*+(?:>|\Z)
  | /(?P<end>[a-zA-Z][^\s/>]*+)?+[^>]*+(?:>|\Z)
  | (?P<start>[a-zA-Z][^\s/>]*+)
    (?P<attrs>(?:[^>"'=]++ | =\s*+(?:"[^"]*+" | '[^']*+' | [^\s>"'][^\s>]*+)?+ | ["'])*+)(?:>|\Z)
)""", re.X)
_ATTR = re.compile(r"""([^\s/>"'=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_NAMING = re.compile("class|id|role", re.I)


class Path:
    """A chain of block elements (tag; class, id and role); equal chains of a
    page are one node."""

    __slots__ = ("tag", "names", "parent", "depth", "kids", "vec", "leaf")

    def __init__(self, tag: str = "", names: str = "", parent: Path | None = None):
        self.tag, self.names, self.parent = tag, names, parent
        self.depth = 0 if parent is None else parent.depth + 1
        self.kids: dict[tuple[str, str], Path] = {}
        self.vec = self.leaf = None

    def child(self, tag: str, names: str) -> Path:
        got = self.kids.get((tag, names))
        if got is None:
            got = self.kids[tag, names] = Path(tag, names, self)
        return got

    def below(self, elements) -> Path:
        node = self
        for tag, names in elements:
            node = node.child(tag, names)
        return node

    def elements(self) -> list[tuple[str, str]]:
        """``(tag, names)``, outermost first."""
        out, node = [], self
        while node.parent is not None:
            out.append((node.tag, node.names))
            node = node.parent
        return out[::-1]


@dataclass
class Block:
    text: str
    path: Path
    linked: int  # characters inside links


class _Reader:
    def __init__(self):
        self.stack: list[tuple[str, Path]] = []
        self.at: dict[str, list[int]] = {}  # places in the stack: of a tag,
        self.scopes: list[int] = []  # of elements that end a search for open items,
        self.outer: list[int] = []  # of elements that are not inline
        self.root = Path()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = 0

    def read(self, html: str) -> list[Block]:
        at = 0
        while (j := html.find("<", at)) >= 0:
            if j > at:
                self.data(html[at:j])
            m = _MARKUP.match(html, j)
            if m is None:
                self.data("<")
                at = j + 1
                continue
            at = m.end()
            if m["start"]:
                tag, attrs = m["start"].lower(), m["attrs"]
                self.open(tag, attrs)
                if attrs.endswith("/") and self._closed(attrs):
                    if tag not in VOID and tag not in INLINE:
                        self.close(tag)
                elif tag in _RAW:
                    end = _RAW[tag].search(html, at)
                    at = end.start() if end else len(html)
            elif m["end"]:
                self.close(m["end"].lower())
        if at < len(html):
            self.data(html[at:])
        self.flush()
        return self.blocks

    @staticmethod
    def _closed(attrs: str) -> bool:
        tail = attrs.rsplit(None, 1)[-1]
        return len(tail) < 2 or "=" not in tail or tail[-2] in "\"'"

    @staticmethod
    def _names(attrs: str) -> str:
        if not _NAMING.search(attrs):
            return ""
        out = []
        for name, *values in _ATTR.findall(attrs):
            if name.lower() in ("class", "id", "role"):
                out.append(unescape("".join(values)))
        return " ".join(filter(None, out))

    def node(self) -> Path:
        return self.stack[-1][1] if self.stack else self.root

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, self.node(), min(self.linked, len(text))))
        self.parts, self.linked = [], 0

    def pop(self, upto: int) -> None:
        for tag, _ in reversed(self.stack[upto:]):
            self.at[tag].pop()
            self.links -= tag == "a"
            self.hidden -= tag in HIDDEN
        del self.stack[upto:]
        for places in (self.scopes, self.outer):
            while places and places[-1] >= upto:
                places.pop()

    def open(self, tag: str, attrs: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag not in INLINE:
                self.flush()
            return
        node = self.node()
        if tag not in INLINE:
            self.flush()
            if tag == "body":
                self.pop(0)
            scope = self.scopes[-1] if self.scopes else -1
            ended = []
            for name in ("p", *_CLOSES.get(tag, ())):
                places = self.at.get(name, ())
                k = bisect_right(places, scope)
                ended += places[k:k + 1]
            if ended:
                self.pop(min(ended))
            node = self.node().child(tag, self._names(attrs))
            self.outer.append(len(self.stack))
            if tag in _SCOPE:
                self.scopes.append(len(self.stack))
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))
        self.links += tag == "a"
        self.hidden += tag in HIDDEN

    def close(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        places = self.at.get(tag)
        if places and (tag not in INLINE or not self.outer or places[-1] > self.outer[-1]):
            self.pop(places[-1])

    def data(self, data: str) -> None:
        if not self.hidden:
            if "&" in data:
                data = unescape(data)
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    """Leaf blocks in page order; none for null or empty."""
    return _Reader().read(html or "")


_known: dict[str, int] = {}


def _slot(kind: str, token: str) -> int:
    key = kind + token
    got = _known.get(key)
    if got is None:
        if len(_known) > 300_000:
            _known.clear()
        h = zlib.crc32(key.encode("utf-8", "surrogatepass"))
        got = _known[key] = (h >> 1) * 2 + (h & 1)
    return got


_words: dict[str, int] = {}  # slot of a word, with its sign in the lowest bit


def _word_vector(words: list[str]) -> np.ndarray:
    """Signed counts of the words' slots."""
    get = _words.get
    slots = [get(w, -1) for w in words]
    if -1 in slots:
        if len(_words) > 500_000:
            _words.clear()
        for k, w in enumerate(words):
            if slots[k] < 0:
                h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
                slots[k] = _words[w] = (h >> 1) % WORD_DIMS * 2 + (h & 1)
    at = np.array(slots)
    return np.bincount(at >> 1, weights=(at & 1) * 2.0 - 1.0, minlength=WORD_DIMS)


def path_tokens(tag: str, names: str) -> list[str]:
    return [f"<{tag}", *(t.lower() for t in _TOKEN.findall(names))]


def _add(vec: np.ndarray, kind: str, tokens: list[str]) -> np.ndarray:
    for token in tokens:
        h = _slot(kind, token)
        vec[(h >> 1) % PATH_DIMS] += 1 if h & 1 else -1
    return vec


def _path_vector(path: Path) -> np.ndarray:
    """Hashed tokens of the path, each step outwards a tenth lighter, and once
    more those of the innermost element."""
    if path.leaf is None:
        todo, node = [], path
        while node.vec is None and node.parent is not None:
            todo.append(node)
            node = node.parent
        if node.vec is None:
            node.vec = np.zeros(PATH_DIMS, np.float32)
        for node in reversed(todo):
            node.vec = _add(node.parent.vec * np.float32(0.9), "p",
                            path_tokens(node.tag, node.names))
        path.leaf = path.vec if path.parent is None else _add(
            path.vec.copy(), "l", path_tokens(path.tag, path.names))
    return path.leaf


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed tag path, hashed words, a few numbers."""
    out = np.zeros((len(blocks), DIMS), np.float32)
    n = len(blocks)
    for i, b in enumerate(blocks):
        out[i, :PATH_DIMS] = _path_vector(b.path)
        words = _WORDS.findall(b.text.lower())
        if words:
            own = _word_vector(words)
            out[i, PATH_DIMS:PATH_DIMS + WORD_DIMS] = own / max(np.sqrt(own @ own), 1e-6)
        size = len(b.text)
        tag = b.path.tag
        out[i, -NUMBERS:] = (
            np.log1p(size) / 5, np.log1p(len(words)) / 4, b.linked / size,
            sum(b.text.count(c) for c in ".,;") / size * 10, tag in HEADINGS,
            sum(b.text.count(c) for c in "0123456789") / size, i / n, (n - i) / n, min(b.path.depth, 12) / 12,
            b.text[-1] in ".!?\"", size < 40, np.log1p(n) / 6)
    return out

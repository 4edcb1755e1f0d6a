"""Main text of web pages, by removing what a site repeats.

A first pass over all pages hashes the subtree of every block element (its
names, its text and its child subtrees) and Spark counts, for each host, on how
many pages a subtree is found. Pages whose own main text is the same count once,
so copies of an article are no template. Subtrees on many of a host's pages
(``SHARE`` of them, and ``LEAST`` at least) are its template. A second pass
deletes these subtrees and writes what is left.

Some parts of a page are no article whatever they hold, and differ from page to
page: elements that HTML itself calls menus, footers, asides, forms, scripts,
and the like, those with such a role, and those whose class or id says so (a
fixed list of words). They go by their kind. Prose inside an article (paragraphs,
headings, list items, quotations, cells) is not deleted for being repeated:
licence lines and shared passages belong to the article. Containers are.

The text is that of the page's articles; of its main element, where no article
holds any text; of its whole body, where neither does.

Markup is read as browsers do, as far as it matters for text: implied ends of
paragraphs, list items, cells and headings; stray end tags; raw text in scripts
and styles; character references with and without a semicolon; an unclosed
comment or tag ends the page. Work is linear in a page's length. White space in
a block, line breaks among it, is one space; blocks are trimmed, empty ones
left out, and joined by a newline.

Defined results: null and empty pages have an empty text. Pages without a host
(a null URL, or one without ``://``) have no template; kinds alone decide.
Repeated rows are extracted each for itself and count once in the templates.
An empty table gives no rows. Other columns are kept; ``text`` and ``n_chars``
are replaced. Helper columns are named apart from those of the input.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .url_rules import canonical

#: A subtree is a template's if it is on so large a part of a host's distinct
#: pages, and on so many at least.
SHARE, LEAST = 0.3, 3
#: Shares of a host's pages meet its template in so many places.
SALTS = 64

#: Element names of HTML, by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())
BLOCKS = PROSE | frozenset(
    "address article aside body center details dialog dir div dl fieldset figure footer form "
    "header hgroup html legend listing main menu nav ol section summary table tbody tfoot thead "
    "tr ul search optgroup option".split()
)
#: A start tag of these ends an open paragraph.
ENDS_P = BLOCKS - frozenset("html body tbody tfoot thead tr td th caption optgroup option legend".split()) | {"hr"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends an open element of the second kinds, up to one of the third.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset("ul ol menu dir".split())),
    "dd": (frozenset({"dd", "dt"}), frozenset({"dl"})),
    "dt": (frozenset({"dd", "dt"}), frozenset({"dl"})),
    "tr": (frozenset("tr td th caption".split()), frozenset({"table"})),
    "td": (frozenset("td th caption".split()), frozenset({"table", "tr"})),
    "th": (frozenset("td th caption".split()), frozenset({"table", "tr"})),
    "tbody": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset({"table"})),
    "thead": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset({"table"})),
    "tfoot": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset("select datalist".split())),
}
#: Elements that stay open across end tags of others inside them.
CELLS = frozenset("table td th caption template".split())
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())
#: No part of an article, by name.
DROPPED = frozenset(
    "head title script style xmp noembed noframes noscript template nav aside form footer menu search "
    "iframe object embed applet svg canvas audio video select datalist button input textarea label "
    "fieldset dialog progress meter".split()
)
#: Roles and words of classes and ids that say the same.
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
    "toolbar status tablist".split()
)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsors sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices notification notifications alert newsletter subscribe "
    "subscription signup signin login register popup popover modal overlay lightbox toast paywall "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager sidebar sidebars "
    "masthead footer footers comment comments commentlist disqus respond reply replies "
    "share sharing social sociable related recommended recommendations trending widget widgets "
    "search searchbox form copyright skip toolbar".split()
)
#: A class with one of these tells of a state, not of a part.
STATES = frozenset("no not has have with without is in hide hidden show open closed status enabled disabled".split())
#: A header or footer of these is the article's own title line.
OWN = frozenset("article post entry content story title section page".split())

_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))*+)>"""
)
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_INTERESTING = re.compile(r"\b(?:class|id|role|hidden|aria-hidden|style)\b", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(source: str) -> dict[str, str]:
    """The attributes that tell what an element is for; the first one counts."""
    found: dict[str, str] = {}
    if source and _INTERESTING.search(source):
        for name, value in _ATTRIBUTE.findall(source):
            if value[:1] in ("'", '"'):
                value = value[1:-1]
            found.setdefault(name.lower(), entities.unescape(value) if "&" in value else value)
    return found


def _marked(name: str) -> bool:
    """Does a class or id name say that the element is no part of an article?"""
    parts = [part.lower() for part in _PART.findall(name)]
    if not parts or not STATES.isdisjoint(parts):
        return False
    if not MARKS.isdisjoint(parts):
        own = "footer" in parts and not OWN.isdisjoint(parts)
        return not own or not MARKS.isdisjoint(set(parts) - {"footer"})
    return "header" in parts and OWN.isdisjoint(parts)


class _Element:
    __slots__ = ("block", "digest", "dropped", "first", "kind", "name")

    def __init__(self, name: str, kind: str, block: bool, dropped: bool, first: int, digest) -> None:
        self.name, self.kind, self.block, self.dropped = name, kind, block, dropped
        self.first, self.digest = first, digest


class _Page:
    """One page, read once from start to end.

    template: hashes of the host's repeated subtrees, or None; hashing: are
    subtrees hashed? Blocks are kept as (text, in an article, in a main
    element); a deleted element takes its blocks with it."""

    def __init__(self, template: frozenset[int] | None, hashing: bool) -> None:
        self.template, self.hashing = template, hashing or bool(template)
        self.blocks: list[tuple[str, bool, bool]] = []
        self.stack: list[_Element] = []
        self.words: list[str] = []
        self.hashes: set[int] = set()
        self.dropped = self.articles = self.mains = 0

    def text(self) -> str:
        for place in (1, 2):
            if any(block[place] for block in self.blocks):
                return "\n".join(block[0] for block in self.blocks if block[place])
        return "\n".join(block[0] for block in self.blocks)

    def _flush(self) -> None:
        if not self.words:
            return
        text = " ".join("".join(self.words).split())
        self.words.clear()
        if text:
            if self.hashing:
                for element in reversed(self.stack):
                    if element.block:
                        element.digest.update(b"t" + text.encode("utf-8", "surrogatepass") + b"\0")
                        break
            if not self.dropped:
                self.blocks.append((text, self.articles > 0, self.mains > 0))

    def _kind(self, name: str, attributes: dict[str, str]) -> str:
        role = attributes.get("role", "").strip().lower()
        if name == "article" or role == "article":
            return "article"
        return "main" if name == "main" or role == "main" else ""

    def _unwanted(self, name: str, kind: str, attributes: dict[str, str]) -> bool:
        if name in DROPPED or (name == "header" and not self.articles and not self.mains):
            return True
        if not attributes or name in ("html", "body") or kind == "main":
            return False
        names = attributes.get("class", "").split()
        if kind == "article":
            # Readers' comments are articles, too, in HTML's own words.
            return any(x.lower() in ("comment", "reply", "ad", "advert", "sponsored") for x in names)
        if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
            return True
        if _HIDDEN.search(attributes.get("style", "")):
            return True
        if attributes.get("role", "").strip().lower() in ROLES:
            return True
        own = attributes.get("id", "").split()
        return any(map(_marked, names)) or any(map(_marked, own))

    def _open(self, name: str, source: str) -> None:
        if name in ("html", "body") and any(e.name == name for e in self.stack):
            return
        block = name in BLOCKS
        if block or name == "hr":
            self._flush()
            if name in ENDS_P:
                self._close_paragraph()
            if name in HEADINGS:
                top = self._top()
                if top is not None and self.stack[top].name in HEADINGS:
                    self._pop_to(top)
        if name in IMPLIED:
            kinds, barriers = IMPLIED[name]
            found = None
            for k in range(len(self.stack) - 1, -1, -1):
                other = self.stack[k].name
                if other in barriers:
                    break
                if other in kinds:
                    found = k
                elif other in CELLS and name not in TABLE_PARTS:
                    break
            if found is not None:
                self._pop_to(found)
        if name == "br" or name == "hr" or name == "wbr":
            if name == "br":
                self.words.append(" ")
            return
        if name in VOID:
            return
        attributes = _attributes(source)
        kind = self._kind(name, attributes)
        dropped = self._unwanted(name, kind, attributes)
        if kind:
            self._uncover(kind)
        digest = None
        if block and self.hashing:
            label = f"{name}\1{attributes.get('id', '')}\1{attributes.get('class', '')}\0"
            digest = hashlib.blake2b(label.encode("utf-8", "surrogatepass"), digest_size=8)
        self.stack.append(_Element(name, kind, block, dropped, len(self.blocks), digest))
        self.dropped += dropped
        self.articles += kind == "article"
        self.mains += kind == "main"

    def _uncover(self, kind: str) -> None:
        """A form around an article, and anything around the main element, is a
        wrapper of the page."""
        for element in self.stack:
            if element.dropped and (kind == "main" or element.name == "form"):
                element.dropped = False
                self.dropped -= 1

    def _top(self) -> int | None:
        """The innermost open block element."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].block:
                return k
        return None

    def _close_paragraph(self) -> None:
        top = self._top()
        if top is not None and self.stack[top].name == "p":
            self._pop_to(top)

    def _pop_to(self, k: int) -> None:
        """Ends all elements from the k-th on."""
        while len(self.stack) > k:
            element = self.stack[-1]
            if not element.block:
                self.stack.pop()
                if element.dropped:
                    self.dropped -= 1
                self.articles -= element.kind == "article"
                self.mains -= element.kind == "main"
                continue
            self._flush()
            self.stack.pop()
            self.dropped -= element.dropped
            if element.digest is not None:
                own = int.from_bytes(element.digest.digest(), "big", signed=True)
                for outer in reversed(self.stack):
                    if outer.block:
                        outer.digest.update(b"e" + element.digest.digest())
                        break
                if element.name not in ("html", "body"):
                    self.hashes.add(own)
                    if self.template and own in self.template and not (self.articles and element.name in PROSE):
                        del self.blocks[element.first :]
            self.articles -= element.kind == "article"
            self.mains -= element.kind == "main"

    def _close(self, name: str) -> None:
        if name in ("html", "body", "br") or name in VOID:
            if name == "br":
                self.words.append(" ")
            return
        block = name in BLOCKS
        inner = False  # is a block element open inside?
        for k in range(len(self.stack) - 1, -1, -1):
            element = self.stack[k]
            if element.name == name or (name in HEADINGS and element.name in HEADINGS):
                if block or not inner or element.dropped:
                    self._pop_to(k)
                else:
                    element.name = ""  # ends nothing but itself
                return
            inner = inner or element.block
            if inner and name == "p":
                return
            if element.name in CELLS and name not in TABLE_PARTS:
                return
            if name == "li" and element.name in ("ul", "ol", "menu", "dir"):
                return

    def _say(self, text: str) -> None:
        if "&" in text:
            text = entities.unescape(text)
        if not self.dropped:
            self.words.append(text)
        elif self.hashing:
            own = " ".join(text.split())
            top = self._top()
            if own and top is not None:
                self.stack[top].digest.update(b"t" + own.encode("utf-8", "surrogatepass") + b"\0")

    def read(self, source: str) -> None:
        at, size, tag = 0, len(source), _TAG
        while at < size:
            start = source.find("<", at)
            if start < 0:
                self._say(source[at:])
                break
            follows = source[start + 1 : start + 2]
            if not (follows in ("/", "!", "?") or (follows.isascii() and follows.isalpha())):
                self._say(source[at : start + 1])
                at = start + 1
                continue
            if start > at:
                self._say(source[at:start])
            if source.startswith("<!--", start):
                if source.startswith((">", "->"), start + 4):
                    at = source.index(">", start + 4) + 1
                    continue
                ends = [e for e in (source.find("-->", start + 4), source.find("--!>", start + 4)) if e >= 0]
                if not ends:
                    break
                at = source.index(">", min(ends)) + 1
                continue
            m = None
            head = source[start + 2 : start + 3] if follows == "/" else follows
            if head.isascii() and head.isalpha():
                m = tag.match(source, start)
                if m is None:
                    # A quotation mark that never ends: from here on a tag ends
                    # at the next bracket.
                    tag = _PLAIN_TAG
                    m = tag.match(source, start)
                    if m is None:
                        break
            if m is None:
                end = source.find(">", start)
                if end < 0:
                    break
                at = end + 1
                continue
            at = m.end()
            name = m[2].lower()
            if m[1]:
                self._close(name)
                continue
            if name in RAW:
                end = _end_of_raw(name).search(source, at)
                if name in BLOCKS or name == "title":
                    self._flush()
                if end is None:
                    break
                at = end.end()
                continue
            if name == "plaintext":
                self._say(source[at:].replace("&", "&amp;"))
                break
            self._open(name, m[3])
            if m[3].endswith("/") and name in ("svg", "math", "path"):
                self._close(name)
        self._flush()
        self._pop_to(0)


_RAW_ENDS: dict[str, re.Pattern] = {}


def _end_of_raw(name: str) -> re.Pattern:
    if name not in _RAW_ENDS:
        _RAW_ENDS[name] = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I)
    return _RAW_ENDS[name]


def read_page(source: str | None, template: frozenset[int] | None = None, hashing: bool = False) -> _Page:
    page = _Page(template, hashing)
    if source:
        page.read(source)
    return page


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, subtree, page) for the distinct subtrees of each page; page is a
    hash of the page's main text; subtree 0 stands for the page itself."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            hosts, counts, found, own = part.column("_host"), [], [], []
            for source in part.column("_html").to_pylist():
                page = read_page(source, hashing=True)
                values = [0, *page.hashes]
                counts.append(len(values))
                found += values
                own.append(_hash(page.text()))
            times = np.array(counts, np.int64)
            row = pa.array(np.repeat(np.arange(len(times)), times))
            yield pa.RecordBatch.from_arrays(
                [hosts.take(row), pa.array(found, pa.int64()), pa.array(own, pa.int64()).take(row)],
                names=["host", "subtree", "page"],
            )


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(host, template): the subtrees that are repeated on a host's pages, for
    pages (_host, _html). A page has some number of subtrees, and each of these
    is on a part of the pages, so a host's list is bounded by the mean number of
    subtrees over ``share``."""
    found = pages.filter(F.col("_host") != "").mapInArrow(_subtrees, "host string, subtree long, page long")
    # Distinct first: a host that holds most pages is then spread over subtrees.
    counts = found.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    counts = stage(counts.filter((F.col("n") >= least) | (F.col("subtree") == 0)), "page-subtrees")
    whole = counts.filter(F.col("subtree") == 0).select("host", F.col("n").alias("pages"))
    kept = counts.filter(F.col("subtree") != 0).join(whole, "host").filter(F.col("n") >= share * F.col("pages"))
    return stage(kept.groupBy("host").agg(F.collect_set("subtree").alias("template")), "page-templates")


def extract(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """Pages (url, html and any others) with ``text`` and ``n_chars``."""
    names = [n for n in pages.columns if n not in ("text", "n_chars")]
    taken = {n.lower() for n in pages.columns}
    host_name, list_name, salt_name = (_free(n, taken) for n in ("_host", "_template", "_salt"))
    host, _ = canonical(F.col("url").cast("string"))
    known = templates(pages.select(host.alias("_host"), F.col("html").cast("string").alias("_html")), share, least)
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    known = known.select(
        F.col("host").alias(host_name), F.col("template").alias(list_name), every.alias(salt_name)
    )
    salt = F.pmod(F.xxhash64(F.col("html").cast("string"), F.col("url").cast("string")), F.lit(SALTS)).cast("int")
    rows = pages.select(*(F.col(f"`{n}`") for n in names), host.alias(host_name), salt.alias(salt_name))
    # Small lists are broadcast by Spark, which knows the size of stored rows.
    rows = rows.join(known, [host_name, salt_name], "left").drop(salt_name)
    schema = T.StructType(
        [*(pages.schema[n] for n in names), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches):
        sets: dict[str, frozenset[int]] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = []
                lists = part.column(list_name)
                for k, (source, own) in enumerate(zip(part.column("html").to_pylist(), part.column(host_name).to_pylist())):
                    if own not in sets:
                        # Hosts come in any order; a few of their sets are kept.
                        if len(sets) >= 64:
                            sets.clear()
                        sets[own] = frozenset(lists[k].as_py() or ())
                    texts.append(read_page(source, sets[own]).text())
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), *made], names=[*names, "text", "n_chars"]
                )

    return rows.mapInArrow(run, schema)


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name

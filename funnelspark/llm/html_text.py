"""Main text of web pages by wrapper induction.

Pages of one host (hot hosts in slices of about ``SLICE_PAGES`` pages) are
parsed, and each tree is aligned with that of a reference page of the slice by
simple tree matching.  A reference node whose whole text, with that of the
elements in it, is the same in nearly all aligned pages is template; nodes with
other text, and page parts without a counterpart, are varying slots.  The main slot is found by following the
varying text from the root to the container that holds nearly all of it.  A
page's text is that of the node aligned with the main slot, without the nodes
that are aligned with template and have its text (an inline element among text
stays or goes with the element around it), and without the parts that a page marks as menus, headers, footers,
sidebars, notices, adverts, forms, comments and the like; those marks (element
names, roles, and classes or ids that are such a word, perhaps with one of layout
as in ``cookie-box``; not ids of headings) also keep varying adverts from becoming
content.

Where alignment says nothing (a single page, all pages equal, no counterpart),
the page's article or main element is taken, or else the container that holds
most of its text.

Defined cases: null and empty pages and pages without main text give an empty
text; a null url is a host of its own; repeated pages give one row each; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.html_tree import BLOCK, RAW_TEXT, Matcher, Node, parse

SLICE_PAGES = 400
#: Hosts that are split may be broadcast up to this many (some 50 bytes each).
MAX_BROADCAST_HOSTS = 50_000
#: A node is template if this share of the aligned pages has the same text.
TEMPLATE_SHARE = 0.9
MIN_TEMPLATE_PAGES = 5
#: The main slot holds at least this share of the varying text.
MAIN_SHARE = 0.8

_SKIPPED = RAW_TEXT | frozenset(
    "head nav header footer aside form button select input menu dialog object embed audio video "
    "canvas map label".split())
_SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                           "menu menubar alertdialog".split())
_SKIPPED_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense banner banners sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices comment comments "
    "commentlist disqus reply replies respond menu menus nav navbar navigation breadcrumb "
    "breadcrumbs sidebar sidebars aside widget widgets footer header masthead topbar share sharing "
    "sharebar social related recommended newsletter subscribe signup login popup modal overlay "
    "pagination pager skip hidden".split())
#: Words of layout that may stand after a skipped word in a class or id, and before it in a class.
_LAYOUT_AFTER = frozenset(
    "box boxes bar block area wrap wrapper container list item items inner outer link links button buttons "
    "icon icons panel unit slot row column form post posts zone holder region module left right top "
    "bottom desktop mobile toggle".split())
_LAYOUT_BEFORE = frozenset(
    "site page main post entry article top bottom left right primary secondary global wp".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINERS = frozenset("#page html body div main article section center table tbody tr td".split())
_NEVER_SKIPPED = frozenset("#page html body main article".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLASS_WORDS = re.compile(r"[a-z]+")


def skipped(node: Node) -> bool:
    """Whether a page marks the element as something else than article text."""
    if node.tag in _SKIPPED:
        return True
    if not node.attributes or node.tag in _NEVER_SKIPPED:
        return False
    if (node.attribute("role") or "").lower() in _SKIPPED_ROLES:
        return True
    if node.attribute("hidden") is not None or (node.attribute("aria-hidden") or "").lower() == "true" \
            or _HIDDEN.search(node.attribute("style") or ""):
        return True
    name = "" if node.tag in _HEADINGS else node.attribute("id") or ""
    return _marks(name) or any(_marks(c, _LAYOUT_BEFORE) for c in (node.attribute("class") or "").split())


def _marks(name: str, before: frozenset[str] = frozenset()) -> bool:
    """Whether a class or id consists of skipped words, but for words of layout around them;
    other words make it the name of a section (``social-impact``)."""
    words = _CLASS_WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
    while words and words[-1] in _LAYOUT_AFTER:
        words.pop()
    first = 0
    while first < len(words) and words[first] in before:
        first += 1
    return first < len(words) and all(w in _SKIPPED_WORDS for w in words[first:])


def is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or (node.attribute("role") or "").lower() in ("main", "article") \
        or node.attribute("itemprop") == "articleBody"


def text_of(node: Node, template: frozenset[int] = frozenset()) -> str:
    """Text under a node in page order: block elements part words, inline ones don't."""
    parts: list[str] = []
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x is node or not (skipped(x) or id(x) in template):
            if x.tag in BLOCK:
                parts.append(" ")
                todo.append(" ")
            todo.extend(reversed(x.items))
    return " ".join("".join(parts).split())


def visible(root: Node) -> list[Node]:
    """Elements outside skipped ones, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children()) if not skipped(c))
    return out


def _in_link(node: Node) -> bool:
    while node is not None:
        if node.tag == "a":
            return True
        node = node.parent
    return False


def descend(root: Node, mass: dict[int, float]) -> Node:
    """From the root to the container that still holds nearly all of the mass."""
    at, total = root, mass.get(id(root), 0.0)
    while not is_article(at):
        inner = max((c for c in at.children() if c.tag in _CONTAINERS and not skipped(c)),
                    key=lambda c: mass.get(id(c), 0.0), default=None)
        if inner is None or mass.get(id(inner), 0.0) < MAIN_SHARE * total:
            break
        at = inner
    return at


def subtree_mass(nodes: list[Node], own: dict[int, float]) -> dict[int, float]:
    mass = defaultdict(float)
    for node in reversed(nodes):
        mass[id(node)] += own.get(id(node), 0.0)
        if node.parent is not None:
            mass[id(node.parent)] += mass[id(node)]
    return mass


def main_by_itself(root: Node) -> Node:
    """Main node of a page without help of others."""
    nodes = visible(root)
    articles = [n for n in nodes if is_article(n)]
    if articles:
        return max(articles, key=lambda n: (len(text_of(n)), -n.depth))
    own = {id(n): float(len(n.own_text())) for n in nodes if not _in_link(n)}
    return descend(root, subtree_mass(nodes, own))


class Wrapper:
    """What the pages of a slice have in common, in terms of a reference tree."""

    def __init__(self, trees: list[Node]):
        order = sorted(range(len(trees)), key=lambda i: (sum(1 for _ in trees[i].walk()), i))
        self.reference = trees[order[len(order) // 2]]
        matcher = Matcher(self.reference)
        self.maps = [matcher.match(t) for t in trees]
        varying: dict[int, float] = defaultdict(float)
        texts = {id(n): n.own_text() for n in self.reference.walk()}
        for tree, pairs in zip(trees, self.maps):
            for node in visible(tree):
                pair = pairs.get(id(node))
                text = node.own_text()
                if pair is not None and text == texts[id(pair[0])]:
                    continue
                if text and not _in_link(node):
                    while pair is None:
                        node = node.parent
                        pair = pairs.get(id(node))
                    varying[id(pair[0])] += len(text)
        nodes = visible(self.reference)
        self.main = descend(self.reference, subtree_mass(nodes, varying)) if sum(varying.values()) else None
        #: Text of each template node; an aligned page node with other text is kept.
        self.template = self._template(trees) if self._varies() else {}

    def _template(self, trees: list[Node]) -> dict[int, str]:
        """Nodes below the main slot whose whole text is the same in nearly all aligned pages."""
        inside = {id(n) for n in visible(self.main) if n is not self.main}
        found: dict[int, Counter] = defaultdict(Counter)
        for tree, pairs in zip(trees, self.maps):
            for node in visible(tree):
                pair = pairs.get(id(node))
                if pair is not None and id(pair[0]) in inside:
                    found[id(pair[0])][text_of(node)] += 1
        template = {}
        for i, counts in found.items():
            text, same = counts.most_common(1)[0]
            met = counts.total()
            if text and met >= max(MIN_TEMPLATE_PAGES, TEMPLATE_SHARE * len(trees)) \
                    and same >= TEMPLATE_SHARE * met:
                template[i] = text
        return template

    def _varies(self) -> bool:
        """Whether most pages differ from the reference inside the main slot; if they
        don't, they are copies and say nothing about the template."""
        mains = {text_of(b) for pairs in self.maps for a, b in pairs.values() if a is self.main}
        return self.main is not None and len(mains) * 2 > len(self.maps)

    def text(self, tree: Node, pairs: dict[int, tuple[Node, Node]]) -> str:
        main = next((b for a, b in pairs.values() if a is self.main), None) if self.main else None
        if main is None or not text_of(main):
            return text_of(main_by_itself(tree))
        template = frozenset(i for i, (a, b) in pairs.items()
                             if id(a) in self.template and text_of(b) == self.template[id(a)]
                             and (b.tag in BLOCK or not b.parent.own_text()))
        inner = [n for n in visible(main) if n is not main and is_article(n)]
        if inner and not is_article(main):
            main = max(inner, key=lambda n: len(text_of(n)))
        return text_of(main, template)


def main_texts(pages: list[str | None]) -> list[str]:
    """Main texts of the pages of one slice."""
    trees = [parse(p or "") for p in pages]
    if len(trees) < 2:
        return [text_of(main_by_itself(t)) for t in trees]
    wrapper = Wrapper(trees)
    return [wrapper.text(t, m) for t, m in zip(trees, wrapper.maps)]


def host(url):
    """Host of a url column, lower case (the url itself if it has none)."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    return F.coalesce(F.when(found == "", url).otherwise(found), F.lit(""))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page row: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).withColumn("host", host(F.col("url")))
    large = rows.groupBy("host").count().where(F.col("count") > SLICE_PAGES) \
        .select("host", F.ceil(F.col("count") / SLICE_PAGES).alias("slices"))
    if large.count() <= MAX_BROADCAST_HOSTS:
        large = F.broadcast(large)
    rows = rows.join(large, "host", "left").withColumn("slice", F.expr(
        "coalesce(pmod(xxhash64(page_id, url, html), slices), 0)")).drop("slices")
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = rows.schema["page_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(group: pa.Table) -> pa.Table:
        texts = main_texts(group.column("html").to_pylist())
        return pa.table({"page_id": group.column("page_id").cast(arrow_id),
                         "url": group.column("url"), "text": pa.array(texts, pa.string()),
                         "n_chars": pa.array([len(t) for t in texts], pa.int64())})
    return rows.groupBy("host", "slice").applyInArrow(
        run, f"page_id {id_type.simpleString()}, url string, text string, n_chars long")

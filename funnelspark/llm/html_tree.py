"""A tolerant HTML tree and the simple tree matching of two of them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import isqrt

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style noscript template textarea title iframe svg xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Open elements that the start of an element closes.
_ENDS_P = BLOCK - frozenset("br body html head option li dd dt tr td th tbody thead tfoot".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
           "tbody": ("thead", "tbody", "tr"), "tfoot": ("tbody", "tr"), "body": ("head",)}
#: Elements that an implied end doesn't reach beyond.
_SCOPE = frozenset("html body table ul ol dl select article section main div td th".split())
#: Deeper elements become children of the element at this depth (no text is lost).
MAX_DEPTH = 120
#: So many weights are remembered at a time; more are computed anew.
MAX_WEIGHTS = 500_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=\"'/>]+)")


class Node:
    """An element; ``items`` holds child nodes and texts in page order."""
    __slots__ = ("tag", "attributes", "items", "parent", "depth", "number")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.items: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0
        self.number = -1

    def children(self) -> list[Node]:
        return [x for x in self.items if not isinstance(x, str)]

    def attribute(self, name: str) -> str | None:
        for m in _ATTRIBUTE.finditer(self.attributes):
            if (m[1] or m[5]).lower() == name:
                return next((v for v in m.group(2, 3, 4) if v is not None), "")
        return None

    def own_text(self) -> str:
        return " ".join(" ".join(x for x in self.items if isinstance(x, str)).split())

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.children()))


def parse(page: str) -> Node:
    """The tree of a page; unclosed, stray and misnested tags are accepted."""
    root = Node("#page")
    at, position = root, 0
    match = _TOKEN.match
    while position < len(page):
        start = page.find("<", position)
        if start < 0:
            start = len(page)
        if start > position:
            at.items.append(html.unescape(page[position:start]))
        if start == len(page):
            break
        m = match(page, start)
        if m is None:  # a "<" that starts no tag is text
            at.items.append("<")
            position = start + 1
            continue
        position = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            at = _close(at, tag)
            continue
        at = _implied_ends(at, tag)
        node = Node(tag, m[3], at)
        at.items.append(node)
        if tag in RAW_TEXT and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, position)
            position = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/") and node.depth < MAX_DEPTH:
            at = node
    return root


def _close(at: Node, tag: str) -> Node:
    node = at
    while node is not None and node.tag != tag:
        node = node.parent
    return at if node is None else node.parent


def _implied_ends(at: Node, tag: str) -> Node:
    if tag in _ENDS_P:
        node = at
        while node is not None and node.tag != "p" and node.tag not in _SCOPE:
            node = node.parent
        if node is not None and node.tag == "p":
            at = node.parent
    ends = _CLOSES.get(tag)
    if ends:
        node, found = at, None
        while node is not None and (node.tag not in _SCOPE or node.tag in ends):
            if node.tag in ends:
                found = node
            node = node.parent
        if found is not None:
            at = found.parent
    return at


# ------------------------------------------------------------ tree matching
def match_trees(a: Node, b: Node) -> dict[int, tuple[Node, Node]]:
    """Simple tree matching: a maximal mapping that keeps order, depth and
    tags; ``id(node of b)`` -> (node of a, node of b)."""
    return Matcher(a).match(b)


class Matcher:
    """Matches trees with one reference tree.

    Elements with equal tags all the way down share a shape, and weights are
    those of pairs of shapes.  Two child lists of any length are paired by the
    whole dynamic programme; of its table every k-th row is kept (k about the
    root of their number) and the rows between are computed again on the way
    back.
    """

    def __init__(self, reference: Node):
        self.reference = reference
        self.numbers: dict[tuple[str, tuple[int, ...]], int] = {}
        #: Tag, shapes of the children and number of elements of each shape.
        self.shapes: list[tuple[str, tuple[int, ...], int]] = []
        self.weights: dict[tuple[int, int], int] = {}
        self.of_reference = self._shapes_of(reference)

    def match(self, tree: Node) -> dict[int, tuple[Node, Node]]:
        of_tree = self._shapes_of(tree)
        out: dict[int, tuple[Node, Node]] = {}
        todo = [(self.reference, tree)] if self.reference.tag == tree.tag else []
        while todo:
            x, y = todo.pop()
            out[id(y)] = (x, y)
            (a, xs), (b, ys) = self.of_reference[id(x)], of_tree[id(y)]
            if a == b:
                todo.extend(zip(xs, ys))
            elif xs and ys:
                todo.extend((xs[i], ys[j]) for i, j in self._pairs(self.shapes[a][1], self.shapes[b][1]))
        return out

    def _shapes_of(self, root: Node) -> dict[int, tuple[int, list[Node]]]:
        """Shape and children of each element."""
        out: dict[int, tuple[int, list[Node]]] = {}
        for node in reversed(list(root.walk())):
            kids = node.children()
            key = node.tag, tuple(out[id(k)][0] for k in kids)
            number = self.numbers.get(key)
            if number is None:
                number = self.numbers[key] = len(self.shapes)
                self.shapes.append((*key, 1 + sum(self.shapes[k][2] for k in key[1])))
            out[id(node)] = number, kids
        return out

    def _weight(self, a: int, b: int) -> int:
        """Most pairs that elements of two shapes can have."""
        (x, xs, size), (y, ys, _) = self.shapes[a], self.shapes[b]
        if x != y:
            return 0
        if a == b:
            return size
        if not xs or not ys:
            return 1
        got = self.weights.get((a, b))
        if got is None:
            first, last = self._ends(xs, ys)
            mx, my = xs[first:len(xs) - last], ys[first:len(ys) - last]
            got = 1 + first + last
            if mx and my:
                row, weights_of = np.zeros(len(my) + 1, np.int64), self._rows(mx, my)
                for x in mx:
                    row = _next_row(row, weights_of(x))
                got += int(row[-1])
            if len(self.weights) >= MAX_WEIGHTS:
                self.weights.clear()
            self.weights[a, b] = got
        return got

    def _ends(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> tuple[int, int]:
        """How many equal leaf tags both lists begin and end with; they always belong to a
        best pairing."""
        most, first, last = min(len(xs), len(ys)), 0, 0
        while first < most and xs[first] == ys[first] and not self.shapes[xs[first]][1]:
            first += 1
        while last < most - first and xs[-1 - last] == ys[-1 - last] and not self.shapes[xs[-1 - last]][1]:
            last += 1
        return first, last

    def _rows(self, xs: tuple[int, ...], ys: tuple[int, ...]):
        """Function from a shape of ``xs`` to its weights with all of ``ys``."""
        distinct = list(dict.fromkeys(ys))
        place = {y: j for j, y in enumerate(distinct)}
        at = np.fromiter((place[y] for y in ys), np.int64, len(ys))
        known: dict[int, np.ndarray] = {}

        def weights_of(x):
            got = known.get(x)
            if got is None:
                if len(known) * len(distinct) >= MAX_WEIGHTS:
                    known.clear()
                got = known[x] = np.fromiter((self._weight(x, y) for y in distinct), np.int64,
                                             len(distinct))
            return got[at]
        return weights_of

    def _pairs(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> list[tuple[int, int]]:
        """Places of the best order-keeping pairing of two child lists."""
        first, last = self._ends(xs, ys)
        out = [(i, i) for i in range(first)] + [(len(xs) - i, len(ys) - i) for i in range(1, last + 1)]
        mx, my = xs[first:len(xs) - last], ys[first:len(ys) - last]
        if not mx or not my:
            return out
        weights_of, step = self._rows(mx, my), isqrt(len(mx)) + 1
        row, kept = np.zeros(len(my) + 1, np.int64), []
        for i, x in enumerate(mx):
            if i % step == 0:
                kept.append(row)
            row = _next_row(row, weights_of(x))
        i, j = len(mx), len(my)
        while i and j:
            start = (i - 1) // step * step
            table, weights = [kept.pop()], []
            for x in mx[start:i]:
                weights.append(weights_of(x))
                table.append(_next_row(table[-1], weights[-1]))
            while i > start and j:
                above, here = table[i - 1 - start], table[i - start][j]
                w = weights[i - 1 - start][j - 1]
                if w and here == above[j - 1] + w:
                    out.append((first + i - 1, first + j - 1))
                    i, j = i - 1, j - 1
                elif here == above[j]:
                    i -= 1
                else:
                    j -= 1
        return out


def _next_row(above: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Row of the dynamic programme from the one above it."""
    row = above.copy()
    np.maximum(above[1:], above[:-1] + weights, out=row[1:])
    return np.maximum.accumulate(row)

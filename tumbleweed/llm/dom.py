"""Trees of block elements from HTML, and their alignment by simple tree matching.

``parse`` reads tags forgivingly, as browsers do where it matters here: end tags
may be missing, a document may break off anywhere, ``script`` and its like hold raw
text.  Only block elements (and inline ones that are marked as boilerplate) become
nodes; text and links stay in their block, in page order.

A ``Shape`` is a tree of labels in which neighbours of one shape stand once, so
a run of paragraphs is one node however long.  ``align`` pairs the nodes of two
shapes by simple tree matching: equal labels match, and their children are paired
in order so that the number of matched nodes below is largest.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre search section summary table tbody td
    template tfoot th thead tr ul""".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form dialog menu search template noscript button select datalist svg object audio video canvas head".split())
BOILERPLATE_ROLES = frozenset("""navigation banner contentinfo complementary search form alert alertdialog dialog toolbar menu menubar
    tablist status""".split())
# Words of class and id names that mark boilerplate.
BOILERPLATE_WORDS = frozenset("""nav navbar navigation navi menu menubar submenu breadcrumb breadcrumbs sidebar sidenav aside footer masthead
    topbar ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent
    gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended recommendations pagination pager toolbar copyright skip skiplink""".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond discussion replies reply disqus ad ads advert advert advertisement sponsored".split())
#: Words that mark boilerplate only where a name says nothing more than these and PLACE_WORDS.
WEAK_WORDS = frozenset("header head search widget widgets top bottom".split())
PLACE_WORDS = frozenset("site page global main wrapper container bar box area".split())
NEGATIONS = frozenset("no has with without not".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}

#: Elements nested deeper than this belong to the node above them.
DEPTH = 200
#: Pairs of children up to which two lists of children are paired optimally; longer ones are paired greedily, in order.
PAIRS = 100_000

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")
_NAME = re.compile(r"[^a-z_-]")

FREE, SOFT, FIRM = 0, 1, 2  # not boilerplate; boilerplate unless it holds an article; boilerplate


class Node:
    """An element: texts (of links as 1-tuples) and nodes in ``kids``."""

    __slots__ = ("tag", "name", "mark", "main", "inline", "kids", "shape", "slot")

    def __init__(self, tag: str, name: str = "", mark: int = FREE, main: bool = False, inline: bool = False):
        self.tag, self.name, self.mark, self.main, self.inline = tag, name, mark, main, inline
        self.kids: list = []
        self.shape = None
        self.slot = -1

    @property
    def nodes(self) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node)]


def _words_mark(value: str) -> int:
    """What a class or id attribute says."""
    found = FREE
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in NEGATIONS or any(a in NEGATIONS for a in words[:-1]):
            continue
        if not COMMENT_WORDS.isdisjoint(words):
            return FIRM
        if not BOILERPLATE_WORDS.isdisjoint(words) or (not WEAK_WORDS.isdisjoint(words) and WEAK_WORDS.union(PLACE_WORDS).issuperset(words)):
            found = SOFT
    return found


@lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> tuple[str, int, bool]:
    """Name, mark and whether it is the main text by its attributes, of an element."""
    mark = FREE
    if tag in BOILERPLATE_TAGS:
        mark = SOFT if tag in ("form", "header") else FIRM
    found = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower().split()
    main = tag in ("article", "main") or "main" in role or "articlebody" in found.get("itemprop", "").lower().split()
    if not BOILERPLATE_ROLES.isdisjoint(role):
        mark = max(mark, SOFT)
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or "display:none" in style or found.get("aria-hidden", "").lower() == "true":
        mark = FIRM
    if tag not in ("html", "body"):
        mark = max(mark, *(_words_mark(found.get(k, "")) for k in ("class", "id")))
    classes = found.get("class", "").split()
    name = _NAME.sub("", (found.get("id") or (classes[0] if classes else "")).lower())[:24]
    return name, mark, main


def parse(html: str) -> Node:
    """The tree of ``html``; its root is a node named ``#``."""
    root = Node("#")
    stack: list[tuple[str, Node]] = [("#", root)]  # every open element and the node its text goes to
    links = deep = at = 0
    n = len(html)

    def pop_to(index: int) -> None:
        nonlocal links
        if links:
            links -= sum(t == "a" for t, _ in stack[index:])
        del stack[index:]

    def add(text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            stack[-1][1].kids.append((text,) if links else text)

    while at < n:
        i = html.find("<", at)
        while i >= 0 and not (html[i + 1:i + 2].isalpha() or html[i + 1:i + 2] in ("/", "!", "?")):
            i = html.find("<", i + 1)  # not a tag: a character of the text
        if i < 0:
            add(html[at:])
            break
        add(html[at:i])
        m = _TAG.match(html, i)
        if m is None:
            if html.startswith("<!--", i):
                end = html.find("-->", i + 2)
                at = n if end < 0 else end + 3
            elif html[i + 1].isalpha() and html[i + 1].isascii() or html[i + 1] == "/" and html[i + 2:i + 3].isalpha():
                break  # the document ends inside a tag
            elif html[i + 1] in "!?/":
                end = html.find(">", i + 2)
                at = n if end < 0 else end + 1
            else:
                add("<")
                at = i + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if deep and tag not in VOID:
                deep -= 1
                continue
            for k in range(len(stack) - 1, 0, -1):
                open_tag = stack[k][0]
                if open_tag == tag:
                    pop_to(k)
                    break
                if tag not in BLOCK and open_tag in BLOCK:
                    break  # an inline element doesn't end outside its block
            if tag == "br":
                add(" ")
            continue
        attributes = m[3]
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if tag in CLOSES:
            closed, border = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closed:
                    pop_to(k)
                    break
                if stack[k][0] in border:
                    break
        if tag in VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr":
                stack[-1][1].kids.append(Node("hr"))
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
            if end is None:
                break
            close = html.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        if len(stack) > DEPTH:
            deep += 1
            if tag in BLOCK:
                stack[-1][1].kids.append(Node("hr"))
            continue
        name, mark, main = _element(tag, attributes)
        above = stack[-1][1]
        if tag in BLOCK or mark or main:
            node = Node(tag, name, mark, main, inline=tag not in BLOCK)
            above.kids.append(node)
            above = node
        stack.append((tag, above))
        links += tag == "a"
    _settle(root)
    return root


def _settle(root: Node) -> None:
    """Lift soft marks off nodes that hold an article; a header inside an article is no page header."""
    def down(node: Node, inside: bool) -> bool:
        inside = inside or node.main
        holds = node.main or node.tag == "h1"
        for k in node.nodes:
            holds = down(k, inside) | holds
        if node.mark == SOFT and (node.tag == "header" and inside or holds and not (node.tag == "header" and not _holds_main(node))):
            node.mark = FREE
        return holds

    down(root, False)


def _holds_main(node: Node) -> bool:
    return any(k.main or _holds_main(k) for k in node.nodes)


class Shape:
    """A node of a shape: label, children, and the page's nodes that it stands for."""

    __slots__ = ("label", "kids", "members", "text", "size", "slot")

    def __init__(self, label: str, kids: list[Shape], members: list[Node]):
        self.label, self.kids, self.members = label, kids, members
        self.text = label + ("(" + ",".join(k.text for k in kids) + ")" if kids else "")
        self.size = 1 + sum(k.size for k in kids)
        self.slot = -1

    def all(self) -> Iterator[Shape]:
        yield self
        for k in self.kids:
            yield from k.all()


def _label(node: Node) -> str:
    return node.tag + (":" + node.name if node.name else "") + ("!" if node.mark else "*" if node.main else "")


def shape_of(root: Node) -> Shape:
    """The shape of a page; what is marked as boilerplate has no children in it."""
    def text(node: Node) -> str:  # bottom-up: equal texts are equal shapes
        if node.shape is None:
            runs: list[str] = []
            if not node.mark:
                for k in node.nodes:
                    t = text(k)
                    if not runs or runs[-1] != t:
                        runs.append(t)
            label = _label(node)
            node.shape = label + ("(" + ",".join(runs) + ")" if runs else "")
        return node.shape

    def build(members: list[Node]) -> Shape:
        kids: list[list[Node]] = []
        if not members[0].mark:
            for m in members:
                at, last = -1, None
                for k in m.nodes:
                    if k.shape != last:
                        at, last = at + 1, k.shape
                        if at == len(kids):
                            kids.append([])
                    kids[at].append(k)
        return Shape(_label(members[0]), [build(k) for k in kids], members)

    text(root)
    return build([root])


_PART = re.compile(r"[^(),]+|[(),]")


def read_shape(text: str) -> Shape:
    """A shape from its text."""
    levels: list[list[Shape]] = [[]]
    labels: list[str] = []
    label = None
    for part in _PART.findall(text):
        if part == "(":
            labels.append(label)
            levels.append([])
            label = None
        elif part == ",":
            if label is not None:
                levels[-1].append(Shape(label, [], []))
            label = None
        elif part == ")":
            if label is not None:
                levels[-1].append(Shape(label, [], []))
            kids = levels.pop()
            levels[-1].append(Shape(labels.pop(), kids, []))
            label = None
        else:
            label = part
    if label is not None:
        levels[-1].append(Shape(label, [], []))
    return number(levels[0][0])


def number(shape: Shape) -> Shape:
    """``shape`` with its nodes numbered in page order."""
    for i, s in enumerate(shape.all()):
        s.slot = i
    return shape


def align(page: Shape, reference: Shape) -> None:
    """Give the nodes of ``page`` the slots of the nodes of ``reference`` that they match; the others keep -1."""
    known: dict[tuple[int, int], int] = {}

    def matched(a: Shape, b: Shape) -> int:
        if a.label != b.label:
            return 0
        if a.text == b.text:
            return a.size
        key = (id(a), b.slot)
        if key not in known:
            known[key] = 1 + (table(a.kids, b.kids)[-1][-1] if len(a.kids) * len(b.kids) <= PAIRS else sum(matched(x, y) for x, y in in_order(a.kids, b.kids)))
        return known[key]

    def table(a: list[Shape], b: list[Shape]) -> list[list[int]]:
        rows = [[0] * (len(b) + 1)]
        for x in a:
            above, row = rows[-1], [0]
            for j, y in enumerate(b):
                w = matched(x, y)
                row.append(max(above[j + 1], row[j], above[j] + w if w else 0))
            rows.append(row)
        return rows

    def in_order(a: list[Shape], b: list[Shape]) -> list[tuple[Shape, Shape]]:
        out, j = [], 0
        where: dict[str, list[int]] = {}
        for k, y in enumerate(b):
            where.setdefault(y.label, []).append(k)
        for x in a:
            places = where.get(x.label, ())
            k = bisect_left(places, j)
            if k < len(places):
                out.append((x, b[places[k]]))
                j = places[k] + 1
        return out

    def pair(a: Shape, b: Shape) -> None:
        a.slot = b.slot
        if a.text == b.text:
            for x, y in zip(a.kids, b.kids, strict=True):
                pair(x, y)
        elif len(a.kids) * len(b.kids) > PAIRS:
            for x, y in in_order(a.kids, b.kids):
                pair(x, y)
        else:
            rows, i, j = table(a.kids, b.kids), len(a.kids), len(b.kids)
            while i and j:
                w = matched(a.kids[i - 1], b.kids[j - 1])
                if w and rows[i][j] == rows[i - 1][j - 1] + w:
                    pair(a.kids[i - 1], b.kids[j - 1])
                    i, j = i - 1, j - 1
                elif rows[i][j] == rows[i - 1][j]:
                    i -= 1
                else:
                    j -= 1

    if page.label == reference.label:
        pair(page, reference)
    for s in page.all():
        for m in s.members:
            m.slot = s.slot

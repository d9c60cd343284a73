"""Main text of web pages by wrapper induction.

1. *Reference.*  Pages of one host are built alike.  Each page's tree is reduced to its
   shape (``dom.py``); a host's reference is its most frequent shape.
2. *Alignment.*  Every page of the host is aligned with the reference by simple tree
   matching.  Each text block falls into the slot of its nearest matched node;
   (slot, block) is counted over all pages of the host, combined in the task and
   then by a shuffle in which a constant block is one row a task.
3. *Wrapper.*  Blocks that stand in the same slot of ``CONSTANT`` of the host's pages
   are template; slots whose text varies hold content.  The main region is the
   ``article`` or ``main`` element with most varying text, else the deepest node that
   holds ``MASS`` of it.  Regions that say what they are by element, role, class or
   id (menus, notices, adverts, comments, ...) are template whatever varies in them,
   and so are, without an ``article``, lists of links.
4. *Extraction.*  Every page is aligned again and gives the blocks of its main region
   that aren't template, in page order.

A wrapper is bounded by ``REFERENCE_NODES`` and the constant blocks, and it, not the
host's pages, is what travels.  Wrappers are broadcast if all are smaller than
``BROADCAST_BYTES``; else those of hosts with one page in ``HOT_HOSTS`` or more are
(no more than ``HOT_HOSTS`` hosts), and the others are joined by host.

Where a host shows too little to tell template from content (fewer than
``MIN_PAGES`` pages, or constant blocks that outweigh what varies, as copies of one
article do), only marked regions are template.  A page that lacks its host's main
region is judged by its own tree alone.

Defined cases: null and empty html give an empty text; a page without ``://`` in its
url, or without url, belongs to the host of the empty name; a page that breaks off
is read as far as it goes; white space (no-break spaces too) inside a block becomes
one space, a line break element counts as white space; each cell of a table is a
block; repeated rows are each answered and each count; columns other than id, url
and html stay out; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm import dom
from tumbleweed.llm.common import cut, quoted
from tumbleweed.llm.urls import host_and_path

CONSTANT = 0.9
MIN_PAGES = 4
MASS = 0.7
LINKED = 0.6
#: A larger shape is no reference; pages of such a shape are extracted all the same.
REFERENCE_NODES = 4000
BROADCAST_BYTES = 64 << 20
HOT_HOSTS = 1000
#: Rows that a task counts before it hands them on.
COUNT_ROWS = 100_000


def blocks(node: dom.Node, slot: int = -1, into: list | None = None) -> list[tuple[int, str, int]]:
    """``(slot, text, characters in links)`` of the blocks below ``node``, in page order; marked regions are left out."""
    out: list[tuple[int, str, int]] = [] if into is None else into
    run: list = []

    def finish(at: int) -> None:
        if run:
            text = " ".join("".join([r[0] if isinstance(r, tuple) else r for r in run]).split())
            if text:
                out.append((at, text, sum(len(r[0].strip()) for r in run if isinstance(r, tuple))))
            run.clear()

    def walk(n: dom.Node, at: int) -> None:
        at = n.slot if n.slot >= 0 else at
        for k in n.kids:
            if not isinstance(k, dom.Node):
                run.append(k)
            elif k.mark:
                if not k.inline:
                    finish(at)
            elif k.inline:
                walk(k, at)
            else:
                finish(at)
                walk(k, at)
                finish(k.slot if k.slot >= 0 else at)

    walk(node, slot)
    finish(node.slot if node.slot >= 0 else slot)
    return out


def read_page(html: str, reference: dom.Shape) -> dom.Node:
    """The tree of a page with the slots of ``reference``."""
    root = dom.parse(html)
    dom.align(dom.shape_of(root), reference)
    return root


class Wrapper:
    """What a host's pages have in common: reference, main slots, left-out slots and constant blocks."""

    def __init__(self, shape: str, main: list[int], out: list[int], constant: list[tuple[int, str]]):
        self.shape, self.main, self.out, self.constant = shape, set(main), set(out), {tuple(c) for c in constant}
        self.reference = dom.read_shape(shape)

    def text(self) -> str:
        return json.dumps([self.shape, sorted(self.main), sorted(self.out), sorted(self.constant)], ensure_ascii=False)

    @classmethod
    def read(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))

    def extract(self, html: str) -> str:
        root = read_page(html, self.reference)
        found: list[dom.Node] = []
        self._main_nodes(root, found)
        if not found:
            return own_wrapper(root).extract_from(root)
        return self.extract_from(root, found)

    def extract_from(self, root: dom.Node, found: list[dom.Node] | None = None) -> str:
        if found is None:
            found = []
            self._main_nodes(root, found)
        kept: list[str] = []
        for node in found:
            kept += [t for slot, t, _ in blocks(node, node.slot) if slot not in self.out and (slot, t) not in self.constant]
        return "\n".join(kept)

    def _main_nodes(self, node: dom.Node, into: list[dom.Node]) -> None:
        if node.slot in self.main:
            into.append(node)
        else:
            for k in node.nodes:
                if not k.mark:
                    self._main_nodes(k, into)


def _heading(shape: dom.Shape) -> bool:
    return shape.label.partition(":")[0].rstrip("*") == "h1" or any(_heading(k) for k in shape.kids)


def induce(shape: str, n_pages: int, stats: list[tuple[int, str, int, int, int]]) -> Wrapper:
    """The wrapper of a host from ``(slot, block, pages, characters, characters in links)`` over all its pages.

    ``block`` is given for blocks of most pages and empty for the others' sum.
    """
    reference = dom.read_shape(shape)
    order = list(reference.all())
    ends = {s.slot: s.slot + s.size for s in order}
    often = [(slot, block, chars) for slot, block, pages, chars, _ in stats if block and n_pages >= MIN_PAGES and pages >= CONSTANT * n_pages]
    fixed = {(slot, block) for slot, block, _ in often}
    chars, links = [0] * len(order), [0] * len(order)
    for slot, block, _, c, in_links in stats:
        if slot >= 0 and (slot, block) not in fixed:
            chars[slot] += c
            links[slot] += in_links
    below = lambda of, s: sum(of[s.slot:ends[s.slot]])

    def candidates(s: dom.Shape) -> Iterator[dom.Shape]:
        for k in s.kids:
            if not k.label.endswith("!"):
                if k.label.endswith("*"):
                    yield k
                yield from candidates(k)

    marked = [s for s in candidates(reference) if below(chars, s)]
    out: set[int] = set()
    if marked:
        best = max(marked, key=lambda s: (below(chars, s), -s.slot))
        while True:  # an article inside main, unless main has much besides
            inner = [s for s in marked if best.slot < s.slot < ends[best.slot] and below(chars, s) > 0.5 * below(chars, best)]
            if not inner or best.label.startswith("article"):
                break
            best = max(inner, key=lambda s: (below(chars, s), -s.slot))
        parent = next(s for s in order if any(k is best for k in s.kids))
        main = [k for k in parent.kids if k.label == best.label and k in marked]
        if best.label.startswith("article"):  # articles in an article are comments on it
            out |= {slot for m in main for s in candidates(m) if s.label.startswith("article") for slot in range(s.slot, ends[s.slot])}
    else:
        best = reference
        while best.kids:
            free = [k for k in best.kids if not k.label.endswith("!")]
            first = max(free, key=lambda s: (below(chars, s), -s.slot), default=None)
            if first is None or not below(chars, first) or below(chars, first) < MASS * below(chars, best) or first.label.split(":")[0] in ("p", "li", "td", "tr", "tbody"):
                break
            if best.label.split(":")[0] not in ("#", "html", "body") and any(_heading(k) and below(chars, k) for k in free if k is not first):
                break
            best = first
        main = [best]
        for s in order[best.slot + 1:ends[best.slot]]:
            if s.label.split(":")[0] in ("ul", "ol", "dl", "div", "section", "table") and below(links, s) > LINKED * below(chars, s):
                out |= set(range(s.slot, ends[s.slot]))
    inside = {slot for m in main for slot in range(m.slot, ends[m.slot])} - out
    varying = sum(chars[s] for s in inside)
    template = [(slot, block) for slot, block, _ in often if slot in inside]
    if sum(c for slot, _, c in often if slot in inside) >= varying:
        template = []
    return Wrapper(shape, [m.slot for m in main], sorted(out), template)


def own_wrapper(root: dom.Node) -> Wrapper:
    """The wrapper of a page by itself; the page gets its own slots."""
    shape = dom.number(dom.shape_of(root))
    for s in shape.all():
        for m in s.members:
            m.slot = s.slot
    return induce(shape.text, 1, [(slot, "", 1, len(t), in_links) for slot, t, in_links in blocks(root)])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield from zip(*[c.to_pylist() for c in part.columns], strict=True)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def finish() -> pa.RecordBatch:
        keys = list(counts)
        out = pa.RecordBatch.from_arrays([pa.array([h for h, _ in keys], pa.string()), pa.array([s for _, s in keys], pa.string()),
                                          pa.array([counts[k] for k in keys], pa.int64())], names=["host", "shape", "n"])
        counts.clear()
        return out

    for batch in batches:
        for host, html in _rows(batch):
            shape = dom.shape_of(dom.parse(html))
            counts[host, shape.text if shape.size <= REFERENCE_NODES else ""] += 1
            if len(counts) >= COUNT_ROWS // 10:
                yield finish()
    if counts:
        yield finish()


def _block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int, str], list[int]] = {}
    references: dict[str, dom.Shape] = {}

    def finish() -> pa.RecordBatch:
        keys, values = list(found), list(found.values())
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()),
             *[pa.array([v[i] for v in values], pa.int64()) for i in range(3)]], names=["host", "slot", "block", "pages", "chars", "links"])
        found.clear()
        return out

    for batch in batches:
        for host, html, shape in _rows(batch):
            if shape not in references:
                if len(references) >= 1000:
                    references.clear()
                references[shape] = dom.read_shape(shape)
            seen = set()
            for slot, text, links in blocks(read_page(html, references[shape])):
                key = (host, slot, text)
                v = found.setdefault(key, [0, 0, 0])
                v[0] += key not in seen
                v[1] += len(text)
                v[2] += links
                seen.add(key)
            if len(found) >= COUNT_ROWS:
                yield finish()
    if found:
        yield finish()


def _induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for host, shape, n_pages, stats in _rows(batch):
            w = induce(shape, n_pages, [(s["slot"], s["block"], s["pages"], s["chars"], s["links"]) for s in stats or []])
            yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([w.text()], pa.string()), pa.array([n_pages], pa.int64())],
                                             names=["host", "wrapper", "n_pages"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, Wrapper] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = []
            for html, wrapper in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                if wrapper is not None and wrapper not in wrappers:
                    if len(wrappers) >= 1000:
                        wrappers.clear()
                    wrappers[wrapper] = Wrapper.read(wrapper)
                if not html:
                    texts.append("")
                elif wrapper is None:
                    root = dom.parse(html)
                    texts.append(own_wrapper(root).extract_from(root))
                else:
                    texts.append(wrappers[wrapper].extract(html))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def with_host(pages: DataFrame, per_host: DataFrame, column: str, n_pages: int, broadcast_bytes: int = BROADCAST_BYTES,
              hot_hosts: int = HOT_HOSTS) -> DataFrame:
    """``pages`` with ``column`` of their host (null without one); a host with a large share of the pages is never a key of a shuffle."""
    size = per_host.agg(F.coalesce(F.sum(F.length(column) + F.length("host")), F.lit(0))).first()[0]
    few = per_host.select("host", column)
    if size <= broadcast_bytes:
        return pages.join(F.broadcast(few), "host", "left")
    least = max(2, -(-n_pages // hot_hosts))
    hot = F.broadcast(per_host.where(F.col("n_pages") >= least).select("host", column))
    return (pages.join(hot, "host").unionByName(
        pages.join(hot, "host", "left_anti").join(few.hint("merge"), "host", "left")))


def induce_wrappers(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, hot_hosts: int = HOT_HOSTS) -> tuple[DataFrame, int]:
    """``(host, wrapper, n_pages)`` of every host that has a reference, and the number of pages, of ``(host, html)`` rows."""
    shapes = cut(pages.select("host", "html").mapInArrow(_shapes, "host string, shape string, n long").groupBy("host", "shape").agg(F.sum("n").alias("n")))
    total = shapes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    best = F.max(F.when(F.col("shape") != "", F.struct("n", (-F.length("shape")).alias("short"), "shape")))
    references = cut(shapes.groupBy("host").agg(best.alias("best"), F.sum("n").alias("n_pages"))
                     .where("best is not null").select("host", "best.shape", "n_pages"))
    placed = with_host(pages.select("host", "html"), references, "shape", total, broadcast_bytes, hot_hosts).where("shape is not null")
    counted = (placed.select("host", "html", "shape")
               .mapInArrow(_block_counts, "host string, slot int, block string, pages long, chars long, links long")
               .groupBy("host", "slot", "block").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links")))
    # only blocks of most pages keep their text: 1 / CONSTANT of them a slot and page place at most
    known = references.select("host", "n_pages")
    known = F.broadcast(known) if references.count() <= 1_000_000 else known
    often = F.when((F.col("n_pages") >= MIN_PAGES) & (F.col("pages") >= F.lit(CONSTANT) * F.col("n_pages")), F.col("block")).otherwise(F.lit(""))
    slots = (counted.join(known, "host").withColumn("block", often).groupBy("host", "slot", "block")
             .agg(*[F.sum(c).alias(c) for c in ("pages", "chars", "links")])
             .groupBy("host").agg(F.collect_list(F.struct("slot", "block", "pages", "chars", "links")).alias("stats")))
    wrappers = references.join(slots, "host", "left").select("host", "shape", "n_pages", "stats")
    return cut(wrappers.mapInArrow(_induced, "host string, wrapper string, n_pages long")), total


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", broadcast_bytes: int = BROADCAST_BYTES,
            hot_hosts: int = HOT_HOSTS) -> DataFrame:
    """``(page_id, url, text)`` of every row."""
    source = pages.select(quoted(page_id).alias("page_id"), quoted(url).cast("string").alias("url"), quoted(html).cast("string").alias("html"))
    source = source.withColumn("host", host_and_path(F.col("url"))[0])
    wrappers, total = induce_wrappers(source.where("html <> ''"), broadcast_bytes, hot_hosts)
    placed = with_host(source, wrappers, "wrapper", total, broadcast_bytes, hot_hosts).select("page_id", "url", "html", "wrapper")
    kind = source.schema["page_id"].dataType.simpleString()
    return placed.mapInArrow(_extracted, f"page_id {kind}, url string, text string")

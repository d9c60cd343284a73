"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, with score intervals.

*Terms* are the maximal runs of ASCII letters and digits and of all characters
from U+0080 on; A-Z count as a-z.  A posting's impact is
``w * ((1000000000*tf) div (1000*tf + 8*m))`` with the integers of ``weight`` and
``length_factor``; a document's score for an item is the sum of its impacts over
the item's terms, once each.

1. *Index.*  One pass over the texts gives each document's number of terms and its
   frequencies of query terms; it is written to the shared folder.  N, L and
   the document frequencies are counted over all documents.
2. *NRA.*  Documents are dealt to blocks of about ``BLOCK_POSTINGS`` postings, each
   with its lists sorted by impact.  For an item, all its lists are read side
   by side, down to an impact level that falls from round to round.  A document's
   score lies between the impacts read so far and that sum plus the next impact of
   each list where it wasn't met.  Reading stops when no unread document can reach
   the k-th lower bound, and every document that can has a closed interval:
   membership, ties and scores are then final.  The k best of a task's earlier
   blocks are the floor of its later ones.
3. The blocks' results meet in a window, limited in each task before its shuffle.

The query terms are the only broadcast: items are worked on in groups of about
``VOCABULARY`` terms, however many items there are.

Defined cases: null and empty texts have no terms and are never found (nor counted
in N); an item without terms, or whose terms no document holds, has no rows; items
without id are left out, rows of one item id make one item; repeated documents are
ranked once each, a document without id never; equal scores go by ascending id; an
empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tumbleweed.llm.common import quoted
from tumbleweed.session import scratch_path

VOCABULARY = 200_000
BLOCK_POSTINGS = 2_000_000
PIECE = 1 << 20
#: Each round of reads goes down to this share of the highest impact that is left.
LEVEL = 4
#: Groups of an item's candidates before the last window.
SLOTS = 32

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in parts that end between terms, so that a long text's terms are never all held."""
    at = 0
    while len(text) - at > size:
        m = _NO_TERM.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:] if at else text


def term_counts(text: bytes) -> Counter:
    counts: Counter = Counter()
    for part in pieces(text):
        counts.update(_TERM.findall(part.lower()))  # of bytes, lower() changes A-Z alone
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """``100 - 90 + ((90*n*N) div L)``; in whole numbers of any size where 64 bits might not do."""
    if len(n) and int(n.max()) * 90 * n_docs >= 1 << 62:
        return np.array([10 + 90 * int(x) * n_docs // total for x in n], dtype=np.int64)
    return 10 + (90 * n.astype(np.int64) * n_docs) // max(total, 1)


def impacts(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(document, score)`` of all documents that may be among the ``k`` best, in any order; scores are final.

    ``lists`` hold distinct document numbers below ``n_docs`` and their impacts, highest
    first.  Documents with a score below ``floor``, or of 0, are left out.
    """
    lists = [(d, x) for d, x in lists if len(x) and x[0] > 0]
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = np.zeros(n_docs, dtype=np.int64)
    met = np.zeros((len(lists), n_docs), dtype=bool)
    at = [0] * len(lists)
    bound = np.array([x[0] for _, x in lists], dtype=np.int64)  # the most that a list can still add
    if bound.sum() < floor:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    open_: np.ndarray | None = None  # the documents that can be among the best, once they are few
    while True:
        level = int(bound.max()) // LEVEL
        for t, (docs, x) in enumerate(lists):
            if bound[t] > level:
                end = len(x) - int(np.searchsorted(x[::-1], level, side="right"))
                read = docs[at[t]:end]
                if open_ is None:
                    low[read] += x[at[t]:end]
                    met[t, read] = True
                else:
                    on = open_[read]
                    low[read[on]] += x[at[t]:end][on]
                    met[t, read[on]] = True
                at[t] = end
                bound[t] = max(x[end], 0) if end < len(x) else 0
        rest = int(bound.sum())
        kth = max(floor, 1)
        if n_docs >= k:
            kth = max(kth, int(np.partition(low, n_docs - k)[n_docs - k]))
        if open_ is None and rest >= kth:
            continue  # a document not met yet could still be among the best
        able = np.flatnonzero(low + rest >= kth if open_ is None else open_ & (low + rest >= kth))
        slack = bound @ ~met[:, able] if rest else np.zeros(len(able), dtype=np.int64)
        able, slack = able[low[able] + slack >= kth], slack[low[able] + slack >= kth]
        if not slack.any():  # every interval that reaches the k-th lower bound is closed
            return able, low[able]
        if len(able) * 4 < n_docs:
            open_ = np.zeros(n_docs, dtype=bool)
            open_[able] = True


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]

    def floor(self, item: int) -> int:
        rows = self.rows[item]
        return -rows[-1][0] if len(rows) == self.k else 0

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        if len(docs):
            keep = np.lexsort((docs, -scores))[:self.k]
            self.rows[item] = sorted([*self.rows[item], *zip((-scores[keep]).tolist(), docs[keep].tolist(), strict=True)])[:self.k]


def _search_block(batches: list[pa.RecordBatch], items: list[list[int]], w: np.ndarray, n_docs: int, total: int, best: Best) -> None:
    t = pa.Table.from_batches(batches).combine_chunks()
    ids, n = t.column("doc_id").to_numpy(), t.column("n").to_numpy()
    lists = t.column("terms").chunk(0)
    term, tf = lists.flatten().to_numpy().astype(np.int64), t.column("tfs").chunk(0).flatten().to_numpy().astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    doc = np.repeat(np.arange(len(ids)), sizes)
    x = impacts(w[term], tf, length_factor(n, n_docs, total)[doc])
    order = np.lexsort((-x, term))
    doc, x, term = doc[order], x[order], term[order]
    edges = np.searchsorted(term, np.arange(len(w) + 1))
    for i, terms in enumerate(items):
        found, scores = nra([(doc[edges[a]:edges[a + 1]], x[edges[a]:edges[a + 1]]) for a in terms], len(ids), best.k, best.floor(i))
        best.add(i, ids[found], scores)


def _search(shared, k: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, items, w, n_docs, total = shared.value
        best, held, postings = Best(len(items), k), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                postings += len(part.column("terms").flatten())
                if postings >= block:
                    _search_block(held, items, w, n_docs, total, best)
                    held, postings = [], 0
        if held:
            _search_block(held, items, w, n_docs, total, best)
        flat = [(names[i], d, -s) for i, rows in enumerate(best.rows) for s, d in rows]
        if flat:
            item, doc, score = zip(*flat, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                             names=["item_id", "doc_id", "score"])
    return run


def _postings(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                n, terms, tfs, ends = [], [], [], [0]
                for text in part.column("text").cast(pa.large_binary()):
                    counts = term_counts(text.as_py() or b"")
                    n.append(counts.total())
                    known = [(number[c], f) for c, f in counts.items() if c in number]
                    terms += [a for a, _ in known]
                    tfs += [f for _, f in known]
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(term_counts(t.as_py() or b"")) for t in batch.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", vocabulary: int = VOCABULARY, block: int = BLOCK_POSTINGS) -> DataFrame:
    """``(item_id, rank, doc_id, score)`` of each item's ``k`` best documents."""
    spark = docs.sparkSession
    source = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    asked = (items.select(quoted(item_id).cast("long").alias("item_id"), quoted(item_text).cast("string").alias("text"))
             .where("item_id is not null").mapInArrow(_item_terms, "item_id long, terms array<binary>"))
    path = scratch_path(spark, "query-terms")
    asked.write.parquet(path)
    asked = spark.read.parquet(path)
    size = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    groups = max(1, math.ceil(size / vocabulary))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    n_docs = total = 0
    for g in range(groups):
        terms_of: dict[int, set[bytes]] = {}
        for r in asked.where(F.expr(f"pmod(xxhash64(item_id), {groups}) = {g}")).toLocalIterator():
            terms_of.setdefault(r["item_id"], set()).update(bytes(x) for x in r["terms"])
        names = sorted(i for i, t in terms_of.items() if t)
        number = {t: a for a, t in enumerate(sorted(set().union(*terms_of.values())))}
        if not names:
            continue
        path = scratch_path(spark, "postings")
        source.mapInArrow(_postings(spark.sparkContext.broadcast(number)), "doc_id long, n long, terms array<int>, tfs array<int>").write.parquet(path)
        index = spark.read.parquet(path)
        if not n_docs:
            n_docs, total = index.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r["term"]: r["n"] for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
        w = np.array([weight(n_docs, df.get(a, 0)) for a in range(len(number))], dtype=np.int64)
        shared = spark.sparkContext.broadcast((names, [[number[t] for t in sorted(terms_of[i])] for i in names], w, n_docs, total))
        found = found.unionByName(index.where("doc_id is not null").mapInArrow(_search(shared, k, block), "item_id long, doc_id long, score long"))
    order = [F.desc("score"), F.asc("doc_id")]
    slot = F.expr(f"pmod(xxhash64(doc_id), {SLOTS})")
    first = found.withColumn("n", F.row_number().over(Window.partitionBy("item_id", slot).orderBy(*order))).where(F.col("n") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return last.select("item_id", "rank", "doc_id", "score")

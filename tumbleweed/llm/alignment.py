"""Cross-tokenizer alignment: groups of tokens by pointer jumping, and id pairs counted corpus-wide.

Two tokenizers cut the same bytes (a space and the text) differently: A is a
byte-level BPE vocabulary (JSON), B a SentencePiece model, which puts the space
there itself.  Tokens of A and B whose byte ranges overlap belong together;
the components of that overlap are the *groups*.

*Pointer jumping.*  Every token points to its farthest-right overlapping token of
the other tokenizer; of two tokens that end together B's is terminal and points
to itself.  ``succ = succ[succ]`` doubles all pointers of a batch at once until
none changes, after the logarithm of the longest chain; then every token points to
the last token of its group, which labels it.  The texts of a batch lie one behind
the other: a text's end is a common end, so no group crosses it.

*Links* are the pairs of an A and a B token that end together: each group's last
two.  ``link_counts`` adds up each id pair over the corpus (combined before the
shuffle); a pair's share of all links decides how a row finds its count:
at most ``HOT_PAIRS`` pairs have one link in ``HOT_PAIRS`` or more, these are
broadcast whatever the corpus; all others, none of which is a hot key, are joined.

A long text is cut before a space between two ASCII letters, where neither
tokenizer has a token across (checked when the vocabularies are read), so memory
follows ``CHUNK`` and the number of tokens.

Defined cases: null and empty texts, texts that are not valid UTF-8, and texts
whose joined token bytes are not the space and the text (such as literal U+2581)
have no tokens and no groups; strings of special tokens are plain text; repeated
rows are aligned, and counted, once each; null ids stay; columns other than the
id and the text stay out; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm.common import cut, quoted

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text worked on at a time, and the length from which a text is cut.
CHUNK = 1 << 20
#: Pairs with one link in so many are broadcast; there can be no more of them.
HOT_PAIRS = 200_000

#: How a byte-level vocabulary splits a text before merging: a fixed value of its format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A.  Its merges must be in the order of their ids, as ranks need it."""

    def __init__(self, data: bytes):
        import tiktoken

        spec = json.loads(data)
        special = {t["id"] for t in spec["added_tokens"]}
        letter = _byte_letters()
        words = {w: i for w, i in spec["model"]["vocab"].items() if i not in special}
        ranks = {bytes(letter[c] for c in w): i for w, i in words.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [words["".join(m)] for m in merges]
        if made != sorted(set(made)) or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a byte-level vocabulary with merges in the order of their ids")
        self.size = max(spec["model"]["vocab"].values()) + 1
        self.lengths = np.zeros(self.size, dtype=np.int64)
        for b, i in ranks.items():
            self.lengths[i] = len(b)
        self.model = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.model.encode_ordinary(text)

    def joined(self, ids: list[int]) -> bytes:
        return self.model.decode_bytes(ids)


class Pieces:
    """Tokenizer B.  No piece may hold a space after another character."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.size = self.model.get_piece_size()
        self.bytes_of: list[bytes] = []
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses a word border")
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def _tokenizers(a: bytes, b: bytes) -> tuple[ByteLevel, Pieces, np.ndarray]:
    first, second = ByteLevel(a), Pieces(b)
    numbers = [str(i) for i in range(max(first.size, second.size))]
    written = np.array([n + mark for mark in ",|;" for n in numbers], dtype=object)
    return first, second, written


def pieces_of(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """``text`` in parts that tokenize by themselves; the space at each cut belongs to the next part, which leaves it out."""
    at = 0
    while len(text) - at > chunk:
        m = _CUT.search(text, at + chunk)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:]


def tokens(text: str, a: ByteLevel, b: Pieces, chunk: int = CHUNK) -> tuple[list[int], list[int]]:
    """Ids of A and of B over a space and ``text``; none where the bytes don't come back."""
    ids_a: list[int] = []
    ids_b: list[int] = []
    for part in pieces_of(text, chunk):
        raw = (" " + part).encode()
        x, y = a.encode(" " + part), b.encode(part)
        if a.joined(x) != raw or b.joined(y) != raw:
            return [], []
        ids_a += x
        ids_b += y
    return ids_a, ids_b


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's group number, for A and for B, from the tokens' end bytes."""
    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)  # the token of B that covers the last byte
    to_a = np.searchsorted(ends_a, ends_b)
    here = np.arange(n, n + len(ends_b))
    succ = np.concatenate([n + to_b, np.where(ends_a[to_a] > ends_b, to_a, here)])
    while True:
        ahead = succ[succ]
        if np.array_equal(ahead, succ):
            break
        succ = ahead
    number = np.cumsum(succ[n:] == here) - 1  # terminal tokens in order
    label = number[succ - n]
    return label[:n], label[n:]


def _aligned(rows: list[tuple[list[int], list[int]]], a: ByteLevel, b: Pieces, written: np.ndarray):
    """Groups as text, number of groups, id pairs and their frequencies, of each row."""
    n_a, n_b = (np.array([len(r[s]) for r in rows], dtype=np.int64) for s in (0, 1))
    x, y = (np.fromiter((i for r in rows for i in r[s]), np.int64, int(n.sum())) for s, n in ((0, n_a), (1, n_b)))
    ends_a, ends_b = np.cumsum(a.lengths[x]), np.cumsum(b.lengths[y])
    of_a, of_b = group_labels(ends_a, ends_b) if len(x) else (x, y)
    last_a, last_b = (np.flatnonzero(np.append(g[1:] != g[:-1], len(g) > 0)) for g in (of_a, of_b))
    # a group's A tokens, then its B tokens, each with the mark that follows it
    order = np.empty(len(x) + len(y), dtype=np.int64)
    size = len(written) // 3
    mark_a, mark_b = x.copy(), y.copy()
    mark_a[last_a] += size
    mark_b[last_b] += 2 * size
    before_b = np.append(0, last_b + 1)
    order[np.arange(len(x)) + before_b[of_a]] = mark_a
    order[np.arange(len(y)) + last_a[of_b] + 1] = mark_b
    strings = written[order].tolist()
    n_groups = np.zeros(len(rows), dtype=np.int64)
    row_of = np.repeat(np.arange(len(rows)), n_a)[last_a]  # each group's row
    np.add.at(n_groups, row_of, 1)
    code = (row_of * a.size + x[last_a]) * b.size + y[last_b]
    distinct, times = np.unique(code, return_counts=True)
    edges = np.searchsorted(distinct, np.arange(len(rows) + 1) * (a.size * b.size))
    at = np.append(0, np.cumsum(n_a + n_b))
    text = ["".join(strings[lo:hi])[:-1] for lo, hi in zip(at, at[1:], strict=False)]
    return n_a, n_b, n_groups, text, distinct % (a.size * b.size), times, edges


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>"


def _align(shared, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, written = _tokenizers(*shared.value)

        def finish(ids: list, rows: list) -> pa.RecordBatch:
            n_a, n_b, n_groups, text, pairs, times, edges = _aligned(rows, a, b, written)
            offsets = pa.array(edges.astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(text, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

        ids: list = []
        rows: list = []
        held = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, doc in enumerate(batch.column(0).to_pylist()):
                raw = texts[i].as_py() or b""
                try:
                    row = tokens(raw.decode(), a, b, chunk) if raw else ([], [])
                except UnicodeDecodeError:
                    row = ([], [])
                ids.append(doc)
                rows.append(row)
                held += len(raw)
                if held >= chunk or len(rows) >= 4096:
                    yield finish(ids, rows)
                    ids, rows, held = [], [], 0
        if rows:
            yield finish(ids, rows)
    return run


def vocabularies(docs: DataFrame, a_path: str = MODEL_A, b_path: str = MODEL_B):
    """Both vocabulary files as one broadcast (their size is fixed); the paths are the driver's."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        return docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))


def align(docs: DataFrame, a_path: str = MODEL_A, b_path: str = MODEL_B, doc_id: str = "doc_id", text: str = "text",
          chunk: int = CHUNK) -> DataFrame:
    """Tokens and groups of every row.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of A and of B, group by group.
    ``pairs`` are the distinct id pairs that end together, coded
    ``a * size of B + b`` (see ``pair_ids``), ``times`` how often each does.
    """
    source = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    return source.mapInArrow(_align(vocabularies(docs, a_path, b_path), chunk), ALIGNED)


def pair_ids(pair: str, size_b: int):
    """The ids of A and B in a pair's code."""
    return (F.expr(f"{pair} div {size_b}L").cast("int").alias("a_id"), F.expr(f"{pair} % {size_b}L").cast("int").alias("b_id"))


def size_of_b(b_path: str = MODEL_B) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def link_counts(aligned: DataFrame, b_path: str = MODEL_B) -> DataFrame:
    """``(pair, a_id, b_id, n, best)`` of every id pair that is linked: its links, and whether no A id has more with this B id."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counted = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    counted = cut(counted.select("pair", *pair_ids("pair", size_of_b(b_path)), "n"))
    most = counted.groupBy("b_id").agg(F.max("n").alias("most"))  # no more rows than B has ids
    return counted.join(F.broadcast(most), "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def _hot_sums(shared):
    """Links, counts and best links of each row as far as broadcast pairs go; other pairs stay in the row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            edges = lists.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            p, t = lists.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            add = lambda v: np.diff(np.append(0, np.cumsum(v))[edges])
            known, total, top = np.zeros(len(p), bool), np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            if len(pair):
                at = np.minimum(np.searchsorted(pair, p), len(pair) - 1)
                known = pair[at] == p
                total, top = np.where(known, t * n[at], 0), np.where(known & best[at], t, 0)
            rest = pa.array(np.append(0, np.cumsum(~known))[edges].astype(np.int32))
            kept = {c: batch.column(c) for c in batch.schema.names if c not in ("pairs", "times")}
            kept |= {"n_links": pa.array(add(t)), "n_best": pa.array(add(top)), "count_sum": pa.array(add(total)),
                     "pairs": pa.ListArray.from_arrays(rest, pa.array(p[~known])), "times": pa.ListArray.from_arrays(rest, pa.array(t[~known]))}
            yield pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))
    return run


def count_links(aligned: DataFrame, counts: DataFrame, row: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` and ``count_sum`` in place of its pairs; ``row`` names a column that tells rows apart.

    ``count_sum`` adds up the corpus-wide counts of a row's links, ``n_best`` counts
    the links whose pair is its B id's most frequent one.
    """
    counts = cut(counts.select("pair", "n", "best"))
    links = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(1, -(-links // hot_pairs))
    hot = counts.where(F.col("n") >= least).orderBy("pair").toPandas()  # hot_pairs rows at most
    shared = aligned.sparkSession.sparkContext.broadcast(
        (hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), hot["best"].to_numpy(bool)))
    plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    sums = aligned.mapInArrow(_hot_sums(shared), ", ".join([*plain, "n_links long, n_best long, count_sum long, pairs array<long>, times array<long>"]))
    cold = counts.where(F.col("n") < least)
    if cold.isEmpty():
        return sums.drop("pairs", "times", row)
    sums = cut(sums)
    each = sums.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(row, F.col("p.pairs").alias("pair"), "p.times")
    more = (each.join(cold, "pair").groupBy(row)
            .agg(F.sum(F.col("times") * F.col("n")).alias("__sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("__best")))
    zero = F.lit(0).cast("long")
    return (sums.join(more, row, "left").withColumn("n_best", F.col("n_best") + F.coalesce("__best", zero))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("__sum", zero)).drop("pairs", "times", "__sum", "__best", row))

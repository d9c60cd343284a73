"""Sampled SentencePiece segmentation: forward filtering, backward sampling.

All segmentations of a text into pieces form a lattice; each has the weight
``exp(theta * sum of its pieces' potentials)``.  The forward pass sums the
weights of all ways to reach each position; the backward pass draws pieces from
the end, each with its exact conditional probability, so a segmentation comes
out with its probability under the model.  Random numbers are a hash of the row's
key, the word's number in the text and the step: the same row always gets the
same segmentation, on any machine and in any batch.

No piece of the vocabulary holds a space after another character (checked when it
is read), so the lattice falls apart before each run of spaces.  Texts are worked
on about ``BATCH`` characters at a time: what precedes a position of a word decides
its forward sum, so the pass runs once for each distinct *beginning* of a word in
the batch, all beginnings of one length together; the backward pass then draws for
all words at a time.  Equal words and beginnings are found by hash and compared
character by character before they are taken as one.

A potential is a unigram model's log probability, or ``-log(1 + rank)`` where the
model's scores are merge ranks.  A character without a piece of its own becomes
its UTF-8 byte pieces, so every text can be encoded and decoding gives back the
same text, literal ``U+2581`` included.  As usual a space is put before the text
and taken away in decoding.  Strings such as ``<s>`` in a text are ordinary text.

Defined cases: null text gives null ids, empty text no ids; a null key draws as
one more key; repeated rows get equal ids; a text's memory is in proportion to
its length; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tumbleweed.llm.common import quoted, without
from tumbleweed.llm.words import mix, powers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BATCH = 1 << 20
BYTE_PENALTY = 10.0
SLOTS = 8


class Vocabulary:
    """Pieces, potentials and byte pieces of a model, read on the driver (its size is fixed)."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.potential: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        scores: list[tuple[str, int, float]] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                text = piece.replace(MARK, " ")
                if re.search(r"[^ ] ", text):
                    raise ValueError(f"piece {piece!r} crosses a word border")
                scores.append((text, i, model.get_score(i)))
                self.bytes_of.append(text.encode())
        ranks = all(s <= 0 and s == int(s) for _, _, s in scores)
        for text, i, s in scores:
            self.potential[text] = (i, -math.log1p(min(-s, 1e6)) if ranks else s)
        self.longest = max((len(p) for p in self.potential), default=1)
        self.byte_potential = min((p for _, p in self.potential.values()), default=0.0) - BYTE_PENALTY


class PieceTable:
    """Pieces by the hash of their characters read backwards, to find all pieces that end at many positions at once."""

    STEP = np.uint64(0x9E3779B97F4A7C15)
    BITS = 22

    def __init__(self, vocabulary: Vocabulary):
        texts = list(vocabulary.potential)
        self.ids = np.array([vocabulary.potential[t][0] for t in texts], dtype=np.int64)
        self.weight = np.array([vocabulary.potential[t][1] for t in texts])
        self.width = vocabulary.longest
        self.chars = np.zeros((len(texts), self.width), dtype=np.uint32)  # last character first
        for k, t in enumerate(texts):
            self.chars[k, :len(t)] = np.frombuffer(t[::-1].encode("utf-32-le"), np.uint32)
        size, h = np.array([len(t) for t in texts]), np.zeros(len(texts), dtype=np.uint64)
        hashes = np.zeros(len(texts), dtype=np.uint64)
        self.some = np.zeros(1 << self.BITS, dtype=bool)  # whether any piece ends like this
        for n in range(self.width):
            on = size > n
            h[on] = self.grow(h[on], self.chars[on, n])
            self.some[(h[on] >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
            hashes[size == n + 1] = h[size == n + 1]
        order = np.argsort(hashes)
        self.hashes, self.order = hashes[order], order

    @classmethod
    def grow(cls, h: np.ndarray, chars: np.ndarray) -> np.ndarray:
        h = (h ^ (chars.astype(np.uint64) + np.uint64(1))) * cls.STEP
        return h ^ (h >> np.uint64(29))

    def ending(self, chars: np.ndarray, last: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(number in last, length, piece)`` of every piece that ends at ``last`` and fits in the ``room`` before it; shorter ones first."""
        at, h = np.arange(len(last)), np.zeros(len(last), dtype=np.uint64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(self.width):
            on = np.flatnonzero(room[at] > n)
            at, h = at[on], h[on]
            h = self.grow(h, chars[last[at] - n])
            on = np.flatnonzero(self.some[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
            at, h = at[on], h[on]
            slot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[slot] == h)
            piece, where = self.order[slot[hit]], last[at[hit]]
            same = np.ones(len(hit), dtype=bool)
            for k in range(n + 1):  # a hash is no proof
                same &= chars[where - k] == self.chars[piece, k]
            found.append((at[hit][same], piece[same]))
        length = np.repeat(np.arange(1, self.width + 1), [len(x) for x, _ in found])
        return np.concatenate([x for x, _ in found]), length, np.concatenate([x for _, x in found])


class Lattice:
    """The forward-filtered lattice of a batch of words.

    Node 0 is the start; every other node is a distinct beginning of a word.  Its
    edges are the pieces that end it, with cumulative conditional probabilities,
    each leading back to the node before its piece.  ``slots`` says, for each
    eighth of the unit interval, how many edges a draw in it can skip.
    """

    def __init__(self, chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray, table: PieceTable, vocabulary: Vocabulary, theta: float):
        up, down = powers(len(chars))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * up[:len(chars)])])
        # distinct words
        whole = (sums[starts + sizes] - sums[starts]) * down[starts]
        _, first, word = np.unique(whole, return_index=True, return_inverse=True)
        offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        if (sizes != sizes[first][word]).any() or (chars[np.repeat(starts, sizes) + offset] != chars[np.repeat(starts[first][word], sizes) + offset]).any():
            first = word = np.arange(len(starts))
        starts, sizes = starts[first], sizes[first]
        # distinct beginnings: position i stands for the beginning of its word that ends there
        depth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        begin = np.repeat(starts, sizes)
        _, first, node = np.unique((sums[begin + depth] - sums[begin]) * down[begin], return_index=True, return_inverse=True)
        last = begin + depth - 1
        before = np.where(depth > 1, np.concatenate([[0], node[:-1]]), -1)
        if (chars[last] != chars[last[first]][node]).any() or (before != before[first][node]).any() or (depth != depth[first][node]).any():
            first = node = np.arange(len(depth))
        # nodes by depth, so that the forward pass goes through them in order
        order = np.argsort(depth[first], kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        node, first = rank[node], first[order]
        self.ends = node[np.cumsum(sizes) - 1][word]  # the last node of each word given
        depths = np.concatenate([[0], depth[first]])
        base = np.searchsorted(depths, np.arange(depths[-1] + 2))

        at, length, piece = table.ending(chars, last[first], depths[1:])
        weight, emit = table.weight[piece] * theta, table.ids[piece]
        alone = np.ones(len(first), dtype=bool)
        alone[at[:np.searchsorted(length, 2)]] = False
        rest = np.flatnonzero(alone)
        single = len(vocabulary.bytes_of)
        self.spelled: list[tuple] = []  # ids of characters without a piece: their bytes
        if len(rest):
            code, which = np.unique(chars[last[first][rest]], return_inverse=True)
            self.spelled = [tuple(vocabulary.byte_ids[b] for b in chr(c).encode()) for c in code]
            cost = np.array([len(r) * vocabulary.byte_potential * theta for r in self.spelled])
            at, length = np.concatenate([at, rest]), np.concatenate([length, np.ones(len(rest), np.int64)])
            weight, emit = np.concatenate([weight, cost[which]]), np.concatenate([emit, single + which])
        order = np.argsort((at << 5) + length)
        at, length, weight, self.emit = at[order], length[order], weight[order], emit[order]
        back = first[at] - length  # the position of the node before the piece, in the same word
        self.back = np.where(depths[at + 1] > length, node[np.maximum(back, 0)], 0)
        heads = np.flatnonzero(np.diff(at, prepend=-1))  # first edge of each node from 1 on: every one has an edge
        stops = np.append(heads, len(at))
        alpha, share = np.zeros(len(depths)), np.empty(len(at))
        for a, b in zip(base[1:-1], base[2:], strict=True):
            lo, hi = stops[a - 1], stops[b - 1]
            w, own, head = alpha[self.back[lo:hi]] + weight[lo:hi], at[lo:hi] - (a - 1), heads[a - 1:b - 1] - lo
            most = np.maximum.reduceat(w, head)
            e = np.exp(w - most[own])
            total = np.add.reduceat(e, head)
            alpha[a:b] = most + np.log(total)
            share[lo:hi] = e / total[own]
        # shares add up within each node alone, edge after edge: what else is in the batch can't change a bit of them
        run, edges = share.copy(), np.diff(stops)
        for k in range(1, int(edges.max(initial=0))):
            on = heads[edges > k] + k
            run[on] += run[on - 1]
        run[stops[1:] - 1] = 1.0
        self.until, self.first = run, np.concatenate([[-1], heads])
        self.slots = np.zeros((len(depths), SLOTS), dtype=np.uint8)
        for k in range(1, SLOTS):  # edges whose share ends at or before the slot's start
            self.slots[1:, k] = np.add.reduceat((run <= k / SLOTS).astype(np.uint8), heads)

    def draw(self, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Drawn id lists of all words, in order, and how many each word has; ``base`` seeds each word."""
        until, back, emit, first, slots = self.until, self.back, self.emit, self.first, self.slots.ravel()
        who, node, drawn = np.arange(len(base)), self.ends, np.zeros(len(base), dtype=np.int64)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(who):
            u = (mix(base + np.uint64(0x9E3779B97F4A7C15 * (len(steps) + 1) % (1 << 64))) >> np.uint64(32)).astype(np.float64) * 2.0**-32
            edge = first[node] + slots[node * SLOTS + (u * SLOTS).astype(np.int64)]
            on = np.flatnonzero(until[edge] <= u)
            while len(on):
                edge[on] += 1
                on = on[until[edge[on]] <= u[on]]
            steps.append((who, emit[edge]))
            drawn[who] += 1
            node = back[edge]
            on = np.flatnonzero(node)
            who, node, base = who[on], node[on], base[on]
        last, lists = np.cumsum(drawn) - 1, np.empty(drawn.sum(), dtype=np.int64)
        for k, (w, e) in enumerate(steps):  # pieces were drawn from the end of each word
            lists[last[w] - k] = e
        return lists, drawn


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Sequences end to end, and where each starts."""
    return np.array([i for x in lists for i in x], dtype=np.int64), np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])


def _gather(numbers: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences with these numbers end to end, and the size of each."""
    sizes = np.diff(starts)[numbers]
    return flat[np.repeat(starts[:-1][numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())], sizes


class Sampler:
    def __init__(self, vocabulary: Vocabulary, theta: float = 1.0):
        self.v, self.theta, self.table = vocabulary, theta, PieceTable(vocabulary)

    def sample(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Sampled piece ids of each text."""
        out = [np.empty(0, np.int64)] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out
        chars = np.frombuffer("".join(" " + texts[i] for i in some).encode("utf-32-le"), np.uint32).astype(np.uint64)
        size = np.array([len(texts[i]) + 1 for i in some])
        text_start = np.cumsum(size) - size
        space = chars == 32
        new = space.copy()  # a word starts at the first of each run of spaces, and where a text starts
        new[1:] &= ~space[:-1]
        new[text_start] = True
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=len(chars))
        counts = np.diff(np.searchsorted(starts, np.append(text_start, len(chars))))
        occurrence = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
        seeds = mix(np.repeat(keys[some], counts) ^ mix(occurrence.astype(np.uint64)))
        lattice = Lattice(chars, starts, sizes, self.table, self.v, self.theta)
        lists, drawn = lattice.draw(seeds)
        ends = np.cumsum(drawn)[np.cumsum(counts) - 1]  # where each text's lists end
        if lattice.spelled:
            lists, width = _gather(lists, *_flat([(i,) for i in range(len(self.v.bytes_of))] + lattice.spelled))
            ends = np.cumsum(width)[ends - 1]
        for i, part in zip(some, np.split(lists, ends[:-1]), strict=True):
            out[i] = part
        return out


def _by_size(batch: pa.RecordBatch, most: int = BATCH) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (its first column) have about ``most`` bytes together, or one row."""
    sizes = np.cumsum([t.as_buffer().size if t.is_valid else 0 for t in batch.column(0).cast(pa.binary())])
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", theta: float = 1.0, seed: int = 0,
           model: str = MODEL) -> DataFrame:
    """Adds ``ids``: a sampled segmentation of every whole text, seeded by the row's key."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))
    base = without(docs, ["ids"])
    names = base.columns
    seeded = base.select(quoted(text).cast("string").alias("__text"),
                         F.xxhash64(quoted(key).cast("string"), F.lit(seed)).alias("__key"), *[quoted(c) for c in names])
    schema = T.StructType([*base.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary.value, theta)
        for batch in batches:
            for b in _by_size(batch):
                texts = b.column(0).to_pylist()
                parts = sampler.sample([t or "" for t in texts], b.column(1).to_numpy().view(np.uint64))
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                values = pa.array(np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32))
                ids = pa.ListArray.from_arrays(offsets, values, mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*b.columns[2:], ids], names=[*names, "ids"])

    return seeded.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Adds ``decoded``: the text that ``ids`` stand for; null for null ids."""
    table = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model).bytes_of)

    @F.pandas_udf("string")
    def text(ids):
        import pandas as pd

        flat, starts = _flat(table.value)
        flat = flat.astype(np.uint8)
        return pd.Series([None if x is None else _gather(x, flat, starts)[0].tobytes().decode()[1:] for x in ids])

    return encoded.withColumn("decoded", text("ids"))

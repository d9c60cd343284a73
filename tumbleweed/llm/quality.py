"""Quality classifier: similarity-weighted votes of the nearest labelled documents.

*Terms* of a text are its byte trigrams (hashed to ``TRIGRAMS`` numbers), the
shapes of its words (kinds of first and last byte, length) and levels of how
often words repeat, counted over the whole text.  Term counts are damped, weighted by inverse
document frequency over *all* documents, and scaled to length one.  A truncated
singular value decomposition of a bounded sample of labelled documents
(``fit_rows``, each distinct text once) gives the latent-semantic space.

*Votes.*  The sample's latent vectors and labels are broadcast; their size is
``fit_rows * DIMS`` floats whatever the corpus.  Every document is compared with
all of them, block by block, by exact cosine products; the ``NEIGHBOURS`` nearest
vote with weight ``cosine ** POWER``.  The score is the weighted share of label 1.

Only texts enter a score.  Learning uses rows whose ``crc32(doc_id) mod 5`` is not
0; the others are held out.

Defined cases: null text counts as empty; a text without terms (or without a
neighbour of positive cosine) scores the share of label 1 in the sample; without
any usable label every score is 0.5; null ids are never learned from; labels
other than 0 and 1 are left out, of repeated labels of one document the least
counts; sample documents at the cosine of the last neighbour share its votes; repeated
rows are each scored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm.common import cut, quoted
from tumbleweed.llm.words import SPACE, word_hashes

TRIGRAMS = 2048
SHAPES = 256
#: Levels of the share of words that repeat the word before them, and of the share that occurred earlier in the text.
LEVELS = (0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
REPEATS = 2 * (len(LEVELS) + 1)
#: A text has one level of each kind against hundreds of trigrams, so levels weigh more.
REPEAT_WEIGHT = 5
TERMS = TRIGRAMS + SHAPES + REPEATS
DIMS = 64
NEIGHBOURS = 15
POWER = 32
FIT_ROWS = 6000
THRESHOLD = 0.3

_KIND = np.full(256, 5, dtype=np.int64)  # other punctuation
_KIND[ord("a"):ord("z") + 1] = 0
_KIND[ord("A"):ord("Z") + 1] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[ord(".")], _KIND[ord(",")], _KIND[ord("|")] = 3, 4, 6
_KIND[128:] = 7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count_piece(text: bytes, into: np.ndarray) -> None:
    b = np.frombuffer(text, np.uint8)
    if len(b) > 2:
        x = b.astype(np.uint32)
        code = ((x[:-2] | (x[1:-1] << 8) | (x[2:] << 16)) * np.uint32(2654435761)) >> np.uint32(32 - 11)
        into[:TRIGRAMS] += np.bincount(code, minlength=TRIGRAMS)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[b]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts):
        size = np.searchsorted([2, 4, 8], ends - starts, side="right")
        shape = (_KIND[b[starts]] * 8 + _KIND[b[ends - 1]]) * 4 + size
        into[TRIGRAMS:TRIGRAMS + SHAPES] += np.bincount(shape, minlength=SHAPES)


def term_counts(texts: list[bytes], piece: int = 1 << 20) -> np.ndarray:
    """A row of term counts for each text; a text is read in pieces, so memory stays bounded."""
    out = np.zeros((len(texts), TERMS), dtype=np.float32)
    for row, text, words in zip(out, texts, word_hashes(texts), strict=True):
        for at in range(0, len(text), piece):
            _count_piece(text[at:at + piece], row)
        if len(words):
            again = (words[1:] == words[:-1]).mean() if len(words) > 1 else 0.0
            seen = 1 - len(np.unique(words)) / len(words)
            first = TRIGRAMS + SHAPES
            row[first + np.searchsorted(LEVELS, again, side="right")] = len(words)
            row[first + len(LEVELS) + 1 + np.searchsorted(LEVELS, seen, side="right")] = len(words)
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, df = 0, np.zeros(TERMS, dtype=np.int64)
    for batch in _slices(batches):
        df += (term_counts(_texts(batch.column(0))) > 0).sum(axis=0)
        n += batch.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(np.append(df, n))], names=["term", "df"])


def term_weights(df: np.ndarray, n: float) -> np.ndarray:
    """Inverse document frequencies; levels of repetition weigh more."""
    idf = np.log((1 + n) / (1 + df)) + 1
    idf[-REPEATS:] *= REPEAT_WEIGHT
    return idf.astype(np.float32)


@dataclass
class Model:
    """Everything a score needs; its size depends on ``fit_rows`` alone."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        z = self.weigh(counts) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cos = self.latent(counts) @ self.vectors.T
        n = cos.shape[1]
        k = min(NEIGHBOURS, n)
        order = np.argpartition(-cos, sorted({k - 1, min(k, n - 1)}), axis=1)
        at = order[:, :k]
        near = np.take_along_axis(cos, at, axis=1)
        label = self.labels[at]
        if n > k:  # sample documents that equal the last neighbour share its votes
            for row in np.flatnonzero(cos[np.arange(len(cos)), order[:, k]] == near[:, k - 1]):
                last = near[row] == near[row, k - 1]
                label[row, last] = self.labels[cos[row] == near[row, k - 1]].mean()
        weight = np.maximum(near.astype(np.float64), 0) ** POWER
        total = weight.sum(axis=1)
        vote = (weight * label).sum(axis=1) / np.maximum(total, 1e-300)
        return np.round(np.where(total > 1e-9, vote, self.labels.mean()), 6)


def latent_basis(x: np.ndarray, dims: int, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors, by a randomised range finder with three power steps."""
    dims = min(dims, *x.shape)
    rng = np.random.default_rng(seed)
    y = x.T @ rng.normal(size=(x.shape[0], min(dims + 16, x.shape[0]))).astype(np.float32)
    for _ in range(3):
        y = x.T @ (x @ np.linalg.qr(y)[0])
    q = np.linalg.qr(y)[0]
    return q @ np.linalg.svd(x @ q, full_matrices=False)[2].T[:, :dims]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the labelled documents of ``docs`` that are not held out."""
    d = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    known = (labels.select(quoted("doc_id").alias("doc_id"), quoted(label).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    # a bounded sample: distinct texts in the order of their hashes
    chosen = (d.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).join(known, "doc_id")
              .groupBy("h").agg(F.min(F.struct("doc_id", "y")).alias("first"))
              .orderBy("h").limit(fit_rows).select("first.doc_id", "first.y"))
    chosen = cut(chosen)

    counted = d.select("text").mapInArrow(_document_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(TERMS + 1)
    for r in counted:
        df[r["term"]] = r["df"]
    idf = term_weights(df[:-1], df[-1])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            counts = term_counts(_texts(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in counts], pa.binary())], names=["doc_id", "y", "counts"])

    picked = d.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text").dropDuplicates(["doc_id"])  # fit_rows ids at most
    counted = picked.mapInArrow(rows, "doc_id long, y int, counts binary")
    # one task holds the sample's counts (fit_rows * TERMS floats); the driver gets the basis and the latent vectors
    learned = {r["part"]: r["data"] for r in counted.repartition(1).mapInArrow(_learn(idf), "part string, data binary").collect()}
    if not learned:
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    y = np.frombuffer(learned["labels"], np.float64)
    return Model(idf, np.frombuffer(learned["basis"], np.float32).reshape(TERMS, -1), np.frombuffer(learned["vectors"], np.float32).reshape(len(y), -1), y)


def _learn(idf: np.ndarray):
    """Basis, latent vectors and labels of a sample, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches([b for b in batches if b.num_rows], schema=pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("counts", pa.binary())]))
        if not t.num_rows:
            return
        t = t.sort_by("doc_id")
        counts = np.stack([np.frombuffer(c, np.float32) for c in t.column("counts").to_pylist()])
        model = Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
        model.basis = latent_basis(model.weigh(counts), DIMS).astype(np.float32)
        parts = {"basis": model.basis, "vectors": model.latent(counts).astype(np.float32), "labels": t.column("y").to_numpy().astype(np.float64)}
        yield pa.RecordBatch.from_arrays([pa.array(list(parts)), pa.array([np.ascontiguousarray(v).tobytes() for v in parts.values()], pa.binary())],
                                         names=["part", "data"])
    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            s = shared.value.scores(term_counts(_texts(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    kind = dict(docs.dtypes)[doc_id]
    d = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    return (d.mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that the model rejects; columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(t):
        import pandas as pd

        texts = [b"" if x is None else x.encode() for x in t]
        parts = [shared.value.scores(term_counts(texts[at:at + 256])) for at in range(0, len(texts), 256)]
        return pd.Series(np.concatenate(parts) >= THRESHOLD if parts else np.zeros(0, bool))

    return docs.where(good(quoted(text).cast("string")))

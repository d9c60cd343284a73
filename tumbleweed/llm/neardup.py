"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

1. *One pass over the texts.*  Each document's set of word shingles is hashed;
   out come its size, a digest of the set, ``BANDS`` band keys over
   ``BANDS * ROWS`` MinHash samples, and an odd sketch: a bitmap in which each
   (sample number, sample) flips one bit.
2. *Equal sets* (exact copies among them) are one class from here on, named by
   its least document.
3. *Candidates* share a band key.  Pairs are formed from each member of a bucket
   to the bucket's least member only.  The population count of the XOR of two
   odd sketches estimates how many samples differ; pairs far below the
   threshold are dropped there.  The bound ``MAX_XOR`` is five standard
   deviations away from what a pair at the threshold shows.
4. *Confirmation* compares full shingle sets: ``100 * intersection >= 100 *
   similarity * union`` in integers.  Sets are made anew for the documents of a
   candidate pair only.
5. *Components* of confirmed links.  Buckets whose members are then still in
   different components are split into bounded cells, which hold the members'
   sketches and full sets; a cell compares all its pairs between different
   components and gives out only which components a link joins.  A bucket
   whose members are all connected is never expanded, so a group of copies costs
   its size and not its square, and no link between components is skipped.

A pair at similarity 0.8 shares no band with probability (1 - 0.8**5)**30 =
6.8e-6.

Defined cases: null and empty texts and texts of white space have no set, size 0
and are linked with nothing; a row without id is in no component (null) and
counts as kept; repeated rows are answered once each; extra columns stay out of
the result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm import bloom
from tumbleweed.llm.common import cut, quoted
from tumbleweed.llm.components import components
from tumbleweed.llm.words import mix, shingle_set, word_hashes

BANDS, ROWS = 30, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Of 150 samples 30 differ on average at similarity 0.8, with a deviation of 4.9; 60 differing samples leave 96 odd bits.
MAX_XOR = 96
#: A cell is two parts of a bucket; a part has about so many rows and shingles.
CELL_ROWS = 512
CELL_SHINGLES = 1 << 20

_rng = np.random.default_rng(97)
_A = _rng.integers(0, 1 << 31, size=SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, size=SAMPLES, dtype=np.uint32)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``SAMPLES`` MinHash values of a set of 64-bit hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(out, (x[None, at:at + 2048] * _A[:, None] + _B[:, None]).min(axis=1), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of samples; the band's number is part of it."""
    s = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2])
    for i in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, i])
    return h.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, ``SKETCH_BITS / 64`` words a row."""
    number = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
    bit = (mix(samples.astype(np.uint64) | number) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flat = np.arange(len(samples))[:, None] * SKETCH_BITS + bit
    odd = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(odd.reshape(len(samples), SKETCH_BITS).astype(np.uint8), axis=1)


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _fingerprints(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingle_set(w, ngram) for w in word_hashes(_texts(batch.column(1)))]
            n = np.array([len(s) for s in sets], dtype=np.int64)
            samples = np.array([minhash(s) for s in sets], dtype=np.uint32).reshape(len(sets), SAMPLES)
            keys, sketch = band_keys(samples), odd_sketches(samples)
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                 pa.array([r.tobytes() for r in sketch], pa.binary())],
                names=["doc_id", "n", "digest", "bands", "sketch"])
    return run


def _sets(ngram: int, shared):
    """Full sets of the rows whose id the filter lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            hit = bloom.may_hold(shared.value, batch.column(2).to_numpy(), batch.column(3).to_numpy())
            if hit.any():
                some = batch.filter(pa.array(hit))
                sets = [shingle_set(w, ngram).tobytes() for w in word_hashes(_texts(some.column(1)))]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])
    return run


def _confirmed(percent: int):
    """Pairs whose full sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 256):
            x, y = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                p, q = (np.frombuffer(s[i].as_py(), np.uint64) for s in (x, y))
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return run


def _plausible(percent: int):
    """What sizes and sketches allow: a similarity of ``percent`` needs that much of a size ratio."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent

    @F.pandas_udf("boolean")
    def near(p, q):
        import pandas as pd

        x, y = (np.frombuffer(b"".join(s), np.uint64).reshape(len(s), -1) for s in (p, q))
        return pd.Series(np.bitwise_count(x ^ y).sum(axis=1) <= MAX_XOR)

    return lambda pairs: pairs.where(sizes).where(near("sketch_a", "sketch_b")).select("a", "b")


def common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, as products of 0/1 matrices over ``width`` hashes at a time."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    flat = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[number] > 1  # a hash of one set only adds to no intersection
    rank = np.cumsum(times > 1) - 1
    row, number = row[shared], rank[number[shared]]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    top = int(number[-1]) + 1 if len(number) else 0
    for at in range(0, top, width):
        lo, hi = np.searchsorted(number, [at, at + width])
        bits = np.zeros((len(left) + len(right), width), dtype=np.float32)
        bits[row[lo:hi], number[lo:hi] - at] = 1
        out += bits[:len(left)] @ bits[len(left):].T
    return out.astype(np.int64)


def _cell_links(c: dict, sketch: np.ndarray, sets: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs of components that a confirmed link of this cell joins: enough to connect what is connected in it."""
    left, right = np.flatnonzero(c["part"] == c["first"]), np.flatnonzero(c["part"] == c["second"])
    n, component = c["n"], c["component"]
    near = []
    for at in range(0, len(left), 64):
        i = left[at:at + 64]
        xor = np.bitwise_count(sketch[i][:, None, :] ^ sketch[right][None, :, :]).sum(axis=2)
        small, large = np.minimum(n[i][:, None], n[right][None, :]), np.maximum(n[i][:, None], n[right][None, :])
        near.append((xor <= MAX_XOR) & (component[i][:, None] != component[right][None, :]) & (small * 100 >= large * percent))
    fit = np.concatenate(near) if near else np.zeros((0, 0), bool)
    x, y = np.flatnonzero(fit.any(axis=1)), np.flatnonzero(fit.any(axis=0))
    if not len(x):
        return []
    x_rows, y_rows = left[x], right[y]
    full = {k: np.frombuffer(sets[k], np.uint64) for k in {*x_rows.tolist(), *y_rows.tolist()}}
    both = common_counts([full[k] for k in x_rows], [full[k] for k in y_rows])
    union = n[x_rows][:, None] + n[y_rows][None, :] - both
    i, j = np.nonzero(fit[np.ix_(x, y)] & (100 * both >= percent * union))
    parent: dict[int, int] = {}

    def root(k: int) -> int:
        while parent.setdefault(k, k) != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for p, q in zip(x_rows[i], y_rows[j], strict=True):
        a, b = root(int(component[p])), root(int(component[q]))
        if a != b:
            parent[a] = b
            out.append((int(component[p]), int(component[q])))
    return out


def _cells(percent: int):
    """``_cell_links`` of every cell; rows arrive sorted by cell, and no more than one cell is held."""
    columns = ("n", "component", "part", "first", "second")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def cells_of(t: pa.Table) -> np.ndarray:
            return np.stack([t.column(k).to_numpy() for k in ("key", "first", "second")])

        def finish(t: pa.Table) -> Iterator[pa.RecordBatch]:
            c = {k: t.column(k).to_numpy() for k in columns}
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(t.num_rows, -1)
            sets, cell = t.column("shingles").to_pylist(), cells_of(t)
            edges = [0, *(np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1), t.num_rows]
            links = [x for lo, hi in zip(edges, edges[1:], strict=False)
                     for x in _cell_links({k: v[lo:hi] for k, v in c.items()}, sketch[lo:hi], sets[lo:hi], percent)]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links]), pa.array([x[1] for x in links])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            cell = cells_of(t)
            last = int(np.argmax((cell == cell[:, -1:]).all(axis=0)))  # the last cell may go on in the next batch
            if last:
                yield from finish(t.slice(0, last))
            held = t.slice(last)
        if held is not None:
            yield from finish(held)

    return run


def link_components(docs: DataFrame, ngram: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row; ``kept`` marks one document of each component."""
    source = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    prints = cut(source.mapInArrow(_fingerprints(ngram), "doc_id long, n long, digest binary, bands array<long>, sketch binary"))
    # one row for each distinct set, under its least id; copies combine before the shuffle
    members = cut(prints.where("digest is not null and doc_id is not null").groupBy("digest")
                  .agg(F.min(F.struct("doc_id", "n", "bands", "sketch")).alias("m")).select("digest", "m.*"))
    keys = members.select("doc_id", F.explode("bands").alias("key"))
    small = members.select("doc_id", "n", "sketch")

    buckets = cut(members.select(F.explode("bands").alias("key"), "doc_id", "n").groupBy("key")
                  .agg(F.min("doc_id").alias("leader"), F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1"))
    shared = cut(keys.join(buckets, "key").select("key", "doc_id", "leader", "size", F.col("shingles").alias("total")))
    plausible = _plausible(percent)

    def with_sketches(pairs: DataFrame) -> DataFrame:
        side = lambda s: small.select(F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
        return pairs.join(side("a"), "a").join(side("b"), "b")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Full sets of the documents named; a filter of bounded size spares the others' texts any shuffle."""
        wanted = cut(wanted.distinct())
        key = F.xxhash64("doc_id")
        passed = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted.select(key.alias("k"))))
        found = (source.where("doc_id is not null").select("doc_id", "text", key.alias("k"), bloom.bits_of(key).alias("b"))
                 .mapInArrow(_sets(ngram, passed), "doc_id long, shingles binary"))
        return found.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("shingles").alias("shingles"))

    def confirm(pairs: DataFrame) -> DataFrame:
        sets = cut(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))))
        side = lambda s: sets.select(F.col("doc_id").alias(s), F.col("shingles").alias(f"set_{s}"))
        both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")
        return both.mapInArrow(_confirmed(percent), "a long, b long")

    stars = cut(plausible(with_sketches(shared.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct())))
    found = cut(components(confirm(stars)))

    # buckets of three or more whose members are not all connected yet
    at = cut(shared.where("size > 2").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
             .withColumn("component", F.coalesce("component", "doc_id")))
    open_ = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    parts = F.greatest(F.ceil(F.col("size") / CELL_ROWS), F.ceil(F.col("total") / CELL_SHINGLES)).cast("int")
    inside = cut(at.join(open_, "key", "left_semi").withColumn("parts", parts))
    merged = found.limit(0)
    if not inside.isEmpty():
        full = sets_of(inside.select("doc_id")).join(small, "doc_id")
        placed = (inside.withColumn("part", F.expr("cast(pmod(xxhash64(doc_id), parts) as int)"))
                  .withColumn("with", F.explode(F.expr("sequence(0, parts - 1)")))
                  .withColumn("first", F.least("part", "with")).withColumn("second", F.greatest("part", "with"))
                  .join(full, "doc_id")
                  .select("key", "first", "second", "part", "n", "component", "sketch", "shingles")
                  .repartition(F.col("key"), F.col("first"), F.col("second")).sortWithinPartitions("key", "first", "second"))
        merged = components(placed.mapInArrow(_cells(percent), "a long, b long"))

    joined = lambda df, column, of: (df.join(of.select(F.col("node").alias(column), F.col("component").alias("__next")), column, "left")
                                     .withColumn(column, F.coalesce("__next", column)).drop("__next"))
    component = joined(joined(members.select("digest", F.col("doc_id").alias("component_id")), "component_id", found), "component_id", merged)
    return (prints.select("doc_id", "n", "digest").join(component, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents of which another one of the group is kept; all columns stay.

    Rows without an id stay.  Of repeated rows of one id each stays or goes as its id does.
    """
    gone = cut(link_components(docs, doc_id=doc_id, text=text, **options).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct())
    key = F.xxhash64(quoted(doc_id).cast("long"))
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(gone.select(F.xxhash64("__gone").alias("k"))))

    @F.pandas_udf("boolean")
    def maybe(k, b):
        import pandas as pd

        return pd.Series(bloom.may_hold(shared.value, k.to_numpy(), b.to_numpy()))

    # rows that the filter refuses are kept for certain; only the others are shuffled to the exact join
    marked = docs.withColumn("__maybe", maybe(key, bloom.bits_of(key)))
    doubtful = marked.where("__maybe").join(gone, quoted(doc_id).cast("long") == F.col("__gone"), "left_anti")
    return marked.where("not __maybe").unionByName(doubtful).drop("__maybe")

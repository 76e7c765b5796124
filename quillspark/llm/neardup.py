"""MinHash near-dedup by HyperMinHash.

Each shingle falls into one of REGISTERS buckets; of a bucket's least hash a register keeps the number of leading zeros
and MANTISSA bits after them, 16 bits in all.  An empty bucket borrows a filled one's register, chosen by a fixed rule
(optimal densification).  BANDS bands of ROWS registers give the buckets in which candidates meet.  The
likeness of two sketches is the share of equal registers, corrected for the registers that are equal by chance; pairs
more than SIGMAS standard errors below the threshold go, the others are confirmed on their full shingle sets.

Texts with one shingle set are a class and enter once.  In a bucket all meet the least member first (no pairs among the
others).  Links are joined to components; buckets that still hold several components then pair the members
outside the bucket's main component with all members of other components, so that no link between components is lost:
in blocks of BLOCK texts, each task counting common shingles exactly and returning one link for two components at most.

Probability that a pair of Jaccard index 0.8 meets in no band: (1 - 0.8 ** 5) ** 40, about 1e-7.

Cases: null, empty and blank texts have no shingles, link with nothing and are kept; with fewer words than a shingle
the whole sequence is the one shingle; rows that share a doc_id are one document (where their texts differ, the one with the least set
hash stands for it); a row without doc_id is left out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, MIX_A, MIX_B, U64, Words, buffers, expand_texts, materialise, mix, slices, squeeze_texts
from .graph import components, linked

SHINGLE, PERCENT = 5, 80
BANDS, ROWS, MANTISSA, SIGMAS, BLOCK = 40, 5, 10, 5.0, 256
REGISTERS = BANDS * ROWS
#: Bytes of text whose shingles are held at once.
PIECE = 1 << 20
LOW = np.arange(256, dtype=np.uint8)
LOW[65:91] += 32


def shingles(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and the bounds of the texts among them."""
    w = Words(LOW[raw], off)
    n = len(off) - 1
    hashes, ok = w.grams(k)
    doc = w.doc()
    for short in range(1, k):  # texts of fewer words: all of them as one
        own = np.flatnonzero(w.counts == short)
        if len(own):
            g, _ = w.grams(short)
            hashes[w.first[own]] = mix(g[w.first[own]] + U64(short))
            ok[w.first[own]] = True
    hashes, doc = hashes[ok], doc[ok]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(n + 1))


def _donors(tries: int = 48) -> np.ndarray:
    """Buckets that each bucket tries in turn when it is empty."""
    j, one = np.arange(REGISTERS, dtype=np.uint64), np.ones(1, np.uint64)
    return np.stack([(mix(j * GOLDEN + np.uint64(t) * one * MIX_B) % U64(REGISTERS)).astype(np.int64) for t in range(1, tries + 1)])


DONORS = _donors()


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of each set; all zero for an empty set."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    value = mix(hashes * MIX_A + GOLDEN)
    bucket = (value >> U64(48)).astype(np.int64) % REGISTERS
    value = value & U64((1 << 48) - 1)
    cell = doc * REGISTERS + bucket
    order = np.lexsort((value, cell))
    cell, value = cell[order], value[order]
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    least, cell = value[first], cell[first]
    exponent = np.frexp(np.maximum(least, 1).astype(np.float64))[1].astype(np.int64)  # bits in use
    zeros = 48 - exponent
    shift = np.maximum(0, exponent - 1 - MANTISSA).astype(np.uint64)
    mantissa = (least >> shift) & U64((1 << MANTISSA) - 1)
    out = np.zeros(n * REGISTERS, np.uint16)
    out[cell] = (zeros.astype(np.uint64) << U64(MANTISSA) | mantissa).astype(np.uint16)
    filled = np.zeros(n * REGISTERS, bool)
    filled[cell] = True
    out, filled = out.reshape(n, REGISTERS), filled.reshape(n, REGISTERS)
    own, todo = filled.copy(), np.argwhere(~filled & (np.diff(bounds) > 0)[:, None])
    for donors in DONORS:
        if not len(todo):
            break
        d, j = todo[:, 0], todo[:, 1]
        some = own[d, donors[j]]
        out[d[some], j[some]] = out[d[some], donors[j[some]]]
        todo = todo[~some]
    for d, j in todo.tolist():  # all tries were empty: the next filled bucket
        ring = np.flatnonzero(np.roll(own[d], -j))
        out[d, j] = out[d, (j + ring[0]) % REGISTERS]
    return out


def chance() -> float:
    """Probability that two registers of unrelated sets are equal: the same leading zeros and mantissa."""
    return 1 / 3 / (1 << MANTISSA)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same, c = (a == b).mean(axis=1), chance()
    return np.maximum(0.0, (same - c) / (1 - c))


def _sketched(batches, k: int):
    for b in slices(batches, most=PIECE):
        hashes, bounds = shingles(*buffers(b.column("text")), k)
        sizes = np.diff(bounds)
        sums = [np.append(np.zeros(1, np.uint64), np.cumsum(mix(hashes * m + U64(7)), dtype=np.uint64)) for m in (MIX_A, MIX_B)]
        both = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], axis=1)
        h = [x if n else None for x, n in zip((r.tobytes() for r in both), sizes.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(h, pa.binary()), pa.array(sizes, pa.int64()), pa.array([r.tobytes() for r in sketches(hashes, bounds)], pa.binary())], ["doc_id", "h", "n", "sketch"])


def _plausible(batches, percent: int):
    """Pairs whose sketches don't rule the threshold out."""
    for b in batches:
        if not b.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sa", "sb"))
        n = np.minimum(b.column("na").to_numpy(), b.column("nb").to_numpy()).astype(float)
        t = percent / 100
        samples = REGISTERS * (1 - np.exp(-n / REGISTERS))  # buckets filled by the set itself
        least = t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(1, samples))
        keep = pa.array(estimates(x, y) >= least)
        yield b.select(["a", "b"]).filter(keep)


def _squeezed(batches):
    for b in slices(batches, most=PIECE):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(squeeze_texts(*buffers(b.column("text"))), pa.binary())], ["doc_id", "z"])


def _confirmed(batches, k: int, percent: int):
    """Pairs whose full shingle sets reach the threshold."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            b = batch.slice(at, 512)
            (ha, ba), (hb, bb) = (shingles(*expand_texts(b.column(c)), k) for c in ("za", "zb"))
            keep = []
            for i in range(b.num_rows):
                x, y = ha[ba[i] : ba[i + 1]], hb[bb[i] : bb[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _common(hashes: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, some columns of shingles at a time."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, column, seen = np.unique(hashes, return_inverse=True, return_counts=True)
    some = seen[column] > 1
    place = np.cumsum(seen > 1) - 1
    doc, column = doc[some], place[column[some]]
    out, width = np.zeros((len(left), len(right)), np.float32), 4096
    row = np.full((2, len(bounds) - 1), -1)
    row[0, left], row[1, right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        d, c = doc[lo:hi], column[lo:hi] - at
        sides = []
        for k, size in enumerate((len(left), len(right))):
            own = row[k, d] >= 0
            m = np.zeros((size, width), np.float32)
            m[row[k, d[own]], c[own]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _crossing(t: pa.Table, k: int, percent: int) -> pa.Table:
    """Links between components among the texts of one block pair; one for two components at most."""
    t = t.combine_chunks()
    hashes, bounds = shingles(*expand_texts(t.column("z")), k)
    size, rep, component = np.diff(bounds), t.column("rep").to_numpy(), t.column("component").to_numpy()
    left, right = (np.flatnonzero(t.column(c).to_numpy(zero_copy_only=False)) for c in ("asks", "asked"))
    both = _common(hashes, bounds, left, right)
    union = size[left][:, None] + size[right][None, :] - both
    i, j = np.nonzero((100 * both >= percent * union) & (both > 0) & (component[left][:, None] != component[right][None, :]))
    a, b = left[i], right[j]
    pair = np.sort(np.stack([component[a], component[b]]), axis=0)
    _, one = np.unique(pair, axis=1, return_index=True) if len(a) else (None, np.zeros(0, np.int64))
    return pa.table({"a": pa.array(np.minimum(rep[a], rep[b])[one], pa.int64()), "b": pa.array(np.maximum(rep[a], rep[b])[one], pa.int64())})


class _Search:
    def __init__(self, docs: DataFrame, k: int, percent: int):
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
        read = self.docs.mapInArrow(partial(_sketched, k=k), "doc_id long, h binary, n long, sketch binary")
        self.base = materialise(read, "sketches")
        one = self.base.groupBy("doc_id").agg(F.min(F.struct("h", "n")).alias("r"))
        self.members = one.select("doc_id", "r.h", "r.n")
        self.classes = self.members.filter("n > 0").groupBy("h").agg(F.min("doc_id").alias("rep"))
        sketch = self.base.select("doc_id", "h", "sketch", "n")
        self.reps = materialise(sketch.join(self.classes.select(F.col("rep").alias("doc_id"), "h"), ["doc_id", "h"]).dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("rep"), "n", "sketch"), "classes")

    def buckets(self) -> DataFrame:
        """key, rep: members of all buckets with two or more."""
        bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sketch"), b * (2 * ROWS) + 1, F.lit(2 * ROWS))))
        rows = self.reps.select("rep", F.explode(bands).alias("key"))
        many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("pivot"), *[F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"x{i}") for i in (1, 2)]).filter("c > 1")
        many = many.groupBy("pivot", "c", "x1", "x2").agg(F.min("key").alias("key")).select("key", "pivot")  # of buckets with the same members one
        return materialise(rows.join(many, "key"), "buckets")

    def keep_texts(self, buckets: DataFrame) -> None:
        """The compressed texts of all members of buckets; dealt by doc_id at every size, as the members grow with the input."""
        need = buckets.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
        self.texts = materialise(self.docs.mapInArrow(_squeezed, "doc_id long, z binary").join(need, "doc_id", "left_semi"), "texts")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), those that reach the threshold: by size, then by sketch, then by the full sets."""
        side = lambda c: self.reps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
        sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"100 * least(na, nb) >= {self.percent} * greatest(na, nb)")
        likely = sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(partial(_plausible, percent=self.percent), "a long, b long")
        text = lambda c: self.texts.select(F.col("doc_id").alias(c), F.col("z").alias(f"z{c}"))
        full = likely.join(text("a"), "a").join(text("b"), "b").select("a", "b", "za", "zb")
        return full.mapInArrow(partial(_confirmed, k=self.k, percent=self.percent), "a long, b long").distinct()


    def crossings(self, buckets: DataFrame, label: DataFrame) -> DataFrame:
        """Links between components that meet in a bucket: members outside its main component against all others."""
        told = buckets.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
        parts = told.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
        mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("size"), F.max(F.struct("c", "component")).alias("main")).filter("kinds > 1")
        mixed = mixed.select("key", F.col("main.component").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("size") - F.col("main.c")) / BLOCK).cast("int").alias("asking"))
        rows = told.join(mixed, "key").withColumn("outside", F.col("component") != F.col("main"))
        own = lambda n: F.pmod(F.xxhash64("rep", "key"), F.col(n)).cast("int")
        cell = lambda i, j, asks, asked: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), asks.alias("asks"), F.lit(asked).alias("asked"))
        span = lambda n: F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1)
        asked = F.transform(span("asking"), lambda i: cell(i, own("blocks"), F.lit(False), True))
        asking = F.when(F.col("outside"), F.transform(span("blocks"), lambda j: cell(own("asking"), j, F.lit(True), False))).otherwise(F.array().cast("array<struct<i:int,j:int,asks:boolean,asked:boolean>>"))
        cells = F.when(F.col("blocks") == 1, F.array(cell(F.lit(0), F.lit(0), F.col("outside"), True))).otherwise(F.concat(asked, asking))
        rows = rows.select("key", "rep", "component", F.explode(cells).alias("c")).select("key", "rep", "component", "c.*")
        full = rows.join(self.texts.select(F.col("doc_id").alias("rep"), "z"), "rep").select("key", "i", "j", "rep", "component", "asks", "asked", "z")
        k, percent = self.k, self.percent
        return full.groupBy("key", "i", "j").applyInArrow(lambda t: _crossing(t, k, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) and kept (doc_id is its component's) of each document."""
    s = _Search(docs, k, percent)
    buckets = s.buckets()
    s.keep_texts(buckets)
    star = materialise(buckets.filter("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = materialise(s.links(star), "links")
    label = materialise(components(links), "components")
    more = materialise(s.crossings(buckets, label), "links")
    final = label if more.isEmpty() else linked(label, more)
    reps = s.classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("h", F.coalesce("component", "rep").alias("component_id"))
    out = s.members.join(reps, "h", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))

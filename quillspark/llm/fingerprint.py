"""Document fingerprints by locally consistent parsing.

Level 0 is the code points of a text.  On each level runs of one name become a single name that has the run's length
too (on level 0 exactly, above as a hash of 64 bits); deterministic coin tossing
then gives each name a small label, from its own and the preceding names only: the lowest bit in which it
differs from the one before it, and that bit's value; done thrice, few labels are left and neighbours
still differ.  A phrase begins at each local maximum of the labels, and the next level has one name for each
phrase, a hash of its names.  Whether a phrase begins somewhere depends on a few neighbours, so equal substrings are
parsed alike inside, whatever stands before them and at whatever offset they are.

The fingerprint is the SIZE least names of the phrases of the top LEVELS levels (of those with at least one whole
phrase), and the likeness of two fingerprints is their estimated Jaccard index: the share of the SIZE least names of the
union that both have.  A text too short for a phrase is one phrase.

Cases: null is the empty text, whose fingerprint is empty; two empty fingerprints have likeness 1, an empty one and
another 0; rows with one doc_id follow each other in the order of their texts' hashes; a single document is its own
next; a very long text is parsed whole, in a batch of its own; an empty table gives an empty result; a row without doc_id comes first; other columns are ignored.
A fingerprint depends on its text alone, whatever texts are parsed in the same batch.
"""

from __future__ import annotations

import hashlib
import json
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, MIX_A, U64, mix, parallelism

SIZE, LEVELS, FIRST = 64, 3, 2
#: Bits of a code point, and the longest run whose length fits above them in a name of 32 bits.
POINT_BITS, MOST_SHORT = 21, 1 << 11
#: Bytes of text in a range of doc_id, about; there are twice as many ranges as shuffle partitions at least.
RANGE_BYTES = 128 << 20
#: Least names of the phrases of level FIRST to FIRST + LEVELS - 1 (level 1 phrases have two to five code points).
LOWEST = np.zeros(1 << 16, np.uint8)
for _bit in range(15, -1, -1):
    LOWEST[(np.arange(1 << 16) >> _bit) & 1 == 1] = _bit


def lowest_bit(x: np.ndarray) -> np.ndarray:
    """Number of the lowest set bit of each non-zero number."""
    low = x.astype(np.uint16)
    out = LOWEST[low]
    at = np.flatnonzero(low == 0)
    for shift in range(16, 8 * x.dtype.itemsize, 16):
        if not len(at):
            break
        part = (x[at] >> x.dtype.type(shift)).astype(np.uint16)
        out[at] = LOWEST[part] + shift
        at = at[part == 0]
    return out


def toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels under 8 or so, different for neighbours; a text's first name is compared with its own complement."""
    differ = np.empty_like(names)
    differ[1:] = names[1:] ^ names[:-1]
    differ[first] = ~names.dtype.type(0)
    low = lowest_bit(differ)
    label = 2 * low + ((names >> low.astype(names.dtype)) & names.dtype.type(1)).astype(np.uint8)
    for _ in range(2):
        apart = np.empty_like(label)
        apart[1:] = label[1:] ^ label[:-1]
        apart[first] = 1
        low = LOWEST[apart]
        label = 2 * low + ((label >> low) & 1)
    return label


def parse(names: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level's names, and where each text's begin among them."""
    if not len(names):
        return names.astype(np.uint64), off
    new = np.empty(len(names), bool)
    new[0], new[1:] = True, names[1:] != names[:-1]
    new[off[:-1][np.diff(off) > 0]] = True
    start = np.flatnonzero(new)
    if len(start) < len(names):  # a run and its length are one name
        run = np.diff(np.append(start, len(names)))
        off = np.searchsorted(start, off)
        points, names = names.dtype == np.uint32, names[start]
        if points:  # above the code point's bits: neighbours differ as their code points do
            names = names.astype(np.uint64) if int(run.max()) > MOST_SHORT else names
            names = names | (run - 1).astype(names.dtype) << names.dtype.type(POINT_BITS)
        else:
            long = np.flatnonzero(run > 1)
            names[long] = mix(names[long] ^ run[long].astype(np.uint64) * GOLDEN)
    n, first = len(names), off[:-1][np.diff(off) > 0]
    label = toss(names, first)
    begin = np.zeros(n, bool)
    if n > 2:
        up = label[1:] > label[:-1]
        begin[1:-1] = up[:-1] & (label[1:-1] > label[2:])
    last = np.append(first[1:], n) - 1
    begin[last] = False
    second = first + 1
    begin[second[second < n]] = False  # a phrase has two names at least where the text has
    begin[first] = True
    at = np.flatnonzero(begin)
    size = np.diff(np.append(at, n))
    name, more = names[at].astype(np.uint64) * GOLDEN + size.astype(np.uint64), np.arange(len(at))
    for j in range(1, int(size.max())):
        more = more[size[more] > j]
        value = (name[more] ^ names[at[more] + j].astype(np.uint64)) * MIX_A
        name[more] = value ^ (value >> U64(29))
    return mix(name), np.searchsorted(at, off)


def fingerprints(points: np.ndarray, off: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """The least names of the phrases of each text, sorted."""
    n, names, ends, keys = len(off) - 1, points, off, []
    done = np.zeros(n, bool)
    for level in range(1, FIRST + LEVELS):
        names, ends = parse(names, ends)
        count = np.diff(ends)
        # a text that is one phrase already keeps that name, so that short texts have a fingerprint too
        use = np.repeat(np.full(n, level >= FIRST) | ((count == 1) & ~done), count)
        done |= count == 1
        own = np.repeat(np.arange(n, dtype=np.uint64), count)
        keys.append(((own << U64(48)) | (names >> U64(16)))[use])
    key = np.sort(np.concatenate(keys))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    cut = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << U64(48)).tolist()
    key &= U64((1 << 48) - 1)
    return [key[a : min(b, a + size)] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def likeness(a: list[int], b: list[int], size: int = SIZE) -> float:
    if not a or not b:
        return float(len(a) == len(b))
    left, right = set(a), set(b)
    union = sorted(left | right)[:size]
    return len(left & right & set(union)) / len(union)


def text_of(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), off


def _edited(batches, size: int):
    """Rows come in order; each is emitted when its next row is known.  A row marked own = false only closes a task's last."""
    held = None
    out: list = []

    def flush():
        texts, kept = [], list(out)
        out.clear()
        for _, text, following in kept:
            half = len(text) // 2
            texts += [text, text[: len(text) - half] + following[:half], following]
        prints = []
        i = 0
        while i < len(texts):  # a slice of a few million code points at a time
            j, total = i, 0
            while j < len(texts) and (j == i or total + len(texts[j]) <= 1_500_000 and j - i < 60_000):
                total += len(texts[j])
                j += 1
            # a text that follows is mostly the next row's own
            own = {t: k for k, t in enumerate(dict.fromkeys(texts[i:j]))}
            found = fingerprints(*_code_points(list(own)), size)
            prints += [found[own[t]] for t in texts[i:j]]
            i = j
        rows = []
        for k, (doc, text, _) in enumerate(kept):
            a, e, f = prints[3 * k : 3 * k + 3]
            names = [x.tolist() for x in (a, e, f)]
            rows.append((doc, len(text), hashlib.sha256(texts[3 * k + 1].encode("utf-8", "surrogatepass")).hexdigest(), text_of(a), text_of(e), likeness(names[0], names[1], size), likeness(names[0], names[2], size)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], columns)

    waiting = 0
    for b in batches:
        for doc, text, own in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("own").to_pylist(), strict=True):
            if held is not None:
                out.append((*held, text))
                waiting += len(held[1])
                if waiting > 1_000_000:
                    yield flush()
                    waiting = 0
            held = (doc, text) if own else None
    if out:
        yield flush()


def _numbers(values: list) -> Column:
    """A list of numbers as one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most doc_id, by binary search."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    bounds = _numbers(cuts)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= doc_id, at + step).otherwise(at))


def edited_fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that and to the next document's.

    The edited text has its last floor(n / 2) code points replaced by as many of the next document's first (or all).
    Documents are dealt out in ranges of doc_id; the first of a range also goes to the range before it, as the next of
    its last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # bounds of ranges of about equal size; what the driver holds is a few numbers for each range
    ids = rows.agg(F.min("doc_id"), F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    if not ids[1]:
        return rows.select("doc_id").mapInArrow(lambda it: iter(()), SCHEMA)
    parts = max(parallelism(spark) * 2, -(-ids[2] // RANGE_BYTES))
    cuts = rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if ids[0] is not None else []
    cuts = sorted({int(c) for c in cuts})
    ranged = rows.withColumn("part", _range_of(F.col("doc_id"), cuts))
    order = F.struct(F.col("doc_id"), F.xxhash64("text").alias("h"))
    firsts = sorted((r[0], r[1]) for r in ranged.groupBy("part").agg(F.min(order).alias("f")).collect())
    before = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}
    held = {p: (f["doc_id"], f["h"], before[p]) for p, f in firsts}
    of_part = lambda i: F.get(_numbers([held.get(p, (None,) * 3)[i] for p in range(firsts[-1][0] + 1)]), F.col("part"))
    marked = ranged.withColumn("_h", F.xxhash64("text")).withColumn("back", of_part(2).cast("int"))
    is_first = F.col("doc_id").eqNullSafe(of_part(0)) & (F.col("_h") == of_part(1))
    copies = F.when(is_first, F.array(F.struct(F.col("part").alias("to"), F.lit(True).alias("own")), F.struct(F.col("back").alias("to"), F.lit(False).alias("own")))).otherwise(F.array(F.struct(F.col("part").alias("to"), F.lit(True).alias("own"))))
    dealt = marked.select("doc_id", "text", "_h", F.explode(copies).alias("c")).select("doc_id", "text", "_h", "c.to", "c.own")
    placed = dealt.repartition(len(firsts), "to").sortWithinPartitions("to", F.col("own").desc(), F.col("doc_id").asc_nulls_first(), "_h")
    return placed.select("to", "doc_id", "text", "own").mapInArrow(partial(_edited, size=size), SCHEMA)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

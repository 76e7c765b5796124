"""Language identification by language-bitmask n-gram filters.

One Bloom filter per language, bit-sliced: slot i of the table holds a bit for each language, so the AND of an
n-gram's HASHES slots is the set of all languages that (perhaps) contain it.  A text's count for a language is the
popcount of its bit over the n-grams of the text; what the fill of that language's slice lets through by chance
is taken off: (hits - f * n) / (1 - f), f = fill ** HASHES.  The largest corrected count decides.  Any number of
languages is learned: the masks are 64 bits wide, and there is a table for each 64 languages.

N-grams are runs of GRAM bytes (and SHORT bytes, for texts with few) of the lower-cased text with every byte run that is no letter made one space, over the whole
text.  A filter is learned where its language's rows are, from PER_LANGUAGE documents of the language at most (of those
whose hash is below the share that gives SPARE times as many), an n-gram counting if LEAST documents of the language hold it; only
the filters, SLOTS bits a language, come to the driver.  Ties fall to the language first in code-point order.

Cases: a null text or one without a letter is `und` with score 0; a text with letters none of whose n-grams any language
has goes to the first language with score 0; null lang is never learned; without any row to learn from all texts are
`und`; repeated rows are learned as often as they occur and predicted alike; a very long text is read whole, in a slice of
its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import MIX_A, MIX_B, SLICE_BYTES, U64, buffers, mix, slices

GRAM, SHORT, HASHES, SLOTS = 5, 3, 2, 1 << 21
#: Texts with fewer n-grams than this are judged by those of SHORT bytes too.
FEW = 64
PER_LANGUAGE, LEAST, SPARE, WIDTH = 600, 2, 1.25, 64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(97, 123), *range(128, 256)]] = True


def lowered(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals U+00C0 to U+00DE in lower case."""
    low = LOWER[raw]
    if len(raw) > 1:
        two = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        low[1:][two] += 32
    return low


def grams(raw: np.ndarray, off: np.ndarray, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each n-gram and its text's number."""
    low = lowered(raw)
    low = np.where(LETTER[low], low, np.uint8(32))
    n, docs = len(low), len(off) - 1
    doc = np.repeat(np.arange(docs), np.diff(off))
    if n:  # one space for a run, and none at a text's start
        first = np.zeros(n, bool)
        first[off[:-1][np.diff(off) > 0]] = True
        blank = low == 32
        keep = ~(blank & (first | np.concatenate([[False], blank[:-1]])))
        low, doc = low[keep], doc[keep]
    n = len(low) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.zeros(n, np.uint64)
    for j in range(size):
        key = (key << U64(8)) | low[j : n + j]
    inside = doc[:n] == doc[size - 1 :]
    return mix((key[inside] + (U64(size) << U64(56))) * MIX_A), doc[:n][inside]


def slots_of(key: np.ndarray) -> list[np.ndarray]:
    return [((key * (MIX_B + U64(2 * j))) >> U64(43)).astype(np.int64) % SLOTS for j in range(HASHES)]


def language_bits(texts: list[bytes]) -> np.ndarray:
    """The slots that a language's documents fill, as packed bits."""
    off, seen, out = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), {GRAM: [], SHORT: []}, np.zeros(SLOTS, bool)
    raw, at = np.frombuffer(b"".join(texts), np.uint8), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE_BYTES, side="right")) - 1)
        for size, keys in seen.items():
            key, doc = grams(raw[off[at] : off[to]], off[at : to + 1] - off[at], size)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            keys.append(np.unique(key[new], return_counts=True))
        at = to
    for keys in seen.values():
        own, place = np.unique(np.concatenate([k for k, _ in keys]), return_inverse=True)
        count = np.bincount(place, weights=np.concatenate([c for _, c in keys]), minlength=len(own))
        for slot in slots_of(own[count >= min(LEAST, len(texts))]):
            out[slot] = True
    return np.packbits(out)


class Filters:
    def __init__(self, learned: dict[str, np.ndarray]):
        """learned: the packed bits of each language's slots."""
        self.languages, self.tables, self.chance = sorted(learned), [], np.zeros(len(learned))
        for first in range(0, len(learned), WIDTH):
            some = self.languages[first : first + WIDTH]
            kind = np.uint8 if len(some) <= 8 else np.uint64
            table = np.zeros(SLOTS, kind)
            for bit, language in enumerate(some):
                filled = np.unpackbits(np.frombuffer(learned[language], np.uint8), count=SLOTS)
                self.chance[first + bit] = (filled.sum() / SLOTS) ** HASHES
                table |= filled.astype(kind) << kind(bit)
            self.tables.append(table)

    def scores(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Share of each language in the corrected counts of each text."""
        key, doc = grams(raw, off)
        n, size = len(off) - 1, len(self.languages)
        few = np.bincount(doc, minlength=n) < FEW
        if few.any():
            part = np.repeat(few, np.diff(off))
            key3, doc3 = grams(raw[part], np.concatenate([[0], np.cumsum(np.where(few, np.diff(off), 0))]), SHORT)
            key, doc = np.concatenate([key, key3]), np.concatenate([doc, doc3])
        slots, total, counts = slots_of(key), np.bincount(doc, minlength=n).astype(float), np.zeros((n, size))
        for t, table in enumerate(self.tables):
            mask = np.full(len(key), ~table.dtype.type(0))
            for at in slots:
                mask &= table[at]
            for b in range(t * WIDTH, min(size, (t + 1) * WIDTH)):
                hits = np.bincount(doc[(mask >> table.dtype.type(b - t * WIDTH)) & table.dtype.type(1) == 1], minlength=n)
                counts[:, b] = np.maximum(0.0, (hits - self.chance[b] * total) / max(1e-9, 1 - self.chance[b]))
        return counts / np.maximum(1e-12, counts.sum(axis=1, keepdims=True))


def _predict(batches, filters: Filters):
    names = np.array([*filters.languages, "und"], dtype=object)
    for b in slices(batches):
        raw, off = buffers(b.column("text"))
        share = filters.scores(raw, off)
        letters = np.zeros(len(raw) + 1, np.int64)
        low = LOWER[raw]
        np.cumsum((low >= 97) & (low <= 122), out=letters[1:])
        some = letters[off[1:]] > letters[off[:-1]]
        data = raw.tobytes()
        for i in np.flatnonzero(~some):
            some[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].decode("utf-8", "replace"))
        best = share.argmax(axis=1) if len(filters.languages) else np.zeros(len(some), np.int64)
        top = share[np.arange(len(some)), best] if len(filters.languages) else np.zeros(len(some))
        # a text with letters has a language if any is learned; texts too short for an n-gram go to the first language with score 0
        known = some & (len(filters.languages) > 0)
        lang = names[np.where(known, best, len(filters.languages))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(np.where(known, top, 0.0), pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])


def fold(parts: int) -> Column:
    """crc32 of doc_id as text, modulo parts; of a null doc_id the empty text's."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def _learned(t: pa.Table) -> pa.Table:
    bits = language_bits([x.encode() for x in t.column("text").to_pylist()])
    return pa.table({"lang": t.column("lang").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Filters:
    """Filters of all languages, from a bounded sample of each one's rows where learn holds."""
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id", F.xxhash64("doc_id", F.lit(41)).alias("h"))
    # a number for each language, as the filters are; a join would deal all texts by language
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Filters({})
    share = F.from_json(F.lit(json.dumps({name: min(1.0, SPARE * per_language / n) for name, n in sizes.items()})), "map<string,double>")
    below = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) <= F.try_element_at(share, F.col("lang"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text"))
    chosen = known.filter(below).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language)
    rows = chosen.select("lang", "text").groupBy("lang").applyInArrow(_learned, "lang string, bits binary").collect()
    return Filters({r["lang"]: np.frombuffer(r["bits"], np.uint8) for r in rows})


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; held_out is docs' own column, or null."""
    out = F.col("held_out").cast("boolean") if "held_out" in docs.columns else F.lit(None).cast("boolean")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict, filters=filters), "doc_id long, held_out boolean, lang_pred string, score double")

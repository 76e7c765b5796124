"""Substring dedup by prefix-partitioned suffix trees.

A suffix starts at a word and is read as far as one window (13 words).  Suffixes are split by variable-length
word prefixes: a prefix that too many suffixes share is extended by another word, up to the whole window.  Each group
of prefixes is small enough for memory; there its suffixes are sorted, neighbours' common prefixes (LCP) give the
internal nodes of the subtree, and a node of window depth with leaves in two documents is a repeat.  Overlapping
windows of repeats join to the maximal repeated passages.

Suffixes without a repeat are dropped before that, exactly: each window has one anchor, the least hash of its
7-word grams (winnowing), equal windows have equal anchors, and an anchor seen in one document only has no repeated
window.  Exact copies are collapsed before; within a task equal windows are collapsed to that of the least doc_id, so
a passage that a third of all documents hold costs one row per task and no group is unbounded.

Cases: null text has no words; rows that share a doc_id are one document (where their texts differ, the one with the
least hash stands for it); a row without doc_id is no document and is left out; a text shorter than a window is kept; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Words, buffers, expand_texts, mix, pack, parallelism, slices, squeeze_texts, unpack

WINDOW, ANCHOR = 13, 7
#: Suffixes of a group at most, if a longer prefix can split it; prefixes counted have this many words at most.
GROUP, PREFIX = 250_000, 3
#: Share of all words from which a prefix is counted as frequent: no level can have more than 1 / FREQUENT of them.
FREQUENT = 1 / 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _read(batches):
    """doc_id, hash of the text, words, hash of the words joined, compressed text."""
    for b in slices(batches):
        raw, off = buffers(b.column("text"))
        data, rows = raw.tobytes(), []
        for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            words = data[i:j].split()
            rows.append((hashlib.blake2b(data[i:j], digest_size=16).digest(), len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
        h, n, sha = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(h, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(squeeze_texts(raw, off), pa.binary())], ["doc_id", "h", "n_words", "sha", "z"])


def _prefixes(batches):
    """Frequent prefixes of a slice, by number of words; level 0 has the number of words."""
    for b in slices(batches):
        w = Words(*buffers(b.column("text")))
        if not len(w):
            continue
        level, prefix, count = [0], [0], [len(w)]
        for k in range(1, PREFIX + 1):
            g, ok = w.grams(k)
            g, c = np.unique(g[ok], return_counts=True)
            often = c >= max(2, len(w) * FREQUENT / 4)
            level += [k] * int(often.sum())
            prefix += g[often].view(np.int64).tolist()
            count += c[often].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(prefix, pa.int64()), pa.array(count, pa.int64())], ["level", "prefix", "n"])


def prefix_plan(docs: DataFrame) -> tuple[int, list[np.ndarray]]:
    """Words in all, and for 1 to PREFIX words the prefixes too frequent for one group (4096 a level at most)."""
    counts = docs.select("text").mapInArrow(_prefixes, "level int, prefix long, n long").groupBy("level", "prefix").agg(F.sum("n").alias("n"))
    total = counts.filter("level = 0").agg(F.sum("n")).first()[0] or 0
    rows = counts.filter((F.col("level") > 0) & (F.col("n") > max(GROUP, total * FREQUENT))).collect()
    return total, [np.sort(np.array([r["prefix"] for r in rows if r["level"] == k], np.int64).view(np.uint64)) for k in range(1, PREFIX + 1)]


class _Slice:
    """Texts of a slice of rows with their windows and anchors."""

    def __init__(self, batch, window: int):
        self.id = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        w = self.words = Words(*expand_texts(batch.column("z")))
        k = min(ANCHOR, window)
        span = window - k + 1
        self.gram, _ = w.grams(k)
        ok = np.arange(len(w)) + window <= np.repeat(w.first[1:], w.counts)
        self.window = np.flatnonzero(ok)  # words at which a window starts
        least, self.anchor = self.gram[self.window], self.window.copy()
        for j in range(1, span):
            g = self.gram[self.window + j]
            less = g < least
            least = np.where(less, g, least)
            self.anchor[less] = self.window[less] + j
        self.doc = w.doc()

    def keyed(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hashes that tell equal values of different documents of the slice apart."""
        return mix(value ^ mix(self.doc[at].astype(np.uint64) + U64(1)))

    def given(self, batch, column: str) -> np.ndarray:
        """Words of the slice that the lists of positions in a column name."""
        out = []
        for d, blob in enumerate(batch.column(column).to_pylist()):
            out.append(unpack(blob)[0].astype(np.int64) + self.words.first[d])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def _dealt(bucket: np.ndarray, kind: str, *columns: np.ndarray):
    """Rows (bucket, kind, packed columns), one for each bucket."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for part in np.split(order, cut[1:]) if len(cut) else ():
        yield int(bucket[part[0]]), kind, pack(*(c[part] for c in columns))


def _sent(rows):
    rows = list(rows)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "kind", "blob"])


def _local(value: np.ndarray, ids: np.ndarray):
    """For each row whether its value is in a row of a lesser id, whether in one of another id; and a row of the least id for each value."""
    order = np.lexsort((ids, value))
    v, d = value[order], ids[order]
    cut = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
    run = np.diff(np.append(cut, len(v)))
    least, most = d[cut], d[cut + run - 1]
    later, shared = np.empty(len(v), bool), np.empty(len(v), bool)
    later[order] = d > np.repeat(least, run)
    shared[order] = np.repeat(least != most, run)
    return later, shared, order[cut]


def _anchors(batches, window: int, buckets: int):
    """Each anchor gram once a task and document; those seen in two documents of the task are known to repeat at once."""
    for b in slices(batches, "z", 2 << 20):
        s = _Slice(b, window)
        at = np.unique(s.anchor)
        _, once = np.unique(s.keyed(s.gram[at], at), return_index=True)
        at = at[once]
        gram, ids, pos = s.gram[at], s.id[s.doc[at]], (at - s.words.first[s.doc[at]]).astype(np.uint32)
        _, shared, first = _local(gram, ids)
        seen = first[shared[first]]
        single = ~shared
        rows = list(_dealt((gram[single] >> U64(40)).astype(np.int64) % buckets, "single", gram[single], ids[single], pos[single]))
        rows += _dealt((gram[seen] >> U64(40)).astype(np.int64) % buckets, "seen", gram[seen])
        rows += _dealt((mix(ids[shared].view(np.uint64)) >> U64(40)).astype(np.int64) % buckets, "known", ids[shared], pos[shared])
        yield from _sent(rows)


def _replies(ids: np.ndarray, pos: np.ndarray, buckets: int) -> pa.Table:
    """Positions for documents, dealt by document."""
    rows = list(_dealt((mix(ids.view(np.uint64)) >> U64(20)).astype(np.int64) % buckets, "", ids, pos))
    return pa.table({"dest": pa.array([r[0] for r in rows], pa.int32()), "blob": pa.array([r[2] for r in rows], pa.binary())})


def _gathered(t: pa.Table) -> pa.Table:
    """A row for each document: doc_id and all its positions, packed."""
    got = [unpack(blob) for blob in t.column("blob").to_pylist()]
    ids, pos = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])
    order = np.lexsort((pos, ids))
    ids, pos = ids[order], pos[order].astype(np.uint32)
    cut = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return pa.table({"doc_id": pa.array(ids[cut], pa.int64()), "at": pa.array([pack(p) for p in np.split(pos, cut[1:])], pa.binary())})


def _repeated(t: pa.Table, buckets: int) -> pa.Table:
    """Documents and anchors that repeat, from all anchors of a bucket."""
    got: dict[str, list] = {"single": [], "seen": [], "known": []}
    for kind, blob in zip(t.column("kind").to_pylist(), t.column("blob").to_pylist(), strict=True):
        got[kind].append(unpack(blob))
    join = lambda kind, i, like: np.concatenate([x[i] for x in got[kind]]) if got[kind] else np.zeros(0, like)
    gram, ids, pos = join("single", 0, np.uint64), join("single", 1, np.int64), join("single", 2, np.uint32)
    _, shared, _ = _local(gram, ids)
    seen = np.unique(join("seen", 0, np.uint64))
    if len(seen) and len(gram):
        shared |= seen[np.minimum(np.searchsorted(seen, gram), len(seen) - 1)] == gram
    return _replies(np.concatenate([ids[shared], join("known", 0, np.int64)]), np.concatenate([pos[shared], join("known", 1, np.uint32)]), buckets)


def _suffixes(batches, window: int, buckets: int, frequent: list):
    """Suffixes at windows whose anchor repeats, dealt by their variable-length prefixes."""
    for b in slices(batches, "z", 2 << 20):
        s = _Slice(b, window)
        w, hit = s.words, s.given(b, "hits")
        at = s.window[np.isin(s.keyed(s.gram[s.anchor], s.anchor), s.keyed(s.gram[hit], hit))]
        if not len(at):
            continue
        whole, _ = w.grams(window)
        _, once = np.unique(s.keyed(whole[at], at), return_index=True)
        at = at[once]
        ids, pos = s.id[s.doc[at]], (at - w.first[s.doc[at]]).astype(np.uint32)
        later, _, first = _local(whole[at], ids)
        rows = list(_dealt((mix(ids[later].view(np.uint64)) >> U64(40)).astype(np.int64) % buckets, "known", ids[later], pos[later]))
        at, ids, pos = at[first], ids[first], pos[first]
        prefix, short = np.zeros(len(at), np.uint64), np.ones(len(at), bool)
        for k in range(1, PREFIX + 1):
            if short.any():
                g = w.grams(min(k, window))[0][at]
                prefix = np.where(short, g, prefix)
                short &= np.isin(g, frequent[k - 1])
        prefix = np.where(short, whole[at], prefix)
        bucket = (prefix >> U64(40)).astype(np.int64) % buckets
        symbol = (w.hash >> U64(32)).astype(np.uint32)
        rows += _dealt(bucket, "suffix", ids, pos, *(symbol[at + j] for j in range(window)))
        yield from _sent(rows)


def _subtree(t: pa.Table, window: int, buckets: int) -> pa.Table:
    """Suffixes of a bucket that a lesser document has too: the leaves below the nodes of window depth."""
    ids, pos, symbols, known = [], [], [[] for _ in range(window)], []
    for kind, blob in zip(t.column("kind").to_pylist(), t.column("blob").to_pylist(), strict=True):
        a = unpack(blob)
        if kind == "known":
            known.append(a)
        else:
            ids.append(a[0])
            pos.append(a[1])
            for j in range(window):
                symbols[j].append(a[2 + j])
    out_id, out_pos = [x[0] for x in known], [x[1] for x in known]
    if ids:
        d, p, s = np.concatenate(ids), np.concatenate(pos), [np.concatenate(x) for x in symbols]
        order = np.lexsort([d, *s[::-1]])
        d, p = d[order], p[order]
        lcp, same = np.zeros(len(d), np.int32), np.ones(len(d), bool)
        same[0] = False
        for x in s:
            x = x[order]
            same[1:] &= x[1:] == x[:-1]
            lcp += same
        node = np.flatnonzero(lcp < window)
        least = np.repeat(d[node], np.diff(np.append(node, len(d))))
        out_id.append(d[d > least])
        out_pos.append(p[d > least])
    return _replies(np.concatenate(out_id) if out_id else np.zeros(0, np.int64), np.concatenate(out_pos) if out_pos else np.zeros(0, np.uint32), buckets)


def _kept(batches, window: int, spans: bool):
    """Words left of each text; with spans, the maximal repeated passages as word ranges."""
    for b in slices(batches, "z", 2 << 20):
        s = _Slice(b, window)
        w, hit = s.words, s.given(b, "gone")
        whole, _ = w.grams(window)
        at = s.window[np.isin(s.keyed(whole[s.window], s.window), s.keyed(whole[hit], hit))]
        edge = np.zeros(len(w) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        data, shas, removed, found = w.raw.tobytes(), [], [], []
        for d in range(len(s.id)):
            lo, hi = w.first[d], w.first[d + 1]
            mask = gone[lo:hi]
            words = data[w.off[d] : w.off[d + 1]].split()
            shas.append(hashlib.sha256(b" ".join(x for x, g in zip(words, mask.tolist(), strict=True) if not g)).hexdigest())
            removed.append(int(mask.sum()))
            if spans:
                turn = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                found.append([{"start": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)])
        columns, names = [pa.array(s.id, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "removed", "kept_sha"]
        if spans:
            columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
            names.append("passages")
        yield pa.RecordBatch.from_arrays(columns, names)


def substring_dedup(docs: DataFrame, window: int = WINDOW, passages: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document; passages adds the repeated word ranges that go."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total, frequent = prefix_plan(docs)
    buckets = max(parallelism(spark), -(-total // (8 * GROUP)))
    one = docs.mapInArrow(_read, "doc_id long, h binary, n_words long, sha string, z binary")
    base = one.filter("doc_id is not null and h is not null").groupBy("doc_id").agg(F.min(F.struct("h", "n_words", "sha", "z")).alias("r")).select("doc_id", "r.*")
    reps = base.groupBy("h").agg(F.min("doc_id").alias("rep"))
    texts = base.filter(F.col("n_words") >= window).join(reps.select(F.col("rep").alias("doc_id"), F.col("h").alias("rep_h")), "doc_id", "left_semi").select("doc_id", "z")
    hits = (
        texts.mapInArrow(partial(_anchors, window=window, buckets=buckets), "bucket int, kind string, blob binary")
        .groupBy("bucket").applyInArrow(lambda t: _repeated(t, buckets), "dest int, blob binary")
        .groupBy("dest").applyInArrow(_gathered, "doc_id long, at binary").withColumnRenamed("at", "hits")
    )
    gone = (
        texts.join(hits, "doc_id").select("doc_id", "z", "hits")
        .mapInArrow(partial(_suffixes, window=window, buckets=buckets, frequent=frequent), "bucket int, kind string, blob binary")
        .groupBy("bucket").applyInArrow(lambda t: _subtree(t, window, buckets), "dest int, blob binary")
        .groupBy("dest").applyInArrow(_gathered, "doc_id long, at binary").withColumnRenamed("at", "gone")
    )
    extra = ", passages array<struct<start: long, end: long>>" if passages else ""
    cut = texts.join(gone, "doc_id").select("doc_id", "z", "gone").mapInArrow(partial(_kept, window=window, spans=passages), f"doc_id long, removed long, kept_sha string{extra}")
    own = base.select("doc_id", "h", "n_words", "sha").join(cut, "doc_id", "left").join(reps, "h")
    copy = (F.col("doc_id") != F.col("rep")) & (F.col("n_words") >= window)
    out = [
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    ]
    if passages:
        whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
        out.append(F.when(copy, whole).otherwise(F.coalesce("passages", F.array().cast("array<struct<start:bigint,end:bigint>>"))).alias("passages"))
    return own.select(*out)

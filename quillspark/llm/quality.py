"""Quality classifier: supervised subword embeddings.

The features of a text are its words, its pairs of neighbouring words and the character n-grams inside its words (with
marks at a word's borders), hashed to BUCKETS vectors of DIM numbers each, learned with the classes.  A text is the mean of
its features' vectors, and beside it the mean over neighbouring words of the product, number by number, of their two
vectors, which tells how words follow each other where the pair itself has never been seen.  A softmax layer over
both gives the class probabilities, and numpy stochastic gradient descent fits it all.  As far as the layer is linear in a
bucket's vector, that is projected to its logit once, and scoring adds those up over the whole text.

It learns from SAMPLE labelled rows at most (those of least hash), which bounds the driver's work and memory.

Cases: a null or empty text has no features and gets the bias' score; null labels aren't learned; without both
classes to learn from the score is the share of label 1, or 1 if nothing is labelled; repeated rows score alike; rows of the sample
with equal hashes come in the order of doc_id, equal scores are not ordered; a very long text is scored whole, in a batch of its own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, IS_SPACE, MIX_A, U64, Words, buffers, slices

BUCKETS, DIM, GRAMS = 1 << 16, 16, (3, 4, 5)
SAMPLE, EPOCHS = 3_000, 5
#: A small sample is gone through more often: up to so many steps, and so many buckets in all.
STEPS, WORK = 6_000, 40_000_000
#: Learning rates: of the bucket vectors, and in shares of it those of the softmax layer over means and over products, and
#: of the vectors whose products are taken.
RATE, LAYER, TURN, FOLLOW = 2.5, 0.05, 4.0, 0.003
#: Bytes of text that are scored at once: the features of a text take many times its size.
PIECE = 1 << 18
SPEED = np.repeat(np.array([LAYER, TURN], np.float32), DIM)[:, None]
BORDER = 32


def characters(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points with one border before, between and behind words, and each one's text (a border's is that of the next word)."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
    size = np.diff(starts)
    own = np.repeat(np.arange(len(size), dtype=np.int32), size)
    blank = (points < 128) & IS_SPACE[np.minimum(points, 127)]
    points = np.insert(np.where(blank, BORDER, points), starts, BORDER)
    own = np.insert(own, starts, np.arange(len(off), dtype=np.int32))
    keep = np.append((points[:-1] != BORDER) | (points[1:] != BORDER), True)  # of a run of borders the last
    return points[keep], own[keep]


def bucket_of(key: np.ndarray) -> np.ndarray:
    return (key >> U64(40)).astype(np.int32) % np.int32(BUCKETS)


def features(w: Words):
    """Of each kind: the bucket of each feature and its text's number.  The first kind are the words."""
    own = w.doc()
    yield bucket_of(w.hash), own
    pairs, inside = w.grams(2)
    yield bucket_of(pairs[inside]), own[inside]
    points, text = characters(w.raw, w.off)
    border, key = points == BORDER, points.astype(np.uint64)
    for k in range(2, max(GRAMS) + 1):
        n = len(points) - k + 1
        if n < 1:
            break
        key = key[:n] * MIX_A + points[k - 1 :]
        free = ~border[1 : n + 1] if k == 3 else free[:n] & ~border[k - 2 : n + k - 2] if k > 3 else None
        if k in GRAMS:  # a border may only be the first or last
            yield bucket_of((key[free] + U64(k)) * GOLDEN), text[1 : n + 1][free]


class Text:
    """A text to learn from: its buckets with their counts, and its words' buckets in order."""

    def __init__(self, text: str):
        raw = np.frombuffer(text.encode(), np.uint8)
        kinds = [b for b, _ in features(Words(raw, np.array([0, len(raw)], np.int64)))]
        # as few bytes a feature as will do: the driver holds all texts of the sample like this
        small = np.uint16 if BUCKETS <= 1 << 16 else np.int32
        self.words = kinds[0].astype(small)
        order = np.argsort(self.words, kind="stable")
        self.order = order.astype(np.int32)
        self.cut = np.flatnonzero(np.diff(kinds[0][order], prepend=-1)).astype(np.int32)
        buckets, n = np.unique(np.concatenate(kinds), return_counts=True)
        self.buckets, self.counts = buckets.astype(small), n.astype(np.min_scalar_type(int(n.max(initial=1))))
        self.size = max(1, int(n.sum()))

    def step(self, embed: np.ndarray, follow: np.ndarray, out: np.ndarray, bias: np.ndarray, label: int, rate: float) -> None:
        """One step of gradient descent on this text."""
        rows, hidden, n = embed.take(self.buckets, axis=0), np.zeros(2 * DIM, np.float32), len(self.words)
        shares = self.counts.astype(np.float32) / np.float32(self.size)
        hidden[:DIM] = np.einsum("i,ij->j", shares, rows)  # not by BLAS, whose threads cost more than the sum
        if n > 1:
            e = follow.take(self.words, axis=0)
            hidden[DIM:] = np.einsum("ij,ij->j", e[1:], e[:-1]) / np.float32(n - 1)
        z = hidden @ out + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        pull = rate * (out @ p)
        out -= SPEED * rate * np.outer(hidden, p)
        bias -= LAYER * rate * p
        rows -= shares[:, None] * pull[:DIM]
        embed[self.buckets] = rows
        if n > 1:
            back = np.zeros_like(e)
            back[1:] = e[:-1]
            back[:-1] += e[1:]
            own = self.words[self.order[self.cut]]
            follow[own] -= np.add.reduceat(back.take(self.order, axis=0), self.cut) * (pull[DIM:] * np.float32(FOLLOW / (n - 1)))


class Model:
    """weight: what a bucket adds to the logit of label 1 against label 0; follow: the word vectors whose products are
    taken, scaled by the weights of those; bias: the rest."""

    def __init__(self, weight: np.ndarray, bias: float, follow: np.ndarray | None = None, turn: np.ndarray | None = None):
        self.weight, self.bias, self.follow, self.turn = weight.astype(np.float32), bias, follow, turn

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], seed: int = 7) -> Model:
        y = np.array(labels, np.int64)
        if len(set(labels)) < 2:
            return cls(np.zeros(BUCKETS), 30.0 if not labels or labels[0] else -30.0)
        known, random = [Text(t) for t in texts], np.random.default_rng(seed)
        embed, follow = (random.uniform(-side, side, (BUCKETS, DIM)).astype(np.float32) for side in (1 / DIM, (3 / DIM) ** 0.5))
        out, bias = np.zeros((2 * DIM, 2), np.float32), np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
        epochs = max(EPOCHS, min(-(-STEPS // len(y)), WORK // max(1, sum(len(t.buckets) for t in known))))
        steps, step = epochs * len(y), 0
        for _ in range(epochs):
            for i in random.permutation(len(y)):
                known[i].step(embed, follow, out, bias, y[i], np.float32(RATE * (1 - step / steps)))
                step += 1
        logits = embed @ out[:DIM]
        return cls(logits[:, 1] - logits[:, 0], float(bias[1] - bias[0]), follow, out[DIM:, 1] - out[DIM:, 0])

    def scores(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        n, w = len(off) - 1, Words(raw, off)
        total, size = np.zeros(n), np.zeros(n)
        for kind, (bucket, doc) in enumerate(features(w)):
            total += np.bincount(doc, weights=self.weight[bucket], minlength=n)
            size += np.bincount(doc, minlength=n)
            if kind == 0:
                words, own = bucket, doc
        logit = total / np.maximum(1, size) + self.bias
        if self.follow is not None and len(words) > 1:
            both = np.empty(len(words) - 1)
            for at in range(0, len(both), 1 << 16):
                e = self.follow[words[at : at + (1 << 16) + 1]]
                both[at : at + len(e) - 1] = (e[1:] * e[:-1]) @ self.turn
            inside = own[1:] == own[:-1]
            logit += np.bincount(own[1:][inside], weights=both[inside], minlength=n) / np.maximum(1, np.bincount(own, minlength=n) - 1)
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def _score(batches, model: Model):
    for b in slices(batches, most=PIECE):
        yield pa.RecordBatch.from_arrays([*(c for c, f in zip(b.columns, b.schema, strict=True) if f.name != "text"), pa.array(model.scores(*buffers(b.column("text"))), pa.float64())], [*(f.name for f in b.schema if f.name != "text"), "score"])


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, learn: Column, most: int) -> list:
    """(text, label) of labelled rows, `most` at most: those of least hash among all where learn holds."""
    chosen = labels.filter(learn & F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    ids = docs.sparkSession.createDataFrame([(r[0], r[1]) for r in chosen.collect()], "doc_id long, label int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label").collect()
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))][:most]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, "quality", learn, sample)
    texts, marks = [t for t, _ in rows], [y for _, y in rows]
    del rows
    return Model.fit(texts, marks)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep, and score: the probability of label 1."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(partial(_score, model=model), f"{kinds}, score double")


def _accepted(batches, model: Model, least: float):
    for b in slices(batches, most=PIECE):
        yield b.filter(pa.array(model.scores(*buffers(b.column("text"))) >= least))


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of docs, with all their columns, whose score is at least this; each row goes through Python once."""
    return docs.mapInArrow(partial(_accepted, model=model, least=least), docs.schema)

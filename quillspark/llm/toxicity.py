"""Toxicity by cumulative-link ordinal regression.

Severity has grades 0 to 3.  One weight vector over sparse text features is shared by all ordered thresholds:
P(grade > j) = sigmoid(x . w - t_j) with t_0 < t_1 < t_2, and the expected severity is the sum of these over j.  A
feature is the presence of a hashed word, or of a word's start of STARTS letters' bytes; words are runs of letters in
lower case.  L1 shrinkage keeps few weights, so a long clean text does not add up noise.

Labels say only toxic or not.  Grade 0 is not toxic; the toxic rows are graded by how many different telling words
they hold (words whose log odds between the two classes exceed TELLING), cut at the toxic rows' terciles.

It learns from SAMPLE labelled rows at most (those of least hash), which bounds the driver's work and memory.

Cases: a null or empty text has no features and gets the thresholds' own severity; null labels aren't learned; without
both classes to learn from all severities are 0 (3 if all are toxic); repeated rows score alike; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, GOLDEN, U64, buffers, mix, slices
from .langid import LETTER, lowered
from .quality import labelled_sample

BUCKETS, STARTS, GRADES = 1 << 18, (4, 5, 6, 7, 8), 4
SAMPLE, ROUNDS, SHRINK, TELLING, LEAST = 6_000, 250, 5e-5, 3.0, 3
#: A feature is used if its rates in the two classes differ by so many standard errors.
SPREAD = 4.0


def features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, text number and kind (0: whole word, else its start) of each feature of each word."""
    low = lowered(raw)
    letter, n = LETTER[low], len(low)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = np.flatnonzero(letter & (edge[:-1] | ~np.concatenate([[False], letter[:-1]])[:n]))
    end = np.flatnonzero(letter & (edge[1:] | ~np.concatenate([letter[1:], [False]])[:n])) + 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)
    doc = np.searchsorted(off, start, side="right") - 1
    size = end - start
    longest = max(STARTS)
    code = np.zeros(len(start), np.uint64)
    buckets, docs, kinds = [], [], []
    padded = np.concatenate([low, np.zeros(longest, np.uint8)])
    for j in range(longest):
        step = mix((code ^ BYTE_CODE[padded[start + j]]) * GOLDEN)
        code = np.where(size > j, step, code)
        if j + 1 in STARTS:
            some = size > j + 1
            buckets.append(code[some] + U64(j + 1))
            docs.append(doc[some])
            kinds.append(np.full(int(some.sum()), j + 1, np.int8))
    # words up to the longest start are hashed by then; the rest add up the bytes behind it
    tail = np.where(letter, BYTE_CODE[low], U64(0))
    at = np.arange(n, dtype=np.uint64) - np.repeat(start, np.diff(np.append(start, n))).astype(np.uint64) if start[0] == 0 else np.concatenate([np.zeros(start[0], np.uint64), np.arange(start[0], n, dtype=np.uint64) - np.repeat(start, np.diff(np.append(start, n))).astype(np.uint64)])
    tail = np.where(at >= U64(longest), tail * (at * GOLDEN | U64(1)), U64(0))
    whole = mix(code ^ np.add.reduceat(tail, start) ^ size.astype(np.uint64))
    buckets.append(whole)
    docs.append(doc)
    kinds.append(np.zeros(len(start), np.int8))
    bucket = (np.concatenate(buckets) >> U64(40)).astype(np.int64) % BUCKETS
    return bucket, np.concatenate(docs), np.concatenate(kinds)


def presence(raw: np.ndarray, off: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs, each once; of the kept buckets only."""
    bucket, doc, _ = features(raw, off)
    if kept is not None:
        some = kept[bucket]
        bucket, doc = bucket[some], doc[some]
    pair = np.unique(doc * BUCKETS + bucket)
    return pair // BUCKETS, pair % BUCKETS


def pieces(raw: np.ndarray, off: np.ndarray, most: int = 1 << 20):
    """Runs of texts of about `most` bytes each: number of the first, bytes, offsets.  It keeps the fit's memory small."""
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield at, raw[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    def __init__(self, weight: np.ndarray, cuts: np.ndarray):
        self.weight, self.cuts, self.flag = weight.astype(np.float32), cuts, 0.5
        self.kept = self.weight != 0

    @staticmethod
    def grades(texts: list[str], toxic: np.ndarray, off: np.ndarray, raw: np.ndarray) -> np.ndarray:
        found = []
        for at, r, o in pieces(raw, off):
            bucket, doc, kind = features(r, o)
            found.append(np.unique((doc[kind == 0] + at) * BUCKETS + bucket[kind == 0]))
        pair = np.concatenate(found)
        doc, bucket = pair // BUCKETS, pair % BUCKETS
        bad = np.bincount(bucket[toxic[doc] == 1], minlength=BUCKETS)
        good = np.bincount(bucket[toxic[doc] == 0], minlength=BUCKETS)
        odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((1 - toxic).sum() + 1))
        telling = (odds > TELLING) & (bad >= LEAST)
        number = np.bincount(doc[telling[bucket]], minlength=len(texts))
        low, high = np.quantile(number[toxic == 1], [1 / 3, 2 / 3])
        return np.where(toxic == 1, 1 + (number > low) + (number > max(high, low)), 0).astype(np.int64)

    @classmethod
    def fit(cls, texts: list[str], labels: list[int]) -> Model:
        toxic = np.array(labels, np.int64)
        if len(set(labels)) < 2:
            return cls(np.zeros(BUCKETS), np.full(GRADES - 1, -40.0 if labels and labels[0] else 40.0))
        data = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        grade = cls.grades(texts, toxic, off, raw)
        pairs = [(d + at, b) for at, r, o in pieces(raw, off) for d, b in [presence(r, o)]]
        doc, bucket = (np.concatenate([p[i] for p in pairs]).astype(np.int32) for i in (0, 1))
        del pairs
        bad = np.bincount(bucket[toxic[doc] == 1], minlength=BUCKETS) / toxic.sum()
        good = np.bincount(bucket[toxic[doc] == 0], minlength=BUCKETS) / (1 - toxic).sum()
        seen = np.bincount(bucket, minlength=BUCKETS)
        pool = (bad + good) / 2
        spread = np.abs(bad - good) / np.sqrt(np.maximum(pool * (1 - pool), 1e-9) * (1 / toxic.sum() + 1 / (1 - toxic).sum()))
        use = np.flatnonzero((seen >= LEAST) & (spread > SPREAD))
        place = np.full(BUCKETS, -1)
        place[use] = np.arange(len(use))
        some = place[bucket] >= 0
        doc, column = doc[some], place[bucket[some]]
        n, w = len(texts), np.zeros(len(use))
        share = np.array([(grade > j).mean() for j in range(GRADES - 1)]).clip(1e-3, 1 - 1e-3)
        cuts = -np.log(share / (1 - share))
        sum_w, sum_c = np.full(len(use), 1e-8), np.full(GRADES - 1, 1e-8)
        for turn in range(2 * ROUNDS):
            if turn == ROUNDS:  # the weights that shrinkage has left are fitted again without it
                live = w != 0
            eta = np.bincount(doc, weights=w[column], minlength=n)
            above = np.concatenate([np.ones((n, 1)), sigmoid(eta[:, None] - cuts), np.zeros((n, 1))], axis=1)
            hi, lo = above[np.arange(n), grade], above[np.arange(n), grade + 1]
            p = np.maximum(hi - lo, 1e-9)
            slope = above * (1 - above)
            own_hi, own_lo = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
            pull = -(own_hi - own_lo) / p  # of the loss by eta
            gw = np.bincount(column, weights=pull[doc], minlength=len(use)) / n
            gc = np.array([(own_hi[grade == j + 1] / p[grade == j + 1]).sum() - (own_lo[grade == j] / p[grade == j]).sum() for j in range(GRADES - 1)]) / n
            sum_w, sum_c = sum_w + gw**2, sum_c + gc**2
            rate = 0.3 / np.sqrt(sum_w)
            w = w - rate * gw
            w = np.sign(w) * np.maximum(0, np.abs(w) - rate * SHRINK) if turn < ROUNDS else np.where(live, w, 0)
            cuts = cuts - 0.1 / np.sqrt(sum_c) * gc
            cuts = np.maximum.accumulate(cuts + np.arange(GRADES - 1) * 1e-3) - np.arange(GRADES - 1) * 1e-3 + np.arange(GRADES - 1) * 1e-6
        weight = np.zeros(BUCKETS)
        weight[use] = w
        model = cls(weight, cuts)
        model.flag = model.calibrated(np.concatenate([model.above(r, o)[:, 0] for _, r, o in pieces(raw, off)]), toxic)
        return model

    @staticmethod
    def calibrated(score: np.ndarray, toxic: np.ndarray) -> float:
        """The score from which a text is toxic: with the fewest errors on the sample, in the middle of the widest such gap."""
        order = np.argsort(score, kind="stable")
        s, t = score[order], toxic[order]
        errors = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
        edges = np.concatenate([[0.0], s, [1.0]])
        gap = np.where(errors == errors.min(), np.diff(edges), -1)
        i = int(gap.argmax())
        return float((edges[i] + edges[i + 1]) / 2)

    def above(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """P(grade > j) of each text, for each threshold."""
        doc, bucket = presence(raw, off, self.kept)
        eta = np.bincount(doc, weights=self.weight[bucket], minlength=len(off) - 1)
        return sigmoid(eta[:, None] - self.cuts)


def _score(batches, model: Model):
    for b in slices(batches):
        p = model.above(*buffers(b.column("text")))
        own = [(c, f.name) for c, f in zip(b.columns, b.schema, strict=True) if f.name != "text"]
        # P(grade > j) falls with j, so the likeliest side of each threshold gives the median grade
        columns = [pa.array(p[:, 0], pa.float64()), pa.array(p.sum(axis=1), pa.float64()), pa.array((p > 0.5).sum(axis=1).astype(np.int32), pa.int32()), pa.array(p[:, 0] > model.flag, pa.bool_())]
        yield pa.RecordBatch.from_arrays([*(c for c, _ in own), *columns], [*(x for _, x in own), "score", "expected_severity", "grade", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, "toxic", F.lit(True), sample)
    return Model.fit([t for t, _ in rows], [y for _, y in rows])


def severity(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep, score (P(grade > 0)), expected_severity (0 to 3), grade (the median) and toxic (score
    above the flag calibrated on the sample)."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(partial(_score, model=model), f"{kinds}, score double, expected_severity double, grade int, toxic boolean")

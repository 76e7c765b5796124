"""Packing by vector bin packing: the dot-product heuristic under limits on tokens, segments and loss-bearing tokens.

Each task packs its own rows, so nothing is shuffled; it holds the sequence it fills and POOL waiting examples of
POOL_TOKENS tokens at most (or one longer).  Of the waiting examples that fit all three limits, that with the largest dot product of its demands and what is
left of the sequence goes in, each dimension weighed by its mean demand.  If none fits, the one whose head fills most of what is left
is cut, and its tail goes on waiting.  A sequence that the limits on segments or loss close before it is full ends at the
largest power of two, where no padding is needed, and what is behind that goes on waiting.  The last tokens of a task go into sequences of the powers of two they sum to.

An example's prompt are its leading tokens, which bear no loss.  Where documents are packed as they are
(`prompted`), the first line of a text of several lines is its prompt: a title that the rest is predicted from.

Cases: a null or empty text has the end id alone; rows are packed one by one, so repeated rows and ties change nothing
(the earliest waiting example wins a tie); a null id or null loss share is kept as null or taken as all tokens; a very
long text is cut into as many sequences as it takes; an
empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, buffers, slices, span_hash, word_spans

LENGTH, SEGMENTS, LOSS, END = 4096, 16, 3968, 2
POOL, POOL_TOKENS, VOCABULARY = 512, 1 << 20, 600_000
#: Bytes of text that are encoded at once: spans and hashes of a text take many times its size.
PIECE = 1 << 20
MARK = "\x01"
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
LETTERS, MARKS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[97:123] = True
MARKS[list(b".,!?;:*%$&#|")] = True


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts, looked up word by word (by 64-bit hash): the tokenizer never joins what white space parts."""

    kept: dict[str, Encoder] = {}

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.end = Tokenizer.from_file(path), end
        self.clear()

    @classmethod
    def at(cls, path: str, end: int) -> Encoder:
        if (path, end) not in cls.kept:
            cls.kept[path, end] = cls(path, end)
        return cls.kept[path, end]

    def clear(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and where their ids are
        self.flat, self.off = np.array([self.end], np.uint32), np.array([0, 1], np.int64)

    def learn(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; many are encoded at once, with a character between them that none of them has."""
        if any(MARK in w for w in words):
            return [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
        mark, out = self.model.encode(MARK, add_special_tokens=False).ids[0], []
        texts = [f" {MARK} ".join(words[i : i + 256]) for i in range(0, len(words), 256)]
        for t in texts:  # one by one, as an encoding takes many times its ids
            ids = self.model.encode_batch_fast([t], add_special_tokens=False)[0].ids
            at = [-1, *(i for i, x in enumerate(ids) if x == mark), len(ids)]
            out += [ids[i + 1 : j] for i, j in zip(at[:-1], at[1:], strict=True)]
        return out

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, the end id after each, and the offsets of the texts among them."""
        low = ASCII_LOWER[raw]  # as the tokenizer does first
        start, end = word_spans(low, off)
        if len(start):  # marks after a last letter are tokens of their own
            at = np.arange(len(low), dtype=np.int32 if len(low) < 1 << 31 else np.int64)
            at[MARKS[low] | IS_SPACE[low]] = -1
            last = np.maximum.reduceat(at, start)
            cut = last + 1
            cut = cut[(last >= start) & (cut < end) & LETTERS[low[last]]]
            start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        own, first, which = np.unique(span_hash(low, start, end), return_index=True, return_inverse=True)
        if len(self.known) + len(own) > VOCABULARY:
            self.clear()
        near = np.searchsorted(self.known, own)
        have = near < len(self.known)
        have[have] = self.known[near[have]] == own[have]
        place = np.zeros(len(own), np.int64)
        place[have] = self.place[near[have]]
        if (new := np.flatnonzero(~have)).size:
            data = low.tobytes()
            ids = self.learn([data[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            place[new] = np.arange(len(self.off) - 1, len(self.off) - 1 + len(new))
            self.known, self.place = np.insert(self.known, near[new], own[new]), np.insert(self.place, near[new], place[new])
            self.flat = np.concatenate([self.flat, np.array([x for y in ids for x in y], np.uint32)])
            self.off = np.concatenate([self.off, self.off[-1] + np.cumsum([len(x) for x in ids])])
        word = np.searchsorted(start, off)
        at = np.insert(place[which], word[1:], 0)  # the end id after each text
        size = self.off[at + 1] - self.off[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = self.flat[np.repeat(self.off[at] - ends[:-1], size) + np.arange(ends[-1])]
        return out, ends[word + np.arange(len(off))]


class Packer:
    """Fills one sequence at a time from a pool of waiting examples."""

    def __init__(self, length: int, segments: int, loss: int, first: int):
        self.limit = np.array([length, segments, loss], np.float64)
        self.wait: list[list] = []  # [id, ids, start, loss-bearing from, tokens of the example]
        self.need = np.zeros((0, 3))
        self.sum, self.seen, self.waiting = np.zeros(3), 0, 0
        self.next, self.rows = first, []
        self.open()

    def open(self) -> None:
        self.left, self.parts = self.limit.copy(), []

    def close(self) -> None:
        """Writes the open sequence; unless it is full it ends at a power of two, and the rest waits again."""
        n = sum(len(p[1]) for p in self.parts)
        size, at = n if n == self.limit[0] else 1 << (n.bit_length() - 1), 0
        for doc, ids, start, loss_from, total in self.parts:
            own = min(len(ids), size - at)
            if own:
                self.rows.append((doc, start, own, ids[:own].astype("<u4").tobytes(), total, self.next, at))
                at += own
            if own < len(ids):
                self.hold([doc, ids[own:], start + own, loss_from, total])
        self.next += 1
        self.open()

    def hold(self, example: list) -> None:
        self.wait.append(example)
        self.need = np.vstack([self.need, np.array(self.demand(example), np.float64)])
        self.waiting += len(example[1])

    @staticmethod
    def demand(example: list) -> tuple[int, int, int]:
        n = len(example[1])
        return n, 1, n - min(n, max(0, example[3] - example[2]))

    def add(self, doc, ids: np.ndarray, loss_from: int) -> None:
        total, start, length = len(ids), 0, int(self.limit[0])
        if self.limit[2] >= length:
            while total - start >= length:
                self.rows.append((doc, start, length, ids[start : start + length].astype("<u4").tobytes(), total, self.next, 0))
                self.next += 1
                start += length
        if start < total:
            self.hold([doc, ids[start:], start, loss_from, total])
            self.sum, self.seen = self.sum + self.need[-1], self.seen + 1
        while len(self.wait) >= POOL or (self.waiting > POOL_TOKENS and len(self.wait) > 1):
            self.step()

    def take(self, i: int) -> list:
        self.need = np.delete(self.need, i, axis=0)
        self.waiting -= len(self.wait[i][1])
        return self.wait.pop(i)

    def step(self) -> None:
        """Puts one example, or the head of one, into the open sequence."""
        fits = (self.need <= self.left).all(axis=1)
        if fits.any():
            weight = (self.sum / self.seen / self.limit) * (self.left / self.limit) / self.limit
            i = int(np.argmax(np.where(fits, self.need @ weight, -1.0)))
            self.left = self.left - self.need[i]
            self.parts.append(self.take(i))
        else:
            tokens, free = self.need[:, 0], self.need[:, 0] - self.need[:, 2]
            head = np.minimum(np.minimum(tokens, self.left[0]), free + self.left[2])
            i = int(np.argmax(head + tokens / (1 + tokens.max())))
            n = int(head[i]) if self.left[1] >= 1 else 0
            if n < 1:
                return self.close()
            doc, ids, start, loss_from, total = self.wait[i]
            self.parts.append([doc, ids[:n], start, loss_from, total])
            self.left = self.left - np.array(self.demand(self.parts[-1]), np.float64)
            if n < len(ids):
                self.wait[i] = [doc, ids[n:], start + n, loss_from, total]
                self.need[i] = self.demand(self.wait[i])
                self.waiting -= n
            else:
                self.take(i)
        if self.left[0] < 1 or self.left[1] < 1:
            self.close()
        return None

    def finish(self) -> None:
        while self.wait:
            self.step()
        while self.parts:  # the largest power of two first
            self.close()
            self.parts, self.wait, self.need, self.waiting = self.wait, [], np.zeros((0, 3)), 0

    def drain(self):
        rows, self.rows = self.rows, []
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def _pack(batches, path: str, end: int, length: int, segments: int, loss: int):
    encoder, packer = Encoder.at(path, end), Packer(length, segments, loss, TaskContext.get().partitionId() << 32)
    for b in slices(batches, most=PIECE):
        ids, off = encoder.encode(*buffers(b.column("text")))
        for doc, share, i, j in zip(b.column("doc_id").to_pylist(), b.column("prompt_share").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
            packer.add(doc, ids[i:j].copy(), int((share or 0.0) * (j - i)))
        yield from packer.drain()
    packer.finish()
    yield from packer.drain()


def prompted(docs: DataFrame) -> DataFrame:
    """doc_id, text and prompt_share: the share of the first line in a text of several lines, none in others."""
    first = F.instr("text", "\n")
    share = F.when(first.between(1, F.length("text") - 1), first / F.length("text")).otherwise(0.0)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("prompt_share", share)


def pack_examples(docs: DataFrame, length: int = LENGTH, segments: int = SEGMENTS, loss: int | None = None, prompt_share: str | None = None, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Pieces of examples with their place: doc_id, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset.

    prompt_share names a column with the share of leading tokens of a row that bear no loss; without one all do.
    """
    share = F.col(prompt_share).cast("double") if prompt_share else F.lit(None).cast("double")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), share.alias("prompt_share"))
    run = partial(_pack, path=tokenizer or tokenizer_path(), end=end, length=length, segments=segments, loss=length if loss is None else loss)
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

"""Shared kernels: whole-batch tokenising and hashing over Arrow buffers, packed arrays, shared tables.

Everything here works on whole texts.  A null text counts as empty.  Words are maximal runs of bytes other
than space and 0x09-0x0D, which in UTF-8 is the same as the code-point pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
GOLDEN, MIX_A, MIX_B = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
SLICE_BYTES = 4 << 20
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local one is set only where the session names none."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = f"file:///tmp/quillspark-checkpoints-{os.getpid()}"
        if spark.sparkContext.master.startswith("local["):
            spark.conf.set("spark.checkpoint.dir", where)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return where


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, so a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a fixed bijection of 64-bit words."""
    x = x ^ (x >> U64(30))
    x = x * MIX_A
    x = x ^ (x >> U64(27))
    x = x * MIX_B
    return x ^ (x >> U64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
WORD_BYTE = np.where(IS_SPACE, U64(0), BYTE_CODE)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and their offsets (n + 1)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about `most` bytes of text, or one longer text."""
    for batch in batches:
        _, off = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a batch of texts begin and end."""
    n, word = len(raw), ~IS_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    start, end = edge[:-1].copy(), edge[1:].copy()
    start[1:] |= ~word[:-1]
    end[:-1] |= ~word[1:]
    return np.flatnonzero(word & start), np.flatnonzero(word & end) + 1


class Words:
    """Words of a batch of texts: byte spans, a 64-bit hash each, and for each text its first word (`first`, n + 1)."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw, self.off = raw, off
        self.start, self.end = word_spans(raw, off)
        self.first = np.searchsorted(self.start, off)
        self.hash = span_hash(raw, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the k words from each word on, and whether they are all in its text."""
        n = len(self)
        out = np.zeros(n, dtype=np.uint64)
        if n >= k:
            c = np.zeros(n - k + 1, dtype=np.uint64)
            for j in range(k):
                c = (c ^ self.hash[j : n - k + 1 + j]) * MIX_A
                c ^= c >> U64(31)
            out[: n - k + 1] = mix(c)
        return out, np.arange(n) + k <= np.repeat(self.first[1:], self.counts)


def span_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; the spans are ordered, don't overlap, and between them is white space only."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    power = np.cumprod(np.concatenate([[U64(1)], np.full(int(length.max()), U64(0x5851F42D4C957F2D))]))
    gap = np.diff(np.append(start, len(raw)))
    at = np.arange(start[0], len(raw)) - np.repeat(start, gap)
    code = WORD_BYTE[raw[start[0] :]] * power[np.minimum(at, len(power) - 1)]
    return mix(np.add.reduceat(code, start - start[0]) + length.astype(np.uint64) * GOLDEN)


_squeeze, _expand = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte planes apart so that sorted numbers shrink."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        kind = a.dtype.str.encode().ljust(8)
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize) if len(a) else np.zeros((0, 1), np.uint8)
        parts += [kind, np.array([len(a)], np.int64).tobytes(), np.ascontiguousarray(planes.T).tobytes()]
    return _squeeze.compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = _expand.decompress(blob)
    count, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _ in range(count):
        kind, n = np.dtype(raw[at : at + 8].decode().strip()), int(np.frombuffer(raw, np.int64, 1, at + 8)[0])
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 16).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += 16 + n * kind.itemsize
    return out


def squeeze_texts(raw: np.ndarray, off: np.ndarray) -> list[bytes]:
    data = raw.tobytes()
    return [_squeeze.compress(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def expand_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = [_expand.decompress(x) if x else b"" for x in column.to_pylist()]
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=off[1:])
    return np.frombuffer(b"".join(texts), np.uint8), off

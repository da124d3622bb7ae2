"""Bloom filters sized from a count of their keys, built where the data is and merged block by block.

A filter is split into blocks; all probes of a hash fall into one block. Tasks send their blocks compressed, so that a
sparse one costs little; the blocks of one number meet in one task, which folds them one after another. A filter has
10 to 20 bits a key, for false positives of 1.7 to 0.3 %, up to KEYS keys: that bounds what the driver holds and
broadcasts (128 MB). For more keys there is no filter: everything is suspect, and whatever uses it confirms exactly
by a join anyway. Where the filters are the method itself, keys are dealt out to several by ranges of their hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import mix64, shuffle_partitions

#: log2 of the bits of a block.
BLOCK_LOG = 18
PROBES = 3
#: Keys that a filter is made for at most: 2^30 bits, or 128 MB.
KEYS = 100_000_000


def log_bits_for(keys: int) -> int:
    """log2 of the bits of a filter for so many keys: 10 a key, filled up to a power of two."""
    return max(BLOCK_LOG, (10 * max(keys, 1) - 1).bit_length())

PARTS = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("once", T.BinaryType()), T.StructField("twice", T.BinaryType())])


def positions(h: np.ndarray, log_bits: int) -> np.ndarray:
    """The bits of each hash, PROBES a row: a block from its top bits, and places in it from the rest."""
    block = (h >> np.uint64(64 - (log_bits - BLOCK_LOG))) if log_bits > BLOCK_LOG else np.zeros(len(h), np.uint64)
    mask = np.uint64((1 << BLOCK_LOG) - 1)
    base = block << np.uint64(BLOCK_LOG)
    out = np.empty((PROBES, len(h)), np.int64)
    for k in range(PROBES):
        place = h >> np.uint64(k * BLOCK_LOG) if k < 2 else ((h >> np.uint64(33)) * np.uint64(0x9E3779B1)) >> np.uint64(9)
        out[k] = base | (place & mask)
    return out


class Bloom:
    """A filter of 2^log_bits bits; `packed` are the bits of a finished one, and tell its size."""

    def __init__(self, log_bits: int = 0, packed: bytes | None = None):
        self.bits = np.zeros(1 << (log_bits - 3), np.uint8) if packed is None else np.frombuffer(packed, np.uint8)
        self.log_bits = log_bits if packed is None else len(packed).bit_length() + 2

    def add(self, h: np.ndarray) -> None:
        flat = positions(h, self.log_bits).ravel()
        np.bitwise_or.at(self.bits, flat >> 3, (1 << (flat & 7)).astype(np.uint8))

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in positions(h, self.log_bits):
            out &= ((self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & np.uint8(1)).astype(bool)
        return out

    def blocks(self) -> np.ndarray:
        return self.bits.reshape(-1, 1 << (min(BLOCK_LOG, self.log_bits) - 3))


def emit(once: Bloom, twice: Bloom | None) -> pa.RecordBatch:
    """The blocks that have bits, compressed."""
    a = once.blocks()
    b = twice.blocks() if twice is not None else None
    full = np.flatnonzero(a.any(axis=1))
    pack = lambda x: zlib.compress(x.tobytes(), 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(full.astype(np.int32)), pa.array([pack(a[i]) for i in full], pa.binary()), pa.array([pack(b[i]) if b is not None and b[i].any() else None for i in full], pa.binary())], names=PARTS.names
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their blocks: each block's bits seen in one task, and those seen in two or twice in one."""
    now, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], names=PARTS.names)

    for batch in batches:
        for block, a, b in zip(*(batch.column(c).to_pylist() for c in PARTS.names), strict=True):
            if block != now:
                if now is not None:
                    yield done()
                now, once, twice = block, None, None
            bits = np.frombuffer(zlib.decompress(a), np.uint8)
            more = np.frombuffer(zlib.decompress(b), np.uint8) if b is not None else np.zeros_like(bits)
            if once is None:
                once, twice = bits.copy(), more.copy()
            else:
                twice |= more | (once & bits)
                once |= bits
    if now is not None:
        yield done()


class Everything:
    """In place of a filter that would be too large: suspects all."""

    def has(self, h: np.ndarray) -> np.ndarray:
        return np.ones(len(h), bool)


def opened(packed: bytes | None) -> Bloom | Everything:
    return Everything() if packed is None else Bloom(packed=packed)


def merged(parts: DataFrame, log_bits: int, column: str) -> bytes:
    """The whole filter, on the driver: 2^log_bits bits, never more. Folded by as many tasks as a shuffle has."""
    blocks = 1 << max(0, log_bits - BLOCK_LOG)
    tasks = min(blocks, max(32, shuffle_partitions(parts.sparkSession)))
    rows = parts.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(_fold, PARTS).select("block", F.col(column).alias("bits"))
    size = 1 << (min(BLOCK_LOG, log_bits) - 3)
    out = np.zeros((blocks, size), np.uint8)
    for r in rows.collect():
        out[r["block"]] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out.tobytes()


def of_column(df: DataFrame, column: str, *, mix: bool = False, keys: int = KEYS) -> bytes | None:
    """The filter of a column of evenly spread 64-bit hashes, or with `mix` of any integers (smallest hashes of windows
    are not even); None for more than `keys` of them. df is read twice."""
    rows = df.where(F.col(column).isNotNull()).select(column)
    n = rows.count()
    if n > keys:
        return None
    log_bits = log_bits_for(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Bloom(log_bits)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            f.add(mix64(h) if mix else h)
        yield emit(f, None)

    return merged(rows.mapInArrow(run, PARTS), log_bits, "once")

"""What the operators of this subpackage share: durable intermediate tables, shipping, and byte-level text kernels.

The kernels work on the raw UTF-8 buffer of an Arrow string column, so that splitting, lower-casing and hashing
cost a few nanoseconds a byte instead of a Python object a word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.session import drop_scratch, durable, scratch, shared_dir, ship, shuffle_partitions, spread, stored, table

__all__ = ["drop_scratch", "durable", "scratch", "shared_dir", "ship", "shuffle_partitions", "spread", "stored", "table"]

#: Bytes of text that a kernel works on at once (one text at least).
SLICE_BYTES = 1 << 20


def range_cells(df: DataFrame, key: str, cells: int) -> tuple[list, F.Column]:
    """Boundaries that deal df's non-null keys evenly over at most `cells` ranges, and the column with a row's range.

    The boundaries are approximate quantiles of the key alone, so that the pass reads one column. Nulls get range 0.
    """
    cuts = df.agg(F.percentile_approx(key, [i / cells for i in range(1, cells)] or [0.5], 10_000).alias("q")).first()[0] or []
    cuts = sorted(set(cuts)) if cells > 1 else []
    return cuts, range_of(F.col(key), cuts)


def range_of(key: Column, cuts: list) -> Column:
    """How many of the ascending cuts a key reaches; 0 for null."""
    if not cuts:
        return F.lit(0)
    step = int(len(cuts) ** 0.5) + 1  # two short searches in place of a long one
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = lambda values: F.size(F.filter(values, lambda c: c <= key))
    coarse = below(F.array(*[F.lit(g[0]) for g in groups]))
    fine = below(F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), F.greatest(coarse, F.lit(1))))
    return F.when(key.isNull() | (coarse == 0), F.lit(0)).otherwise((coarse - 1) * step + fine).cast("int")


#: Rows of ids that are broadcast at most.
SMALL = 1 << 21


def small(ids: DataFrame, most: int = SMALL) -> DataFrame:
    """A table of one id a row for the small side of a join, stored: marked for broadcast if it has at most `most` rows;
    beyond that Spark's own join by shuffling takes over."""
    ids = stored(ids)
    return F.broadcast(ids) if ids.count() <= most else ids


# ---- Arrow buffers -------------------------------------------------------------------------------------------------


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold at most `most` bytes together, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = min(end, n)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; nulls are empty."""
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
IDENTITY = np.arange(256, dtype=np.uint8)
#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words (the splitmix64 finaliser); works in place on its own copy."""
    x = x.astype(np.uint64, copy=True)
    t = x >> np.uint64(30)
    x ^= t
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=t)
    x ^= t
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=t)
    x ^= t
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit words."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x5851F42D + 1)) | np.uint64(1)


_places: dict[int, np.ndarray] = {}


def places(n: int, seed: int) -> np.ndarray:
    if seed not in _places or len(_places[seed]) < n:
        _places[seed] = randoms(max(1024, 1 << (n - 1).bit_length()), seed + 101)
    return _places[seed]


class Words:
    """The words of a column of texts: byte spans, and how many each text has."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray, fold: np.ndarray = IDENTITY):
        self.data = data if fold is IDENTITY else fold[data]
        self.offsets = offsets
        n = len(data)
        mask = word[self.data]
        before = np.zeros(n + 1, bool)
        before[1:] = mask
        cut = offsets[offsets < n]
        before[cut] = False
        self.starts = np.flatnonzero(mask & ~before[:-1])
        after = np.zeros(n + 1, bool)
        after[:-1] = mask
        after[offsets] = False
        self.ends = np.flatnonzero(mask & ~after[1:]) + 1
        self.mask = mask
        self.first = np.searchsorted(self.starts, offsets)  # of each text's words; one more at the end
        self.counts = np.diff(self.first)

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word: a multilinear form of its bytes over fixed random words, then mixed."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lens = self.ends - self.starts
        at = np.cumsum(lens) - lens
        pos = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
        r = places(int(lens.max()), seed)
        v = randoms(256, seed)[self.data[self.mask]]
        v *= r[pos]
        return mix64(np.add.reduceat(v, at) + lens.astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """For each word the row of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def grams(self, hashes: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every run of n words of a text, and the word each run begins with."""
        total = len(hashes)
        if total < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        c = randoms(n, seed + 7)
        g = hashes[: total - n + 1] * c[0]
        for j in range(1, n):
            g += hashes[j : total - n + 1 + j] * c[j]
        ends = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(ends[: total - n + 1] - np.arange(total - n + 1) >= n)
        return mix64(g[at]), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))


class HashIndex:
    """Numbers 0, 1, .. for 64-bit hashes, in an open hash table that is probed for many at once. Zero is no hash.
    2^log_slots slots to begin with."""

    def __init__(self, log_slots: int):
        self.log_slots = log_slots
        self.keys = np.zeros(1 << log_slots, np.uint64)
        self.numbers = np.zeros(1 << log_slots, np.int32)
        self.size = 0

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.log_slots)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        slot = self._slot(h)
        got = self.keys[slot]
        out = np.where(got == h, self.numbers[slot], np.int32(-1))
        at = np.flatnonzero((got != h) & (got != 0))
        while len(at):
            slot[at] = (slot[at] + 1) & ((1 << self.log_slots) - 1)
            got = self.keys[slot[at]]
            same = got == h[at]
            out[at[same]] = self.numbers[slot[at[same]]]
            at = at[~same & (got != 0)]
        return out

    def _grow(self, size: int) -> None:
        """Room for `size` hashes at half load at most."""
        if 2 * size <= len(self.keys):
            return
        old, numbers = self.keys[self.keys != 0], self.numbers[self.keys != 0]
        self.log_slots = (2 * size - 1).bit_length()
        self.keys, self.numbers = np.zeros(1 << self.log_slots, np.uint64), np.zeros(1 << self.log_slots, np.int32)
        self._place(old, numbers)

    def add(self, h: np.ndarray) -> None:
        """Number distinct hashes that aren't in the table yet, in their order. The table grows as it must."""
        self._grow(self.size + len(h))
        self._place(h, np.arange(self.size, self.size + len(h), dtype=np.int32))
        self.size += len(h)

    def _place(self, h: np.ndarray, number: np.ndarray) -> None:
        slot = self._slot(h)
        left = np.arange(len(h))
        while len(left):
            free = self.keys[slot[left]] == 0
            self.keys[slot[left[free]]] = h[left[free]]  # of several for one slot the last stays
            done = self.keys[slot[left]] == h[left]
            self.numbers[slot[left[done]]] = number[left[done]]
            left = left[~done]
            slot[left] = (slot[left] + 1) & ((1 << self.log_slots) - 1)

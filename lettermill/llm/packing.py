"""Packing of tokenised documents into fixed-length sequences, by minimum bin slack.

Documents are cut into full sequences and a remainder. The remainders of a group of documents fill windows one after
another: the longest goes in first, then a subset-sum over bit sets finds the multiset of remaining lengths that comes
closest to the window's capacity, and walking back through the stages gives how many of each length to take. A window
that no multiset fills is topped up by cutting one more remainder. What is left at a group's end goes to sequences
whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import LOWER, HashIndex, Words, ship, slices, spread, table, utf8

WINDOW = 2048
#: Tokens that a packing group gathers before it is packed; a group never spans tasks.
GROUP_TOKENS = 1 << 20
#: Distinct units whose ids a worker remembers.
CACHE_UNITS = 1_500_000

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Classes of bytes: white space, ASCII letters, ASCII punctuation but the apostrophe, all others.
KINDS = np.full(256, 3, np.uint8)
KINDS[[0x20, 9, 10, 11, 12, 13]] = 0
KINDS[65:91] = KINDS[97:123] = 1
KINDS[33:48] = KINDS[58:65] = KINDS[91:97] = KINDS[123:127] = 2
KINDS[0x27] = 3


class Units(Words):
    """Stretches of a text that the tokenizer never joins: words between white space, and in these letters apart from
    punctuation. A boundary next to an apostrophe or a code point above 127 is left alone."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = KINDS[data]
        self.data, self.offsets = LOWER[data], offsets
        n = len(data)
        self.mask = kind > 0
        breaks = np.zeros(n + 1, bool)
        breaks[offsets] = True
        pair = kind[:-1] + kind[1:] * np.uint8(4)
        breaks[1:n] |= (pair == 9) | (pair == 6)  # a letter then punctuation, or the other way round
        before = np.zeros(n + 1, bool)
        before[1:] = self.mask
        self.starts = np.flatnonzero(self.mask & (~before[:-1] | breaks[:-1]))
        after = np.zeros(n + 1, bool)
        after[:-1] = self.mask
        self.ends = np.flatnonzero(self.mask & (~after[1:] | breaks[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)


class UnitTokenizer:
    """Ids of whole texts, unit by unit.

    The tokenizer lower-cases, and its rules never join characters across the bounds of Units, so a text's ids are
    those of its units in turn. Each distinct unit is encoded once and remembered by its 64-bit hash, up to a bound;
    the ids of a text are then gathered. Texts with the tokenizer's own marks in them are encoded as a whole.
    """

    def __init__(self, path: str, cache: int = CACHE_UNITS):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cache_most = cache
        self._reset()

    def _reset(self) -> None:
        self.index = HashIndex((2 * self.cache_most).bit_length())
        self.flat = np.zeros(1 << 20, np.uint16)
        self.at = np.zeros(1 << 18, np.int32)
        self.size = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        k = self.index.size
        while k + len(units) > len(self.at):
            self.at, self.size = np.concatenate([self.at, self.at * 0]), np.concatenate([self.size, self.size * 0])
        encode, each = self.tok.encode, []
        for unit in units:
            ids = encode(unit, add_special_tokens=False).ids
            each.append(len(ids))
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, self.flat * 0])
            self.flat[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        self.size[k : k + len(units)] = each
        self.at[k : k + len(units)] = self.used - np.cumsum(each[::-1])[::-1]
        self.index.add(hashes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each text has."""
        data, offsets = utf8(texts)
        units = Units(data, offsets)
        h = units.hashes(23) | np.uint64(1)
        found = self.index.find(h)
        if (missing := np.flatnonzero(found < 0)).size:
            _, first = np.unique(h[missing], return_index=True)
            new = missing[np.sort(first)]
            if self.index.size + len(new) > self.cache_most:
                self._reset()
                _, first = np.unique(h, return_index=True)
                new = np.sort(first)
            raw = units.data.tobytes()
            self._learn(h[new], [raw[a:b].decode() for a, b in zip(units.starts[new].tolist(), units.ends[new].tolist(), strict=True)])
            found = self.index.find(h)
        size = self.size[found].astype(np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.at[found] - (ends - size), size) + np.arange(total)]
        upto = np.concatenate([[0], ends])[units.first]
        counts = np.diff(upto)
        if b"<|" in (raw := data.tobytes()):
            parts = np.split(ids, upto[1:-1])
            for i in range(len(offsets) - 1):
                if b"<|" in (one := raw[offsets[i] : offsets[i + 1]]):
                    parts[i] = np.array(self.tok.encode(one.decode(), add_special_tokens=False).ids, np.uint16)
                    counts[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, counts


def closest_subset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (at most counts[n] of length n) whose sum is closest to capacity, not above it.

    Bit s of a stage's set says that the sum s can be had from the lengths so far; a length's copies enter by doubling,
    so that a count c takes log2(c) shifts. The stages are walked back for the counts taken. Longer lengths enter
    first: of equally close sums, one with few pieces is found.
    """
    full = (1 << (capacity + 1)) - 1
    sums, stages = 1, []
    for n in sorted((n for n in counts if 0 < n <= capacity), reverse=True):
        left, take = counts[n], 1
        while left > 0 and n * take <= capacity:
            take = min(take, left)
            stages.append((n, take, sums))
            sums |= (sums << (n * take)) & full
            left -= take
            take *= 2
        if sums >> capacity & 1:
            break
    best = sums.bit_length() - 1
    taken: dict[int, int] = {}
    for n, take, before in reversed(stages):
        if not before >> best & 1:
            taken[n] = taken.get(n, 0) + take
            best -= n * take
    return taken


def pack(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece. Each sequence is full, or its length a power of two."""
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    pool: dict[int, list[tuple[int, int]]] = {}
    for doc, n in enumerate(lengths):
        for start in range(0, n - window + 1, window):
            out.append((doc, start, window, sequence, 0))
            sequence += 1
        if rest := n % window:
            pool.setdefault(rest, []).append((doc, n - rest))
    left = sum(n * len(x) for n, x in pool.items())

    def take(n: int) -> tuple[int, int]:
        doc = pool[n].pop()
        if not pool[n]:
            del pool[n]
        return doc

    def put(n: int, piece: tuple[int, int], cut: int, offset: int) -> None:
        """The first `cut` tokens of a remainder into the open sequence; the rest returns to the pool."""
        out.append((*piece, cut, sequence, offset))
        if n > cut:
            pool.setdefault(n - cut, []).append((piece[0], piece[1] + cut))

    while left > 0:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        offset = 0
        if (longest := max(pool)) <= room:
            put(longest, take(longest), longest, 0)
            offset = longest
        for n, k in closest_subset({n: len(x) for n, x in pool.items()}, room - offset).items() if room > offset else ():
            for _ in range(k):
                put(n, take(n), n, offset)
                offset += n
        while offset < room:  # no multiset fills it: cut the shortest remainder that can
            n = min((n for n in pool if n > room - offset), default=None) or max(pool)
            cut = min(n, room - offset)
            put(n, take(n), cut, offset)
            offset += cut
        sequence += 1
    return out


_tokenizers: dict[str, UnitTokenizer] = {}


def packer(path: str | None, window: int, end_id: int, group_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        where = path or tokenizer_path()
        if where not in _tokenizers:
            _tokenizers[where] = UnitTokenizer(where)
        tok = _tokenizers[where]
        base = TaskContext.get().partitionId() << 33
        ids: list[np.ndarray] = []
        docs: list = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal base
            pieces = pack([len(x) for x in ids], window)
            crcs = [zlib.crc32(ids[d][s : s + n].tobytes()) for d, s, n, _, _ in pieces]
            d, s, n, q, o = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            q += base
            base = int(q.max()) + 1
            sizes = np.array([len(x) for x in ids], np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()).take(pa.array(d)), pa.array(s), pa.array(n), pa.array(crcs, pa.int64()), pa.array(sizes[d]), pa.array(q), pa.array(o)], names=PIECES.names
            )
            ids.clear()
            docs.clear()
            return out

        for batch in batches:
            for part in slices(batch):
                texts = part.column("text")
                flat, counts = tok.encode(texts.fill_null("") if texts.null_count else texts)
                ends = np.cumsum(counts)
                for doc, a, b in zip(part.column("doc_id").to_pylist(), ends - counts, ends, strict=True):
                    x = np.empty(b - a + 1, np.uint32)
                    x[:-1] = flat[a:b]
                    x[-1] = end_id
                    ids.append(x)
                    docs.append(doc)
                    held += len(x)
                    if held >= group_tokens:
                        held = 0
                        yield flush()
        if ids:
            yield flush()

    return run


def pack_documents(docs: DataFrame, *, path: str | None = None, window: int = WINDOW, end_id: int = 1, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all documents in sequences of `window` tokens; one pass, no shuffle.

    Every document ends with end_id, so that a null or empty text is that id alone. Repeated rows are packed one by
    one; a null doc_id stays null. Sequence ids are unique in the result and follow the input's partitions. Columns
    other than doc_id and text don't matter. An empty table gives no pieces. A document longer than group_tokens is a
    group of its own; its ids are held in memory, four bytes each. `path`: the tokenizer file, on every executor;
    unset, the public one that each machine has installed. Its vocabulary has at most 65,536 ids and its rules never
    join characters across ASCII white space.
    """
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(packer(path, window, end_id, group_tokens), PIECES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").cast("long"), "text"))


QUERIES = {"op10_packing": op10_packing}
ORACLE: dict[str, str] = {}

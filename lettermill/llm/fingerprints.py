"""Document fingerprints from prefix polynomial hashes.

Prefix arrays modulo a prime give the hash of any span of a text in constant time: two spans are equal when their
hashes are, and a binary search over lengths finds the longest common extension of two positions. A fingerprint holds
the hash of the whole text and the smallest hashes of its spans of WIDTH bytes, so that the likeness of two texts can
be told from their fingerprints alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import mix64, range_cells, ship, shuffle_partitions, spread, table

P = np.uint64((1 << 31) - 1)
BASES = (np.uint64(1_000_003_321 % ((1 << 31) - 1)), np.uint64(1_684_936_727))
#: Bytes of a span whose hash can enter a fingerprint, and how many do.
WIDTH = 32
KEPT = 64
#: Bytes of text that are fingerprinted at once.
BLOCK = 1 << 20


def _mod(x: np.ndarray) -> np.ndarray:
    """Modulo 2^31 - 1, of values below 2^62."""
    x = (x & P) + (x >> np.uint64(31))
    x = (x & P) + (x >> np.uint64(31))
    return np.where(x >= P, x - P, x)


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) at least."""
    have = _powers.get(int(base))
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = _mod(have[-1:] * base)
        have = np.concatenate([have, _mod(have * step)])
    _powers[int(base)] = have
    return have


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), int(P) - 2, int(P)))


class PrefixHash:
    """Prefix arrays of a buffer of bytes, one for each base."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        c = data.astype(np.uint64) + np.uint64(1)
        self.prefix = []
        for base in BASES:
            terms = c * powers(base, n)[:n]
            h = np.zeros(n + 1, np.uint64)
            step = 1 << 24  # sums of this many terms below 2^39 stay below 2^63
            for i in range(0, n, step):
                h[i + 1 : i + step + 1] = _mod(_mod(np.cumsum(terms[i : i + step])) + h[i])
            self.prefix.append(h)

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hashes of spans, wherever they lie: 62 bits from both bases."""
        out = np.zeros(len(starts), np.uint64)
        top = int(starts.max()) + 1 if len(starts) else 0
        for h, base in zip(self.prefix, BASES, strict=True):
            d = h[ends] + P - h[starts]
            out = (out << np.uint64(31)) | _mod(_mod(d) * powers(inverse(base), top)[starts])
        return out

    def equal(self, a: int, b: int, length: int) -> bool:
        one = lambda i: self.span(np.array([i]), np.array([i + length]))[0]
        return bool(one(a) == one(b))


def common_extension(x: PrefixHash, a: np.ndarray, y: PrefixHash, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How far the bytes from a in x and from b in y agree, at most `most`: for all pairs by one binary search."""
    lo, hi = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = x.span(a, a + mid) == y.span(b, b + mid)
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)
    return lo


def _spans(h: PrefixHash, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and mixed hash of every span of `width` bytes of the rows [starts, ends); a shorter row is one span."""
    n = np.where(ends > starts, np.maximum(ends - starts - width + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + starts[row]
    return row, at, mix64(h.span(at, np.minimum(at + width, ends[row])))


def _smallest(row: np.ndarray, h: np.ndarray, rows: int, kept: int) -> list[np.ndarray]:
    """The `kept` smallest distinct hashes of each row. Rows with many spans are first cut to their small ones; where
    repeats leave such a row short, all its spans are sorted."""
    n = np.bincount(row, minlength=rows)
    share = np.minimum(1.0, 4 * kept / np.maximum(n, 1))
    limit = np.where(share < 1, share * 2.0**64, 0).astype(np.uint64)
    few = (share >= 1)[row] | (h < limit[row])

    def sort(pick: np.ndarray) -> dict[int, np.ndarray]:
        r, x = row[pick], h[pick]
        order = np.lexsort((x, r))
        r, x = r[order], x[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
        r, x = r[new], x[new]
        cut = np.searchsorted(r, np.arange(rows + 1))
        return {i: x[cut[i] : min(cut[i + 1], cut[i] + kept)] for i in range(rows)}

    found = sort(few)
    if short := [i for i in range(rows) if share[i] < 1 and len(found[i]) < kept]:
        again = sort(np.isin(row, short))
        found |= {i: again[i] for i in short}
    return [found[i] for i in range(rows)]


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """The share of the smallest hashes of both that both have: an estimate of the Jaccard likeness of their spans."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:][both[1:] == both[:-1]]
    distinct = np.concatenate([both[:1], both[1:][both[1:] != both[:-1]]])[:kept]
    return float(np.searchsorted(twice, distinct[-1], "right")) / len(distinct)


def _text(whole: int, small: np.ndarray) -> str:
    return f"{whole:016x}:{small.astype('>u4').tobytes().hex()}"


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("common_prefix_bytes", T.LongType()),
    ]
)


def fingerprint_block(texts: list[str], following: str | None, ids: list) -> pa.RecordBatch:
    """Fingerprints of texts, each with its successor in the list; `following` comes after the last, and where it is
    None the last text only serves as successor."""
    n = len(texts)
    after = [*texts[1:], following if following is not None else ""]
    raw = [t.encode() for t in texts]
    sizes = np.array([len(x) for x in raw], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    edited, tails, kept_bytes = [], [], np.zeros(n, np.int64)
    for i, (t, nxt) in enumerate(zip(texts, after, strict=True)):
        k = len(t) // 3
        tail = nxt[:k].encode()
        keep = len(t[: len(t) - k].encode())
        kept_bytes[i] = keep
        edited.append(hashlib.sha256(raw[i][:keep] + tail).hexdigest())
        tails.append(raw[i][max(0, keep - WIDTH + 1) : keep] + tail)
    h = PrefixHash(np.frombuffer(b"".join(raw), np.uint8))
    tail_sizes = np.array([len(x) for x in tails], np.int64)
    tail_ends = np.cumsum(tail_sizes)
    tail_starts = tail_ends - tail_sizes
    g = PrefixHash(np.frombuffer(b"".join(tails), np.uint8))
    row, at, mixed = _spans(h, starts, ends, WIDTH)
    mine = _smallest(row, mixed, n, KEPT)
    # the edited text's spans: those that end before the edit, and those of its tail; a short text is all tail
    whole_tail = kept_bytes < WIDTH
    inside = (at + WIDTH <= starts[row] + kept_bytes[row]) & ~whole_tail[row]
    row2, _, mixed2 = _spans(g, tail_starts, tail_ends, WIDTH)
    lone = ~whole_tail & (tail_sizes < WIDTH)  # its tail is too short for a span of its own
    mixed2, row2 = mixed2[~lone[row2]], row2[~lone[row2]]
    theirs = _smallest(np.concatenate([row[inside], row2]), np.concatenate([mixed[inside], mixed2]), n, KEPT)
    whole = h.span(starts, ends)
    # hash of the edited text: its kept part, then what follows, moved to its place
    lead = np.minimum(kept_bytes, WIDTH - 1)
    head, rest = PrefixPair(h, starts, starts + kept_bytes), PrefixPair(g, tail_starts + lead, tail_ends)
    whole_edited = head.then(rest, kept_bytes)
    reach = np.minimum(tail_sizes - lead, sizes - kept_bytes)
    common = kept_bytes + common_extension(h, starts + kept_bytes, g, tail_starts + lead, reach)
    # hashes cut to 32 bits, as the fingerprint holds them
    mine = [(x >> np.uint64(32)).astype(np.uint32) for x in mine]
    theirs = [(x >> np.uint64(32)).astype(np.uint32) for x in theirs]
    if following is not None:
        f = following.encode()
        hf = PrefixHash(np.frombuffer(f, np.uint8))
        one = np.array([0], np.int64), np.array([len(f)], np.int64)
        r, _, m = _spans(hf, *one, WIDTH)
        last = [(x >> np.uint64(32)).astype(np.uint32) for x in _smallest(r, m, 1, KEPT)]
        nexts = [*mine[1:], *last]
        whole_next = np.concatenate([whole[1:], hf.span(*one)])
    else:
        nexts, whole_next = [*mine[1:], mine[0]], np.roll(whole, -1)
    m = n if following is not None else n - 1
    near = [1.0 if whole[i] == whole_edited[i] else likeness(mine[i], theirs[i]) for i in range(m)]
    near_next = [1.0 if whole[i] == whole_next[i] else likeness(mine[i], nexts[i]) for i in range(m)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:m], pa.int64()),
            pa.array([len(t) for t in texts[:m]], pa.int64()),
            pa.array(edited[:m], pa.string()),
            pa.array([_text(int(whole[i]), mine[i]) for i in range(m)], pa.string()),
            pa.array([_text(int(whole_edited[i]), theirs[i]) for i in range(m)], pa.string()),
            pa.array(near, pa.float64()),
            pa.array(near_next, pa.float64()),
            pa.array(common[:m], pa.int64()),
        ],
        names=SCHEMA.names,
    )


class PrefixPair:
    """The hashes of spans under each base, for joining spans end to end."""

    def __init__(self, h: PrefixHash, starts: np.ndarray, ends: np.ndarray):
        both = h.span(starts, ends)
        self.parts = [both >> np.uint64(31), both & P]

    def then(self, other: PrefixPair, shift: np.ndarray) -> np.ndarray:
        out = np.zeros(len(shift), np.uint64)
        for a, b, base in zip(self.parts, other.parts, BASES, strict=True):
            out = (out << np.uint64(31)) | _mod(a + _mod(b * powers(base, int(shift.max(initial=0)) + 1)[shift]))
        return out


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in descending order; the last one, flagged guest, is the head of the next range."""
    texts: list[str] = []
    ids: list = []
    held, done = 0, False
    for batch in batches:
        for doc, text, guest in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("guest").to_pylist(), strict=True):
            if done:
                continue
            texts.append(text or "")
            ids.append(doc)
            held += len(texts[-1])
            done = guest
            if (held >= BLOCK and len(texts) > 1) or guest:
                if len(texts) > 1:
                    yield fingerprint_block(texts[:-1], texts[-1], ids[:-1])
                texts, ids, held = texts[-1:], ids[-1:], len(texts[-1])


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, in which the last third of the code points gives way to
    the first as many of the next document (in descending doc_id; after the last comes the first).

    Null texts are empty. Null doc_ids come last, rows with the same doc_id by text; the successor of a lone row is
    itself. Columns other than doc_id and text don't matter. An empty table gives an empty result. Documents are dealt
    out by ranges of doc_id; only the head of each range is copied, to the range that precedes it.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    cells = shuffle_partitions(spark)
    _, cell = range_cells(docs, "doc_id", cells)
    heads = {r["c"]: r["head"] for r in docs.groupBy(cell.alias("c")).agg(F.max("doc_id").alias("head")).collect()}
    filled = sorted(heads)
    target = {c: (filled[i + 1] if i + 1 < len(filled) else filled[0]) for i, c in enumerate(filled)}
    top = (filled[-1] if filled else 0) + 1
    at = F.col("cell") + 1
    head = F.element_at(F.array(*[F.lit(heads.get(c)).cast("long") for c in range(top)]), at)
    goes = F.element_at(F.array(*[F.lit(target.get(c, 0)) for c in range(top)]), at)
    own = F.struct(F.col("cell").alias("cell"), F.lit(False).alias("guest"))
    more = F.struct(goes.alias("cell"), F.lit(True).alias("guest"))
    rows = docs.withColumn("cell", cell).withColumn("to", F.when(F.col("doc_id").eqNullSafe(head), F.array(own, more)).otherwise(F.array(own)))
    rows = rows.select("doc_id", "text", F.inline("to"))
    rows = rows.repartitionById(max(cells, top), F.col("cell")).sortWithinPartitions("guest", F.desc_nulls_last("doc_id"), F.coalesce("text", F.lit("")))
    return rows.select("doc_id", "text", "guest").mapInArrow(_run, SCHEMA)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(spread(table(spark, sf_dir, "documents")))


QUERIES = {"op5_fingerprints": op5_fingerprints}
ORACLE: dict[str, str] = {}

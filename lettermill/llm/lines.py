"""Removal of lines that recur across documents.

Each task fills two Bloom filters over the hashes of its long lines, once-seen and twice-seen; merged, the second one
suspects every line that more than one document may have. Only suspects are shuffled, as digests: they are counted
exactly, and those in enough documents stay in one document only, the one with the largest id. Texts don't move: the
repeated lines are broadcast to them while they are few; beyond that, only documents that lose a line are shuffled.

The filters are sized from the number of long lines. Where there are more than one pair of filters may hold, lines are
dealt out by ranges of their hash and each range has its own pair, so that filters never fill up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import LOWER, NOT_SPACE, drop_scratch, mix64, places, randoms, scratch, ship, slices, spread, stored, table, utf8
from .bloom import KEYS, PARTS, Bloom, emit, log_bits_for, merged, of_column, opened

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
#: Repeated lines that are broadcast at most (some 80 MB in a worker).
FEW = 1 << 19


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def key_digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


class Lines:
    """The long lines of a column of texts, stripped: byte spans, and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_chars: int):
        rows = len(offsets) - 1
        breaks = np.flatnonzero(data == 10)
        row_of = np.searchsorted(offsets, breaks, "right") - 1
        counts = 1 + np.bincount(row_of, minlength=rows)
        first = np.cumsum(counts) - counts
        total = int(counts.sum())
        lead = np.zeros(total, bool)
        lead[first] = True
        last = np.zeros(total, bool)
        last[first + counts - 1] = True
        starts, ends = np.empty(total, np.int64), np.empty(total, np.int64)
        starts[lead], starts[~lead] = offsets[:-1], breaks + 1
        ends[last], ends[~last] = offsets[1:], breaks
        row = np.repeat(np.arange(rows), counts)
        ink = np.flatnonzero(NOT_SPACE[data])
        if not len(ink):
            self.row = self.starts = self.ends = np.zeros(0, np.int64)
        else:
            a = np.searchsorted(ink, starts)
            b = np.searchsorted(ink, ends)
            some = b > a
            a, b = ink[a[some]], ink[b[some] - 1] + 1
            chars = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
            long = chars[b] - chars[a] >= min_chars
            self.row, self.starts, self.ends = row[some][long], a[long], b[long]
        self.data = data

    def hashes(self, seed: int = 3) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lens = self.ends - self.starts
        at = np.cumsum(lens) - lens
        pos = np.arange(int(lens.sum())) - np.repeat(at, lens)
        v = randoms(256, seed)[LOWER[self.data[pos + np.repeat(self.starts, lens)]]]
        v *= places(int(lens.max()), seed)[pos]
        return mix64(np.add.reduceat(v, at) + lens.astype(np.uint64))


class _Seen:
    """The two filters of a task."""

    def __init__(self, log_bits: int):
        self.once, self.twice = Bloom(log_bits), Bloom(log_bits)

    def add(self, h: np.ndarray, row: np.ndarray) -> None:
        """Lines and the documents they are in; those seen before in another one become twice-seen."""
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        same = h[1:] == h[:-1]
        fresh = np.ones(len(h), bool)
        fresh[1:] = ~same
        here = np.concatenate([[False], same & (row[1:] != row[:-1])]) if len(h) else fresh
        if here.any():
            self.twice.add(h[here])
        h = h[fresh]
        if (seen := self.once.has(h)).any():
            self.twice.add(h[seen])
        self.once.add(h)


def _fill(min_chars: int, log_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(log_bits)
        for batch in batches:
            for part in slices(batch):
                lines = Lines(*utf8(part.column("text")), min_chars)
                seen.add(lines.hashes(), lines.row)
        yield emit(seen.once, seen.twice)

    return run


def _digests(lines: Lines, pick: np.ndarray) -> dict[tuple[int, bytes], None]:
    """The distinct (row, digest) of some of the lines."""
    raw = lines.data.tobytes()
    return dict.fromkeys((int(r), key_digest(raw[a:b].lower())) for r, a, b in zip(lines.row[pick], lines.starts[pick].tolist(), lines.ends[pick].tolist(), strict=True))


def _suspects(shared, min_chars: int):
    """(key, doc) of the lines that may be in two documents or more; of all lines without a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = opened(shared.value)
        for batch in batches:
            for part in slices(batch):
                lines = Lines(*utf8(part.column("text")), min_chars)
                found = _digests(lines, np.flatnonzero(twice.has(lines.hashes())))
                if found:
                    rows, keys = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), part.column("doc").take(pa.array(rows))], names=["key", "doc"])

    return run


def _hash_of_key(col: pa.Array) -> np.ndarray:
    """The first 8 of a digest's 16 bytes, mixed."""
    data, _ = utf8(col)
    return mix64(np.ascontiguousarray(data.reshape(-1, 16)[:, :8]).view(np.uint64).ravel()) if len(col) else np.zeros(0, np.uint64)


def _fill_keys(log_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(log_bits)
        for batch in batches:
            h = _hash_of_key(batch.column(0))
            seen.add(h, np.arange(len(h)))  # a document brings a key once
        yield emit(seen.once, seen.twice)

    return run


def _suspect_keys(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = opened(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(twice.has(_hash_of_key(batch.column(0)))))

    return run


def _suspected(pair: DataFrame, schema: T.StructType, n: int, min_chars: int, keys: int) -> DataFrame:
    """(key, doc) of suspect lines, stored; n: how many long lines there are at most."""
    spark = pair.sparkSession
    if n <= keys:
        log_bits = log_bits_for(n)
        filled = merged(pair.select("text").mapInArrow(_fill(min_chars, log_bits), PARTS), log_bits, "twice")
        return stored(pair.mapInArrow(_suspects(spark.sparkContext.broadcast(filled), min_chars), schema))
    ranges = -(-n // keys)
    cell = F.pmod(F.xxhash64("key"), F.lit(ranges)).cast("int").alias("cell")
    dealt = scratch(spark)
    every = pair.mapInArrow(_suspects(spark.sparkContext.broadcast(None), min_chars), schema)
    every.select("*", cell).write.partitionBy("cell").option("compression", "zstd").parquet(dealt)
    kind = T.StructType([*schema.fields, T.StructField("cell", T.IntegerType())])
    out = scratch(spark)
    log_bits = log_bits_for(2 * keys)
    for i in range(ranges):
        rows = spark.read.schema(kind).parquet(dealt).where(F.col("cell") == i).select("key", "doc")
        filled = merged(rows.select("key").mapInArrow(_fill_keys(log_bits), PARTS), log_bits, "twice")
        shared = spark.sparkContext.broadcast(filled)
        rows.mapInArrow(_suspect_keys(shared), schema).write.mode("append").parquet(out)
        shared.unpersist()
    drop_scratch(spark, dealt)
    return spark.read.schema(schema).parquet(out)


def _result(names: list[str], part: pa.RecordBatch, lost: dict[int, set[bytes]], of: Callable[[bytes], bytes], keep_text: bool) -> pa.RecordBatch:
    """The rows with their counts and digests, where row r loses the lines x with of(x) in lost[r]."""
    n_lines, n_dropped, sums, texts = [], [], [], []
    for r, text in enumerate(part.column("text").to_pylist()):
        kept = text or ""
        n_lines.append(kept.count("\n") + 1)
        if gone := lost.get(r):
            stay = [x for x in kept.encode().split(b"\n") if of(line_key(x)) not in gone]
            n_dropped.append(n_lines[-1] - len(stay))
            kept = b"\n".join(stay).decode()
        else:
            n_dropped.append(0)
        sums.append(hashlib.sha256(kept.encode()).hexdigest())
        texts.append(kept if n_dropped[-1] else text)
    cols = [part.column(c) if c != "text" else pa.array(texts, pa.string()) for c in names]
    return pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sums, pa.string())], names=[*names, "n_lines", "n_dropped", "kept_sha256"])


def _apply_table(shared, key: str, names: list[str], min_chars: int, keep_text: bool):
    """Lines go by a table of the repeated ones and who keeps each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keepers = shared.value
        for batch in batches:
            for part in slices(batch):
                lost: dict[int, set[bytes]] = {}
                if keepers:
                    lines = Lines(*utf8(part.column("text")), min_chars)
                    raw, docs = lines.data.tobytes(), part.column(key).to_pylist()
                    for r, a, b in zip(lines.row.tolist(), lines.starts.tolist(), lines.ends.tolist(), strict=True):
                        line = raw[a:b].lower()
                        if docs[r] is not None and (keeper := keepers.get(key_digest(line))) is not None and docs[r] < keeper:
                            lost.setdefault(r, set()).add(line)
                yield _result(names, part, lost, bytes, keep_text)

    return run


def _apply_joined(names: list[str], keep_text: bool):
    """Lines go by the digests that were joined to their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lost = {r: set(keys) for r, keys in enumerate(part.column("__drop").to_pylist()) if keys}
                yield _result(names, part, lost, key_digest, keep_text)

    return run


def _pick(shared, wanted: bool):
    """Rows that the filter says may lose a line (wanted), or that lose none. Rows without __hash lose none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = opened(shared.value)
        for batch in batches:
            h = batch.column(batch.schema.get_field_index("__hash"))
            may = bloom.has(h.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & ~np.asarray(h.is_null())
            yield batch.filter(pa.array(may == wanted))

    return run


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep_text: bool = True, keys: int = KEYS, few: int = FEW) -> DataFrame:
    """Documents without the long lines that min_docs documents or more have; the document with the largest key keeps
    all its copies of such a line.

    A line's key is the line stripped of ASCII white space at both ends, with A-Z lower-cased; keys under min_chars
    code points never count. Every row is a document: rows that share a doc_id count one by one, and keep the line
    together if theirs is the largest. Rows without a doc_id count, but neither lose nor are left a line. A null or
    empty text is one empty line, and stays null. Adds n_lines (before), n_dropped and kept_sha256; columns of docs
    with these names, or that begin with two underscores, are replaced. With keep_text=False text is left out. An
    empty table gives an empty result. keys and few bound the filters and the table of repeated lines that are
    broadcast; the result is the same beyond them. A text is held in memory as a whole, at some 30 bytes a byte.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop(*[c for c in docs.columns if c in ("n_lines", "n_dropped", "kept_sha256") or c.startswith("__")])
    names = [c for c in docs.columns if keep_text or c != "text"]
    extra = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    out = T.StructType([docs.schema[c] for c in names] + extra)
    pair = docs.select(F.col(key).alias("doc"), "text")
    n_breaks = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    most = F.least(n_breaks + 1, F.floor(F.octet_length("text") / min_chars)) if min_chars else n_breaks + 1
    n = pair.agg(F.sum(most)).first()[0] or 0
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc", docs.schema[key].dataType)])
    found = _suspected(pair, schema, n, min_chars, keys)
    # written, so that a join with it has an exchange on either side, and a line of very many documents can be split
    repeated = stored(found.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper")).where((F.col("n") >= min_docs) & F.col("keeper").isNotNull()).drop("n"))
    if repeated.count() <= few:
        table_ = {bytes(r["key"]): r["keeper"] for r in repeated.collect()}
        return docs.mapInArrow(_apply_table(spark.sparkContext.broadcast(table_), key, names, min_chars, keep_text), out)
    drops = stored(found.join(repeated, "key").where(F.col("doc") < F.col("keeper")).groupBy("doc").agg(F.collect_set("key").alias("__drop")))
    shared = spark.sparkContext.broadcast(of_column(drops.select(F.xxhash64("doc").alias("h")), "h", keys=keys))
    hashed = docs.withColumn("__hash", F.when(F.col(key).isNotNull(), F.xxhash64(key)))
    whole = hashed.mapInArrow(_pick(shared, False), hashed.schema)
    whole = whole.select(*names, (F.coalesce(n_breaks, F.lit(0)) + 1).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
    cut = hashed.mapInArrow(_pick(shared, True), hashed.schema).drop("__hash")
    cut = cut.join(drops.withColumnRenamed("doc", "__doc"), F.col(key) == F.col("__doc"), "left").drop("__doc")
    return whole.unionByName(cut.mapInArrow(_apply_joined(names, keep_text), out))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spread(table(spark, sf_dir, "documents")).select("doc_id", "text"), keep_text=False)


QUERIES = {"op3_lines": op3_lines}
ORACLE = {
    "op3_lines": """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS ord FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.line, k.ord, (r.key IS NOT NULL AND k.doc_id < r.keeper) AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
}

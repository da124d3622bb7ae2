"""Near-duplicate clusters over word shingles: exact by an inverted index, or by banded MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettermill.functions.text import words
from lettermill.operators.graph import connected_components
from lettermill.session import ship, stored

#: Words or shingles that Python holds at a time, shingles that order others behind them (a broadcast of 32 MB), times
#: that one of these was seen at least, and ids that are broadcast.
CHUNK, MOST_COMMON, LEAST_COMMON, BROADCAST_IDS = 1 << 20, 1 << 21, 4, 1_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words."""
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def hash_sets(lists: pa.ListArray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's shingles, end to end, and how many each has, from the hashes of its
    words in their order: of its runs of k words, or of its words where there are fewer."""
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[at[0] : at[-1]]
    n = np.diff(at)
    begin = np.repeat(at[:-1] - at[0], n)
    place = np.arange(len(flat)) - begin
    size = np.repeat(n, n)
    row = np.repeat(np.arange(len(n)), n)
    whole = place <= size - k  # a run of k begins here
    run = np.zeros(int(whole.sum()), np.uint64)
    first = np.flatnonzero(whole)
    for j in range(k):
        run = (run + flat[first + j]) * np.uint64(0x9E3779B97F4A7C15)
    few = size < k
    values = np.concatenate([_mixed(run), _mixed(flat[few] ^ np.uint64(k))])
    rows = np.concatenate([row[whole], row[few]])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], np.bincount(rows[new], minlength=len(n))


def _word_hashes(df: DataFrame, key: str, text: str) -> DataFrame:
    hashed = F.transform(F.coalesce(words(F.col(text)), F.array().cast("array<string>")), lambda w: F.xxhash64(w))
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), hashed.alias("w")).where(F.size("w") > 0)


def _chunks(counts: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` items together: a row at least, or as many as fit."""
    ends, begin = np.cumsum(counts), 0
    while begin < len(counts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield begin, end
        begin = end


def _list(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _one_each(keys: pa.Array, digests: list[bytes]) -> list[int]:
    """For each digest the row of its smallest key."""
    first: dict[bytes, int] = {}
    for i in pc.sort_indices(keys).to_pylist():
        first.setdefault(digests[i], i)
    return list(first.values())


def _sets(df: DataFrame, key: str, text: str, k: int, whole: bool = True) -> DataFrame:
    """(k, digest, s, often, times) of every row with a key and words: a digest of its shingles' hashes, the hashes in
    their order, and, at one row of each chunk, those that several of the chunk's different sets have, and how many.
    Without `whole` only (k, digest)."""
    ship(df.sparkSession)
    names = ["k", "digest", "s", "often", "times"][: 5 if whole else 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in _chunks(np.diff(batch.column("w").offsets.to_numpy().astype(np.int64))):
                part = batch.slice(begin, end - begin)
                values, counts = hash_sets(part.column("w"), k)
                ends = np.cumsum(counts)
                digests = [hashlib.blake2b(values[b - n : b].tobytes(), digest_size=16).digest() for n, b in zip(counts, ends, strict=True)]
                out = [part.column("k"), pa.array(digests, pa.binary())]
                if whole:
                    different = np.zeros(len(counts), bool)
                    different[_one_each(part.column("k"), digests)] = True
                    often, times = np.unique(values[np.repeat(different, counts)], return_counts=True)
                    often, times = often[times > 1], times[times > 1]
                    at_first = np.where(np.arange(len(counts)) == 0, len(often), 0)
                    out += [_list(values.view(np.int64), counts), _list(often.view(np.int64), at_first), _list(times, at_first)]
                yield pa.RecordBatch.from_arrays(out, names=names)

    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("k", df.schema[key].dataType), T.StructField("digest", T.BinaryType()), *[T.StructField(n, longs) for n in ("s", "often", "times")]]
    return _word_hashes(df, key, text).mapInArrow(run, T.StructType(fields[: len(names)]))


def _members(sets: DataFrame, key: str) -> DataFrame:
    """(key, first) of stored sets' rows: the smallest key that has the same digest."""
    each = sets.select("k", "digest")
    heads = each.groupBy("digest").agg(F.min("k").alias("first"))
    return each.join(heads, "digest").select(F.col("k").alias(key), "first").distinct()


def equal_sets(df: DataFrame, *, key: str = "id", text: str = "text", k: int = 5) -> DataFrame:
    """(key, first) of every row with a key and words: the smallest key whose text has the same shingles. Only keys and
    digests of sets are written and shuffled."""
    return _members(stored(_sets(df, key, text, k, whole=False)), key)


def near_pairs(df: DataFrame, *, key: str = "id", text: str = "text", threshold: float = 0.8, k: int = 5) -> DataFrame:
    """(a, b, n_common, jaccard) of all pairs of different sets with Jaccard >= threshold, a < b.

    Texts with the same shingles are one class, and their smallest key stands for them all: equal_sets tells the
    others, so that n copies cost n rows. Texts without words and rows without a key pair with nothing; keys are meant
    to be unique. Prefix filter: two sets of sizes m >= n with the threshold share at least ceil(t * m) shingles, so
    that in any one order of all shingles the first n - ceil(t * n) + l of each have l in common; l is 1 and a
    twentieth of the smaller set. The order is that of hashes, with shingles that many texts have behind. Sets are then
    compared in full, as sets of 64-bit hashes; only those of candidates are shuffled.
    """
    return _pairs(stored(_sets(df, key, text, k)), threshold)


def _common(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that chunks of texts were seen to share, sorted, and how often: at most MOST_COMMON, the most frequent.
    Which ones these are decides how many candidates there are, and no more."""
    pairs = sets.where(F.size("often") > 0).select(F.explode(F.arrays_zip("often", "times")).alias("o"))
    seen = stored(pairs.groupBy(F.col("o.often").alias("h")).agg(F.sum("o.times").alias("n")).where(F.col("n") >= LEAST_COMMON))
    total, least = 0, None
    size = F.floor(F.log2("n") * 8)  # classes of numbers, some hundred at most
    for r in sorted(seen.groupBy(size.alias("c")).agg(F.count("*").alias("rows"), F.min("n").alias("n")).collect(), key=lambda r: -r["c"]):
        total += r["rows"]
        if total > MOST_COMMON:
            break
        least = r["n"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = seen.where(F.col("n") >= least).toArrow()
    h, n = rows.column("h").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def _prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(k, digest, n, l, h) of each set's first shingles; of a chunk's equal sets only the one with the smallest key."""
    common = sets.sparkSession.sparkContext.broadcast(_common(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = common.value
        for batch in batches:
            for begin, end in _chunks(np.diff(batch.column("s").offsets.to_numpy().astype(np.int64))):
                part = batch.slice(begin, end - begin)
                part = part.take(pa.array(_one_each(part.column("k"), part.column("digest").to_pylist())))
                s = part.column("s")
                at = s.offsets.to_numpy().astype(np.int64)
                values, n = s.values.to_numpy()[at[0] : at[-1]], np.diff(at)
                if len(known):
                    where = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    weight = np.where(known[where] == values, times[where], 0)
                    values = values[np.lexsort((weight, np.repeat(np.arange(len(n)), n)))]  # stable: hashes stay in order
                must = np.ceil(threshold * n - 1e-9).astype(np.int64)
                l = np.minimum(1 + n // 20, np.maximum(must, 1))
                keep = np.minimum(n - must + l, n)
                h = values[np.arange(len(values)) - np.repeat(at[:-1] - at[0], n) < np.repeat(keep, n)]
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("digest"), pa.array(n.astype(np.int32)), pa.array(l.astype(np.int32)), _list(h, keep)], names=["k", "digest", "n", "l", "h"])

    fields = [sets.schema["k"], sets.schema["digest"], T.StructField("n", T.IntegerType()), T.StructField("l", T.IntegerType()), T.StructField("h", T.ArrayType(T.LongType()))]
    return sets.select("k", "digest", "s").mapInArrow(run, T.StructType(fields)).withColumn("h", F.explode("h"))


def _pairs(sets: DataFrame, threshold: float) -> DataFrame:
    # one shuffle, by h: equal sets are one by their smallest key, and what meets nobody is out
    each = _prefixes(sets, threshold).repartition("h").groupBy("h", "digest").agg(F.min("k").alias("k"), F.first("n").alias("n"), F.first("l").alias("l"))
    same = Window.partitionBy("h")
    each = each.withColumn("lo", F.min("digest").over(same)).withColumn("hi", F.max("digest").over(same))
    met = stored(each.where("lo < hi").select("h", "digest", "k", "n", "l"))
    left, right = met.select("h", *[F.col(c).alias(f"{c}_a") for c in ("k", "digest", "n", "l")]), met.select("h", *[F.col(c).alias(f"{c}_b") for c in ("k", "digest", "n", "l")])
    near_size = (F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - F.lit(1e-9)) & (F.col("k_a") < F.col("k_b"))
    ends = ("k_a", "digest_a", "k_b", "digest_b")
    shared = left.join(right, "h").where(near_size).groupBy(*ends).agg(F.count("*").alias("c"), F.first(F.least("l_a", "l_b")).alias("l"))
    pairs = stored(shared.where("c >= l").select(*ends))
    ids = pairs.select(F.col("k_a").alias("k"), F.col("digest_a").alias("digest")).union(pairs.select("k_b", "digest_b")).distinct()
    ids = stored(ids)
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    full = stored(sets.select("k", "digest", "s").join(ids, ["k", "digest"], "left_semi"))
    full = full.dropDuplicates(["k", "digest"])
    left, right = full.select(F.col("k").alias("k_a"), F.col("digest").alias("digest_a"), F.col("s").alias("sa")), full.select(F.col("k").alias("k_b"), F.col("digest").alias("digest_b"), F.col("s").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(left, ["k_a", "digest_a"]).join(right, ["k_b", "digest_b"]).select(F.col("k_a").alias("a"), F.col("k_b").alias("b"), common.alias("n_common"), (F.size("sa") + F.size("sb")).alias("n_all"))
    return both.select("a", "b", "n_common", (F.col("n_common") / (F.col("n_all") - F.col("n_common"))).alias("jaccard")).where(F.col("jaccard") >= threshold)


@lru_cache
def band_shape(permutations: int, threshold: float) -> tuple[int, int]:
    """(bands, rows) within `permutations` whose collision curve errs least around the threshold: the areas of false
    positives below it and of false negatives above it, weighed alike."""
    x = (np.arange(4000) + 0.5) / 4000

    def err(b: int, r: int) -> float:
        p = 1 - (1 - x**r) ** b
        return float(np.where(x < threshold, p, 1 - p).mean())

    return min(((b, r) for b in range(1, permutations + 1) for r in range(1, permutations // b + 1)), key=lambda s: err(*s))


def lsh_bands(df: DataFrame, *, key: str = "id", text: str = "text", threshold: float = 0.8, permutations: int = 128, k: int = 5, seed: int = 42) -> DataFrame:
    """(key, band) rows: the bands of each text's MinHash signature. Texts without words have none."""
    ship(df.sparkSession)
    bands, rows = band_shape(permutations, threshold)
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, permutations, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
    weights = rng.integers(1, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                values, counts = hash_sets(part.column("w"), k)
                at = np.cumsum(counts) - counts  # every text has a word, and so a shingle
                least = np.stack([np.minimum.reduceat((values * x + y) >> np.uint64(1), at) for x, y in zip(a, b, strict=True)], axis=1)
                held = least[:, : bands * rows].reshape(-1, bands, rows)
                keys = _mixed((_mixed(held) * weights).sum(axis=2, dtype=np.uint64) + weights[:, 0])
                ends = np.arange(len(counts) + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64)))], names=["k", "bands"])

    schema = T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("bands", T.ArrayType(T.LongType()))])
    return _word_hashes(df, key, text).mapInArrow(run, schema).select(F.col("k").alias(key), F.explode("bands").alias("band"))


def near_clusters(df: DataFrame, *, key: str = "id", text: str = "text", method: str = "lsh", threshold: float = 0.8, permutations: int = 128, k: int = 5, seed: int = 42) -> DataFrame:
    """(key, cluster) for every row: the smallest key of its cluster, its own if it stands alone.

    `lsh` joins texts that agree in a band, unverified and so by chance; `exact` joins those with Jaccard >= threshold.
    Members of a band, and texts with equal sets, hang on their smallest key, so that n of them cost n edges.
    """
    if method == "exact":
        sets = stored(_sets(df, key, text, k))
        copies = _members(sets, key).where(F.col(key) > F.col("first")).select(F.col("first").alias("a"), F.col(key).alias("b"))
        edges = stored(_pairs(sets, threshold).select("a", "b").unionByName(copies))
    else:
        bands = stored(lsh_bands(df, key=key, text=text, threshold=threshold, permutations=permutations, k=k, seed=seed))
        heads = bands.groupBy("band").agg(F.min(key).alias("a"), F.max(key).alias("z")).where("a < z").drop("z")
        edges = bands.join(heads, "band").where(F.col(key) > F.col("a")).select("a", F.col(key).alias("b")).distinct()
    names = connected_components(edges, "a", "b").select(F.col("node").alias(key), F.col("component").alias("cluster"))
    return df.select(key).join(names, key, "left").select(key, F.coalesce("cluster", key).alias("cluster"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    """(cluster, n) of clusters with more than one member."""
    return clusters.groupBy("cluster").agg(F.count("*").alias("n")).where("n > 1")

"""Near-duplicate detection: fast similarity sketches, banding, exact verification.

A sketch has SIZE bins. In each round every shingle of a text is placed in one bin by a hash, and a bin keeps the
smallest value of the first round that reached it. Rounds go on until every bin is filled; after SIZE rounds a
shingle's bin is the round's number itself, so that after twice SIZE rounds none is empty, whatever the text. Bins
agree with the texts' Jaccard similarity as probability, concentrated as for independent ones.

Texts with equal sets are one class from the start. Classes that agree in a band of bins share a bucket. Each bucket
names a pivot; links between pivots and members are confirmed on full sets. Components of the links tell which buckets
still have members of several components. Of their pairs those are confirmed that share a rare shingle, or whose sizes
without rare shingles leave a link possible: no link is lost, and no group is expanded into all its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettermill.operators.graph import connected_components

from .base import LOWER, NOT_SPACE, Words, durable, list_array, mix64, randoms, ship, signed, slices, spread, stored, table, utf8
from .bloom import KEYS, of_column, opened

SIZE = 128
ROWS = 4
SHINGLE = 4
PERCENT = 80
#: A pair at the threshold shares no band with probability (1 - 0.8^4)^32 = 5e-8.
BANDS = SIZE // ROWS
#: Texts that may have a shingle for it to count as rare.
RARE = 10
SEED = 29


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, end to end, and how many each has. A text with fewer than n
    words is one shingle of all its words, one without words has none."""
    w = Words(*utf8(texts), NOT_SPACE, LOWER)
    h = w.hashes(SEED)
    row = w.text_of()
    grams, at = w.grams(h, n, SEED)
    rows, values = [row[at]], [grams]
    for k in range(1, n):
        g, a = w.grams(h, k, SEED + 1000 * k)
        only = w.counts[row[a]] == k
        rows.append(row[a][only])
        values.append(g[only])
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.argsort(rows, kind="stable")
    values = values[order]
    cut = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(texts)))])
    for i in np.flatnonzero(np.diff(cut) > 1):
        values[cut[i] : cut[i + 1]].sort()
    rows = rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], np.bincount(rows[new], minlength=len(texts))


def sketches(values: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """One row of `size` bins for each set; the row of an empty set stays unfilled. size is a power of two."""
    n = len(counts)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * size, empty, np.uint64)
    row = np.repeat(np.arange(n), counts)
    left = np.arange(len(values))
    rounds = randoms(2 * size, 77)
    shift, low = np.uint64(64 - size.bit_length() + 1), np.uint64((1 << 52) - 1)
    for i in range(2 * size):
        h = mix64(values[left] ^ rounds[i])
        base = row[left] * size
        at = base + (h >> shift).astype(np.int64) if i < size else base + (i - size)
        value = (h & low) | np.uint64(i << 52)
        np.minimum.at(out, at, value)
        open_ = (out.reshape(n, size) == empty).any(axis=1)
        left = left[open_[row[left]]]
        if not len(left):
            break
    return out.reshape(n, size)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of `rows` bins."""
    n, size = sketch.shape
    c = randoms(size, 91).reshape(size // rows, rows)
    return mix64((mix64(sketch.reshape(-1)).reshape(n, size // rows, rows) * c).sum(axis=2, dtype=np.uint64) + c[:, 0])


def _describe(shingle: int, size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values, counts = shingle_sets(part.column("text"), shingle)
                ends = np.cumsum(counts)
                digests = [hashlib.blake2b(values[b - n : b].tobytes(), digest_size=16).digest() if n else None for n, b in zip(counts, ends, strict=True)]
                keys = band_keys(sketches(values, counts, size), rows)
                some = counts > 0
                bands = list_array(signed(keys[some].reshape(-1)), np.where(some, keys.shape[1], 0))
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(counts.astype(np.int64)), pa.array(digests, pa.binary()), bands], names=["doc", "n_shingles", "digest", "bands"])

    return run


def _sets(shared, shingle: int):
    """The sets of the documents whose ids may be in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = opened(shared.value)
        for batch in batches:
            ids = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64)
            picked = batch.filter(pa.array(bloom.has(mix64(ids.view(np.uint64)))))
            for part in slices(picked):
                values, counts = shingle_sets(part.column("text"), shingle)
                yield pa.RecordBatch.from_arrays([part.column("node"), list_array(signed(values), counts)], names=["node", "shingles"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a_set"), batch.column("b_set")
            va, vb = a.flatten().to_numpy(), b.flatten().to_numpy()
            na, nb = (x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
            # numbered by pair, so that equal neighbours of one sorted whole are what the two sides share
            pair = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
            both = np.concatenate([va, vb])
            order = np.lexsort((both, pair))
            pair, both = pair[order], both[order]
            same = (both[1:] == both[:-1]) & (pair[1:] == pair[:-1])
            shared = np.bincount(pair[1:][same], minlength=len(na))
            linked = 100 * shared >= percent * (na + nb - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked))

    return run


PAIRS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, size: int = SIZE, rows: int = ROWS, keys: int = KEYS) -> DataFrame:
    """For every row of docs: key, n_shingles, component_id and kept.

    Sets hold the distinct shingles of `shingle` words (A-Z lower-cased, split at ASCII white space); two texts are
    linked with 100 * |intersection| >= percent * |union|. component_id is the smallest key reachable over links, and
    kept marks its row. Null, empty and wordless texts have no shingles and stand alone. Null keys are linked with
    nothing, their component is null, and they are kept. Keys are meant to be unique integers: rows that share one are
    one document in the links. Columns beyond key and text don't matter; an empty table gives none. Shingles are
    64-bit hashes, sets are compared in full. keys: what the broadcast filter of bucket members may hold; beyond it
    the sets of all documents travel, with the same result. A text is held in memory as a whole, at some 100 bytes a
    byte while its set is made.
    """
    spark = docs.sparkSession
    ship(spark)
    pair = docs.select(F.col(key).cast("long").alias("doc"), "text")
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    texts = durable(pair.mapInArrow(_describe(shingle, size, rows), schema))
    known = texts.where("digest is not null and doc is not null")
    classes = durable(known.groupBy("digest").agg(F.min("doc").alias("node"), F.min_by("bands", "doc").alias("bands")))
    spread = classes.select("node", F.explode("bands").alias("band"))
    # written, so that the join with it has an exchange on either side, and a band of very many texts can be split
    shared = stored(spread.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("most")).where("pivot < most").drop("most"))
    members = stored(spread.join(shared, "band"))
    nodes = members.select("node").distinct()
    component = _components(pair, members, nodes, shingle, percent, keys)
    names = classes.select("digest", "node")
    if component is not None:
        names = names.join(component, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    else:
        names = names.select("digest", F.col("node").alias("component"))
    # texts without a digest or a key have no class to be looked up
    none = texts.where("digest is null or doc is null").select("doc", "n_shingles", F.col("doc").alias("component"))
    out = texts.where("digest is not null and doc is not null").join(names, "digest", "left").select("doc", "n_shingles", "component").unionByName(none)
    out = out.select(F.col("doc").alias(key), "n_shingles", F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _components(pair: DataFrame, members: DataFrame, nodes: DataFrame, shingle: int, percent: int, keys: int) -> DataFrame | None:
    """The component of every linked node, over the links between members of all buckets; None without buckets."""
    if members.limit(1).count() == 0:
        return None
    spark = pair.sparkSession
    nodes = stored(nodes)
    broad = spark.sparkContext.broadcast(of_column(nodes, "node", mix=True, keys=keys))
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])
    sets = pair.where("doc is not null").withColumnRenamed("doc", "node").mapInArrow(_sets(broad, shingle), schema)
    sets = stored(sets.join(nodes, "node", "left_semi"))

    def confirm(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
        # a pair whose sizes alone rule it out needs no sets
        sizes = F.least(F.size("a_set"), F.size("b_set")) * 100 >= F.greatest(F.size("a_set"), F.size("b_set")) * percent
        return stored(pairs.join(left, "a").join(right, "b").where(sizes).select("a", "b", "a_set", "b_set").mapInArrow(_verify(percent), PAIRS))

    links = confirm(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    label = stored(connected_components(links, "a", "b"))
    # a bucket is open if members that weren't its pivot are in several components; it joins the group of its largest
    free = members.where("node <> pivot").select("band", "node").join(label, "node", "left").select("band", "node", F.coalesce("component", "node").alias("l"))
    parts = free.groupBy("band", "l").agg(F.count("*").alias("n"))
    # written, as the pivots are, so that a band of very many texts can be split in the join with it
    main = stored(parts.groupBy("band").agg(F.max_by("l", F.struct("n", "l")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts"))
    group = stored(free.join(main, "band").select("main", "node", "l").distinct())
    if group.limit(1).count() == 0:
        return label
    found = confirm(_open_pairs(group, sets, percent))
    # components of components
    ends = found.join(label.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    up = connected_components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct(), "a", "b").select(F.col("node").alias("old"), F.col("component").alias("new"))
    every = nodes.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return every.join(up, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))


def _open_pairs(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of a group, in different components, that may be linked; no pair that is linked is left out.

    A shingle is rare that at most RARE texts of all groups have. Two texts either share a rare shingle, and are found
    by it, or they share no more than what is left of the smaller one without its rare shingles. In the second case
    each has at least `percent` of its shingles left, and the smaller one at least `percent` of the larger one's size:
    what has less is out before any pairs are made, and pairs are made between neighbouring classes of size only.
    Several thousand texts of one size, with hardly a rare shingle, that differ by a little more than the threshold
    still cost a test of sizes for each of their pairs.
    """
    label = group.select("node", "l").distinct()
    spread = sets.join(label.select("node"), "node", "left_semi").select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    counts = spread.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") <= RARE)
    rare = stored(spread.select("node", "h").join(counts, "h"))
    near = rare.where("c > 1").select("node", "h").join(label, "node")
    other = near.select("h", F.col("node").alias("b"), F.col("l").alias("lb"))
    by_rare = near.join(other, "h").where("node < b and l <> lb").select(F.col("node").alias("a"), "b").distinct()
    size = sets.join(label.select("node"), "node", "left_semi").select("node", F.size("shingles").alias("n"))
    size = size.join(rare.groupBy("node").agg(F.count("*").alias("r")), "node", "left").select("node", F.col("n").cast("long").alias("n"), (F.col("n") - F.coalesce("r", F.lit(0))).alias("m"))
    # a text is in one group for each of its bands at most; a pair is taken up in the first that both are in
    size = size.join(group.groupBy("node").agg(F.collect_set("main").alias("mains")), "node")
    # classes a little wider than the ratio of linked sizes, so that rounding can't part neighbours further
    step = F.floor(F.log("n") / F.lit(1.0001 * max(math.log(100 / percent), 1e-3)))
    g = stored(group.join(size.where(F.col("m") * 100 >= F.col("n") * percent), "node").withColumn("step", step))
    x = g.where("l <> main").select("main", F.col("node").alias("a"), F.col("l").alias("la"), F.col("n").alias("na"), F.col("m").alias("ma"), F.col("mains").alias("mains_a"), F.explode(F.array(*[F.col("step") + i for i in (-1, 0, 1)])).alias("step"))
    # with s shared: 100 s >= percent (na + nb - s)
    may = F.least("ma", "m") * (100 + percent) >= (F.col("na") + F.col("n")) * percent
    once = F.array_min(F.array_intersect("mains_a", "mains")) == F.col("main")
    by_size = x.join(g, ["main", "step"]).where((F.col("la") != F.col("l")) & may & once).where((F.col("l") == F.col("main")) | (F.col("a") < F.col("node")))
    by_size = by_size.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
    return by_rare.union(by_size).distinct()


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spread(table(spark, sf_dir, "documents")))


QUERIES = {"op1_near_duplicates": op1_near_duplicates}
_W = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ORACLE = {
    "op1_near_duplicates": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_W} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
bth AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS node, b AS t FROM bth UNION SELECT r.node, bth.b FROM reach r JOIN bth ON r.t = bth.a),
comp AS (SELECT node, least(node, min(t)) AS component FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id, w.doc_id = coalesce(component, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.node = w.doc_id
"""
}

"""Benchmark decontamination by winnowing.

Of the hashes of all GRAM-word runs, the smallest in every stretch of WINDOW - GRAM + 1 is a fingerprint: two texts
that share WINDOW words share a fingerprint there. Documents keep those fingerprints that a Bloom filter of the
benchmark's may hold, each with a hash of the window that it stands for; these are joined with the benchmark's, so
that a common fingerprint brings the windows that may be equal and no others, and the hits are confirmed word by word
and extended over the whole document.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import ALNUM, LOWER, Words, durable, list_array, mix64, randoms, ship, signed, slices, spread, table, utf8
from .bloom import KEYS, of_column, opened

WINDOW = 8
GRAM = 4
SEED = 11
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def winnow(words: Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of every window of words, and the word each window begins with."""
    grams, at = words.grams(hashes, gram, SEED)
    span = window - gram + 1
    if len(grams) < span:
        return grams[:0], at[:0]
    least = grams[: len(grams) - span + 1].copy()
    for j in range(1, span):
        np.minimum(least, grams[j : len(grams) - span + 1 + j], out=least)
    whole = at[span - 1 :] - at[: len(at) - span + 1] == span - 1  # all in one text
    return least[whole], at[: len(at) - span + 1][whole]


def short_grams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return words.grams(hashes, n, SEED + 100 + n)


def wholes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each of the places."""
    c = randoms(n, SEED + 300 + n)
    return mix64((hashes[at[:, None] + np.arange(n)] * c).sum(axis=1, dtype=np.uint64))


def _bench(window: int, gram: int):
    """Rows (print, whole, item, window's words, number of words) of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = Words(*utf8(part.column("text")), ALNUM, LOWER)
                h = w.hashes(SEED)
                row = w.text_of()
                prints, at = winnow(w, h, window, gram)
                sizes, whole = np.full(len(at), window), wholes(h, at, window)
                for n in range(1, window):
                    p, a = short_grams(w, h, n)
                    only = w.counts[row[a]] == n
                    prints, at, sizes = np.concatenate([prints, p[only]]), np.concatenate([at, a[only]]), np.concatenate([sizes, np.full(int(only.sum()), n)])
                    whole = np.concatenate([whole, wholes(h, a[only], n)])
                raw = w.data.tobytes()
                text = [b" ".join(raw[s:e] for s, e in zip(w.starts[i : i + n].tolist(), w.ends[i : i + n].tolist(), strict=True)).decode() for i, n in zip(at.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(prints)), pa.array(signed(whole)), part.column("item").take(pa.array(row[at])), pa.array(text, pa.string()), pa.array(sizes.astype(np.int32))],
                    names=["print", "whole", "item", "window", "n"],
                )

    return run


PRINT = T.StructType([T.StructField("print", T.LongType()), T.StructField("whole", T.LongType())])


def _suspects(shared, window: int, gram: int, short: list[int]):
    """Every document's number of words, the fingerprints that the benchmark may hold, and its text if it has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = opened(shared.value)
        for batch in batches:
            for part in slices(batch):
                w = Words(*utf8(part.column("text")), ALNUM, LOWER)
                h = w.hashes(SEED)
                row = w.text_of()
                found = []
                for n, (prints, at) in [(window, winnow(w, h, window, gram)), *((n, short_grams(w, h, n)) for n in short)]:
                    fresh = np.ones(len(prints), bool)
                    fresh[1:] = prints[1:] != prints[:-1]  # neighbours mostly share theirs: each is looked up once
                    hit = bloom.has(mix64(prints[fresh]))[np.cumsum(fresh) - 1] if len(prints) else fresh
                    found.append((prints[hit], wholes(h, at[hit], n), row[at[hit]]))
                p, x, r = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.lexsort((x, p, r))
                p, x, r = p[order], x[order], r[order]
                new = np.ones(len(p), bool)
                new[1:] = (p[1:] != p[:-1]) | (x[1:] != x[:-1]) | (r[1:] != r[:-1])
                p, x, r = p[new], x[new], r[new]
                n = np.bincount(r, minlength=part.num_rows)
                text = part.column("text").take(pa.array(np.arange(len(n)), mask=n == 0))
                pairs = pa.StructArray.from_arrays([pa.array(signed(p)), pa.array(signed(x))], names=PRINT.names)
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc"), pa.array(w.counts.astype(np.int64)), list_array(pairs, n), text], names=["uid", "doc", "n_words", "prints", "text"]
                )

    return run


def spans_hit(words: list[bytes], windows: dict[int, dict[bytes, set]]) -> tuple[np.ndarray, set]:
    """Which words lie in an occurrence of a window, and the items of the windows that occur."""
    hit = np.zeros(len(words), bool)
    items: set = set()
    for n, known in windows.items():
        for i in range(len(words) - n + 1):
            if (found := known.get(b" ".join(words[i : i + n]))) is not None:
                hit[i : i + n] = True
                items |= found
    return hit, items


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, n_items, sums = [], [], []
        for text, cands in zip(batch.column("text").to_pylist(), batch.column("windows").to_pylist(), strict=True):
            hit, items = np.zeros(0, bool), set()
            if cands:
                windows: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
                for c in cands:
                    windows[c["n"]][c["window"].encode()].add(str(c["item"]))
                hit, items = spans_hit(words_of(text), {n: dict(x) for n, x in windows.items()})
            n_hit.append(int(hit.sum()))
            n_items.append(len(items))
            sums.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid"), batch.column("doc"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sums, pa.string())],
            names=["uid", "doc", "n_words", "n_hit", "n_items", "items_sha256"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", item: str = "item_id", window: int = WINDOW, gram: int = GRAM, keys: int = KEYS) -> DataFrame:
    """For every row of docs: key, n_words, n_hit (words in occurrences of benchmark windows), n_items (items with
    windows that occur) and items_sha256 (of their ids, sorted as strings, joined by commas).

    A window is `window` consecutive words of an item; an item with fewer words, but not none, is one window as a
    whole. Words are runs of digits, letters and code points above 127, A-Z lower-cased. Null and empty texts have no
    words; items without an id are left out; rows that repeat give a row each; columns beyond key and text don't
    matter; an empty table on either side gives no hits. Texts travel only for documents with a suspect fingerprint.
    keys: what the broadcast filter of fingerprints may hold; beyond it all fingerprints are joined, with the same
    result. A text is held in memory as a whole, at some 80 bytes a byte.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = benchmark.schema[item].dataType
    schema = T.StructType([*PRINT.fields, T.StructField("item", kind), T.StructField("window", T.StringType()), T.StructField("n", T.IntegerType())])
    bench = durable(benchmark.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), "text").mapInArrow(_bench(window, gram), schema).distinct())
    short = [r["n"] for r in bench.select("n").where(F.col("n") < window).distinct().collect()]
    shared = spark.sparkContext.broadcast(of_column(bench.select("print").distinct(), "print", mix=True, keys=keys))
    schema = T.StructType(
        [T.StructField("uid", T.LongType()), T.StructField("doc", docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("prints", T.ArrayType(PRINT)), T.StructField("text", T.StringType())]
    )
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).alias("doc"), "text")
    rows = durable(rows.mapInArrow(_suspects(shared, window, gram, sorted(short)), schema))
    prints = rows.select("uid", F.inline("prints"))
    cands = prints.join(bench, ["print", "whole"]).groupBy("uid").agg(F.collect_set(F.struct("item", "window", "n")).alias("windows"))
    joined = rows.drop("prints").join(cands, "uid", "left")
    out = T.StructType(
        [schema["uid"], schema["doc"], schema["n_words"], T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType())]
    )
    return joined.mapInArrow(_confirm, out).withColumnRenamed("doc", key).drop("uid")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.col("n_items") >= 2)


QUERIES = {"op8_decontaminate": op8_decontaminate}
_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
ORACLE = {
    "op8_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS win
       FROM (SELECT item_id, w, least(8, len(w)) AS n, unnest(range(len(w) - least(8, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win
       FROM (SELECT doc_id, n, w, unnest(range(len(w) - n + 1)) AS i FROM d CROSS JOIN ns WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
}

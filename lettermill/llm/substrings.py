"""Removal of passages that an earlier document already has, with automata of repeated phrases.

A window is WINDOW consecutive words. The smallest hash of the GRAM-word runs in a window is its anchor; windows that
recur have anchors that recur, and anchors are few. Anchors are counted over all documents; runs of windows around an
anchor that recurs are cut out as segments, with their words as they are, and dealt out by anchor, equal ones as one.
Where they meet, windows found in two documents or more are confirmed word by word and compiled into Aho-Corasick
automata, a shard of anchors at a time, and all segments of the shard are streamed through to locate every occurrence,
with the first document that has it. An anchor with very many segments is dealt out by single windows instead. Hashes
only choose what meets: windows are equal when their words are. What was found goes back to the segments that asked by
the 128-bit digest of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import NOT_SPACE, Words, mix64, places, ship, signed, slices, spread, stored, table, utf8
from .bloom import KEYS, of_column, opened

WINDOW = 13
GRAM = 5
#: Segments of an anchor beyond which it is dealt out by window.
HOT = 5000
#: Segments that are compiled and streamed together.
SHARD = 10_000
SEED = 41


class Anchors:
    """The anchor of every window of a column of texts."""

    def __init__(self, texts: pa.Array, window: int, gram: int):
        w = Words(*utf8(texts), NOT_SPACE)
        h = w.hashes(SEED)
        grams, at = w.grams(h, gram, SEED)
        span = window - gram + 1
        if len(grams) < span:
            self.value, self.at = grams[:0], at[:0]
        else:
            least = grams[: len(grams) - span + 1].copy()
            for j in range(1, span):
                np.minimum(least, grams[j : len(grams) - span + 1 + j], out=least)
            whole = at[span - 1 :] - at[: len(at) - span + 1] == span - 1
            self.value, self.at = least[whole], at[: len(at) - span + 1][whole]
        self.words = w
        self.row = w.text_of()[self.at] if len(self.at) else self.at
        # a hash of each text's words in their order
        mixed = h * places(int(w.counts.max(initial=0)) or 1, 9)[np.arange(len(h)) - np.repeat(w.first[:-1], w.counts)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        self.text = mix64(sums[w.first[1:]] - sums[w.first[:-1]] + w.counts.astype(np.uint64))

    def spans(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The words first .. last of each run, joined by single spaces."""
        w = self.words
        lens = w.ends - w.starts
        ends = np.cumsum(lens + 1)  # in a buffer where a space follows each word
        flat = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
        flat[np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)] = w.data[w.mask]
        a, b = ends[first] - lens[first] - 1, ends[last] - 1
        n = b - a
        to = np.cumsum(n)
        text = flat[np.arange(int(to[-1]) if len(to) else 0) + np.repeat(a - (to - n), n)]
        offsets = np.concatenate([[0], to])
        return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text)]).cast(pa.string())


def _anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                a = Anchors(part.column("text"), window, gram)
                fresh = np.ones(len(a.value), bool)
                fresh[1:] = (a.value[1:] != a.value[:-1]) | (a.row[1:] != a.row[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(signed(a.value[fresh])), part.column("doc").take(pa.array(a.row[fresh]))], names=["anchor", "doc"])

    return run


def _segments(shared, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = opened(shared.value)
        for batch in batches:
            for part in slices(batch):
                a = Anchors(part.column("text"), window, gram)
                fresh = np.ones(len(a.value), bool)
                fresh[1:] = (a.value[1:] != a.value[:-1]) | (a.row[1:] != a.row[:-1])
                lead = np.flatnonzero(fresh)
                tail = np.concatenate([lead[1:], [len(a.value)]]) - 1 if len(lead) else lead
                hit = bloom.has(mix64(a.value[lead]))
                lead, tail = lead[hit], tail[hit]
                first, last = a.at[lead], a.at[tail] + window - 1
                row = a.row[lead]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(a.value[lead])),
                        a.spans(first, last),
                        part.column("doc").take(pa.array(row)),
                        pa.array(signed(a.text[row])),
                        pa.array((first - a.words.first[row]).astype(np.int32)),
                    ],
                    names=["anchor", "words", "doc", "text_key", "start"],
                )

    return run


def locate(segments: list[tuple[int, str, int, int]], window: int) -> list[tuple[list[int], list[int]]]:
    """For each (anchor, words, first document, last document): the places of windows that some document has before
    the segment's last one, and for each the first document that has it. Segments of an anchor stand together, and no
    window has two anchors: a segment alone under its anchor needs no search. Words are numbered as they come up."""
    import ahocorasick

    alone = [
        (i == 0 or segments[i - 1][0] != s[0]) and (i + 1 == len(segments) or segments[i + 1][0] != s[0]) for i, s in enumerate(segments)
    ]
    numbers: dict[str, int] = {}
    coded = [None if lone else tuple([numbers.setdefault(w, len(numbers)) for w in s[1].split(" ")]) for s, lone in zip(segments, alone, strict=True)]
    firsts: dict[tuple, int] = {}
    lasts: dict[tuple, int] = {}
    for ids, (_, _, first, last) in zip(coded, segments, strict=True):
        for k in range(len(ids) - window + 1 if ids else 0):
            win = ids[k : k + window]
            if (f := firsts.get(win)) is None:
                firsts[win], lasts[win] = first, last
            else:
                if first < f:
                    firsts[win] = first
                if last > lasts[win]:
                    lasts[win] = last
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for win, first in firsts.items():
        if first < lasts[win]:
            automaton.add_word(win, first)
    if len(automaton):
        automaton.make_automaton()
    out = []
    for ids, (_, words, first, last) in zip(coded, segments, strict=True):
        if ids is None:
            n = words.count(" ") + 2 - window if first < last else 0
            out.append((list(range(n)), [first] * n))
        else:
            found = [(end - window + 1, f) for end, f in automaton.iter(ids) if f < last] if len(automaton) else []
            out.append(([x[0] for x in found], [x[1] for x in found]))
    return out


LOCATED = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("firsts", T.ArrayType(T.LongType()))])


def _locate(window: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            found = locate([(r[0], *r[2:]) for r in rows], window)
            keep = [(r[1], p, f) for r, (p, f) in zip(rows, found, strict=True) if p]
            cols = list(zip(*keep, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.list_(pa.int32())), pa.array(cols[2], pa.list_(pa.int64()))], names=LOCATED.names)

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "words", "first", "last")), strict=True):
                if len(held) >= shard and held[-1][0] != r[0]:
                    yield flush(held)
                    held = []
                held.append(r)
        if held:
            yield flush(held)

    return run


def _split(shared):
    """Texts of documents that the filter says lose nothing are done with; the others travel on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = opened(shared.value)
        for batch in batches:
            for part in slices(batch):
                a = Anchors(part.column("text"), 1, 1)
                may = bloom.has(a.text) & ~np.asarray(part.column("doc").is_null())
                sums = [None if m else hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t, m in zip(part.column("text").to_pylist(), may, strict=True)]
                text = part.column("text").take(pa.array(np.arange(len(may)), mask=~may))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(signed(a.text)), pa.array(a.words.counts.astype(np.int64)), text, pa.array(sums, pa.string())], names=["doc", "text_key", "n_words", "text", "kept_sha256"]
                )

    return run


def _remove(window: int, keep_text: bool):
    names = ["doc", "n_words", "n_removed", "kept_sha256"] + (["kept", "whole"] if keep_text else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, sums, kept, whole = [], [], [], []
            for text, done, starts in zip(batch.column("text").to_pylist(), batch.column("kept_sha256").to_pylist(), batch.column("starts").to_pylist(), strict=True):
                if done is not None:
                    removed.append(0)
                    sums.append(done)
                    kept.append(None)
                    whole.append(True)
                    continue
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + window, bool)
                for s in starts or ():
                    gone[s : s + window] = True
                gone = gone[: len(words)]
                stay = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                removed.append(int(gone.sum()))
                sums.append(hashlib.sha256(stay).hexdigest())
                kept.append(stay.decode())
                whole.append(not removed[-1])
            cols = [batch.column("doc"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(sums, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(kept, pa.string()), pa.array(whole)] if keep_text else []), names=names)

    return run


def repeated_windows(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard: int = SHARD, keys: int = KEYS) -> DataFrame:
    """(doc, text_key, starts): where windows start that a document with a smaller id has as well. docs: (doc, text)."""
    spark = docs.sparkSession
    known = docs.where("doc is not null and text is not null")
    pairs = known.mapInArrow(_anchors(window, gram), T.StructType([T.StructField("anchor", T.LongType()), T.StructField("doc", T.LongType())]))
    again = stored(pairs.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("anchor"))
    shared = spark.sparkContext.broadcast(of_column(again, "anchor", mix=True, keys=keys))
    schema = T.StructType(
        [T.StructField("anchor", T.LongType()), T.StructField("words", T.StringType()), T.StructField("doc", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("start", T.IntegerType())]
    )
    segments = stored(known.mapInArrow(_segments(shared, window, gram), schema))

    crowded = stored(segments.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"))
    if crowded.limit(1).count():
        busy = segments.join(crowded, "anchor", "left_semi").withColumn("__w", F.split("words", " "))
        wins = F.transform(F.sequence(F.lit(0), F.size("__w") - window), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("__w", k + 1, window), " ").alias("words")))
        busy = busy.select(F.inline(wins), "doc", "text_key", "start")
        busy = busy.select(F.xxhash64(F.lit(1), "words").alias("anchor"), "words", "doc", "text_key", (F.col("start") + F.col("k")).alias("start"))
        segments = segments.join(crowded, "anchor", "left_anti").select(busy.columns).union(busy)
    key = F.unhex(F.md5("words")).alias("key")  # words have one anchor, so the key needs no anchor beside it
    distinct = segments.groupBy("anchor", "words").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    found = distinct.repartition("anchor").sortWithinPartitions("anchor").select("anchor", key, "words", "first", "last").mapInArrow(_locate(window, shard), LOCATED)
    here = segments.select(key, "doc", "text_key", "start").join(found, "key")
    starts = F.transform(F.filter(F.arrays_zip("places", "firsts"), lambda x: x["firsts"] < F.col("doc")), lambda x: x["places"] + F.col("start"))
    here = here.select("doc", "text_key", starts.alias("s")).where(F.size("s") > 0)
    return here.groupBy("doc", "text_key").agg(F.flatten(F.collect_set("s")).alias("starts"))  # a set, as rows may share a key


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM, keep_text: bool = False, hot: int = HOT, shard: int = SHARD, keys: int = KEYS) -> DataFrame:
    """key, n_words, n_removed and kept_sha256 for every row: words in windows that a document with a smaller key has
    are removed; windows are judged on the input. kept_sha256 is of the words left, joined by single spaces. With
    keep_text=True also `kept`, those words, and `whole`, that none was removed (kept is then null: see the text).

    Words are split at ASCII white space and compared as they are. Null texts have no words. Rows with a null key are
    left whole and prove nothing about others; rows that share a key don't prove anything about each other. Columns
    beyond key and text don't matter; an empty table gives none. Keys are integers. keys: what a broadcast filter may
    hold; beyond it every segment and text is looked at where they meet, with the same result. A text is held in memory
    as a whole, at some 80 bytes a byte while it is cut up.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(key).cast("long").alias("doc"), "text")
    places_ = stored(repeated_windows(docs, window=window, gram=gram, hot=hot, shard=shard, keys=keys))
    shared = spark.sparkContext.broadcast(of_column(places_, "text_key", keys=keys))
    schema = T.StructType(
        [T.StructField("doc", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept_sha256", T.StringType())]
    )
    rows = docs.mapInArrow(_split(shared), schema)
    # rows without a key match nothing, and are spread instead of meeting under null
    rows = rows.withColumn("__none", F.col("doc").isNull()).withColumn("__key", F.when(F.col("doc").isNull(), F.monotonically_increasing_id()).otherwise(F.col("doc")))
    at = places_.select(F.col("doc").alias("__key"), "text_key", "starts", F.lit(False).alias("__none"))
    joined = rows.join(at, ["__none", "__key", "text_key"], "left").select("doc", "n_words", "text", "kept_sha256", "starts")
    out = [schema["doc"], schema["n_words"], T.StructField("n_removed", T.LongType()), schema["kept_sha256"]]
    out += [T.StructField("kept", T.StringType()), T.StructField("whole", T.BooleanType())] if keep_text else []
    return joined.mapInArrow(_remove(window, keep_text), T.StructType(out)).withColumnRenamed("doc", key)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spread(table(spark, sf_dir, "documents")))


QUERIES = {"op7_substrings": op7_substrings}
_W = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ORACLE = {
    "op7_substrings": f"""
WITH d AS (SELECT doc_id, {_W} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 13], ' ') AS x FROM (SELECT doc_id, w, unnest(range(len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT x, min(doc_id) AS f FROM win GROUP BY x),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (x) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
kept AS (SELECT words.doc_id, count(*) FILTER (gone.p IS NOT NULL) AS n_removed,
                string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS t
         FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
}

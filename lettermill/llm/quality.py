"""A quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into chunks that overlap by one filter width less a byte, so that every window of bytes lies in
some chunk. Learned filters slide over each chunk and are max-pooled in it; a text's features are the means of its
chunks' maxima, and a logistic unit turns them into one probability. A filter over bytes is a table of 256 weights for
each of its places, so that convolving is adding table rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import ship, slices, spread, table, utf8
from .language import fold, training_sample

CHUNK = 256
WIDTH = 5
FILTERS = 8
#: Bounds of the training sample for each class: documents in the order of a hash of their ids, and characters. No
#: document brings more than a sixteenth of the characters.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 3 << 20
EPOCHS = 40
BATCH = 64


@dataclass
class Network:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    offset: float
    #: Probability of an empty text, and of all texts where there was nothing to learn from.
    prior: float


def chunks(data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every chunk in the padded buffer, and its row. A text of n bytes has max(n - width + 1,
    1) windows: shorter ones are filled up with zero bytes. Empty texts have none."""
    sizes = np.diff(offsets)
    windows = np.where(sizes > 0, np.maximum(sizes - width + 1, 1), 0)
    step = chunk - width + 1
    per = (windows + step - 1) // step
    row = np.repeat(np.arange(len(sizes)), per)
    k = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    first = offsets[:-1][row] + k * step
    return first, np.minimum(first + step, offsets[:-1][row] + windows[row]), row


def _activations(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Filter outputs of the window at each byte. A window that would reach into the next text only belongs to a chunk
    if its own text is shorter than the filter; those few are then done over, filled up with zero bytes."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    out = net.tables[0][padded[:n]]
    buffer = np.empty_like(out)
    for k in range(1, WIDTH):
        np.take(net.tables[k], padded[k : n + k], axis=0, out=buffer, mode="clip")
        out += buffer
    sizes = np.diff(offsets)
    for r in np.flatnonzero((sizes > 0) & (sizes < WIDTH)):
        short = np.zeros(WIDTH, np.uint8)
        short[: sizes[r]] = data[offsets[r] : offsets[r + 1]]
        out[offsets[r]] = sum(net.tables[k][short[k]] for k in range(WIDTH))
    return out


def _pooled(net: Network, data: np.ndarray, offsets: np.ndarray, spots: bool = False):
    """Mean over chunks of the rectified maxima, for each row; with `spots` also where the maxima are."""
    rows = len(offsets) - 1
    first, last, row = chunks(data, offsets)
    if not len(first):
        return (np.zeros((rows, FILTERS), np.float32), None) if spots else np.zeros((rows, FILTERS), np.float32)
    act = _activations(net, data, offsets)
    # chunks of a text abut in windows; between texts lie windows of no chunk, which form segments of their own
    marks = np.empty(2 * len(first), np.int64)
    marks[0::2], marks[1::2] = first, last
    inside = marks < len(act)
    keep = np.ones(len(marks), bool)
    keep[1:] = marks[1:] > marks[:-1]
    keep[0::2] = True
    keep[1:-1:2] = marks[1:-1:2] < marks[2::2]
    keep &= inside
    top = np.maximum.reduceat(act, marks[keep], axis=0)[(np.arange(len(marks))[keep] % 2) == 0]
    lit = np.maximum(top + net.bias, 0)
    per = np.bincount(row, minlength=rows)
    sums = np.stack([np.bincount(row, lit[:, f], minlength=rows) for f in range(FILTERS)], axis=1)
    means = sums / np.maximum(per, 1)[:, None]
    if not spots:
        return means
    where = np.empty((len(first), FILTERS), np.int64)
    for c, (a, b) in enumerate(zip(first, last, strict=True)):
        where[c] = a + act[a:b].argmax(axis=0)
    return means, (where, lit > 0, row, per)


def score(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    z = _pooled(net, data, offsets) @ net.weights + net.offset
    out = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return np.where(np.diff(offsets) > 0, out, net.prior)


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the logistic loss with balanced classes. Through a maximum the slope reaches one window a chunk only."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, float)
    net = Network(rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.5, FILTERS), 0.0, 0.5)
    if not len(y) or y.min() == y.max():
        net.weights[:] = 0
        net.prior = float(y.mean()) if len(y) else 0.5
        net.offset = float(np.clip(net.prior, 0, 1) * 20 - 10) if len(y) else 0.0
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    params = [net.tables, net.bias, net.weights]
    first, second = [np.zeros(p.shape) for p in params] + [0.0], [np.zeros(p.shape) for p in params] + [0.0]
    step = 0
    rounds = max(epochs, -(-epochs * 12 // max(1, len(texts) // BATCH)))
    rounds = min(rounds, 6 * epochs)
    for e in range(rounds):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            data = np.frombuffer(b"".join(texts[j] for j in pick), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[j]) for j in pick])]).astype(np.int64)
            means, spots = _pooled(net, data, offsets, spots=True)
            if spots is None:
                continue
            p = 1 / (1 + np.exp(-np.clip(means @ net.weights + net.offset, -30, 30)))
            slope = (p - y[pick]) * weight[pick] / len(pick)
            where, lit, row, per = spots
            back = (slope[row] / per[row])[:, None] * net.weights[None, :] * lit
            g_tables = np.zeros(net.tables.shape)
            padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
            for f in range(FILTERS):
                for k in range(WIDTH):
                    g_tables[k, :, f] = np.bincount(padded[where[:, f] + k], back[:, f], minlength=256)
            grads = [g_tables + 1e-5 * net.tables, back.sum(axis=0), means.T @ slope + 1e-4 * net.weights, float(slope.sum())]
            step += 1
            rate = 0.02 * (1 - 0.9 * e / rounds)
            for n, g in enumerate(grads):
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                move = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                if n < 3:
                    params[n] -= move.astype(params[n].dtype)
                else:
                    net.offset -= float(move)
    net.prior = float(y.mean())
    return net


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", most_docs: int = SAMPLE_DOCS, most_chars: int = SAMPLE_CHARS) -> Network:
    """Learn `label` (0 or 1) from a bounded sample of labelled texts of each class. Rows with a null key, text or
    label are left out; of contradictory labels of one document each counts, of equal ones one. Without labels of both
    classes every text gets the mean label (0.5 without any). Columns beyond these don't matter, whatever their names."""
    docs = docs.select(F.col(key).alias("__id"), "text").where("__id is not null and text is not null")
    marks = labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)").distinct()
    known = docs.select("__id", F.length("text").alias("n")).join(marks, "__id")
    rows = training_sample(docs, known, "__id", most_docs, most_chars).collect()
    rows = sorted((r["text"].encode(), r["label"]) for r in rows)
    return fit([t for t, _ in rows], [y for _, y in rows])


def classify(docs: DataFrame, net: Network, *, keep: bool = False, key: str = "doc_id") -> DataFrame:
    """key (with keep=True all columns) and score for every row. Null and empty texts get the network's prior.
    Repeated rows and null keys pass through; a column named score is replaced; an empty table gives none."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("score")
    docs = docs if keep else docs.select(key, "text")
    names = [c for c in docs.columns if keep or c != "text"]
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                s = score(shared.value, *utf8(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(s, pa.float64())], names=[*names, "score"])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in names] + [T.StructField("score", T.DoubleType())]))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    held_out = fold(F.col("doc_id"), 3) == 1
    net = train(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return classify(docs, net).select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


QUERIES = {"op9_quality": op9_quality}
ORACLE: dict[str, str] = {}

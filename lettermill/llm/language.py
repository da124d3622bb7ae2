"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability in a language is
summed over all its segmentations into pieces by the forward algorithm; a text's is the product over its words. The
piece probabilities are fitted by expectation maximisation on a bounded sample of labelled documents.

All sums are in logarithms, so that a word may be as long as it likes. Where no piece of the vocabulary reaches across
a place in a word, every segmentation has a bound there and the sum is the product of both sides; words fall into short
segments that way, and the forward algorithm steps through all segments of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import HashIndex, Words, durable, ship, slices, spread, table, utf8

#: Bounds of the training sample for each language: documents in the order of a hash of their ids, and characters. No
#: document brings more than a sixteenth of the characters.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 1 << 20
ROUNDS = 4
MARK = 0x20  # stands before a word's first byte, and for the vocabulary's word mark
SMOOTH = 0.02
#: Word bytes: ASCII letters and all bytes of other code points.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True

_STEP = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """The pieces and all their beginnings in one open hash table; id -1: only a beginning."""

    keys: np.ndarray
    ids: np.ndarray
    log_slots: int
    size: int

    @staticmethod
    def of(pieces: list[bytes]) -> Vocabulary:
        entries: dict[int, int] = {}
        for n, piece in enumerate(pieces):
            h = 0
            for k, b in enumerate(piece):
                h = (h * int(_STEP) + b + 1) % (1 << 64)
                if k == len(piece) - 1:
                    entries[h] = n
                else:
                    entries.setdefault(h, -1)
        log_slots = max(4, (4 * len(entries)).bit_length())
        keys, ids = np.zeros(1 << log_slots, np.uint64), np.full(1 << log_slots, -1, np.int32)
        for h, n in entries.items():
            slot = ((h * int(_SPREAD)) % (1 << 64)) >> (64 - log_slots)
            while keys[slot]:
                slot = (slot + 1) % (1 << log_slots)
            keys[slot], ids[slot] = h, n
        return Vocabulary(keys, ids, log_slots, len(pieces))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1."""
        slot = ((h * _SPREAD) >> np.uint64(64 - self.log_slots)).astype(np.int64)
        got = self.keys[slot]
        out = np.where(got == h, slot, -1)
        at = np.flatnonzero((got != h) & (got != 0))
        while len(at):
            slot[at] = (slot[at] + 1) & ((1 << self.log_slots) - 1)
            got = self.keys[slot[at]]
            same = got == h[at]
            out[at[same]] = slot[at[same]]
            at = at[~same & (got != 0)]
        return out


def public_pieces(path: str | None = None) -> list[bytes]:
    """The pieces of the public vocabulary, lower-cased and distinct, and every single byte."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {bytes([b]) for b in range(256)}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            raw = sp.id_to_piece(i).replace("▁", " ").lower().encode()
            if raw:
                pieces.add(raw)
    return sorted(pieces)


def words_of(texts: pa.Array) -> Words:
    """The words of a column of texts, lower-cased."""
    return Words(*utf8(pc.utf8_lower(texts.fill_null("") if texts.null_count else texts)), LETTERS)


class Lattice:
    """Some of a column's words, cut into segments, and all pieces of a vocabulary in them.

    An edge is a piece: it leads from node `src` to node `dst`. Edges are sorted by their distance from the segment's
    begin, then by length; a run of equals in both has no node twice on either side.
    """

    def __init__(self, vocabulary: Vocabulary, w: Words, first: np.ndarray):
        self.words = len(first)
        size = w.ends[first] - w.starts[first] + 1  # with the mark
        begin = np.cumsum(size) - size
        total = int(size.sum())
        place = np.arange(total) - np.repeat(begin, size)
        data = w.data[np.maximum(np.repeat(w.starts[first], size) + place - 1, 0)] if total else np.zeros(0, np.uint8)
        data[place == 0] = MARK
        end = np.repeat(begin + size, size)
        src, length, ids = self._pieces(vocabulary, data, end)
        inside = length > 1  # places that a piece reaches across
        across = np.cumsum(np.bincount(src[inside] + 1, minlength=total + 1) - np.bincount((src + length)[inside], minlength=total + 1))[:total]
        self.start = np.flatnonzero(across == 0)  # of each segment
        segment = np.cumsum(across == 0) - 1
        self.word = np.repeat(np.arange(self.words), size)[self.start]
        # each segment has an end of its own, so that nodes are places shifted by the segment's number
        seg = segment[src]
        far = src - self.start[seg]
        order = np.lexsort((length, far))
        self.src, self.dst, self.ids = (src + seg)[order], (src + seg + length)[order], ids[order]
        far, length = far[order], length[order]
        cut = np.flatnonzero((far[1:] != far[:-1]) | (length[1:] != length[:-1])) + 1
        self.runs = list(zip([0, *cut.tolist()], [*cut.tolist(), len(far)], strict=True)) if len(far) else []
        self.nodes = total + len(self.start)
        self.begins = self.start + np.arange(len(self.start))
        self.ends = np.append(self.start[1:], total)[: len(self.start)] + np.arange(len(self.start))
        self.edge_segment = seg[order]

    @staticmethod
    def _pieces(vocabulary: Vocabulary, data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, length and number of every piece: from all places at once, a byte further in each step."""
        at = np.arange(len(data))
        h = np.zeros(len(data), np.uint64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        while len(at):
            h = h * _STEP + data[at + n] + np.uint64(1)
            n += 1
            slot = vocabulary.find(h)
            alive = slot >= 0
            ids = vocabulary.ids[slot[alive]]
            whole = ids >= 0
            found.append((at[alive][whole], np.full(int(whole.sum()), n), ids[whole]))
            alive &= at + n < end[at]
            at, h = at[alive], h[alive]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def forward(self, log_probs: np.ndarray) -> np.ndarray:
        """At each node the logarithm of the sum over all ways to it. log_probs: pieces, or pieces x languages."""
        a = np.full((self.nodes, *log_probs.shape[1:]), -np.inf)
        a[self.begins] = 0.0
        for i, j in self.runs:
            dst = self.dst[i:j]
            a[dst] = np.logaddexp(a[dst], a[self.src[i:j]] + log_probs[self.ids[i:j]])
        return a

    def backward(self, log_probs: np.ndarray) -> np.ndarray:
        b = np.full((self.nodes, *log_probs.shape[1:]), -np.inf)
        b[self.ends] = 0.0
        for i, j in reversed(self.runs):
            src = self.src[i:j]
            b[src] = np.logaddexp(b[src], b[self.dst[i:j]] + log_probs[self.ids[i:j]])
        return b


def log_likelihood(lattice: Lattice, log_probs: np.ndarray) -> np.ndarray:
    """Of every distinct word in every language, summed over all segmentations. log_probs: pieces x languages."""
    whole = lattice.forward(log_probs)[lattice.ends]
    out = np.zeros((lattice.words, log_probs.shape[1]))
    np.add.at(out, lattice.word, whole)
    return out


def fit(vocabulary: Vocabulary, texts: pa.Array, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation, from even ones."""
    w = words_of(texts)
    _, first, which = np.unique(w.hashes(5), return_index=True, return_inverse=True)
    x = Lattice(vocabulary, w, first)
    times = np.bincount(which, minlength=x.words).astype(float)[x.word]
    p = np.full(vocabulary.size, 1.0 / vocabulary.size)
    for _ in range(rounds):
        log_p = np.log(p)
        a, b = x.forward(log_p), x.backward(log_p)
        share = np.exp(a[x.src] + log_p[x.ids] + b[x.dst] - a[x.ends][x.edge_segment]) * times[x.edge_segment]
        got = np.bincount(x.ids, share, minlength=vocabulary.size)
        p = (got + SMOOTH) / (got.sum() + SMOOTH * vocabulary.size)
    return p


@dataclass
class Model:
    vocabulary: Vocabulary
    languages: list[str]
    log_probs: np.ndarray  # pieces x languages


def training_sample(docs: DataFrame, labelled: DataFrame, key: str, most_docs: int = SAMPLE_DOCS, most_chars: int = SAMPLE_CHARS) -> DataFrame:
    """(label, text) of at most most_docs documents and most_chars characters for each label, chosen by a hash of the
    key; a text brings no more than its first sixteenth of most_chars. labelled: (key, label, n), n the characters of
    the text. The smallest hashes are cut out by a threshold from each label's count before rows of a label meet; texts
    are only read for the few that are chosen, whose ids are broadcast. Other columns of docs don't matter."""
    each = max(1, most_chars // 16)
    docs = docs.select(F.col(key).alias("__key"), "text")
    u = F.shiftrightunsigned(F.xxhash64(F.col(key)), 1)
    counts = labelled.groupBy("label").count().collect()  # a row for each label, as the model will have
    if not counts:
        return docs.select(F.lit(None).cast(labelled.schema["label"].dataType).alias("label"), "text").limit(0)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["label"], min(1.0, (4.0 * most_docs + 100) / r["count"]))])
    order = Window.partitionBy("label").orderBy("__u", "__id")
    few = labelled.where(u <= F.lit(float(1 << 63)) * share[F.col("label")]).select(F.col(key).alias("__id"), "label", F.least("n", F.lit(each)).alias("__n"), u.alias("__u"))
    few = few.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= most_docs)
    few = few.withColumn("__sum", F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("__sum") <= most_chars)
    few = durable(few.select("__id", "label"))
    return docs.join(F.broadcast(few), F.col("__key") == F.col("__id")).select("label", F.substring("text", 1, each).alias("text"))


def train(docs: DataFrame, *, key: str = "doc_id", label: str = "lang", path: str | None = None, most_docs: int = SAMPLE_DOCS, most_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from (text, label) of docs, within the bounds of training_sample; rows with a null in either, or in the
    key, are left out. Without any labelled row the model knows no language. Repeated rows count as often as they
    occur; columns beyond these three don't matter, whatever their names."""
    known = docs.select(F.col(key).alias("__id"), F.col(label).alias("__label"), "text").where("__label is not null and text is not null and __id is not null")
    marks = known.select("__id", F.col("__label").alias("label"), F.length("text").alias("n"))
    texts: dict[str, list[str]] = {}
    for r in training_sample(known, marks, "__id", most_docs, most_chars).collect():
        texts.setdefault(r["label"], []).append(r["text"])
    vocabulary = Vocabulary.of(public_pieces(path))
    names = sorted(x for x in texts if any(any(c.isalpha() for c in t) for t in texts[x]))
    probs = np.stack([fit(vocabulary, pa.array(sorted(texts[x]), pa.string())) for x in names], axis=1) if names else np.ones((vocabulary.size, 0))
    return Model(vocabulary, names, np.log(probs))


class Worth:
    """Log-likelihoods of words in a model's languages. What a word is worth is remembered by its 64-bit hash, within a
    bound of memory: beyond it all is forgotten and begun anew, and a batch with more words than that is held whole."""

    def __init__(self, model: Model, most_bytes: int = 32 << 20):
        self.model = model
        self.most = max(1, most_bytes // (8 * max(1, len(model.languages)) + 24))
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex(16)
        self.known = np.zeros((0, len(self.model.languages)))

    def of(self, w: Words) -> np.ndarray:
        """Words x languages."""
        h = w.hashes(5) | np.uint64(1)
        found = self.index.find(h)
        if len(new := np.flatnonzero(found < 0)):
            if self.index.size + len(new) > self.most:
                self._forget()
                new = np.arange(len(h))
            _, first = np.unique(h[new], return_index=True)
            new = new[first]
            each = log_likelihood(Lattice(self.model.vocabulary, w, new), self.model.log_probs)
            if self.index.size + len(new) > len(self.known):
                self.known = np.concatenate([self.known, np.zeros((max(len(new), len(self.known), 1 << 14), each.shape[1]))])
            self.known[self.index.size : self.index.size + len(new)] = each
            self.index.add(h[new])
            found = self.index.find(h)
        return self.known[found]


def predict(worth: Worth, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its share of the posterior, with an even prior."""
    n, languages = len(texts), worth.model.languages
    lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    if not languages or not n:
        return ["und"] * n, np.zeros(n)
    w = words_of(texts)
    total = np.zeros((n, len(languages)))
    if len(w.starts):
        each, row = worth.of(w), w.text_of()
        for k in range(total.shape[1]):
            total[:, k] = np.bincount(row, each[:, k], minlength=n)
    best = total.argmax(axis=1)
    share = 1.0 / np.exp(total - total[np.arange(n), best][:, None]).sum(axis=1)
    return [languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], np.where(lettered, share, 0.0)


def identify(docs: DataFrame, model: Model, *, key: str = "doc_id") -> DataFrame:
    """key, lang_pred and score (0 to 1) for every row. `und` and 0 where the text is null or has no letter. Equal
    likelihoods: the first language by name. Repeated rows and null keys pass through; columns beyond key and text
    don't matter; an empty table gives none. A batch is held in memory at some 200 bytes for each byte of its distinct
    words; a stretch without bounds, as of one letter over and over, is stepped through in some 20 microseconds a byte."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = Worth(shared.value)
        for batch in batches:
            for part in slices(batch):
                names, share = predict(worth, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(share, pa.float64())], names=[key, "lang_pred", "score"])

    schema = T.StructType([docs.schema[key], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(key, "text").mapInArrow(run, schema)


def fold(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo `of`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % of


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    held_out = fold(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_language": op2_language}
ORACLE: dict[str, str] = {}

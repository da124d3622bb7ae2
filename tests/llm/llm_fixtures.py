"""Small document tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def texts(seed=0):
    """Texts with copies, near copies, shared passages and odd ones."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([3, 12, 13, 14, 40, 120])) for _ in range(40)]
    out = [" ".join(w) for w in base]
    for w in base[:12]:  # near copies: one word changed
        v = list(w)
        v[rng.randrange(len(v))] = "changed"
        out.append("  ".join(v))
    passage = words(rng, 30)
    for i in range(10):  # a shared passage in various company
        out.append(" ".join(words(rng, 5) + passage[: 15 + i] + words(rng, 7)))
    out += out[:5]
    line = "This Line is long enough to be looked at, forty characters"
    out += [f"first {i}\n  {line if i % 2 else line.upper()} \t\nlast" for i in range(7)]
    out += ["", None, " \n\t ", "\n", "one", "One ONE one", "éà ça   x", "x" * 5000, "a b " * 3000, "Été naïve façade coöperate"]
    return out


def rows(seed=0):
    return [(i, t, "en" if i % 3 else None, f"s{i % 4}", len(t) if t is not None else None) for i, t in enumerate(texts(seed))]


def frame(spark, data=None, seed=0):
    return spark.createDataFrame(rows(seed) if data is None else data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def odd(spark):
    """Null keys, repeated rows, a key with two texts."""
    return spark.createDataFrame([(None, "no key at all here", None, None, None), (1, "twice the same text", "en", "s", 1), (1, "twice the same text", "en", "s", 1), (2, None, None, None, None), (3, "", "xx", "", 0)], SCHEMA)

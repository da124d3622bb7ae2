"""The registered queries and the operators' general interfaces on tables with clashing columns and very long texts."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from llm_fixtures import frame, texts, words
from pyspark.sql import functions as F
from test_dedup import brute_lines, brute_near, brute_substrings

from lettermill.llm import decontaminate, fingerprints, language, lines, minhash, packing, quality, registry, sharding, substrings, warc

CLASHES = ["label", "lang_pred", "score", "kept", "band", "bands", "digest", "node", "component", "anchor", "words", "start", "doc", "uid", "print", "whole", "window", "n", "item", "item_id", "cell", "part", "number"]
CLASHES += ["shard", "slot", "__run", "__key", "__none", "__id", "__hash", "__drop", "n_lines", "n_dropped", "kept_sha256", "to", "guest", "refers_to", "key", "k", "value", "h", "quality", "sequence_id", "page_id"]


def clashing(df):
    return df.select("*", *[F.lit(f"clash {i}").alias(c) for i, c in enumerate(CLASHES) if c not in df.columns])


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of two languages and two qualities with copies, lines and passages; every table with clashing columns."""
    rng = random.Random(11)
    say = {"aa": ["lorem", "ipsum", "dolor", "amet", "sit"], "bb": ["zwei", "drei", "über", "schön", "weiß"]}
    docs = []
    for i in range(240):
        lang = ("aa", "bb")[i % 2]
        bad = i % 3 == 0
        docs.append((i, " ".join((rng.choice(say[lang]) + ("!!#" if bad else "") + str(rng.randrange(10))) for _ in range(rng.choice([30, 60]))), lang, "s", 0, int(not bad)))
    docs += [(240 + i, t, None, "odd", 0, None) for i, t in enumerate(texts())]
    folder = tmp_path_factory.mktemp("llm")
    df = spark.createDataFrame([d[:5] for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    clashing(df).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(d[0], d[5], 0) for d in docs if d[5] is not None], "doc_id long, quality int, toxic int")
    labels.withColumn("label", F.lit("clash")).withColumn("text", F.lit(0)).write.parquet(f"{folder}/labels.parquet")
    bench = [(1, docs[4][1]), (2, " ".join(docs[6][1].split()[3:12])), (3, "one"), (4, None)]
    spark.createDataFrame(bench, "item_id long, text string").withColumn("print", F.lit(0)).withColumn("doc_id", F.lit(1)).write.parquet(f"{folder}/benchmark.parquet")
    pages = [(i, f"u{i}", ("<p>" + "x" * 1200) if i % 5 == 0 else t) for i, t in enumerate(texts())]
    clashing(spark.createDataFrame(pages, "page_id long, url string, html string")).write.parquet(f"{folder}/pages.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return str(folder), {d[0]: d for d in docs}, con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, tables, name):
    folder, _, con = tables
    df = registry.QUERIES[name](spark, folder)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    found = con.execute(registry.ORACLE[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in found.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(names) and got == want


def test_language_query(spark, tables):
    """Folds and predictions; scores against a forward algorithm over every word, place by place."""
    folder, docs, _ = tables
    got = {r["doc_id"]: r for r in registry.QUERIES["op2_language"](spark, folder).collect()}
    assert set(got) == set(docs) and all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert sum(r["held_out"] for d, r in got.items() if docs[d][2]) > 40
    assert all(got[d]["lang_pred"] == x[2] for d, x in docs.items() if x[2])
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in docs[d][1] or "")) and 0 <= r["score"] <= 1 for d, r in got.items())
    model = language.train(spark.read.parquet(f"{folder}/documents.parquet").where(language.fold(F.col("doc_id"), 4) != 2))
    pieces = {p: i for i, p in enumerate(language.public_pieces())}
    most = max(map(len, pieces))
    assert model.languages == ["aa", "bb"] and most > 16

    def total(word):
        best = np.full((len(word) + 1, 2), -np.inf)
        best[0] = 0
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + most) + 1):
                if (n := pieces.get(word[i:j])) is not None:
                    best[j] = np.logaddexp(best[j], best[i] + model.log_probs[n])
        return best[-1]

    import re

    for d in (0, 1, 2, 3, 50, 301, 318, 320, 321, 323):
        found = re.findall(rb"[A-Za-z\x80-\xff]+", (docs[d][1] or "").lower().encode())[:400]
        if len(found) == 400 or not found:
            continue
        worth = sum((total(b" " + w) for w in found), np.zeros(2))
        share = 1 / (1 + math.exp(min(700, worth.min() - worth.max())))
        assert got[d]["lang_pred"] == model.languages[int(worth.argmax())] and abs(got[d]["score"] - share) < 1e-6


def test_sharding_query(spark, tables):
    folder, docs, _ = tables
    got = registry.QUERIES["op4_sharding"](spark, folder).collect()

    def shard(d, n):
        u = lambda s: (int(hashlib.md5(f"{d}/{s}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
        return max(range(n), key=lambda s: (math.log(u(s)), -s))

    assert {r["doc_id"] for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        raw = (docs[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (shard(r["doc_id"], 8), shard(r["doc_id"], 9)) and r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_quality_query(spark, tables):
    """Folds and predictions; scores against filters moved over each chunk one place at a time."""
    folder, docs, _ = tables
    got = {r["doc_id"]: r for r in registry.QUERIES["op9_quality"](spark, folder).collect()}
    assert set(got) == set(docs) and all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert all(got[d]["predicted"] == x[5] for d, x in docs.items() if x[5] is not None)
    df = spark.read.parquet(f"{folder}/documents.parquet")
    net = quality.train(df.where(language.fold(F.col("doc_id"), 3) != 1), spark.read.parquet(f"{folder}/labels.parquet"))
    step = quality.CHUNK - quality.WIDTH + 1
    for d in (0, 1, 250, 255, 300, 314, 321, 323):
        raw = (docs[d][1] or "").encode()
        if not raw:
            assert abs(got[d]["score"] - net.prior) < 1e-9
            continue
        pad = raw + b"\0" * max(0, quality.WIDTH - len(raw))
        act = np.array([sum(net.tables[k][pad[i + k]] for k in range(quality.WIDTH)) for i in range(len(pad) - quality.WIDTH + 1)])
        tops = [np.maximum(act[i : i + step].max(axis=0) + net.bias, 0) for i in range(0, len(act), step)]
        z = float(np.mean(tops, axis=0) @ net.weights + net.offset)
        assert abs(got[d]["score"] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-4


def test_fingerprint_query(spark, tables):
    """Both likenesses against the smallest hashes of all spans, each span hashed on its own."""
    folder, docs, _ = tables
    got = {r["doc_id"]: r for r in registry.QUERIES["op5_fingerprints"](spark, folder).collect()}
    order = sorted(docs, reverse=True)
    p = (1 << 31) - 1
    powers = [[pow(int(b), i, p) for i in range(32)] for b in fingerprints.BASES]

    def small(raw):
        spans = {raw[i : i + 32] for i in range(max(1, len(raw) - 31))} if raw else set()
        whole = [(sum((c + 1) * b for c, b in zip(x, powers[0], strict=False)) % p) << 31 | sum((c + 1) * b for c, b in zip(x, powers[1], strict=False)) % p for x in spans]
        return sorted({int(x) for x in fingerprints.mix64(np.array(whole, np.uint64))})[:64] if whole else []

    def like(x, y):
        if x == y:
            return 1.0
        a, b = [v >> 32 for v in small(x)], [v >> 32 for v in small(y)]
        least = sorted(set(a) | set(b))[:64]
        return sum(v in a and v in b for v in least) / len(least) if a and b else float(not a and not b)

    for i, d in list(enumerate(order))[::7]:
        t, nxt = docs[d][1] or "", docs[order[(i + 1) % len(order)]][1] or ""
        if max(len(t), len(nxt)) > 3000:
            continue
        k = len(t) // 3
        r = got[d]
        assert abs(r["near_next"] - like(t.encode(), nxt.encode())) < 0.05
        assert abs(r["near_edited"] - like(t.encode(), (t[: len(t) - k] + nxt[:k]).encode())) < 0.05


def test_packing_query(spark, tables):
    from tokenizers import Tokenizer

    folder, docs, _ = tables
    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = registry.QUERIES["op10_packing"](spark, folder).collect()
    ids = {d: np.array([*tok.encode(x[1] or "", add_special_tokens=False).ids, 1], np.uint32) for d, x in docs.items()}
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))
    for r in got:
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    sizes = {}
    for r in got:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes.values())


def test_columns_that_clash(spark):
    """The same rows with and without further columns, whose names the operators use themselves."""
    docs = frame(spark)
    odd = clashing(docs)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(w for w in texts()[3].split()[:20]))], "item_id long, text string")
    model = language.train(docs)
    net = quality.train(docs, labels)
    wide = clashing(labels)
    by_id = dict(enumerate(texts()))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(odd).collect()} == brute_near(by_id, 4, 80)
    for more in ({}, {"keys": 5, "few": 0}):
        assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in lines.dedup_lines(odd, **more).collect()} == brute_lines(by_id)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(odd).collect()} == brute_substrings(by_id)
    runs = {
        "shard": lambda d: sharding.shard(d, "doc_id", [1.0, 2.0]).select("doc_id", "shard", "slot"), "fingerprints": fingerprints.fingerprint, "contamination": lambda d: decontaminate.contamination(d, bench), "packing": lambda d: packing.pack_documents(d).groupBy("doc_id").agg(F.sum("length").alias("n")), "language": lambda d: language.identify(d, model),
        "quality": lambda d: quality.classify(d, net), "trained": lambda d: language.identify(docs, language.train(d)), "taught": lambda d: quality.classify(docs, quality.train(d, labels if d is docs else wide)),
    }
    for name, run in runs.items():
        one, two = (sorted(map(tuple, run(d).collect()), key=repr) for d in (docs, odd))
        assert one == two, name
    contaminated = decontaminate.contamination(docs, clashing(bench.drop("item_id").withColumn("item_id", F.lit(1).cast("long"))))
    assert sorted(map(tuple, contaminated.collect()), key=repr) == sorted(map(tuple, decontaminate.contamination(docs, bench).collect()), key=repr)


def test_pages_with_columns_that_clash(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts())], "page_id long, url string, html string")
    assert warc.write_warc(pages, str(tmp_path / "a")) == warc.write_warc(clashing(pages), str(tmp_path / "b"))


def test_texts_over_a_megabyte(spark):
    """Texts longer than what kernels work on at once, with a near copy, a repeated passage and lines, beside short ones."""
    rng = random.Random(9)
    w = words(rng, 180_000, 30_000)
    line = "this line is in very many of the documents that follow it"
    long = "\n".join([" ".join(w[:90_000]), line, " ".join(w[90_000:])])
    assert len(long) > 1 << 20
    docs = {0: "short one", 1: long, 2: long.replace(w[7], "changed"), 3: " ".join(w[100:400]), 4: None, 5: "x" * 1_100_000, 6: f"{line}\nend", 7: f"a\n  {line.upper()}", 8: line, 9: "é" * 600_000}
    df = frame(spark, [(d, t, None, None, None) for d, t in docs.items()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_near(docs, 4, 80) and got[2][1] == 1
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in lines.dedup_lines(df).collect()}
    assert got == brute_lines(docs) and got[1][1] == 1
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(df).collect()}
    assert got == brute_substrings(docs) and got[3][1] == 300
    bench = spark.createDataFrame([(1, " ".join(w[150_000:150_020]))], "item_id long, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(df, bench).collect()}
    assert [got[d] for d in sorted(docs)] == [0, 20, got[2], 0, 0, 0, 0, 0, 0, 0] and got[2] > 0
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    some = df.where("doc_id in (1, 3, 4)")
    ids = {d: np.array([*tok.encode(docs[d] or "", add_special_tokens=False).ids, 1], np.uint32) for d in (1, 3, 4)}
    for r in packing.pack_documents(some).collect():
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    chars = {r["doc_id"]: r["n_chars"] for r in fingerprints.fingerprint(df).collect()}
    assert chars == {d: len(t or "") for d, t in docs.items()}
    model = language.train(frame(spark))
    shorter = df.withColumn("text", F.when(F.col("doc_id").isin(5, 9), F.substring("text", 1, 30_000)).otherwise(F.col("text")))
    assert {r["doc_id"] for r in language.identify(shorter, model).where("lang_pred = 'und'").collect()} == {4}
    net = quality.train(frame(spark), spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int"))
    offsets = np.array([0, len(long.encode())])
    want = quality.score(net, np.frombuffer(long.encode(), np.uint8), offsets)[0]
    assert abs({r["doc_id"]: r["score"] for r in quality.classify(df, net).collect()}[1] - want) < 1e-9

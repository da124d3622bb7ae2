import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import empty, frame, odd, texts

from lettermill.llm import decontaminate, fingerprints, language, packing, quality, sharding, warc


def test_contamination_against_brute_force(spark):
    rng = random.Random(5)
    items = {0: "Short item", 1: "one", 2: None, 3: " ".join(f"B{rng.randrange(50)}" for _ in range(20)), 4: " ".join(f"b{i}" for i in range(8)), 5: "...", None: "no id w1 w2"}
    docs = dict(enumerate(texts()))
    n = len(docs)
    docs |= {n: "x y " + (items[3] or "").upper() + " z", n + 1: "(short) ITEM, one; b0 b1 b2 b3 b4 b5 b6 b7 b8", n + 2: "one", n + 3: " ".join((items[3] or "").split()[4:12])}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    find = lambda t: word.findall((t or "").translate(low))
    wins = {i: {tuple(w[k : k + min(8, len(w))]) for k in range(len(w) - min(8, len(w)) + 1)} for i, t in items.items() if i is not None and (w := find(t))}
    want = {}
    for d, t in docs.items():
        w, hit, found = find(t), set(), set()
        for i, ws in wins.items():
            for win in ws:
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k : k + len(win)]) == win:
                        hit |= set(range(k, k + len(win)))
                        found.add(str(i))
        want[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = decontaminate.contamination(frame(spark, [(d, t, None, None, None) for d, t in docs.items()]), bench).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got} == want
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    none = decontaminate.contamination(odd(spark), bench.limit(0)).collect()
    assert len(none) == 5 and not any(r["n_items"] for r in none)


def test_packing_is_a_partition_of_all_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    docs = dict(enumerate(texts()))
    ids = {d: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], np.uint32) for d, t in docs.items()}
    got = packing.pack_documents(frame(spark), group_tokens=4000).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        x = ids[r["doc_id"]]
        assert zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(x)
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for groups, size in ((by_doc, lambda d: len(ids[d])), (by_seq, None)):
        for k, v in groups.items():
            at = 0
            for start, n in sorted(v):
                assert start == at
                at += n
            assert at == size(k) if size else at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    assert set(by_doc) == set(docs)
    assert packing.pack_documents(empty(spark)).count() == 0
    assert {r["doc_id"] for r in packing.pack_documents(odd(spark)).collect()} == {None, 1, 2, 3}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=8), st.integers(0, 60))
def test_closest_subset_is_optimal(counts, capacity):
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    best = max(s for s in sums if s <= capacity)
    taken = packing.closest_subset(counts, capacity)
    assert sum(n * k for n, k in taken.items()) == best
    assert all(0 < k <= counts[n] for n, k in taken.items())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB's.,!|<> \n\té…́İΣ1한  ")) , max_size=30), max_size=4))
def test_unit_tokenizer_equals_the_tokenizer(parts):
    tok = packing.UnitTokenizer(packing.tokenizer_path(), 1000)
    ids, counts = tok.encode(pa.array(parts, pa.string()))
    ends = np.cumsum(counts)
    for t, n, b in zip(parts, counts, ends, strict=True):
        assert ids[b - n : b].tolist() == tok.tok.encode(t, add_special_tokens=False).ids


def test_unit_tokenizer_keeps_special_marks_and_forgets():
    tok = packing.UnitTokenizer(packing.tokenizer_path(), 50)
    for t in ["<|endoftext|> A<|ENDOFTEXT|>b", *(f"word{i} thing{i}" for i in range(200)), " ".join(f"unit{i}" for i in range(5000)), "few again"]:
        assert tok.encode(pa.array([t]))[0].tolist() == tok.tok.encode(t, add_special_tokens=False).ids


def test_fingerprints(spark):
    docs = dict(enumerate(texts()))
    order = sorted(docs, reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint(frame(spark)).collect()}
    spans = lambda b: {b[i : i + 32] for i in range(max(1, len(b) - 31))} if b else set()
    for i, d in enumerate(order):
        t, nxt = docs[d] or "", docs[order[(i + 1) % len(order)]] or ""
        k = len(t) // 3
        e = t[: len(t) - k] + nxt[:k]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert r["common_prefix_bytes"] == len(os.path.commonprefix([t.encode(), e.encode()]))
        a, b = spans(t.encode()), spans(e.encode())
        assert abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1)) < 0.3
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (t == e)
    same = {}
    for d, r in got.items():
        assert same.setdefault(docs[d] or "", r["fingerprint"]) == r["fingerprint"]
    assert fingerprints.fingerprint(empty(spark)).count() == 0
    assert fingerprints.fingerprint(odd(spark)).count() == 5
    assert fingerprints.fingerprint(odd(spark).where("doc_id = 3")).collect()[0]["near_next"] == 1.0


@settings(max_examples=50, deadline=None)
@given(st.binary(min_size=2, max_size=80), st.data())
def test_prefix_hash_answers_spans(raw, data):
    h = fingerprints.PrefixHash(np.frombuffer(raw, np.uint8))
    a, b = data.draw(st.integers(0, len(raw))), data.draw(st.integers(0, len(raw)))
    n = data.draw(st.integers(0, len(raw) - max(a, b)))
    assert h.equal(a, b, n) == (raw[a : a + n] == raw[b : b + n])
    most = np.array([len(raw) - max(a, b)])
    assert fingerprints.common_extension(h, np.array([a]), h, np.array([b]), most)[0] == len(os.path.commonprefix([raw[a:], raw[b:]]))


def test_warc_round_trip(spark, tmp_path):
    big = "<html>" + "x" * 1200
    data = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", "tiny"), (4, "u", "tiny"), (5, "u", None), (6, "u", ""), (7, "u", big), (None, "u", big), (8, "ü", "é\r\n\r\nWARC/1.1\r\n" * 90), (7, "u", big)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    files = warc.write_warc(pages, str(tmp_path / "a"), roll_bytes=600)
    assert sum(f["records"] for f in files) == len(data) and len(files) > 2
    assert {p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")} == {f["name"] for f in files} | {"manifest.json"}
    got = warc.read_warc(spark, str(tmp_path / "a")).collect()
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=str)
    assert kinds == sorted([(1, "revisit", 7), (2, "revisit", 7), (7, "response", None), (7, "response", None), *((i, "response", None) for i in (3, 4, 5, 6, 8, None))], key=str)
    for r in got:
        html = next((h or "").encode() for p, _, h in data if p == r["page_id"])
        assert r["payload_bytes"] == len(html) and r["payload_digest"] == hashlib.sha1(html).hexdigest()
        assert r["payload"] == (html if r["record_type"] == "response" else None)
    again = warc.write_warc(pages.repartition(3), str(tmp_path / "b"), roll_bytes=600)
    assert again == files
    assert warc.write_warc(pages.limit(0), str(tmp_path / "c")) == [] and warc.read_warc(spark, str(tmp_path / "c")).count() == 0


def test_warc_files_do_not_depend_on_partitions(spark, tmp_path):
    """The same bytes for 300,000 rows under two partitionings and two settings, with crowded ranges and null ids."""
    from pyspark.sql import functions as F

    pages = spark.range(300_000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("page_id"),
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"),
        F.concat(F.lit("page "), (F.col("id") % 5000).cast("string")).alias("html"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = warc.write_warc(pages.repartition(3), str(tmp_path / "a"), revisit_bytes=5, cell_bytes=1 << 18, roll_bytes=200_000)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        two = warc.write_warc(pages.repartition(11), str(tmp_path / "b"), revisit_bytes=5, cell_bytes=1 << 18, roll_bytes=200_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == two and len(one) > 12 and sum(f["records"] for f in one) == 300_000
    assert max(f["records"] for f in one) < 90_000  # the id of a third of all rows is in several files
    some = warc.read_warc(spark, str(tmp_path / "a"), payload=False).where("page_id = 77 or page_id is null").groupBy("page_id", "record_type").count().collect()
    assert {(r["page_id"], r["record_type"]): r["count"] for r in some} == {(None, "response"): 30_000, (77, "revisit"): 90_001}


def test_warc_failure_leaves_nothing_behind(spark, tmp_path):
    from pyspark.sql import functions as F

    pages = spark.range(10).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") < 9, "x").otherwise(F.raise_error(F.lit("damaged")).cast("string")).alias("html"))
    with pytest.raises(Exception, match="damaged"):
        warc.write_warc(pages, str(tmp_path / "a"))
    assert not [p for p in (tmp_path / "a").rglob("*") if p.is_file()] if (tmp_path / "a").exists() else True


def test_sharding(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("shard"))
    got = sharding.shard(df, "doc_id", [1.0] * 8).collect()
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and 280 < len(slots) < 480
    grown = {r["doc_id"]: r["s"] for r in df.select("doc_id", sharding.shard_of(F.col("doc_id").cast("string"), [1.0] * 9).alias("s")).collect()}
    moved = [r for r in got if grown[r["doc_id"]] != r["shard"]]
    assert moved and all(grown[r["doc_id"]] == 8 for r in moved) and len(moved) < 450
    heavy = [r["shard"] for r in sharding.shard(df, "doc_id", [3.0, 1.0]).collect()]
    assert abs(heavy.count(0) / 3000 - 0.75) < 0.05
    assert sharding.shard(odd(spark), "doc_id", [1.0, 1.0]).count() == 5
    assert sharding.shard(empty(spark), "doc_id", [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("x"), [1.0, 0.0])


def test_sharding_numbers_runs_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SUB_ROWS", 50)
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    got = sharding.shard(df, "doc_id", [1.0, 1.0]).collect()
    for s in (0, 1):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_forward_sums_all_segmentations():
    """Also for words beyond any segment's length, in logarithms where sums of products would underflow."""
    pieces = [b"a", b"b", b"c", b"ab", b" a", b" ", b"ba", b"bbb", b"abababababababababababababababababab"]
    vocabulary = language.Vocabulary.of(pieces)
    rng = np.random.default_rng(5)
    p = rng.uniform(0.001, 0.2, (len(pieces), 3))
    texts_ = ["aba", "c ab", "ab" * 40, "abc" * 300, "a" * 2000, "", "bbbb"]

    def total(x):
        """log of the sum over all segmentations, place by place."""
        best = np.full((len(x) + 1, 3), -np.inf)
        best[0] = 0
        for i in range(len(x)):
            for k, q in enumerate(pieces):
                if x.startswith(q, i):
                    best[i + len(q)] = np.logaddexp(best[i + len(q)], best[i] + np.log(p[k]))
        return best[-1]

    w = language.words_of(pa.array(texts_))
    model = language.Model(vocabulary, ["x", "y", "z"], np.log(p))
    for most in (1 << 20, 1):  # remembering all words, and next to none
        worth = language.Worth(model, most)
        for _ in range(2):
            each = worth.of(w)
            for r, t in enumerate(texts_):
                assert np.allclose(each[w.text_of() == r].sum(axis=0), sum((total(b" " + x.encode()) for x in t.split()), np.zeros(3)), rtol=1e-9)


def test_expectation_maximisation_raises_the_likelihood():
    vocabulary = language.Vocabulary.of([b"a", b"b", b"ab", b" ", b" a"])
    data = pa.array(["ab ab a b", "abab b"])
    w = language.words_of(data)
    worth = [language.Worth(language.Model(vocabulary, ["x"], np.log(language.fit(vocabulary, data, rounds))[:, None])).of(w).sum() for rounds in range(1, 6)]
    assert all(y >= x - 0.05 for x, y in zip(worth, worth[1:], strict=False)) and abs(language.fit(vocabulary, data).sum() - 1) < 1e-9


def test_language(spark):
    rng = random.Random(3)
    own = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["zwei", "drei", "über", "schön"]}
    data = [(i, " ".join(rng.choice(own[x]) for _ in range(30)), x, None, None) for i, x in enumerate(["aa", "bb"] * 30)]
    df = frame(spark, data)
    model = language.train(df.where("doc_id < 40"))
    got = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    assert all(got[i]["lang_pred"] == x and 0 < got[i]["score"] <= 1 for i, _, x, _, _ in data)
    rest = {r["doc_id"]: r for r in language.identify(frame(spark), model).collect()}
    assert all((rest[i]["lang_pred"] == "und") == (not t or not any(c.isalpha() for c in t)) for i, t in enumerate(texts()))
    from pyspark.sql import functions as F

    clashing = df.withColumn("label", F.lit("x")).withColumn("n", F.lit(1)).withColumn("__id", F.lit(2)).withColumn("__u", F.lit(3))
    same = language.train(clashing.where("doc_id < 40"))
    assert same.languages == model.languages and np.array_equal(same.log_probs, model.log_probs)
    nothing = language.train(empty(spark))
    assert {r["lang_pred"] for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.identify(empty(spark), model).count() == 0
    assert language.identify(odd(spark), model).count() == 5


def test_training_sample_keeps_its_bounds(spark):
    from pyspark.sql import functions as F

    docs = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") % 5 == 0, F.repeat(F.lit("é"), 5000)).otherwise("short").alias("text"), (F.col("id") % 2).alias("label"))
    marks = docs.select("k", "label", F.length("text").alias("n"))
    rows = language.training_sample(docs, marks, "k", 1500, 1 << 30).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in rows} == {0: 1500, 1: 1500}
    rows = language.training_sample(docs, marks, "k", 1500, 20_000).collect()
    for label in (0, 1):
        own = [r["text"] for r in rows if r["label"] == label]
        assert 10_000 < sum(map(len, own)) <= 20_000 and max(map(len, own)) == 1250


def test_quality(spark):
    rng = random.Random(4)
    say = lambda bad: " ".join((f"W{rng.randrange(99)}!!" if bad else f"word{rng.randrange(99)}") for _ in range(60))
    data = [(i, say(i % 3 == 0), None, None, None) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(80)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    net = quality.train(frame(spark, data), labels)
    got = {r["doc_id"]: r["score"] for r in quality.classify(frame(spark, data), net).collect()}
    assert all((got[i] >= 0.5) == (i % 3 != 0) for i in got)
    assert all(0 <= r["score"] <= 1 for r in quality.classify(frame(spark), net).collect())
    assert quality.classify(empty(spark), net).count() == 0 and quality.classify(odd(spark), net).count() == 5
    flat = quality.train(frame(spark, data), labels.limit(0))
    assert {r["score"] for r in quality.classify(frame(spark, data), flat).collect()} == {0.5}


def test_chunks_cover_every_window():
    for n in (0, 1, 4, 5, 255, 256, 257, 600):
        first, last, row = quality.chunks(np.zeros(n, np.uint8), np.array([0, n]))
        seen = [w for a, b in zip(first, last, strict=True) for w in range(a, b)]
        assert seen == list(range(max(n - quality.WIDTH + 1, 1) if n else 0))


def test_pooling_equals_direct_convolution():
    rng = np.random.default_rng(0)
    net = quality.Network(rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), rng.normal(size=quality.FILTERS).astype(np.float32), np.ones(quality.FILTERS), 0.0, 0.5)
    raw = [b"", b"ab", bytes(rng.integers(0, 256, 700, dtype=np.uint8)), b"", b"xyzzy", b"q" * 256]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got, _ = quality._pooled(net, np.frombuffer(b"".join(raw), np.uint8), offsets, spots=True)
    for x, g in zip(raw, got, strict=True):
        if not x:
            assert (g == 0).all()
            continue
        pad = x + b"\0" * max(0, quality.WIDTH - len(x))
        act = np.array([sum(net.tables[k][pad[i + k]] for k in range(quality.WIDTH)) for i in range(len(pad) - quality.WIDTH + 1)])
        step = quality.CHUNK - quality.WIDTH + 1
        tops = [np.maximum(act[i : i + step].max(axis=0) + net.bias, 0) for i in range(0, len(act), step)]
        assert np.allclose(g, np.mean(tops, axis=0), atol=1e-4)

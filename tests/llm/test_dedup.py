import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import empty, frame, odd, texts

from lettermill.llm import lines, minhash, substrings
from lettermill.llm.bloom import Bloom

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_near(docs, k, percent):
    sets = {}
    for d, t in docs.items():
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_against_all_pairs(spark, k):
    docs = dict(enumerate(texts()))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark), shingle=k).collect()}
    want = brute_near(docs, k, 80)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def test_near_duplicates_chain_is_one_component(spark):
    """Each text is linked with its neighbours only."""
    word = [f"v{i}" for i in range(400)]
    data = [(i, " ".join(word[5 * i : 5 * i + 100]), None, None, None) for i in range(40)]
    got = {r["component_id"] for r in minhash.near_duplicates(frame(spark, data)).collect()}
    assert got == {0}


def test_near_duplicates_crowd_of_unlinked_texts(spark):
    """Texts that share enough to meet in buckets, in several groups that aren't linked."""
    common = [f"c{i}" for i in range(60)]
    data = [(40 * g + i, " ".join(common + [f"g{g}x{j}" for j in range(28)] + [f"u{g}n{i}a"]), None, None, None) for g in range(4) for i in range(12)]
    docs = {r[0]: r[1] for r in data}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame(spark, data)).collect()}
    assert got == brute_near(docs, 4, 80)


def test_near_duplicates_odd_rows(spark):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd(spark)).collect()]
    assert sorted(got, key=str) == sorted([(None, 2, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True)], key=str)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    for n in (1, 2, 50):
        assert (minhash.sketches(np.sort(a[:n]), np.array([n])) != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    x, y = np.sort(a[:800]), np.sort(a[200:])  # similarity 0.6
    s = minhash.sketches(np.concatenate([x, y]), np.array([800, 800]))
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15


def brute_lines(docs, least=40, most=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    held = {}
    for d, t in docs.items():
        for x in set(map(key, (t or "").split("\n"))):
            if len(x) >= least:
                held.setdefault(x, []).append(d)
    gone = {x: max(ds) for x, ds in held.items() if len(ds) >= most}
    out = {}
    for d, t in docs.items():
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (key(x) in gone and d < gone[key(x)])]
        out[d] = (len(ls), len(ls) - len(kept), sha("\n".join(kept)))
    return out


@pytest.mark.parametrize("keys,few", [(100_000_000, 1 << 19), (5, 1 << 19), (100_000_000, 0), (5, 0)])
def test_lines_against_brute_force(spark, keys, few):
    """By filters for all lines and by ranges of them; with repeated lines broadcast, and joined."""
    got = lines.dedup_lines(frame(spark), keys=keys, few=few).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == brute_lines(dict(enumerate(texts())))
    assert any(r["n_dropped"] for r in got)
    assert all(sha(r["text"] or "") == r["kept_sha256"] for r in got)


def test_lines_odd_rows_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    df = odd(spark).withColumn("n_lines", F.lit("mine")).withColumn("__drop", F.lit(1))
    assert sorted(r["n_lines"] for r in lines.dedup_lines(df).collect()) == [1, 1, 1, 1, 1]
    assert lines.dedup_lines(empty(spark)).count() == 0


def brute_substrings(docs, n=13):
    first = {}
    ws = {d: WORD.findall(t or "") for d, t in docs.items()}
    for d, w in sorted(ws.items()):
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), d)
    out = {}
    for d, w in ws.items():
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone |= set(range(i, i + n))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("hot,shard", [(5000, 10_000), (0, 10_000), (2, 1)])
def test_substrings_against_brute_force(spark, hot, shard):
    got = substrings.remove_repeats(frame(spark), hot=hot, shard=shard, keep_text=True, keys=0 if hot == 2 else 1 << 20).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_substrings(dict(enumerate(texts())))
    assert all(r["whole"] or sha(r["kept"]) == r["kept_sha256"] for r in got)


def test_substrings_tells_words_apart_whose_hashes_collide(spark, monkeypatch):
    """Where all words of one length have one hash, passages of different words must stay."""
    monkeypatch.setattr(substrings.Words, "hashes", lambda self, seed: (self.ends - self.starts).astype(np.uint64))
    base = [f"w{i}" for i in range(1, 10)] + ["x", "yy", "zzz"]
    data = [(1, " ".join([*base, "INV0309455"])), (2, " ".join([*base, "INV0394037"])), (3, " ".join([*base, "INV0394037", "end"])), (4, " ".join(reversed(base)) + " tail")]
    schema = pa.schema([("doc", pa.int64()), ("text", pa.string())])
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in data]), pa.array([t for _, t in data])], schema=schema)

    class Shared:
        value = None

    segments = pa.Table.from_batches(list(substrings._segments(Shared, 13, 5)(iter([batch])))).to_pylist()
    assert len({s["anchor"] for s in segments}) < len(segments)
    rows = sorted({(s["anchor"], s["words"]) for s in segments})
    held = [(a, w, min(s["doc"] for s in segments if s["words"] == w), max(s["doc"] for s in segments if s["words"] == w)) for a, w in rows]
    found = {w: f for (_, w, _, _), f in zip(held, substrings.locate(held, 13), strict=True)}
    assert found[data[0][1]] == ([], []) and found[data[1][1]][1] in ([2], []) and all(f[1] in ([], [2]) for f in found.values())
    assert [2] in [f[1] for f in found.values()]


def test_substrings_odd_rows(spark):
    assert sorted(r["n_removed"] for r in substrings.remove_repeats(odd(spark)).collect()) == [0] * 5
    assert substrings.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3000, 200_000])
def test_filters_are_sized_from_their_keys(spark, n):
    """One in fifty other keys at most is suspect, whatever the number of keys; beyond its bound there is no filter."""
    from lettermill.llm import bloom

    packed = bloom.of_column(spark.range(n).toDF("k"), "k", mix=True)
    f = bloom.opened(packed)
    other = bloom.mix64(np.arange(n, n + 50_000, dtype=np.uint64))
    assert f.has(bloom.mix64(np.arange(n, dtype=np.uint64))).all() and f.has(other).mean() < 0.02
    assert 8 * len(packed) == 1 << bloom.log_bits_for(n) and 8 * len(packed) <= max(1 << 18, 20 * n)
    assert n == 0 or bloom.opened(bloom.of_column(spark.range(n).toDF("k"), "k", mix=True, keys=n - 1)).has(other).all()


def test_a_full_filter_only_suspects_more(spark, monkeypatch):
    """Lines are as by brute force even where the filters have a bit a line."""
    monkeypatch.setattr(lines, "log_bits_for", lambda n: 18)
    docs = {d: "\n".join([f"line {i} of document {d}, which no other document has" for i in range(700)] + ["a line that every document has, whatever else is in it"]) for d in range(300)}
    got = lines.dedup_lines(frame(spark, [(d, t, None, None, None) for d, t in docs.items()])).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == brute_lines(docs)


def test_bloom_has_what_was_added():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    f = Bloom(20)
    f.add(h)
    assert f.has(h).all()
    assert f.has(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.05


def test_line_spans_ignore_short_and_blank_lines():
    data = np.frombuffer(("  \n" + "é" * 40 + "\nshort").encode(), np.uint8)
    found = lines.Lines(data, np.array([0, len(data)]), 40)
    assert len(found.starts) == 1 and found.ends[0] - found.starts[0] == 80
    assert isinstance(pa.array(found.row), pa.Array)

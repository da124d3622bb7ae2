import random

from llm_fixtures import words
from test_dedup import brute_lines, brute_near

import corpus_pipeline


def test_every_stage_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    line = "a line of boilerplate that many of these documents have in common"
    item = " ".join(f"q{i}" for i in range(12))
    data = []
    for i in range(60):
        w = [f"W{rng.randrange(9)}!!" for _ in range(50)] if i % 4 == 0 else words(rng, 60)
        data.append((i, " ".join(w) + (f"\n{line}" if i % 2 else ""), "en", "s", 0))
    data += [(60 + i, data[4 * i + 1][1] + " end", "en", "s", 0) for i in range(5)]
    data += [(70, " ".join(words(rng, 30)) + " " + item, "en", "s", 0), (71, None, None, None, None)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sf_dir = str(tmp_path)

    def held(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}

    stages = [f for _, f in corpus_pipeline.STAGES]
    good = stages[0](spark, docs, sf_dir)
    assert good.columns == docs.columns
    before = held(good)
    assert {d for d in before if d < 60} == {i for i in range(60) if i % 4}
    cut = stages[1](spark, good, sf_dir)
    after = held(cut)
    want = brute_lines(before)
    assert {d: len((t or "").split("\n")) for d, t in after.items()} == {d: max(1, n - k) for d, (n, k, _) in want.items()}
    assert any(k for _, k, _ in want.values())
    single = stages[2](spark, cut, sf_dir)
    groups = brute_near(after, 5, 80)
    assert set(held(single)) == {d for d, (_, c) in groups.items() if c == d}
    clean = stages[3](spark, single, sf_dir)
    assert set(held(single)) - set(held(clean)) == {70}
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == set(held(clean))


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, rows without ids, repeated rows and columns that clash, through every stage."""
    from llm_fixtures import empty, odd
    from test_queries import clashing

    from lettermill.session import stored

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "twice the same text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs, kept in ((empty(spark), [0, 0, 0, 0]), (clashing(odd(spark)), [5, 5, 5, 3])):
        for (_, stage), n in zip(corpus_pipeline.STAGES[:-1], kept, strict=True):
            docs = stored(stage(spark, docs, str(tmp_path)))
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == n
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert {r["doc_id"] for r in packed} == ({None, 2, 3} if kept[0] else set())

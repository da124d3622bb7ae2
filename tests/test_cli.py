"""Command line, reports, the language test, and the registered queries against their SQL."""

import io
import json
import sys

import duckdb
import pytest
from pyspark.sql import functions as F
from test_mail import MIXED, PLAIN, RICH, tree

from lettermill import __main__ as cli
from lettermill import catalog
from lettermill.functions.language import english


def test_build_command(spark, tmp_path):
    tree(tmp_path / "raw")
    out = tmp_path / "out"
    text = cli.run(spark, ["build", "--raw", str(tmp_path / "raw"), "--out", str(out), "--near", "exact", "--language", "any"])
    assert "Messages read: 8, kept: 6" in text and "Folders of no known source: unknown" in text
    rows = [json.loads(x) for p in out.glob("part-*") for x in p.read_text().splitlines()]
    assert len(rows) == 6
    table = text[text.index("By source, label and split:") :].splitlines()
    assert table[1].split() == ["source", "label", "train", "val", "test", "total"]
    sums = [x for x in table if x.split()[:1] == ["total"]]
    assert sums[0].split()[-1] == "6" and sums[1].split() == ["total", "1"]
    few = cli.run(spark, ["build", "--raw", str(tmp_path / "raw"), "--out", str(out), "--near", "off", "--limit-per-source", "1", "--language", "any"])
    assert "kept: 4" in few and "(must be 0) 0" in " ".join(few.split())


def test_import_command(spark, tmp_path):
    for name, raw in {"bec/0000.eml": PLAIN, "bec/0001.eml": PLAIN, "ham/0000.eml": RICH}.items():
        path = tmp_path / "eml" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    args = ["import", "--eml-dir", str(tmp_path / "eml"), "--dataset", str(tmp_path / "d.jsonl")]
    text = " ".join(cli.run(spark, [*args, "--dry-run"]).split())
    assert "dry run" in text and "bec 1 of 2" in text and "ham 1 of 1" in text and "known or repeated 1" in text
    assert "synthetic n=2" in " ".join(cli.run(spark, args).split())
    assert "bec 0 of 2" in " ".join(cli.run(spark, args).split())


def test_record_command(spark, tmp_path, monkeypatch):
    (tmp_path / "m.eml").write_bytes(MIXED)
    shown = json.loads(cli.run(spark, ["record", str(tmp_path / "m.eml"), "--runtime", "--id", "7", "--label", "phishing"]))
    assert len(shown) == 18 and shown["id"] == "7" and shown["label"] == "phishing" and shown["split"] is None and shown["has_attachment"] is True
    monkeypatch.setattr(sys, "stdin", type("In", (), {"buffer": io.BytesIO(PLAIN)})())
    shown = json.loads(cli.run(spark, ["record", "-"]))
    assert len(shown) == 10 and shown["text"] == "Hello there bye"
    with pytest.raises(SystemExit):
        cli.main(["record"])


def test_english(spark):
    cases = {
        "Please confirm that the payment is ready for your account": True, "Bitte bestätigen Sie, dass die Zahlung auf das Konto ist": False, "Le paiement est dans les comptes que vous avez": False,
        "los pagos están para el cliente": False, "12345 ...": None, "": None, None: None, "xyzzy plugh": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", english(F.col("t"))).collect()} == cases


SLOW = {"near_lsh_clusters"}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Tables like the registered queries', a few rows each."""
    folder = tmp_path_factory.mktemp("sf")
    docs = [(i, f"see  the {'same text' if i % 4 == 0 else f'text {i} of many'} and www . a . b{i} <b>x</b>" + " word" * (i * 20), ["en", "fr", None, "de", "es"][i % 5], f"src{i % 4}", 20 + 100 * i) for i in range(20)]
    docs += [(20, "", "en", "src0", 0)]
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, i % 2, 0) for i in range(0, 20, 3)], "doc_id long, quality int, toxic int"),
        "pages": ([(i, f"https://h{i}.example/p", f"<html><a href='u{i}'>t &amp; {i}</a><script>x</script></html>") for i in range(6)], "page_id long, url string, html string"),
        "conversations": ([(c, t, ["user", "assistant"][t % 2], f"turn {t} of {c}, said at length") for c in range(9) for t in range(3)], "conv_id long, turn long, role string, text string"),
        "events": ([(i, ["click", "view"][i % 2], float(i * 9)) for i in range(12)], "event_id long, event_type string, value double"),
        "nation": ([(i, f"n{i}", i % 2) for i in range(7)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        path = f"{folder}/{name}.parquet"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    return str(folder), con


def plain(value):
    if isinstance(value, list):
        return tuple(map(plain, value))
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, small, name):
    folder, con = small
    df = catalog.QUERIES[name](spark, folder)
    got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    if name in SLOW:
        assert len(got) == 21
        return
    found = con.execute(catalog.ORACLE[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in found.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(names) and got == want

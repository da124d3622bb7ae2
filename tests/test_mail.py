"""Messages, mailboxes, the raw tree, the build, imports and the stream, on hand-written mail."""

import hashlib
import json
import time

from pyspark.sql import functions as F

from lettermill.config import BuildConfig
from lettermill.operators import mime
from lettermill.plans import build
from lettermill.sources import mail, sinks
from lettermill.streaming import runtime

PLAIN = b"From: Ann Example <Ann@Example.org>\nSubject: Hello\nMessage-ID: <m1@x>\n\nHello  there https://a.example/x\nbye\n"
MIXED = (
    b"From: =?utf-8?q?B=C3=B6b?= <bob@example.org>\nSubject: Re: Hello\nIn-Reply-To: <m1@x>\nReferences: <m0@x> <m1@x>\n"
    b"Authentication-Results: mx;\n spf=pass\nAuthentication-Results:  \nAuthentication-Results: dkim=fail\n"
    b"MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=B\n\n"
    b"--B\nContent-Type: multipart/alternative; boundary=C\n\n"
    b"--C\nContent-Type: text/plain; charset=latin-1\nContent-Transfer-Encoding: 8bit\n\nCaf\xe9 one\n"
    b"--C\nContent-Type: text/html\n\n<p>rich <a href=\"hxxp://evil.example/q\">l</a> <img src=/local></p>\n--C--\n"
    b"--B\nContent-Type: text/plain; name=\"note.txt\"\n\ninline but named\n"
    b"--B\nContent-Type: image/png\nContent-Disposition: attachment; filename=\"q.png\"\nContent-Transfer-Encoding: base64\n\nUE5H\n"
    b"--B\nContent-Type: application/pdf\nContent-Disposition: attachment\n\n\n"
    b"--B\nContent-Type: message/rfc822\n\nSubject: inner\nContent-Type: text/plain\n\ninner text\n--B--\n"
)
RICH = b"From: c@example.org\nSubject: x\nContent-Type: text/html; charset=nonsense\n\n<style>p{}</style><p>A &amp;lt;b&amp;gt; bold &eacute;</p>\n"


def parsed(spark, *raws, **kw):
    return mime.parse_messages(spark.createDataFrame([(i, bytearray(r) if r is not None else None) for i, r in enumerate(raws)], "i int, message binary"), **kw)


def test_training_record(spark):
    rows = {r["i"]: r for r in mime.epi_record(parsed(spark, PLAIN, MIXED, RICH), source=F.lit("s")).collect()}
    assert rows[0]["text"] == "Hello there bye" and rows[0]["from"] == "Ann Example <Ann@Example.org>" and rows[0]["source"] == "s" and rows[0]["id"] is None
    assert rows[1]["text"] == "Café one inner text" and rows[1]["references"] == "<m0@x> <m1@x>" and rows[1]["in_reply_to"] == "<m1@x>"
    assert rows[2]["text"] == "A bold é"


def test_runtime_record(spark):
    base = parsed(spark, PLAIN, MIXED, RICH, qr_decoder=lambda b: ["https://qr.example/" + b.decode()])
    rows = {r["message_id"] or r["subject"]: r for r in mime.runtime_record(base).collect()}
    first, mixed = rows["<m1@x>"], rows["Re: Hello"]
    assert len(mixed) == 18 and mixed.__fields__[-2:] == ["urls", "attachments"]
    assert first["urls"] == ["https://a.example/x"] and first["has_url"] and not first["has_attachment"] and first["attachments"] == []
    assert mixed["urls"] == ["http://evil.example/q", "https://qr.example/PNG"] and mixed["has_qr"]
    assert mixed["auth_results"] == "mx; spf=pass | dkim=fail" and mixed["from"] == "Böb <bob@example.org>"
    files = {a["content_type"]: a for a in mixed["attachments"]}
    assert files["image/png"]["sha256"] == hashlib.sha256(b"PNG").hexdigest() and files["image/png"]["size"] == 3
    assert files["application/pdf"]["size"] <= 1 and files["text/plain"]["filename"] == "note.txt"


def test_codes_of_pictures(spark):
    """Codes are trimmed, those without a URL don't count, a decoder that fails finds none."""
    def some(payload):
        return ["  www.qr.example/a ", " not a url ", b" hxxps://q[.]example ", "see http://in.text/x"]

    def raising(payload):
        raise ValueError("no picture")

    found = mime.runtime_record(parsed(spark, MIXED, qr_decoder=some)).first()
    assert found["urls"] == ["http://evil.example/q", "https://q.example", "see http://in.text/x", "www.qr.example/a"] and found["has_qr"]
    none = mime.runtime_record(parsed(spark, MIXED, qr_decoder=raising)).first()
    assert none["urls"] == ["http://evil.example/q"] and not none["has_qr"] and none["has_attachment"] and none["subject"] == "Re: Hello"
    only = mime.runtime_record(parsed(spark, MIXED.replace(b"hxxp://evil.example/q", b""), qr_decoder=lambda b: [" not a url "])).first()
    assert not only["has_qr"] and not only["has_url"] and only["urls"] == []


def test_html_by_parser(spark):
    from lettermill.functions import markup

    page = RICH.replace(b"<p>A", b"<p title='a>b'>A").replace(b"</p>", b"<a href='www.l.example'>t</a></p>")
    rec = mime.epi_record(parsed(spark, page, PLAIN), html_stripper=markup.strip_parts).orderBy("i").collect()
    assert rec[0]["text"] == "A bold é t" and rec[1]["text"] == "Hello there bye"
    run = mime.runtime_record(parsed(spark, page), html_stripper=markup.strip_parts).first()
    assert run["urls"] == ["www.l.example"] and run["text"] == "A bold é t"


def test_unparsable_messages_are_marked(spark):
    rows = parsed(spark, None, b"", PLAIN).orderBy("i").collect()
    assert rows[0]["parsed"]["parse_error"] and rows[1]["parsed"]["parse_error"] is None and rows[2]["parsed"]["sender"] == "ann@example.org"


def test_senders():
    assert mime.sender_of('"Last, First" <A@B.c>') == "a@b.c"
    assert mime.sender_of("nobody") is None and mime.sender_of(None) is None and mime.sender_of("") is None


def test_splitting_mailboxes():
    sep = b"From x@y Mon Jan 01 00:00:00 2024\n"
    two = sep + PLAIN + b"\n" + sep + RICH
    assert mime.split_messages(two) == [sep + PLAIN + b"\n", sep + RICH]
    assert mime.split_messages(b"junk\n" + two) == [b"junk\n" + two]  # no separator leads: one message
    assert mime.split_messages(b"junk\n" + two, "a.MBOX") == [sep + PLAIN + b"\n", sep + RICH]
    assert mime.split_messages(PLAIN, "a.mbox") == [] and mime.split_messages(PLAIN) == [PLAIN]
    assert mime.split_messages(b" \n") == [] and mime.split_messages(None) == [] and mime.split_messages(b"no mail at all") == []


def tree(root):
    files = {
        "enron/a/1.": PLAIN, "enron/a-b/2.": b"From: z@example.org\nSubject: y\n\nunique text of enron\n", "nazario/box.mbox": b"From a@b Mon Jan 01 00:00:00 2024\n" + PLAIN + b"From a@b Tue Jan 02 00:00:00 2024\n" + RICH,
        "spamassassin/hard_ham/1": b"From: h@example.org\nSubject: Re: Topic\n\nhard ham text\n", "spamassassin/easy/1": b"From: e@example.org\nSubject: Fwd: topic\n\neasy text entirely different\n",
        "spamassassin/easy/2": b"From: e@example.org\nSubject: other\n\n \n", "spamassassin/easy/3": b"not mail", "unknown/1": PLAIN, "phishing_pot/sub dir/1.eml": MIXED,
    }
    for name, raw in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)


def test_build_end_to_end(spark, tmp_path):
    tree(tmp_path / "raw")
    out = build.build_dataset(spark, str(tmp_path / "raw"), str(tmp_path / "out"), BuildConfig(near="exact"))
    s = out.stats
    assert s["skipped_unknown_source"] == ["unknown"] and s["parsed"] == 8
    assert s["dropped_duplicate"] == 1 and s["dropped_empty_or_undetected"] == 1 and s["kept"] == 6 and s["near_clusters_leaked"] == 0
    rows = [json.loads(line) for p in sorted((tmp_path / "out").glob("part-*")) for line in p.read_text().splitlines()]
    assert all(list(r) == ["id", "text", "label", "source", "split"] for r in rows)
    assert [(r["split"], r["source"], r["id"]) for r in rows] == sorted((r["split"], r["source"], r["id"]) for r in rows)
    recs = {r["text"]: r for r in out.records.collect()}
    assert recs["Hello there bye"]["source"] == "enron"  # first of the sources wins
    assert recs["hard ham text"]["_is_hard_ham"] and recs["hard ham text"]["component"] == recs["easy text entirely different"]["component"]
    assert recs["Hello there bye"]["component"] == recs["Café one inner text"]["component"]  # one thread
    again = build.build_dataset(spark, str(tmp_path / "raw"), None, BuildConfig(near="lsh", near_max_cluster=1))
    assert again.stats["kept"] == 6
    limited = build.build_dataset(spark, str(tmp_path / "raw"), None, BuildConfig(near="off", limit_per_source=1))
    assert limited.stats["by_source"] == {"enron": 1, "nazario": 1, "phishing_pot": 1, "spamassassin": 1}


def test_language_filter_counts(spark, tmp_path):
    tree(tmp_path / "raw")
    english = lambda t: F.when(F.trim(t) != "", ~F.contains(t, F.lit("é")))
    s = build.build_dataset(spark, str(tmp_path / "raw"), None, BuildConfig(near="off"), english).stats
    assert s["dropped_non_english"] == 2 and s["kept"] == 4


def test_sampling_keeps_order_and_is_repeatable():
    files = [f"f{i:03}" for i in range(50)]
    few = mail.sample_files(files, 7, 42)
    assert few == sorted(few) and len(few) == 7 and few == mail.sample_files(files, 7, 42)
    assert mail.sample_files(files, 0, 1) == files and mail.sample_files(files, 50, 1) == files


def test_files_are_ordered_by_components(spark, tmp_path):
    tree(tmp_path)
    assert mail.list_files(spark, str(tmp_path / "enron")) == ["a/1.", "a-b/2."]
    files, _ = mail.read_tree(spark, str(tmp_path), BuildConfig(sample_files=1))
    assert files.where("source = 'enron'").count() == 1 and files.where("label is null").count() == 0


def test_hidden_folders_are_read(spark, tmp_path):
    """Mail in folders whose names begin with an underscore or a dot is mail like any other."""
    for name in ("enron/x/_sent mail/1.", "enron/x/in/2.", "nazario/_a/.b/3", "nazario/c;d/.e/4", "nazario/[f]/5", "phishing_pot/empty/"):
        path = tmp_path / name
        (path if name.endswith("/") else path.parent).mkdir(parents=True, exist_ok=True)
        if not name.endswith("/"):
            path.write_bytes(PLAIN)
    assert mail.list_files(spark, str(tmp_path / "enron")) == ["x/_sent mail/1.", "x/in/2."]
    for few in (0, 3000):
        files, _ = mail.read_tree(spark, str(tmp_path), BuildConfig(sample_files=few))
        found = sorted("/".join([r["source"], *r["path_parts"]]) for r in files.select("source", "path_parts").collect())
        assert found == ["enron/x/_sent mail/1.", "enron/x/in/2.", "nazario/[f]/5", "nazario/_a/.b/3", "nazario/c;d/.e/4"]


def test_import_of_classes(spark, tmp_path):
    for name, raw in {"bec/0000.eml": PLAIN, "bec/0001.eml": PLAIN, "ham/0000.eml": RICH, "ham/0001.eml": b"From: a@b\nSubject: x\n\n\n", "ham/note.txt": PLAIN, "ham/deep/2.eml": MIXED, "other/1.eml": MIXED}.items():
        path = tmp_path / "eml" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    data = str(tmp_path / "data.jsonl")
    first = build.import_classes(spark, str(tmp_path / "eml"), data, dry_run=True)
    assert first["generated"]["bec"] == 2 and first["accepted"] == {"bec": 1, "whaling": 0, "clone": 0, "qr": 0, "ai_creds": 0, "ham": 1}
    assert first["dropped_dup"] == 1 and first["dropped_empty"] == 1 and first["failed"] == 0 and first["by_label"] == {"legitimate": 1, "phishing": 1}
    assert mail.read_dataset(spark, data).count() == 0
    build.import_classes(spark, str(tmp_path / "eml"), data, manifest=str(tmp_path / "manifest.json"))
    assert json.loads((tmp_path / "manifest.json").read_text())["results"]["accepted"]["ham"] == 1
    again = build.import_classes(spark, str(tmp_path / "eml"), data)
    assert sum(again["accepted"].values()) == 0 and again["dropped_dup"] == 3
    rows = mail.read_dataset(spark, data)
    assert {r["split"] for r in rows.collect()} == {"train"} and mail.existing_ids(spark, data).count() == 2
    assert mail.real_text_lengths(rows).count() == 0


def test_datasets_of_mixed_rows(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"id": "1", "text": "a", "label": null, "source": "enron", "split": "val"}\n\nbroken\n{"id": "2", "text": "bcd", "source": null, "from": "x"}\n{"id": "3", "text": "zz", "source": "synthetic"}\n')
    rows = mail.read_dataset(spark, str(path))
    assert sorted(r["id"] for r in rows.where("id is not null").collect()) == ["1", "2", "3"]
    assert sorted(r["n"] for r in mail.real_text_lengths(rows).collect()) == [1, 3]


def test_message_files(spark, tmp_path):
    df = spark.createDataFrame([("ham", 3, bytearray(PLAIN)), ("qr", 12345, bytearray(RICH))], "class string, n int, message binary")
    done = sinks.write_messages(df, str(tmp_path / "eml")).collect()
    assert (tmp_path / "eml/ham/0003.eml").read_bytes() == PLAIN and (tmp_path / "eml/qr/12345.eml").read_bytes() == RICH and len(done) == 2
    assert not list((tmp_path / "eml").rglob("*.tmp"))
    assert json.loads(sinks.to_json(spark.createDataFrame([(1, None)], "a int, b string")).first()["json"]) == {"a": 1, "b": None}


def test_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.eml").write_bytes(PLAIN)
    (tmp_path / "in/2.eml").write_bytes(PLAIN)
    (tmp_path / "in/3.eml").write_bytes(MIXED)
    stream = runtime.runtime_stream(runtime.message_stream(spark, str(tmp_path / "in")), qr_decoder=lambda b: ["https://qr.example/x"])
    q = stream.writeStream.format("memory").queryName("mail_records").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    for _ in range(240):
        if not q.isActive:
            break
        time.sleep(0.5)
    assert q.exception() is None
    rows = {r["text"]: r for r in spark.table("mail_records").collect()}
    assert sorted(rows) == ["Café one inner text", "Hello there bye"]
    assert rows["Café one inner text"]["has_qr"] and "https://qr.example/x" in rows["Café one inner text"]["urls"]


def test_mail_tasks_keep_their_size(spark, tmp_path):
    """A table of mail is dealt out by its bytes, and not only to as many tasks as there are cores."""
    from lettermill import session

    spark.range(40_000).selectExpr("id", "sha2(cast(id as string), 256) as t").repartition(6).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    size = session.file_bytes(rows)
    assert sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet")) == size
    assert session.spread(rows, size // 20).rdd.getNumPartitions() in (20, 21)
    assert session.spread(rows, size // 20).exceptAll(rows).count() == 0


def test_header_memory_is_small():
    """Headers of which each message has its own fill the memory of every worker: some kilobytes each."""
    for i in range(3000):
        mime.parse(b"From: a@b.example\nMessage-ID: <%d@x>\nReferences: <%d@y>\n\nx\n" % (i, i))
    assert mime._header.cache_info().currsize <= 1000


def test_mailboxes_are_parsed_by_one_worker(spark):
    sep = b"From x@y Mon Jan 01 00:00:00 2024\n"
    boxes = [("a.mbox", bytearray(sep + PLAIN + b"\n" + sep + RICH)), ("b", bytearray(MIXED)), ("c", None), ("d", bytearray(b"no mail"))]
    files = spark.createDataFrame(boxes, "path string, content binary")
    got, want = mime.parsed_messages(files), mime.parse_messages(mime.explode_messages(files))
    assert got.schema == want.schema and got.orderBy("path", "ord").collect() == want.orderBy("path", "ord").collect() and got.count() == 3
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_small_files_share_tasks(spark, tmp_path):
    folder = tmp_path / "enron/x"
    folder.mkdir(parents=True)
    for i in range(700):
        (folder / f"{i}.").write_bytes(PLAIN)
    files, _ = mail.read_tree(spark, str(tmp_path), BuildConfig(sample_files=0))
    assert files.rdd.getNumPartitions() <= 16  # 22 before
    assert {r[0] for r in files.selectExpr("element_at(path_parts, -1)").collect()} == {f"{i}." for i in range(700)}

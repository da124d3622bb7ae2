"""Text functions on texts with literal results, and on texts built to overflow or to slow down a matcher."""

import html
import unicodedata

import pytest
from pyspark.sql import functions as F

from lettermill.functions import markup
from lettermill.functions import text as X


def check(spark, f, cases):
    """Every text of cases, given to f, has its result."""
    texts = list(cases)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(2)
    got = dict(zip(texts, (r[0] for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").select("x").collect()), strict=True))
    assert got == cases


def test_collapse(spark):
    check(spark, X.collapse, {"": "", "plain words": "plain words", "  two\n\nlines \x1c\x1d ": "two lines", "a  b c\x85d": "a b c d", "a​b": "a​b"})


def test_strip_urls(spark):
    cases = {
        "see https://www.h and (https://x/y) now. Bye": "see   and ( ) now. Bye",
        "https://a.example. Thanks": "  Thanks",
        "FTP://f/x'y": " 'y",
        "HTTP : / / spaced . example / path rest": "  rest",
        "go www . a . b / c / d e": "go   e",
        "www12.example.org/path?q=1&amp;r=2 end": "  end",
        "h t t p wwww www": "h t t p wwww www",
        "http://": " ",
        "http:// word.more/x y": "  y",
    }
    check(spark, X.strip_urls, cases)


def test_find_urls(spark):
    cases = {
        "https://www.h": ["https://www.h", "https://www.h", "www.h"],
        "(https://x/y)": ["https://x/y", "https://x/y)"],
        "https://a.example. Thanks": ["https://a.example.", "https://a.example.Thanks"],
        "https://a:8080/x": ["https://a:8080/x", "https://a"],
        "hxxps://evil[.]example/p": ["hxxps://evil[.", "hxxps://evil"],
        "see www . a . b": ["www.a.b"],
        "fxp : //x / y z": ["fxp://x/y"],
        "nothing": [],
    }
    check(spark, X.find_urls, cases)


def test_live_url(spark):
    check(spark, X.live_url, {" hXXps://a[.]b(.)c[dot]d ": "https://a.b.c.d", "FXP://x": "ftp://x", "http://ok": "http://ok", "HXXPS://a": "httpS://a"})


def test_unescape(spark):
    texts = ["", "no entity", "&amp;lt;b&amp;gt; &eacute; &#39; &nbsp;", "&notit; &not &#x41 &bogus;", "a & b", "&AMP &lt"]
    check(spark, X.unescape, {t: html.unescape(t) for t in texts})


def test_html(spark):
    cases = {
        '<p class="x">hi</p> <a href=\'l\'>z</a>': " hi   z ",
        "<script>a<b</script>x<STYLE>y</style>z<tag\nnext>": " x z ",
        "<script>never closed": " never closed",
        "a < b &lt;i&gt;": "a < b <i>",
        "<>x<<y>": "<>x ",
        "<scripted>s</scripted>": " s ",
    }
    check(spark, X.html_text, cases)
    links = {
        '<a href="u1"><img SRC = \'u2\'><form action=u3>': ["u1", "u2", "u3"],
        '<a href=" sp "><a href=""><a data-href="d">': ["sp", "d"],
        "<a xhref=q src=>": [],
    }
    check(spark, X.html_links, links)


def test_html_parser(spark):
    page = '<p>a &amp; b</p><style>s{}</style><IMG src="i"><a href=" l ">t</a><script>x<y</script><iframe src=f></iframe><b data-href=n>z'
    assert markup.strip(page) == ("a & b t z", ["l", "i", "f"])
    assert markup.strip(None) == ("", [])
    df = spark.createDataFrame([([page, "plain"],), ([],), (None,)], "parts array<string>")
    got = [r[0] for r in df.coalesce(1).select(markup.strip_parts(F.col("parts"))).collect()]
    assert got[0]["texts"] == ["a & b t z", "plain"] and got[0]["links"] == ["l", "i", "f"]
    assert got[1]["texts"] == [] and (got[2] is None or got[2]["texts"] is None)


def test_residual_markup(spark):
    cases = {
        "x " + "QUJD" * 13 + "== y": "x   y",
        "QUJD" * 12: "QUJD" * 12,
        "body { color: red } .a-b{x} 12ab{y}z": "    12 z",
        "{x} a {" + "é" * 601 + "}": "{x} a {" + "é" * 601 + "}",
        "{x} a{" + "é" * 600 + "}": "{x}  ",
        "see <b>bold</b> <a <b>> <user@host>": "see  bold     ",
        'one a-b = "v" two 1c="x" -d="y" é-e="z" f=\'n\'': 'one   two 1c="x" -  é-  f=\'n\'',
        "width: 30px; font-size=2,\nMARGIN :x}": "   ,\n }",
        "bandwidth: 3 widths: 4": "bandwidth: 3 widths: 4",
    }
    check(spark, X.strip_residual_markup, cases)


def test_delivery_artifacts(spark):
    cases = {
        "From: a\n> To: b\nX-Foo: c\nnot: d\n|  Subject : e\n": " \n \n \nnot: d\n \n",
        "a\n-- Original Message --\nbody": "a\n \nbody",
        "> ---\nFORWARDED Message\n--- by me\nx": " \nx",
        "xx forwarded by me\nafter\nnot forwarded byway": " \nafter\nnot forwarded byway",
        "On Mon, A wrote:\nreply": " \nreply",
        "On Mon, A wrote: more": "On Mon, A wrote: more",
        "On " + "x" * 201 + "wrote:": "On " + "x" * 201 + "wrote:",
        "______ \n____\n": " \n____\n",
        "x-: no\nx-a-1: yes\r\nCc:\x0b": "x-: no\n \n ",
    }
    check(spark, X.strip_delivery_artifacts, cases)


def test_tokens(spark):
    cases = {
        "Enron ect houses ECT-x ect_y éect": "    houses  -x ect_y éect",
        "bob@enron.com http://sourceforge.net lists.sourceforge.net": "bob@  http://   ",
        "Razor, razors; ſourceforge": " , razors;  ",
    }
    check(spark, X.scrub_tokens, cases)


def test_normalize(spark):
    body = "See https://a.example/x &amp;lt;b&amp;gt; &quot;q&quot; <i>it</i>\nSubject: gone\nect  done"
    check(spark, X.normalize, {body: 'See <b> "q" it done'.replace("<b>", "&lt;b&gt;"), "": "", " \n": ""})
    check(spark, lambda c: X.normalize(c, tokens=False), {body: 'See &lt;b&gt; "q" it ect done'})


def test_subjects_and_threads(spark):
    cases = {"Re[2]: Fwd:  Hello  World": ("hello world", True), "AW : x": ("x", True), "Regarding: y": ("regarding: y", False), None: ("", False), "fyi: [1] z": ("[1] z", True), "re:": ("", True)}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    none = F.lit(None).cast("string")
    rows = df.select("t", X.normalize_subject(F.col("t")), X.is_reply(F.col("t")), X.thread_keys(F.lit("<a@b>"), none, F.lit("<c> junk <d e> <f>"), F.col("t"))).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == cases
    for r in rows:
        assert r[3] == ["mid:<a@b>", "mid:<c>", "mid:<f>"] + ([f"subj:{r[1]}"] if r[2] and r[1] else [])


def test_words_and_shingles(spark):
    """Combining marks, joiners and a dotted capital I part words, as they are no letters."""
    cases = {
        "One two_3, FOUR-five six": ["one", "two_3", "four", "five", "six"],
        "cóte x‍y": ["co", "te", "x", "y"],
        "İstanbul ΣΣ straße ½ กิ": ["i", "stanbul", "σς", "straße", "½", "ก"],
        "...": [],
    }
    assert unicodedata.category("̇") == unicodedata.category("ิ") == "Mn"
    check(spark, X.words, cases)
    sets = {"a b c d e f a b c d e": ["a b c d e", "b c d e f", "c d e f a", "d e f a b", "e f a b c", "f a b c d"], "a b a": ["a", "b"], "": [], "a b c d E": ["a b c d e"]}
    check(spark, X.shingles, sets)


LONG = 1_000_000
HOSTILE = {
    "underscored word": "a_" * (LONG // 2), "hyphened word": "a-" * (LONG // 2), "digits and hyphens": "1-" * (LONG // 2), "one letter": "x" * LONG, "accents": "é" * LONG,
    "prefixes": "re:" * (LONG // 3), "spaces": " " * LONG + "x", "spaces within": "x" + " " * LONG + "y", "host": "www" + ".a" * (LONG // 2), "spaced host": "http : / / " + "a . " * (LONG // 4),
    "x- header": "x-" + "ab-" * (LONG // 3) + ": y", "less-thans": "<" * LONG, "braces": "{" * LONG, "closing braces": "}" * LONG, "open attributes": 'a="' * (LONG // 3), "dashes": "-" * LONG,
    "dash lines": "-\n" * (LONG // 2), "underscores": "_" * LONG, "headers": "From: x\n" * (LONG // 8), "entities": "&amp;" * (LONG // 5), "open tags": "<a " * (LONG // 3), "base64": "QUJD" * (LONG // 4),
}


@pytest.fixture(scope="module")
def hostile(spark):
    return spark.createDataFrame(list(HOSTILE.items()), "k string, t string").repartition(4)


@pytest.mark.parametrize("name", ["collapse", "strip", "strip_urls", "find_urls", "html_text", "html_links", "strip_residual_markup", "strip_delivery_artifacts", "scrub_tokens", "normalize", "normalize_subject", "is_reply", "strip_fences", "words", "live_url"])
def test_long_words(hostile, name):
    """Texts of a megabyte that recursion or backtracking would choke on."""
    got = {r[0]: r[1] for r in hostile.select("k", getattr(X, name)(F.col("t"))).collect()}
    assert set(got) == set(HOSTILE) and all(x is not None for x in got.values())
    want = {
        "collapse": {"spaces": "x", "spaces within": "x y"}, "strip": {"spaces": "x", "one letter": HOSTILE["one letter"]}, "strip_urls": {"host": " ", "spaced host": "  . "}, "find_urls": {"host": [HOSTILE["host"]] * 2},
        "strip_residual_markup": {"base64": " ", "hyphened word": HOSTILE["hyphened word"], "braces": HOSTILE["braces"]}, "strip_delivery_artifacts": {"x- header": " ", "underscores": " "},
        "normalize_subject": {"prefixes": ""}, "html_text": {"less-thans": HOSTILE["less-thans"], "entities": "&" * (LONG // 5)}, "words": {"underscored word": [HOSTILE["underscored word"]]},
    }
    for key, x in want.get(name, {}).items():
        assert got[key] == x


def test_null_texts_stay_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    c = F.col("t")
    for f in (X.collapse, X.unescape, X.strip_urls, X.find_urls, X.html_text, X.html_links, X.scrub, X.normalize, X.live_url, X.strip_fences, X.error_code):
        assert df.select(f(c)).first()[0] is None
    assert df.select(X.shingles(c)).first()[0] == []


def test_fences_codes_and_sniffing(spark):
    one = lambda f, t: spark.createDataFrame([(t,)], "t string").select(f(F.col("t"))).first()[0]
    assert one(X.strip_fences, "```eml\nFrom: x\n\nbody\n```\n") == "From: x\n\nbody"
    assert one(X.strip_fences, " no fence ``` ") == "no fence ```"
    assert one(X.error_code, "HTTP 503 then 404") == 503 and one(X.error_code, "a5030") is None
    assert one(X.looks_like_email, "From: a\nTo: b\n\nx") and not one(X.looks_like_email, "From: a\nTo:b")
    assert not one(X.looks_like_email, "x" * 4090 + "\nA: b\nC: d\n")

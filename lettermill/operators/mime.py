"""The one Python boundary of the mail path: raw bytes to messages, messages to flat records.

Splitting a mailbox and walking a MIME tree have no column expression; both run over Arrow batches. Everything after
them (normalising, URLs, keys, digests) is column expressions again.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from email import message_from_bytes, policy
from email.message import EmailMessage
from email.utils import getaddresses

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettermill.functions import text as X
from lettermill.session import ship

# A mailbox's separator line, and a header line.
SEPARATOR = re.compile(rb"^From \S+.*?\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\b.*$", re.M)
HEADER = re.compile(rb"^[A-Za-z][A-Za-z0-9-]{0,40}:[ \t]", re.M)
HEAD_BYTES = 4096

ATTACHMENT = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
#: Output field and header of each, in the message's order of use.
HEADERS = (
    ("from", "From"),
    ("reply_to", "Reply-To"),
    ("return_path", "Return-Path"),
    ("subject", "Subject"),
    ("message_id", "Message-ID"),
    ("in_reply_to", "In-Reply-To"),
    ("references", "References"),
)
PARSED = T.StructType(
    [T.StructField(name, T.StringType()) for name, _ in HEADERS]
    + [
        T.StructField("auth", T.ArrayType(T.StringType())),
        T.StructField("sender", T.StringType()),
        T.StructField("plain_parts", T.ArrayType(T.StringType())),
        T.StructField("html_parts", T.ArrayType(T.StringType())),
        T.StructField("attachments", T.ArrayType(ATTACHMENT)),
        T.StructField("qr", T.ArrayType(T.StringType())),
        T.StructField("parse_error", T.StringType()),
    ]
)



@functools.lru_cache(1 << 9)  # some kilobytes each, in every worker
def _header(name: str, value: str):
    return policy.default.header_fetch_parse(name, value)


class _Remembering(policy.EmailPolicy):
    """The default policy, but that a header is parsed once and not each time that something of it is asked for; most
    of a message's time goes there, and many headers are the same in all messages."""

    def header_fetch_parse(self, name, value):
        return _header(name, value) if type(value) is str else super().header_fetch_parse(name, value)


POLICY = _Remembering()

QrDecoder = Callable[[bytes], list[str]]
#: An array of HTML parts to struct<texts array<string>, links array<string>>.
HtmlStripper = Callable[[Column], Column]


def email_like(raw: bytes) -> bool:
    """Two header lines at least near the beginning."""
    return sum(1 for _ in HEADER.finditer(raw[:HEAD_BYTES])) >= 2


def split_messages(raw: bytes | None, name: str = "") -> list[bytes]:
    """The messages of a file: those of a mailbox (by suffix, or by two separators of which one leads), or the one.

    Each message of a mailbox keeps its separator line; what stands before the first is no message, and a `.mbox`
    without any separator has none. What doesn't look like mail is left out.
    """
    if not raw or not raw.strip():
        return []
    at = [m.start() for m in SEPARATOR.finditer(raw)]
    if name.lower().endswith(".mbox") or (len(at) > 1 and at[0] == 0):
        found = [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=False)]  # none without a separator
    else:
        found = [raw]
    return [m for m in found if email_like(m)]


def _or_else(f: Callable, otherwise):
    """What f returns; `otherwise` where damaged mail makes it raise."""
    try:
        return f()
    except Exception:
        return otherwise


def _decoded(part: EmailMessage) -> str:
    """A part's text: in its own charset if that is known and fits, else UTF-8, else Latin-1, which always fits."""
    raw = _or_else(lambda: part.get_payload(decode=True), None)
    if raw is None:
        return str(_or_else(part.get_content, ""))
    charsets = (part.get_content_charset("utf-8"), "utf-8", "latin-1")
    return next(text for text in (_or_else(lambda c=c: raw.decode(c), None) for c in charsets) if text is not None)


def _attached(part: EmailMessage) -> bool:
    return (part.get_content_disposition() or "").lower() == "attachment" or bool(part.get_filename())


def sender_of(header: str | None) -> str | None:
    """The first address of a From header, lower-cased, if it is one."""
    first = next((a for _, a in getaddresses([header or ""]) if a), "").strip().lower()
    return first if "@" in first else None


def parse(raw: bytes, qr: QrDecoder | None = None) -> dict:
    """A message's headers, bodies and attachments as they are, for column expressions to refine. A picture that the
    decoder fails on has no codes."""
    msg = message_from_bytes(raw, policy=POLICY)
    out: dict = {}
    for field, name in HEADERS:
        value = msg.get(name)
        out[field] = None if value is None else str(value)
    out["auth"] = [str(v) for v in msg.get_all("Authentication-Results") or []]
    out["sender"] = sender_of(" ".join(out["from"].split()) if out["from"] else None)
    plain, rich, files, codes = [], [], [], []
    for part in msg.walk():
        if part.is_multipart():
            continue
        kind = (part.get_content_type() or "").lower()
        if _attached(part):
            payload = _or_else(lambda p=part: p.get_payload(decode=True), None) or b""
            files.append({"filename": part.get_filename(), "content_type": kind, "size": len(payload), "payload": payload})
            if qr is not None and payload and kind.startswith("image/"):
                codes += [c.decode("utf-8", "replace") if isinstance(c, bytes) else str(c) for c in _or_else(lambda b=payload: list(qr(b)), [])]
        elif kind == "text/plain":
            plain.append(_decoded(part))
        elif kind == "text/html":
            rich.append(_decoded(part))
    return out | {"plain_parts": plain, "html_parts": rich, "attachments": files, "qr": codes, "parse_error": None}


def _clean(value):
    """Lone surrogates, which undecodable headers may bring, as Arrow can hold them."""
    if isinstance(value, str):
        return value.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
    if isinstance(value, list):
        return [_clean(v) for v in value]
    return {k: _clean(v) for k, v in value.items()} if isinstance(value, dict) else value


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _exploding(files: DataFrame, content: str, name: str) -> tuple[list[str], T.StructType, Run]:
    """What a file's messages need: input columns, output schema, and the function over batches."""
    rest = [c for c in files.columns if c not in (content, "ord", "message")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a file at a time: mailboxes are large
                one = batch.slice(i, 1)
                found = split_messages(one.column(content)[0].as_py(), one.column(name)[0].as_py() or "")
                if found:
                    at = pa.array([0] * len(found))
                    yield pa.RecordBatch.from_arrays([*(one.column(c).take(at) for c in rest), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], names=[*rest, "ord", "message"])

    schema = T.StructType([files.schema[c] for c in rest] + [T.StructField("ord", T.IntegerType()), T.StructField("message", T.BinaryType())])
    return [*rest, content], schema, run


def explode_messages(files: DataFrame, *, content: str = "content", name: str = "path") -> DataFrame:
    """A row for each message of each file: the file's other columns, `ord` from 0, and `message`. A file whose content
    is null, blank or no mail gives none."""
    ship(files.sparkSession)
    columns, schema, run = _exploding(files, content, name)
    return files.select(*columns).mapInArrow(run, schema)


def _parsing(given: T.StructType, message: str, qr_decoder: QrDecoder | None) -> tuple[list[str], T.StructType, Run]:
    """What parsing needs: input columns, output schema, and the function over batches."""
    rest = [c for c in given.names if c not in (message, "parsed")]
    empty = dict.fromkeys(PARSED.names)
    schema = T.StructType([given[c] for c in rest] + [T.StructField("parsed", PARSED)])
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(PARSED)

    def one(raw: bytes | None) -> dict:
        try:
            if raw is None:
                raise ValueError("no message")
            return _clean(parse(raw, qr_decoder))
        except Exception as e:
            return empty | {"parse_error": f"{type(e).__name__}: {e}"[:500]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array([one(x) for x in part.column(message).to_pylist()], kind)], names=[*rest, "parsed"])

    return [*rest, message], schema, run


def parse_messages(messages: DataFrame, *, message: str = "message", qr_decoder: QrDecoder | None = None) -> DataFrame:
    """The other columns and `parsed`, a struct of PARSED. A message that can't be parsed has only parse_error; a null
    message counts as such."""
    ship(messages.sparkSession)
    columns, schema, run = _parsing(messages.schema, message, qr_decoder)
    return messages.select(*columns).mapInArrow(run, schema)


def parsed_messages(files: DataFrame, *, content: str = "content", name: str = "path", qr_decoder: QrDecoder | None = None) -> DataFrame:
    """parse_messages of explode_messages, by one Python worker for each task instead of two, between which all messages
    would go through the JVM."""
    ship(files.sparkSession)
    columns, between, explode = _exploding(files, content, name)
    _, schema, parse_all = _parsing(between, "message", qr_decoder)
    return files.select(*columns).mapInArrow(lambda batches: parse_all(explode(batches)), schema)


def header(c: Column) -> Column:
    """A header's value with white space collapsed; null if there is none or it is blank."""
    return F.nullif(X.collapse(c), F.lit(""))


def auth_results(c: Column) -> Column:
    """All authentication results, collapsed, blank ones left out, joined; null if there are none."""
    return F.nullif(F.array_join(F.filter(F.transform(c, X.collapse), lambda v: v != ""), " | "), F.lit(""))


def _given(id: Column | None, label: Column | None, source: Column | None, split: Column | None) -> list[Column]:
    none = F.lit(None).cast("string")
    return [(none if c is None else c).alias(n) for n, c in (("id", id), ("label", label), ("source", source), ("split", split))]


def _with_body(parsed: DataFrame, stripper: HtmlStripper | None) -> DataFrame:
    """Columns __body and __links of parsed messages. Each step is a column of its own, so that it is computed once."""
    plain, rich = F.col("parsed.plain_parts"), F.col("parsed.html_parts")
    if stripper is None:
        out = parsed.withColumn("__html", F.when(F.size(plain) == 0, F.array_join(F.transform(rich, X.untag), "\n")))
        out = out.withColumn("__links", F.flatten(F.transform(rich, X.html_links)))
        html = X.unescape(F.col("__html"))  # as HTML; the whole body is unescaped once more as text
    else:
        out = parsed.withColumn("__stripped", stripper(rich))
        out = out.withColumn("__links", F.col("__stripped.links"))
        html = F.array_join("__stripped.texts", "\n")
    return out.withColumn("__body", F.when(F.size(plain) > 0, F.array_join(plain, "\n")).otherwise(F.coalesce(html, F.lit(""))))


def epi_record(
    parsed: DataFrame, *, id: Column | None = None, source: Column | None = None, label: Column | None = None, split: Column | None = None, scrub_tokens: bool = True, html_stripper: HtmlStripper | None = None
) -> DataFrame:
    """The training record of parsed messages: ten fields, then the columns of `parsed` but for the struct. A message
    that couldn't be parsed has an empty text and no headers."""
    names = ("from", "subject", "message_id", "in_reply_to", "references")
    first, *given = _given(id, label, source, split)
    rest = [c for c in parsed.columns if c != "parsed" and c not in ("id", "text", "label", "source", "split", *names)]
    text = X.normalize(F.col("__body"), tokens=scrub_tokens)
    return _with_body(parsed, html_stripper).select(first, text.alias("text"), *given, *[header(F.col("parsed").getField(n)).alias(n) for n in names], *[F.col(f"`{c}`") for c in rest])


def runtime_record(
    parsed: DataFrame, *, id: Column | None = None, source: Column | None = None, label: Column | None = None, split: Column | None = None, html_stripper: HtmlStripper | None = None
) -> DataFrame:
    """The eighteen fields of a detector's record: headers, text without token scrub, URLs made live, attachments. Of
    the codes read from pictures those count that hold a URL."""
    p = lambda name: F.col("parsed").getField(name)
    mark = "\x00"  # one pass of entity resolution over all URLs of a message
    base = _with_body(parsed.select(*_given(id, label, source, split), "parsed"), html_stripper)
    base = base.withColumn("__found", F.array_distinct(F.filter(F.concat(F.filter("__links", X.is_web_link), X.find_urls(F.col("__body"))), lambda u: u != "")))
    base = base.withColumn("__joined", F.when(F.size("__found") > 0, F.array_join("__found", mark)))
    base = base.withColumn("__urls", F.coalesce(F.split(X.unescape(F.col("__joined")), mark), F.array().cast("array<string>")))
    base = base.withColumn("__codes", F.filter(F.transform(p("qr"), X.strip), X.holds_url))
    live = F.array_sort(F.array_distinct(F.transform(F.filter(F.concat("__urls", "__codes"), lambda u: u != ""), X.live_url)))
    files = F.transform(
        p("attachments"),
        lambda a: F.struct(
            a["filename"].alias("filename"),
            a["content_type"].alias("content_type"),
            a["size"].alias("size"),
            F.when(a["size"] > 0, F.sha2(a["payload"], 256)).alias("sha256"),
            F.when(a["size"] > 0, F.md5(a["payload"])).alias("md5"),
        ),
    )
    return base.select(
        "id",
        X.normalize(F.col("__body"), tokens=False).alias("text"),
        "label",
        "source",
        "split",
        *[header(p(n)).alias(n) for n, _ in HEADERS],
        auth_results(p("auth")).alias("auth_results"),
        ((F.size("__urls") > 0) | (F.size("__codes") > 0)).alias("has_url"),
        (F.size("__codes") > 0).alias("has_qr"),
        (F.size(p("attachments")) > 0).alias("has_attachment"),
        live.alias("urls"),
        files.alias("attachments"),
    )

"""A deterministic, sharded WARC writer, and a reader of its archives.

Records are dealt out by ranges of the page id and written in its order, each as a gzip member of its own. How many
ranges there are follows from the bytes of all payloads, and their bounds are exact quantiles of ids that a hash chose:
the same pages give the same files, however they are partitioned and whatever Spark's settings are. A file is rolled
when its compressed size passes a limit. Tasks write under temporary names that no other attempt shares; when all are
done, tasks move the files that the successful attempts named to their final names, and the driver writes a manifest.
Headers and digests are computed anew from the payload. Of pages with equal payloads one is a response and the others
revisit records that refer to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import durable, range_of, scratch, ship, spread, table

#: Compressed bytes after which a file is closed.
ROLL_BYTES = 1 << 30
#: Payload bytes of a range, and how many ranges there are at most; beyond that ranges get larger. A range is a task's.
CELL_BYTES = 4 << 20
MOST_CELLS = 16_000
#: Distinct ids by which a range's bounds are found, on average; the driver holds those of all ranges.
CELL_SAMPLE = 64
#: A range with so many times the mean number of rows is dealt out once more, by a hash of the record.
CROWDED = 4
#: Equal payloads of fewer bytes are written in full each time.
REVISIT_BYTES = 1000
#: No clock enters an archive: the same pages give the same bytes.
DATE = "1970-01-01T00:00:00Z"
EMPTY_SHA1 = hashlib.sha1(b"").hexdigest()

FILES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("temporary", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sha256", T.StringType()),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(uri)


def _record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>"


def _clean(value: str) -> str:
    """A header value stays on its line."""
    return "".join(c if c >= " " else "%%%02X" % ord(c) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record. A revisit has the full payload's length and digest in its headers, and no payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = payload if refers_to is None else b""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    head += [("WARC-Payload-Digest", digest), ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
    head += [("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()), ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


class _File:
    """An archive in progress, under a temporary name."""

    def __init__(self, folder: str, inner: str, name: str):
        self.fs, base = _filesystem(folder)
        self.name, self.temporary = name, f"{inner}/{uuid.uuid4().hex}-{name}"
        self.out = self.fs.open_output_stream(f"{base}/{self.temporary}", compression=None)
        self.records, self.bytes, self.sum = 0, 0, hashlib.sha256()

    def add(self, raw: bytes) -> None:
        packed = gzip.compress(raw, 6, mtime=0)
        self.out.write(packed)
        self.sum.update(packed)
        self.records, self.bytes = self.records + 1, self.bytes + len(packed)

    def close(self) -> tuple:
        self.out.close()
        return self.name, self.temporary, self.records, self.bytes, self.sum.hexdigest()


def _writer(folder: str, inner: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, cell, seq = [], None, None, 0
        page, refers = None, {}  # what payloads of this page refer to, by digest
        for batch in batches:
            for part, own, to, digest, url, html in zip(*(batch.column(c).to_pylist() for c in ("part", "page_id", "refers_to", "digest", "url", "html")), strict=True):
                if own != page:
                    page, refers = own, {}
                if digest is not None:
                    refers[digest] = to
                    continue
                if part != cell:
                    if now:
                        done.append(now.close())
                    now, cell, seq = None, part, 0
                if now is None:
                    now, seq = _File(folder, inner, f"part-{cell:06d}-{seq:05d}.warc.gz"), seq + 1
                payload = (html or "").encode()
                now.add(record(own, url, payload, refers.get(hashlib.sha1(payload).hexdigest()) if refers else None))
                if now.bytes >= roll_bytes:
                    done.append(now.close())
                    now = None
        if now:
            done.append(now.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*done, strict=True)], names=FILES.names)

    return run


def _mover(folder: str):
    """Moves files to their final names; one that an earlier attempt has moved stays where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        fs, base = _filesystem(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                if fs.get_file_info(f"{base}/{temporary}").type != pafs.FileType.NotFound:
                    fs.move(f"{base}/{temporary}", f"{base}/{name}")
                elif fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{base}/{temporary}")
            yield batch

    return run


@dataclass
class Deal:
    """How pages are dealt out: by ranges of the page id, those without an id as the last range; a crowded range has
    further parts."""

    cuts: list[int]
    #: Of a crowded range: where its further parts begin, and how many parts it has in all.
    crowded: dict[int, tuple[int, int]]
    parts: int

    @staticmethod
    def of(pages: DataFrame, cells: int) -> Deal:
        n = max(1, pages.count())
        u = F.shiftrightunsigned(F.xxhash64(F.lit(23), F.col("page_id")), 1)
        chosen = pages.where(F.col("page_id").isNotNull() & (u <= F.lit(min(1.0, cells * CELL_SAMPLE / n) * float(1 << 63))))
        ids = sorted(r[0] for r in chosen.select("page_id").distinct().collect()) if cells > 1 else []
        deal = Deal(sorted({ids[len(ids) * i // cells] for i in range(1, cells)}) if ids else [], {}, 0)
        deal.parts = len(deal.cuts) + 2
        for r in sorted(pages.groupBy(deal.cell().alias("cell")).count().collect()):
            more = -(-r["count"] * cells // n)
            if more > CROWDED:
                deal.crowded[r["cell"]] = deal.parts, more
                deal.parts += more - 1
        return deal

    def cell(self) -> Column:
        return F.when(F.col("page_id").isNull(), F.lit(len(self.cuts) + 1)).otherwise(range_of(F.col("page_id"), self.cuts)).cast("int")

    def _of(self, which: int, otherwise: int) -> Column:
        if not self.crowded:
            return F.lit(otherwise)
        return F.coalesce(F.create_map(*[F.lit(x) for cell, two in self.crowded.items() for x in (cell, two[which])])[F.col("cell")], F.lit(otherwise))

    def further(self) -> Column:
        """How many parts the range in column `cell` has."""
        return self._of(1, 1)

    def part(self, number: Column) -> Column:
        """The part of a row of column `cell`, by its number within the range's parts."""
        return F.when(number == 0, F.col("cell")).otherwise(self._of(0, 0) + number - 1).cast("int").alias("part")


def write_warc(pages: DataFrame, folder: str, *, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES, cell_bytes: int = CELL_BYTES) -> list[dict]:
    """Write all pages (page_id, url, html) under `folder`, a URI that all machines share; returns the manifest.

    A null html is an empty payload; a null url has no target header; null page_ids get no page header and are never
    revisits. Rows of the same page_id are records of their own: where they hold the largest page_id of a payload they
    are all responses. An empty table gives no files. Other columns don't matter. Only digests are shuffled to find
    equal payloads; the pages themselves are shuffled once. The driver holds a line for each file. A payload is held in
    memory as a whole, some four times. If writing fails, its temporary files are deleted and no manifest is written.
    """
    spark = pages.sparkSession
    ship(spark)
    pages = pages.select("page_id", "url", "html")
    html = F.coalesce(F.col("html"), F.lit(""))
    key = (F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n"))
    sums = pages.where(F.col("page_id").isNotNull() & (F.octet_length(html) >= revisit_bytes)).select("page_id", *key)
    groups = durable(sums.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    revisits = sums.join(groups, ["digest", "n"]).where("page_id < refers_to").select("page_id", "refers_to", "digest").distinct()
    total = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    deal = Deal.of(pages, max(1, min(MOST_CELLS, -(-total // cell_bytes))))
    none = F.lit(None).cast("string")
    rows = pages.withColumn("cell", deal.cell())
    rows = rows.select("page_id", F.lit(None).cast("long").alias("refers_to"), none.alias("digest"), "url", "html", deal.part(F.pmod(F.xxhash64("url", "html"), deal.further())))
    # what a page's payloads refer to goes ahead of it, to every part of its range
    marks = revisits.withColumn("cell", deal.cell()).withColumn("number", F.explode(F.sequence(F.lit(0), deal.further() - 1)))
    marks = marks.select("page_id", "refers_to", "digest", none.alias("url"), none.alias("html"), deal.part(F.col("number")))
    rows = rows.unionByName(marks).repartitionById(deal.parts, F.col("part")).sortWithinPartitions("part", F.asc_nulls_last("page_id"), F.asc_nulls_last("digest"), "url", "html")
    fs, base = _filesystem(folder)
    inner = f"_temporary-{uuid.uuid4().hex}"
    fs.create_dir(f"{base}/{inner}")
    try:
        written = durable(rows.mapInArrow(_writer(folder, inner, roll_bytes), FILES))
        n = written.count()
        moved = written.repartition(max(1, min(n, 1000)), "name").mapInArrow(_mover(folder), FILES).drop("temporary").collect() if n else []
        files = sorted((r.asDict() for r in moved), key=lambda f: f["name"])
        with fs.open_output_stream(f"{base}/{inner}/manifest.json") as out:
            out.write(json.dumps({"files": files}, indent=1).encode())
        fs.move(f"{base}/{inner}/manifest.json", f"{base}/manifest.json")
    finally:
        fs.delete_dir(f"{base}/{inner}")
    return files


class _Members(io.RawIOBase):
    """The decompressed bytes of a file of gzip members, read in pieces."""

    def __init__(self, raw):
        self.raw, self.engine, self.left = raw, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if self.engine.eof:
                self.left, self.engine = self.engine.unused_data, zlib.decompressobj(31)
            data = self.left or self.raw.read(1 << 16)
            self.left = b""
            if not data:
                return 0
            out = self.engine.decompress(data, len(into))
            if not self.engine.eof:
                self.left = self.engine.unconsumed_tail
            if out:
                into[: len(out)] = out
                return len(out)


def parse(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        block = stream.read(int(head["Content-Length"]))
        if "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged block in {head['WARC-Record-ID']}")
        yield head, block


def _hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


def _reader(folder: str, payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as raw:
                    for head, block in parse(io.BufferedReader(_Members(raw), 1 << 16)):
                        kind = head["WARC-Type"]
                        digest = hashlib.sha1(block).hexdigest() if kind == "response" else _hex(head["WARC-Payload-Digest"])
                        if digest != _hex(head["WARC-Payload-Digest"]):
                            raise ValueError(f"damaged payload in {head['WARC-Record-ID']}")
                        size = len(block) if kind == "response" else int(head["X-Payload-Length"])
                        rows.append((number(head.get("X-Page-Id")), size, digest, kind, number(head.get("X-Refers-To-Page-Id")), head.get("WARC-Target-URI"), block if payload and kind == "response" else None))
                        held += len(block) * payload + 200
                        if held >= 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=RECORDS.names)


def read_warc(spark: SparkSession, folder: str, *, payload: bool = True) -> DataFrame:
    """All records of the archives that the manifest in `folder` names. Digests are checked on the way; payload is null
    for revisits (and everywhere with payload=False). Files are streamed, one at a time in a task."""
    ship(spark)
    fs, base = _filesystem(folder)
    with fs.open_input_stream(f"{base}/manifest.json") as f:
        names = [x["name"] for x in json.loads(f.read())["files"]]
    paths = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, len(names)), "name") if names else spark.createDataFrame([], "name string")
    return paths.mapInArrow(_reader(folder, payload), RECORDS)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    write_warc(spread(table(spark, sf_dir, "pages")), folder)
    return read_warc(spark, folder, payload=False).drop("payload", "url")


QUERIES = {"op6_warc": op6_warc}
ORACLE = {
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM m
"""
}

"""Sources: a raw tree of mail files, single messages, class folders of synthetic mail, and JSON-lines datasets."""

from __future__ import annotations

import random
import re
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettermill.config import CLASS_LABELS, BuildConfig
from lettermill.session import file_bytes

#: Spark's partitions of small files that go to a task together, and bytes of a task.
FILE_PARTS, FILE_BYTES = 32, 16 << 20

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text", "label", "source", "split", "from", "subject", "message_id", "in_reply_to", "references")])


def _root(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def source_folders(spark: SparkSession, raw: str) -> list[str]:
    """Names of the folders directly in `raw`, sorted."""
    fs, p = _root(spark, raw)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def roots(spark: SparkSession, folder: str) -> list[str]:
    """Paths that a recursive reader has to be given to read all files below a folder: the folder, and every folder
    below it that it would pass over for a name that begins with an underscore or a dot. None where there is no file.
    Files of such names are passed over in any case. A few calls to the JVM for each level of folders."""
    fs, p = _root(spark, folder)
    if not fs.listFiles(p, True).hasNext():
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out, level = [p.toString()], _escaped(p.toString().rstrip("/"))
    while len(fs.globStatus(path(f"{level}/*"))):
        out += [s.getPath().toString() for s in fs.globStatus(path(level + "/{_*,.*}")) if s.isDirectory()]
        level += "/*"
    return out


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """All files below a folder, in hidden folders too, as paths relative to it, in the order of their path's components.
    Spark lists them, in parallel where there are many folders, and no content is read."""
    every = roots(spark, folder)
    if not every:
        return []
    base = _bare(every[0]).rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([_escaped(p) for p in every]).select("path")
    return sorted((_bare(r[0]).removeprefix(base) for r in files.toLocalIterator()), key=lambda f: PurePosixPath(f).parts)


def _bare(path: str) -> str:
    """A path without scheme and authority, which may be spelt in more than one way."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/*", "/", path)


def sample_files(files: list[str], k: int, seed: int) -> list[str]:
    """k of the listed files without replacement, in their order; all of them if k is 0 or not below their number."""
    if k <= 0 or k >= len(files):
        return files
    chosen = set(random.Random(seed).sample(files, k))
    return [f for f in files if f in chosen]


def read_tree(spark: SparkSession, raw: str, cfg: BuildConfig | None = None) -> tuple[DataFrame, list[str]]:
    """(files, skipped): all files of the known sources with their content, and the folders of no known source.

    Columns: path, source, label, path_parts (of the path within the source: its order is that of files) and content.
    Unknown folders are not listed. Of the sampled source only the sample is read.
    """
    cfg = cfg or BuildConfig()
    folders = source_folders(spark, raw)
    skipped = [f for f in folders if f not in cfg.source_labels]
    _, base = _root(spark, raw)
    prefix = base.toString().rstrip("/") + "/"
    depth = base.depth()
    paths: list[str] = []
    for source in folders:
        if source in skipped:
            continue
        if source == cfg.sampled_source and cfg.sample_files > 0:
            paths += [f"{prefix}{source}/{f}" for f in sample_files(list_files(spark, f"{prefix}{source}"), cfg.sample_files, cfg.seed)]
        else:
            paths += roots(spark, f"{prefix}{source}")
    schema = "path string, modificationTime timestamp, length long, content binary"
    if not paths:
        return spark.createDataFrame([], "path string, source string, label string, path_parts array<string>, content binary"), skipped
    files = gathered(spark.read.format("binaryFile").option("recursiveFileLookup", "true").schema(schema).load([_escaped(p) for p in paths]))
    # the scheme and authority of a listed path may be spelt in more than one way
    whole = F.split(F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/*", ""), "/")
    parts = F.slice(whole, depth + 1, 10_000)
    labels = F.create_map(*[F.lit(x) for kv in cfg.source_labels.items() for x in kv])
    source = F.element_at(parts, 1)
    return files.select("path", source.alias("source"), labels[source].alias("label"), F.slice(parts, 2, 10_000).alias("path_parts"), "content"), skipped


def gathered(files: DataFrame) -> DataFrame:
    """Files as they were read, in fewer tasks where they are small: Spark counts a file as four megabytes more than it
    is and gives a task 32 of them, so that a task's start costs more than its mail. Without a shuffle, up to
    FILE_PARTS of Spark's partitions to a task, while tasks have no more than FILE_BYTES on the average."""
    n = files.rdd.getNumPartitions()
    cores = files.sparkSession.sparkContext.defaultParallelism
    want = max(4 * cores, -(-n // FILE_PARTS), -(-file_bytes(files) // FILE_BYTES))
    return files.coalesce(want) if want < n else files


def _escaped(path: str) -> str:
    """A path for a reader that takes glob patterns."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def read_message(spark: SparkSession, raw: bytes) -> DataFrame:
    """One message, as standard input or a single file may bring it."""
    return spark.createDataFrame([(bytearray(raw),)], "message binary")


def read_classes(spark: SparkSession, folder: str, limit_per_class: int = 0) -> DataFrame:
    """The `.eml` files directly in each known class's folder: class, label, name and message. Missing folders give
    nothing. With a limit the first by name of each class."""
    fs, base = _root(spark, folder)
    have = [c for c in CLASS_LABELS if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base, c))]
    if not have:
        return spark.createDataFrame([], "class string, label string, name string, message binary")
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").load([_escaped(f"{base.toString().rstrip('/')}/{c}") for c in have])
    parts = F.split("path", "/")
    labels = F.create_map(*[F.lit(x) for kv in CLASS_LABELS.items() for x in kv])
    out = read.select(F.element_at(parts, -2).alias("class"), labels[F.element_at(parts, -2)].alias("label"), F.element_at(parts, -1).alias("name"), F.col("content").alias("message"))
    if limit_per_class:
        from pyspark.sql import Window

        rank = F.row_number().over(Window.partitionBy("class").orderBy("name"))
        out = out.withColumn("__n", rank).where(F.col("__n") <= limit_per_class).drop("__n")
    return out


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines dataset, rows of five or ten fields alike. Blank lines and lines that are no record are left out; a
    missing file is empty."""
    fs, p = _root(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("mode", "DROPMALFORMED").json(p.toString())


def existing_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path).where("id is not null").select("id").distinct()


def real_text_lengths(dataset: DataFrame) -> DataFrame:
    """Lengths in code points of the non-empty texts that aren't synthetic; rows without a source count as real."""
    return dataset.where(~F.col("source").eqNullSafe(F.lit("synthetic")) & (F.col("text") != "")).select(F.length("text").alias("n"))

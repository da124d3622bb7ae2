"""Sinks: JSON-lines datasets, appended records, message files, a manifest."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.config import DATASET_FIELDS
from lettermill.session import ship, stored


def write_dataset(records: DataFrame, path: str, *, single_file: bool = False) -> None:
    """The five fields of a dataset as JSON lines with explicit nulls, sorted by split, source and id over all files in
    their order."""
    rows = records.select(*DATASET_FIELDS).orderBy("split", "source", "id")
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_records(records: DataFrame, path: str, *, dry_run: bool = False) -> None:
    """Append records with all their fields to a JSON-lines dataset; nothing is written for none, or on a dry run."""
    if dry_run:
        return
    records = stored(records)  # whether there are any is asked before they are written
    if not records.isEmpty():
        records.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_messages(messages: DataFrame, folder: str) -> DataFrame:
    """Each message as `<folder>/<class>/<number of four digits>.eml`, by the tasks, under a temporary name that is
    then moved. `folder` is a URI that all machines share. Returns (class, n, path, bytes) of the files written."""
    ship(messages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(folder)
        made = set()
        for batch in batches:
            kinds, numbers, paths, sizes = [], [], [], []
            for kind, n, raw in zip(*(batch.column(c).to_pylist() for c in ("class", "n", "message")), strict=True):
                if kind not in made:
                    fs.create_dir(f"{base}/{kind}")
                    made.add(kind)
                final = f"{base}/{kind}/{n:04d}.eml"
                temporary = f"{final}.{uuid.uuid4().hex}.tmp"
                with fs.open_output_stream(temporary) as out:
                    out.write(raw)
                fs.move(temporary, final)
                kinds.append(kind)
                numbers.append(n)
                paths.append(final)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(numbers, pa.int64()), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["class", "n", "path", "bytes"])

    rows = messages.select("class", F.col("n").cast("long"), "message")
    return stored(rows.mapInArrow(run, "class string, n long, path string, bytes long"))


def write_manifest(spark: SparkSession, path: str, content: dict) -> None:
    """A JSON file of run settings and statistics."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hadoop, True)
    try:
        out.write(bytearray(json.dumps(content, ensure_ascii=False, indent=2).encode()))
    finally:
        out.close()


def to_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, with explicit nulls."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))

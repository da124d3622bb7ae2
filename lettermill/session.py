"""What an operator needs of a session: the shared folder, durable intermediate tables, and this package on executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_lettermill_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(), "lettermill.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, dirs, names in os.walk(ROOT):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(ROOT)))
    sc.addPyFile(path)
    sc._lettermill_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset and all runs on one
    machine, a temporary folder; on a cluster no folder of one machine will do, and that is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="lettermill-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession) -> str:
    """A path of this application's own in the shared folder, where nothing is yet."""
    return f"{shared_dir(spark).rstrip('/')}/lettermill-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete one scratch path whose rows nobody will read again, or without a path all of this application's: call it
    when the results of queries are written."""
    fs, p = _hadoop(spark, path or scratch(spark).rpartition("/")[0])
    fs.delete(p, True)


def durable(df: DataFrame) -> DataFrame:
    """Computed once, written to the shared folder, lineage cut: it outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that a table as it was read comes from."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces(df: DataFrame, piece: int) -> int:
    """How many tasks a table as it was read is for, with `piece` bytes of its files each: a core each at least."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, min(-(-file_bytes(df) // piece), 20_000))


def spread(df: DataFrame, piece: int | None = None) -> DataFrame:
    """A table as it was read, for costly work on each row: dealt out anew if it came in fewer partitions than there are
    cores, as a small one in a single file does. A large one is left as it is, without a shuffle, unless tasks are to
    have `piece` bytes of its files each."""
    n = df.sparkSession.sparkContext.defaultParallelism if piece is None else pieces(df, piece)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """As durable(), but as a compressed Parquet table (in a scratch path, or the one given): for wide rows that are
    read more than once."""
    path = path or scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

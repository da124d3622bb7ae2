"""Rendezvous sharding, in DataFrame expressions only.

A record goes to the shard whose score for its key is highest. A score depends on the key and that one shard, so that a
further shard takes records only into itself, and each shard's share follows its weight: with u uniform in (0, 1) from
the hash of key and shard, the score is ln(u) / weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import durable, table

#: Rows of a shard that are numbered in one task, until SUB_MOST runs a shard are reached.
SUB_ROWS = 4096
#: Runs a shard is numbered in at most; bounds the broadcast table of their sizes to shards x this.
SUB_MOST = 4096


def _uniform(key: Column, shard: int) -> Column:
    """In (0, 1), from 48 bits of md5(key/shard): the same value wherever md5 exists."""
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, 12), 16, 10).cast("long")
    return (h + F.lit(0.5)) / F.lit(float(1 << 48))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, of a string key. A null key is the key '\\N'. Equal scores: the lower shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights are positive, one for each shard")
    key = F.coalesce(key, F.lit("\\N"))
    scored = [F.struct((F.log(_uniform(key, s)) / F.lit(float(w))).alias("score"), F.lit(-s).alias("s")) for s, w in enumerate(weights)]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best.getField("s")).cast("int")


def shard(df: DataFrame, key: str, weights: Sequence[float], *, order: Sequence[str] = ()) -> DataFrame:
    """Add `shard` and `slot`, gapless from 0 in each shard.

    A shard is numbered in runs, by a hash of the key, each in a task of its own; only the runs' sizes meet (at most
    SUB_MOST a shard, so their table is broadcast). Within a run rows follow the key, then `order`. Rows equal in all
    of these are alike but for columns not named. Null keys form one group. Columns of df named shard, slot or
    starting with two underscores are replaced. An empty table gives an empty result. A key that repeats goes to one
    run as a whole: keys are meant to be record ids.
    """
    clash = [c for c in df.columns if c in ("shard", "slot") or c.startswith("__")]
    df = df.drop(*clash)
    n = df.count()
    runs = max(1, min(SUB_MOST, -(-n // (SUB_ROWS * len(weights)))))
    text = F.col(key).cast("string")
    df = df.select("*", shard_of(text, weights).alias("shard"), F.pmod(F.xxhash64(F.coalesce(text, F.lit("\\N")), F.lit(17)), F.lit(runs)).cast("int").alias("__run"))
    sizes = df.groupBy("shard", "__run").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", "__run", F.coalesce(before, F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("shard", "__run").orderBy(F.col(key), *order))
    return df.join(F.broadcast(starts), ["shard", "__run"]).withColumn("slot", (F.col("__start") + within - 1).cast("long")).drop("__run", "__start")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `key`: doc_id and the number of shards decide. Null text: no bytes, so size 1, and the checksum of nothing."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    small = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    small = durable(small)
    grown = shard_of(F.col("doc_id").cast("string"), [1.0] * 9).alias("grown_shard")
    out = shard(small, "doc_id", [1.0] * 8, order=["size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", grown)


QUERIES = {"op4_sharding": op4_sharding}
ORACLE: dict[str, str] = {}

"""Leakage components and their assignment to training, validation and test parts."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettermill.config import SPLITS
from lettermill.functions.text import thread_keys
from lettermill.operators.graph import connected_components
from lettermill.session import ship


def leak_edges(records: DataFrame, clusters: DataFrame | None = None, *, sender: str = "sender") -> DataFrame:
    """(src, dst): what must not be parted. Records hang on their sender's address, their thread keys, and the first
    member of their near-duplicate cluster; each key is a node, so that n records on one key cost n edges."""
    keys = F.concat(
        F.when(F.col(sender).isNotNull(), F.array(F.concat(F.lit("addr:"), F.col(sender)))).otherwise(F.array().cast("array<string>")),
        thread_keys(F.col("message_id"), F.col("in_reply_to"), F.col("references"), F.col("subject")),
    )
    edges = records.select(F.concat(F.lit("id:"), "id").alias("src"), F.explode(keys).alias("dst"))
    if clusters is not None:
        edges = edges.unionByName(clusters.where("id <> cluster").select(F.concat(F.lit("id:"), "cluster").alias("src"), F.concat(F.lit("id:"), "id").alias("dst")))
    return edges


def leak_components(records: DataFrame, edges: DataFrame, *, key: str = "id") -> DataFrame:
    """(key, component) for every record: the smallest node that it hangs together with, its own if it is alone."""
    found = connected_components(edges).where(F.startswith("node", F.lit("id:")))
    found = found.select(F.substring("node", 4, 1 << 30).alias(key), "component")
    return records.select(key).join(found, key, "left").select(key, F.coalesce("component", F.concat(F.lit("id:"), F.col(key))).alias("component"))


def dominant(c: str | Column) -> Column:
    """The most frequent value, of equally frequent ones the smallest."""
    return F.mode(c, True)


def component_summary(records: DataFrame, *, component: str = "component", key: str = "id", label: str = "label", source: str = "source", hard: Column | None = None) -> DataFrame:
    """A row for each component: canonical (smallest key), size, its dominant label, source and hard flag, and whether
    its labels are mixed."""
    return records.groupBy(component).agg(
        F.min(key).alias("canonical"),
        F.count("*").alias("size"),
        dominant(label).alias("label"),
        dominant(source).alias("source"),
        dominant(F.lit(False) if hard is None else hard).alias("hard"),
        (F.count_distinct(label) > 1).alias("mixed"),
    )


def assign_splits(components: DataFrame, strata: Sequence[str], *, val: float = 0.10, test: float = 0.10, size: str = "size", canonical: str = "canonical") -> DataFrame:
    """Add `split` to components, stratum by stratum.

    In each stratum components go from large to small, equal ones by canonical, and each goes to the part that lacks
    most of its target; of equal lacks train before val before test. The last is set aside for test and, of three or
    more, the one before it for val; these count from the start. Where each goes depends on all before it, so a
    stratum is one task's: it streams by in order, and the task holds three sums. A column named split is replaced.
    """
    components = components.drop("split")
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(F.asc(size), F.desc(canonical)))  # from the end
    ends = components.select(*strata, size, canonical).withColumn("__rank", rank).where("__rank <= 2")
    ends = ends.groupBy(*strata).agg(F.max(F.when(F.col("__rank") == 1, F.col(size))).alias("__last"), F.max(F.when(F.col("__rank") == 2, F.col(size))).alias("__before"))
    whole = components.groupBy(*strata).agg(F.count("*").alias("__n"), F.sum(size).cast("double").alias("__total"))
    heads = _joined(whole, ends, strata)
    rows = _joined(components, heads, strata).repartition(*strata).sortWithinPartitions(*strata, F.desc(size), F.asc(canonical))
    names, goals = components.columns, (1.0 - val - test, val, test)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, have, goal = None, 0, [], []
        for batch in batches:
            out = []
            extra = [batch.column(c).to_pylist() for c in ("__n", "__total", "__last", "__before", size)]
            for stratum, n, total, last, before, own in zip(zip(*(batch.column(c).to_pylist() for c in strata), strict=True), *extra, strict=True):
                if now != (stratum,):
                    now, left, goal = (stratum,), n, [total * f for f in goals]
                    have = [0.0, float(before) if n >= 3 else 0.0, float(last) if n >= 2 else 0.0]
                if n >= 2 and left == 1:
                    pick = 2
                elif n >= 3 and left == 2:
                    pick = 1
                else:
                    lack = [g - h for g, h in zip(goal, have, strict=True)]
                    pick = lack.index(max(lack))
                    have[pick] += own
                left -= 1
                out.append(SPLITS[pick])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.string())], names=[*names, "split"])

    ship(components.sparkSession)
    return rows.mapInArrow(fold, T.StructType([*components.schema.fields, T.StructField("split", T.StringType())]))


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Joined by columns of which nulls are equal, too."""
    other = right.select(*[F.col(c).alias(f"__on_{c}") for c in on], *[c for c in right.columns if c not in on])
    return left.join(other, functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on])).drop(*[f"__on_{c}" for c in on])


def leaked_clusters(records: DataFrame, *, cluster: str = "cluster", split: str = "split") -> DataFrame:
    """Clusters with members in more than one part; there must be none."""
    return records.groupBy(cluster).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")

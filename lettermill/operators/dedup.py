"""Exact deduplication, incremental admission, limits and thinning. Survivors are defined, never arbitrary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.session import stored


def first_of_each(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Of rows with the same key the first in the given order. Map sides send only the best row of each key.

    Null keys are one group. Rows equal in key and order are interchangeable: one stays. Columns keep their order.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def not_yet_known(df: DataFrame, known: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Rows whose key isn't among `known`, of equal ones the first."""
    return first_of_each(df.join(known.select(key), key, "left_anti"), key, order)


def first_n(df: DataFrame, group: str, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows of each group; all of them for n = 0."""
    if not n:
        return df
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def admit_by_source(df: DataFrame, *, key: str, source: str, order: Sequence[str], limit: int, sources: Sequence[str]) -> DataFrame:
    """Sources in turn, each giving its first `limit` rows whose key none has given before.

    A source is read no further than its limit, so that what it holds beyond can still come from a later source. With
    limit 0 this is first_of_each over (source, order).
    """
    if not limit:
        return first_of_each(df, key, [source, *order])
    taken: DataFrame | None = None
    for name in sorted(sources):
        own = first_of_each(df.where(F.col(source) == name), key, order)
        if taken is not None:
            own = own.join(taken.select(key), key, "left_anti").select(df.columns)
        own = first_n(own, source, limit, order)
        own = stored(own)
        taken = own if taken is None else taken.unionByName(own)
    return taken if taken is not None else df.limit(0)


def thin(df: DataFrame, group: str, n: int, key: str) -> DataFrame:
    """Of each group the n rows with the smallest keys; all for n = 0."""
    return first_n(df, group, n, [key])

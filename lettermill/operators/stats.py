"""Counts and tables that describe a corpus build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettermill.config import SPLITS


def grouped_counts(records: DataFrame, sets: Sequence[Sequence[str]] = (("source",), ("label",), ("split",), ("source", "split"), ("source", "label", "split"))) -> DataFrame:
    """Counts by several groupings in one pass: their columns (null where not grouped by), grouping_id and n."""
    names = sorted({c for s in sets for c in s})
    return records.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(F.grouping_id().alias("grouping_id"), F.count("*").alias("n"))


def split_table(records: DataFrame) -> DataFrame:
    """Rows by source and label, columns by part, with totals of rows and, under null names, of columns."""
    by = records.rollup("source", "label").agg(F.grouping_id().alias("__g"), *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS], F.count("*").alias("total"))
    return by.where("__g <> 1").drop("__g")


def split_shares(records: DataFrame) -> DataFrame:
    """(split, n, percent) of the parts that have rows."""
    n = records.groupBy("split").agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.lit(100) * F.col("n") / F.sum("n").over(Window.partitionBy()))


def hard_by_split(records: DataFrame, hard: str = "_is_hard_ham") -> DataFrame:
    """(split, n): hard rows in each of the parts that have any."""
    return records.groupBy("split").agg(F.count_if(hard).alias("n")).where("n > 0")


def class_counts(classes: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(class, label, generated, accepted) of every class, also of those without rows. outcomes: (class, status)."""
    n = outcomes.groupBy("class").agg(F.count("*").alias("g"), F.count_if(F.col("status") == "accepted").alias("a"))
    return classes.join(n, "class", "left").select("class", "label", F.coalesce("g", F.lit(0)).alias("generated"), F.coalesce("a", F.lit(0)).alias("accepted"))


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def error_histogram(errors: DataFrame, message: str = "message") -> DataFrame:
    """(code, n) of the status codes in error messages; null for none."""
    from lettermill.functions.text import error_code

    return errors.groupBy(error_code(F.col(message)).alias("code")).agg(F.count("*").alias("n"))


def length_summary(lengths: DataFrame, column: str = "n") -> DataFrame:
    """(n, mean, median) of a column; zeros for no rows."""
    zero = F.lit(0.0)
    return lengths.agg(F.count(column).alias("n"), F.coalesce(F.avg(column), zero).alias("mean"), F.coalesce(F.median(column), zero).alias("median"))


def largest(sizes: DataFrame, n: int = 5, column: str = "n") -> DataFrame:
    """The n largest values."""
    return sizes.orderBy(F.desc(column)).limit(n).select(column)

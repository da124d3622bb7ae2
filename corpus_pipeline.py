"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents, and further columns of docs are left out, whatever their names. An empty table gives an empty one.
ORACLE_SQL is None: no SQL expresses the classifier of the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm import decontaminate, lines, minhash, packing, quality
from lettermill.llm.base import small, spread, stored, table

#: Words of a shingle and similarity in percent, of the near-duplicate stage.
SHINGLE, PERCENT = 5, 80

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, gives a probability of 0.5 or more. Null and empty texts
    get the share of good labels as theirs; without labels of both classes all texts do. Rows that repeat and rows
    without a doc_id are judged by their text; an empty table stays empty."""
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs.select(*COLUMNS), net, keep=True).where("score >= 0.5").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more share; n_chars follows the text. Every row is a document; those
    without a doc_id count as holders of a line and lose none. Null texts stay null; no row goes."""
    out = lines.dedup_lines(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars.cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id. Null, empty and wordless texts, and rows
    without a doc_id, are in no group and stay; rows that share a doc_id stay or go together."""
    found = minhash.near_duplicates(docs, shingle=SHINGLE, percent=PERCENT)
    return docs.join(small(found.where(~F.col("kept")).select("doc_id").distinct()), "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Null texts have none; rows without a doc_id can't be named and
    stay; rows that share a doc_id go together."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(small(found.where("n_items > 0").select("doc_id").distinct()), "doc_id", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; a null or empty text is its end mark alone."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

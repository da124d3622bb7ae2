"""The detector's record over a stream of message files: the batch expressions, and a state of ids seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions import text as X
from lettermill.operators import mime

FILES = "path string, modificationTime timestamp, length long, content binary"


def message_stream(spark: SparkSession, folder: str, *, files_per_trigger: int = 1000) -> DataFrame:
    """The files that arrive in a folder."""
    return spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").load(folder)


def runtime_stream(files: DataFrame, *, delay: str = "1 day", qr_decoder: mime.QrDecoder | None = None) -> DataFrame:
    """Records of the messages of each file, by the text's id; of equal texts within the delay the first only, so that
    the state of seen ids is bounded."""
    parsed = mime.parsed_messages(files.select("path", "modificationTime", "content"), qr_decoder=qr_decoder)
    records = mime.runtime_record(parsed).drop("id")
    out = records.withColumn("id", X.content_id(F.col("text"))).withColumn("seen_at", F.current_timestamp())
    return out.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["id"])

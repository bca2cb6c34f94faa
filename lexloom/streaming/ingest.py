"""New dictionary lines as they arrive: the same projections as in batch, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.readers import ENTRY, first_ipa, is_vietnamese


def entries(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """A stream of parsed entries from a folder that JSON lines are added to."""
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(path)
    parsed = lines.select(F.col("value").alias("raw"), F.from_json("value", ENTRY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e")).select("raw", "e.*")
    return parsed.where(F.col("_bad").isNull() & is_vietnamese(F.col("lang"), F.col("lang_code")))


def headwords(stream: DataFrame) -> DataFrame:
    """Running counts of entries, senses and transcriptions of each headword: partial sums, bounded state for each key."""
    return stream.groupBy(T.merge_key(F.col("word")).alias("headword")).agg(
        F.count("*").alias("entries"),
        F.sum(F.size(F.coalesce("senses", F.array().cast(stream.schema["senses"].dataType)))).alias("senses"),
        F.count_if(first_ipa(F.col("sounds")) != "").alias("with_ipa"),
    )

"""The 214 radicals: characters by Unicode's compatibility forms, strokes by their order."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The last radical of each number of strokes, from one stroke on.
LAST = (6, 29, 60, 94, 117, 146, 166, 175, 186, 194, 200, 204, 208, 210, 211, 213, 214)


def table(spark: SparkSession) -> DataFrame:
    """(number, radical, strokes, file) of all radicals."""
    rows = []
    for number in range(1, 215):
        strokes = next(i for i, last in enumerate(LAST, 1) if number <= last)
        rows.append((number, unicodedata.normalize("NFKC", chr(0x2F00 + number - 1)), strokes, f"radical-{number:03d}.json"))
    return spark.createDataFrame(rows, "number int, radical string, strokes int, file string")


def strokes(number: Column) -> Column:
    out = F.lit(None).cast("int")
    for i in range(len(LAST), 0, -1):
        out = F.when(number <= LAST[i - 1], F.lit(i)).otherwise(out)
    return F.when(number >= 1, out)


def with_radicals(han: DataFrame, spark: SparkSession, number: str = "radical") -> DataFrame:
    """``han`` with its radicals' characters and strokes: a join with 214 rows."""
    return han.join(F.broadcast(table(spark).withColumnRenamed("radical", "radical_character").withColumnRenamed("number", number)), number, "left")


def coverage(han: DataFrame, number: str = "radical") -> DataFrame:
    """How many of the radicals occur, and what part."""
    known = F.count_distinct(F.when(F.col(number).between(1, 214), F.col(number)))
    return han.agg(known.alias("radicals"), F.round(known * 100 / 214, 2).alias("percent"))

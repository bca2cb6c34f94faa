"""A sharded search index and its scored top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

#: Bits of an index row.
IPA, NATIVE, HAN = 1, 2, 4
MOST = 80


def index(rows: DataFrame, id: str, word: str, flags: Column) -> DataFrame:
    """(i, w, n, t, b, f): id, word, its form without tones, tokens, bucket, flags."""
    n = T.strip_tone(F.col(word))
    tokens = F.regexp_extract_all(n, F.lit("[a-z]+"), 0)
    return rows.select(
        F.col(id).alias("i"),
        F.col(word).alias("w"),
        n.alias("n"),
        F.concat(F.lit("|"), F.array_join(tokens, "|"), F.lit("|")).alias("t"),
        T.first_char_bucket(F.col(word)).alias("b"),
        flags.alias("f"),
        tokens.alias("tokens"),
    )


def shards(indexed: DataFrame) -> DataFrame:
    """Each row once for every first letter of its tokens, `other` where it has none."""
    letters = F.array_distinct(F.transform("tokens", lambda t: F.substring(t, 1, 1)))
    return indexed.withColumn("shard", F.explode(F.when(F.size(letters) > 0, letters).otherwise(F.array(F.lit("other")))))


def shard_of(query: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(T.strip_tone(F.lit(query)), "[a-z]", 0), F.lit("")), F.lit("other"))


def score(query: str) -> Column:
    q = T.strip_tone(F.lit(query.strip()))
    needle = F.concat(F.lit("|"), q)
    return (
        F.when((F.col("n") == q) & (F.lower("w") == query.strip().lower()), 210)
        .when(F.col("n") == q, 200)
        .when(F.startswith("n", q), 140)
        .when(F.contains("t", F.concat(needle, F.lit("|"))), 130)
        .when(F.contains("t", needle), 120)
        .when(F.contains("n", q), 90)
        .otherwise(0)
    )


def search(sharded: DataFrame, query: str, mask: int = 0, letter: str | None = None, most: int = MOST, each: int = MOST) -> DataFrame:
    """The best rows of the query's shard: a partition filter, ``each`` of every score, then a top-k."""
    rows = sharded.where(F.col("shard") == shard_of(query))
    if mask:
        rows = rows.where(F.col("f").bitwiseAND(mask) != 0)
    if letter:
        rows = rows.where(F.col("b") == letter)
    tier = Window.partitionBy("score").orderBy("n", "w", "i")
    scored = rows.withColumn("score", score(query)).where("score > 0").withColumn("_tier", F.row_number().over(tier)).where(F.col("_tier") <= each).drop("_tier")
    return scored.orderBy(F.col("score").desc(), "n", "w", "i").limit(most)

"""Keyed merges with an explicit order of precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

#: The ranks of origins; the greater wins, of equal ones the earlier.
ORIGIN_RANK = {"không rõ": 0, "thuần Việt": 1, "vay mượn khác": 2, "Hán Việt": 3}


def first_non_null(value: str, order: str) -> Column:
    """Aggregate: the value of the least order that isn't null."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def last_wins(value: str, order: str) -> Column:
    return F.max_by(value, order)


def rank_max(value: str, rank: Column, order: str) -> Column:
    """Aggregate: the value of the greatest rank, of equal ranks the least order."""
    return F.max_by(value, F.struct(rank, -F.col(order)))


def union_distinct(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys, value): distinct values of a key as an array in order of first occurrence.

    Values are made distinct before they are gathered, so a task holds what
    the result has, not every row.
    """
    once = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(order).alias("_ord"))
    return once.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_ord", value))), lambda x: x[value]).alias(value))


def dedupe(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def enrich_only(base: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """``base`` with columns of ``meta`` where the key is known; never new rows."""
    return base.join(meta, key, "left")


def unseen(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(known.select(*keys), keys, "left_anti")


def assign_slugs(words: DataFrame, word: str = "word") -> DataFrame:
    """``id``: the slug for the first word that has it, a slug with a hash for the others."""
    s = words.withColumn("slug", T.slug(F.col(word)))
    n = F.row_number().over(Window.partitionBy("slug").orderBy(word))
    return s.withColumn("id", F.when(n == 1, F.col("slug")).otherwise(F.concat("slug", F.lit("-"), T.short_hash(F.col(word)))))


def carry_forward(rows: DataFrame, keys: list[str], order: str, value: str, placeholder: Column, into: str) -> DataFrame:
    """``into``: the value, or for a placeholder the last one before it in its run."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(~placeholder, F.col(value)), ignorenulls=True).over(w)
    return rows.withColumn(into, F.when(placeholder, before).otherwise(F.col(value)))


def fingerprint(ids: DataFrame, layer: str = "layer", id: str = "id") -> DataFrame:
    """Count and a digest of each layer's ids that doesn't depend on their order.

    Ids are hashed and summed by a prefix of the hash, then the 256 sums are
    hashed: no list of all ids is gathered.
    """
    h = ids.select(layer, F.sha2(F.concat_ws(":", layer, F.col(id).cast("string")), 256).alias("h"))
    part = h.groupBy(layer, F.substring("h", 1, 2).alias("p")).agg(
        F.count("*").alias("n"), F.sum(F.conv(F.substring("h", 3, 12), 16, 10).cast("decimal(38,0)")).alias("s")
    )
    line = F.concat_ws(":", "p", F.col("n").cast("string"), F.col("s").cast("string"))
    return part.groupBy(layer).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("fingerprint"))


def line_digest(ids: DataFrame, layer: str = "layer", id: str = "id") -> str:
    """SHA-256 of the sorted lines `layer:id`, streamed a partition at a time; the same for any order of rows."""
    import hashlib

    digest, first = hashlib.sha256(), True
    lines = ids.select(F.concat_ws(":", layer, F.col(id).cast("string")).alias("line")).orderBy("line")
    for r in lines.toLocalIterator():
        digest.update((("" if first else "\n") + r.line).encode())
        first = False
    return digest.hexdigest()

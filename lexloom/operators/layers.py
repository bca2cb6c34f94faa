"""Layers of the dictionary: words, Han characters, lexemes, Nom, synsets, evidence.

A layer is built by one aggregation by key.  What is gathered into arrays is
made distinct first, and an explicit order decides what comes first.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from . import merge


def ordered(rows: DataFrame, rank: DataFrame) -> DataFrame:
    """``rows`` (source, ordinal, ...) with ``ord``: the source's rank, then the ordinal."""
    joined = rows.join(F.broadcast(rank.select("source", "rank")), "source")  # sources are tens
    return joined.withColumn("ord", F.col("rank") * F.lit(10**12).cast("long") + F.col("ordinal"))


def numbered(rows: DataFrame, order: list[Column], into: str) -> DataFrame:
    """``rows`` with their place in an order, from 1.

    Rows are dealt by ranges and sorted there; a place is the number of rows in
    the ranges before, one count each, and the place in its own.  The ranges
    are kept on the executors, as both need the same ones.
    """
    at = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at).persist(StorageLevel.MEMORY_AND_DISK)
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    # a row for each range
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn(into, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before", "_at")


def _listed(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Distinct values of a key in order of first occurrence."""
    once = rows.select(*keys, value.alias(name), "ord").where(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.min("ord").alias("ord"))
    return once.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", name))), lambda x: x[name]).alias(name))


def words(entries: DataFrame) -> DataFrame:
    """Words by merge key from entries (word, source, ipa, pos, origin, meaning, ord).

    The first transcription counts, the origin of greatest rank, and of a
    source's meanings one of each folded form; a meaning that folds to nothing
    is dropped, and so is a word without a meaning or a Latin letter.
    """
    e = entries.withColumn("key", T.merge_key(F.col("word"))).where((F.col("key") != "") & F.col("word").rlike(r"\p{IsLatin}"))
    rank = F.coalesce(*[F.when(F.col("origin") == o, r) for o, r in merge.ORIGIN_RANK.items()], F.lit(0))
    base = e.groupBy("key").agg(
        F.min_by("word", "ord").alias("word"), merge.first_non_null("ipa", "ord").alias("ipa"), merge.rank_max("origin", rank, "ord").alias("origin"), F.count("*").alias("merged")
    )
    folded = F.trim(F.regexp_replace(T.fold(F.col("meaning")), r"[^\p{L}\p{N}]+", " "))
    once = e.withColumn("folded", folded).where("folded <> ''").groupBy("key", "source", "folded").agg(F.min(F.struct("ord", "meaning")).alias("m"))
    meanings = once.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("m.ord", "source", "m.meaning"))), lambda x: F.struct(x["source"].alias("source"), x["meaning"].alias("meaning"))).alias("definitions"))
    pos = _listed(e, ["key"], T.part_of_speech(F.col("pos")), "part_of_speech")
    sources = _listed(e, ["key"], F.col("source"), "sources")
    joined = base.join(meanings, "key").join(pos, "key", "left").join(sources, "key", "left")
    return merge.assign_slugs(joined).drop("slug")


def lexemes(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Headwords that aren't words, with distinct evidence (source, record hash)."""
    e = entries.withColumn("key", T.merge_key(F.col("headword"))).where("key <> ''").join(known.select("key"), "key", "left_anti")
    evidence = e.groupBy("key", "source", "record_hash").agg(F.min(F.struct("ord", "headword")).alias("m"))
    return evidence.groupBy("key").agg(F.min_by("m.headword", "m.ord").alias("headword"), F.array_sort(F.collect_list(F.struct("source", "record_hash"))).alias("evidence"))


def han(base: DataFrame, meta: DataFrame) -> DataFrame:
    """Characters of ``base`` with what ``meta`` knows of them; ``meta`` adds no character."""
    own = base.where(T.is_single_han(F.col("character"))).groupBy("character").agg(F.array_distinct(F.flatten(F.collect_list("readings"))).alias("readings"), F.min("meaning").alias("meaning"))
    extra = meta.groupBy("character").agg(*[F.first(c, ignorenulls=True).alias(f"_{c}") for c in ("readings", "meaning", "radical", "total_strokes")])
    j = own.join(extra, "character", "left")
    none = F.array().cast("array<string>")
    return j.select(
        T.code_point_id(F.col("character")).alias("id"),
        "character",
        F.array_union("readings", F.coalesce("_readings", none)).alias("readings"),
        F.coalesce("meaning", "_meaning").alias("meaning"),
        F.col("_radical").alias("radical"),
        F.col("_total_strokes").alias("total_strokes"),
    )


def evidence(examples: DataFrame) -> DataFrame:
    """Examples by the hash of their text; of equal hashes the last in order counts."""
    keyed = examples.withColumn("id", F.concat(F.lit("evidence-"), T.short_hash(F.col("text"))))
    return keyed.groupBy("id").agg(F.max_by(F.struct("headword", "text", "source"), "ord").alias("e")).select("id", "e.*")


def compact(definitions: Column, native: str = "vi") -> Column:
    """What a search result shows: native definitions if there are any, else the first three;
    two examples and five labels of each."""
    own = F.filter(definitions, lambda d: d["language"] == native)
    chosen = F.when(F.size(own) > 0, own).otherwise(F.slice(definitions, 1, 3))
    return F.transform(
        chosen,
        lambda d: F.struct(d["meaning"].alias("meaning"), d["language"].alias("language"), F.slice(d["examples"], 1, 2).alias("examples"), F.slice(d["labels"], 1, 5).alias("labels")),
    )


def han_index(characters: DataFrame) -> DataFrame:
    """Characters by strokes, then in Chinese order; an unknown number of strokes comes first."""
    strokes = F.coalesce("total_strokes", F.lit(0))
    flat = characters.select("id", "character", "radical", strokes.alias("strokes"), F.array_join("readings", ", ").alias("readings"), "meaning")
    return flat.orderBy("strokes", F.expr("character COLLATE zh"), "character")


def search_han(characters: DataFrame, query: str, most: int = 80) -> DataFrame:
    """Characters that are, are read, or mean the query; without one, those of four strokes or less."""
    rows = han_index(characters)
    q = query.strip().lower()
    if not q:
        return rows.where("strokes <= 4").limit(most)
    hit = (F.col("character") == query.strip()) | F.contains(F.lower("readings"), F.lit(q)) | F.contains(F.lower(F.coalesce("meaning", F.lit(""))), F.lit(q))
    return rows.where(hit).limit(most)

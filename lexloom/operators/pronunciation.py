"""Pronunciation facts: conflicts at three grains, dialect gaps, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: What the buckets of conflicts are called.
BUCKETS = ("formatting_only", "dialect_source_variant", "source_attested_variant", "unresolved")


def conflicts(facts: DataFrame) -> DataFrame:
    """One row for each headword with two raw transcriptions or more.

    ``facts``: headword, word, ipa, source, dialect, system, record.  Three
    aggregations from the finest grain up (record, source and dialect,
    headword), each on what the one below has left.
    """
    shown = facts.withColumn("shown", T.strip_brackets(F.col("ipa"))).withColumn("dialect", F.coalesce("dialect", F.lit("")))
    grain = ["headword", "source", "dialect", "system"]
    records = shown.groupBy(*grain, "record").agg(F.count_distinct("shown").alias("n"))
    values = shown.groupBy(*grain).agg(F.count("*").alias("facts"), F.count_distinct("shown").alias("values"))
    by_source = values.join(records.groupBy(*grain).agg(F.count("*").alias("records"), F.count_if(F.col("n") > 1).alias("mixed")), grain)
    single = F.count_if((F.col("values") > 1) & ~((F.col("records") == 1) & (F.col("mixed") == 1))) == 0
    sources = by_source.groupBy("headword").agg(F.count_if(F.col("values") > 1).alias("varied"), single.alias("attested"), F.count("*").alias("groups"))
    heads = shown.groupBy("headword").agg(
        F.count("*").alias("facts"),
        F.count_distinct("ipa").alias("raw_values"),
        F.count_distinct("shown").alias("shown_values"),
        F.count_distinct("word").alias("words"),
        F.count_if(F.col("dialect") == "").alias("without_dialect"),
        F.min("shown").alias("_any"),
    )
    bucket = (
        F.when(F.col("shown_values") == 1, BUCKETS[0])
        .when(F.col("varied") == 0, BUCKETS[1])
        .when((F.col("words") == 1) & F.col("attested"), BUCKETS[2])
        .otherwise(BUCKETS[3])
    )
    return (
        heads.where("raw_values >= 2").join(sources, "headword").withColumn("bucket", bucket)
        .withColumn("safe_ipa", F.when(F.col("bucket") == BUCKETS[0], F.col("_any")))
        .drop("_any", "attested")
    )


def unresolved(facts: DataFrame) -> DataFrame:
    """(headword, words, reasons, scopes, route) of every headword whose conflict is unresolved.

    ``facts`` as for :func:`conflicts`, with pos and entry_id.  Reasons and
    scopes look at the groups of one source, dialect and system that have
    several transcriptions; an entry's id that several records of those have
    is a fault of the parser, and sends the headword there.
    """
    open_ = conflicts(facts).where(F.col("bucket") == BUCKETS[3]).select("headword")
    shown = facts.withColumn("shown", T.strip_brackets(F.col("ipa"))).withColumn("dialect", F.coalesce("dialect", F.lit("")))
    grain = ["headword", "source", "dialect", "system"]
    varied = shown.groupBy(*grain).agg(F.count_distinct("shown").alias("_values")).where("_values > 1").join(open_, "headword").drop("_values")
    inner = shown.join(varied, grain)
    records = inner.groupBy(*grain, "record").agg(F.count_distinct("shown").alias("n"))
    by_group = records.groupBy(*grain).agg(F.count("*").alias("records"), F.max(F.col("n") > 1).alias("mixed"))
    groups = by_group.groupBy("headword").agg(F.max("mixed").alias("mixed"), F.max(F.col("records") > 1).alias("several"))
    pos = inner.groupBy("headword").agg(F.count_distinct("pos").alias("pos"))
    reused = inner.groupBy("headword", "entry_id").agg(F.count_distinct("record").alias("n")).groupBy("headword").agg(F.max(F.col("n") > 1).alias("reused"))
    words = facts.join(open_, "headword").groupBy("headword").agg(F.count_distinct("word").alias("words"))
    h = words.join(groups, "headword").join(pos, "headword").join(reused, "headword")
    forms = F.col("words") > 1

    def tags(*pairs: tuple[Column, str]) -> Column:
        return F.array_compact(F.array(*[F.when(c, F.lit(x)) for c, x in pairs]))

    reasons = tags((forms, "case_or_form_variant_present"), (F.col("several"), "multiple_raw_records_same_source_dialect"), (F.col("mixed"), "same_raw_record_multiple_ipa_same_source_dialect"))
    broad = tags((F.col("pos") > 1, "cross_pos_scope"), (forms, "normalized_form_collision"))
    narrow = F.when(F.col("several"), F.array(F.when(F.col("reused"), "source_entry_id_reused_across_raw_records").otherwise("same_form_same_pos_distinct_source_records"))).otherwise(F.array().cast("array<string>"))
    return h.select(
        "headword",
        "words",
        F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("source_dialect_internal_variant"))).alias("reasons"),
        F.when(F.size(broad) > 0, broad).otherwise(narrow).alias("scopes"),
    ).withColumn("route", F.when(F.array_contains("scopes", "source_entry_id_reused_across_raw_records"), "parser_fix").otherwise("human_review"))


def gap_reason(tags: Column, note: Column, dialects: list[str], other_notes: str) -> Column:
    """Why a fact has no dialect: never inferred, only what its labels say."""
    known = F.lit(False)
    for d in dialects:
        known = known | (note == d) | note.startswith(d + ";") | note.startswith(d + ",") | note.startswith(d + " (")
    return (
        F.when(F.size(tags) > 0, "unrecognized_explicit_tag")
        .when(F.coalesce(note, F.lit("")) == "", "no_explicit_source_label")
        .when(known, "recognized_geographic_label_with_qualifier")
        .when(note.rlike(other_notes), "non_geographic_note_qualifier")
        .otherwise("unrecognized_explicit_note")
    )


def coverage(facts: DataFrame) -> DataFrame:
    with_dialect = F.coalesce("dialect", F.lit("")) != ""
    return facts.groupBy("source").agg(F.count("*").alias("facts"), F.count_if(with_dialect).alias("with_dialect"), F.count_if(~with_dialect).alias("without_dialect"))


def dialect_histogram(facts: DataFrame) -> DataFrame:
    """(source, method, dialect, n, reason): how many facts of each dialect a source has; those without one say why."""
    method = F.when(F.startswith("source", F.lit("kaikki_")), "raw-sounds-tags-and-notes").otherwise("normalized-scalar-no-explicit-dialect")
    n = facts.groupBy("source", F.nullif("dialect", F.lit("")).alias("dialect")).agg(F.count("*").alias("n"))
    return n.select("source", method.alias("method"), "dialect", "n", F.when(F.col("dialect").isNull(), "no explicit dialect in tags or note").alias("reason"))


#: What to do about each bucket of conflicts, and where each gap goes.
ACTIONS = {
    BUCKETS[0]: "display the safe form; keep every raw form",
    BUCKETS[1]: "keep all variants as facts of their own",
    BUCKETS[2]: "keep the alternatives that the source attests",
    BUCKETS[3]: "review parsing or add metadata before choosing",
}
ROUTES = {
    "unrecognized_explicit_tag": "manual_label_review",
    "recognized_geographic_label_with_qualifier": "manual_label_parsing_review",
    "non_geographic_note_qualifier": "not_a_dialect_label",
    "unrecognized_explicit_note": "manual_label_review",
    "no_explicit_source_label": "source_metadata_unavailable",
}


def action(bucket: Column) -> Column:
    return F.coalesce(*[F.when(bucket == k, v) for k, v in ACTIONS.items()])


def route(gap: Column) -> Column:
    return F.coalesce(*[F.when(gap == k, v) for k, v in ROUTES.items()])


def rollup(found: DataFrame) -> DataFrame:
    """Conflicts, their facts and facts without a dialect, by bucket and in all."""
    return found.rollup("bucket").agg(F.count("*").alias("headwords"), F.sum("facts").alias("facts"), F.sum("without_dialect").alias("without_dialect"))

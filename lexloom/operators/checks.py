"""Validation: predicates over layers, references between them, metamorphic checks.

A check returns the rows that break it, so an empty result passes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVIEW = ("unreviewed", "machine-checked", "human-reviewed", "ai-reviewed")


def valid_trace(trace: Column) -> Column:
    """A provenance struct: id, 64 hex digits, confidence of 0 to 1, a known status."""
    ok = (
        (F.coalesce(trace["source_id"], F.lit("")) != "")
        & trace["raw_record_hash"].rlike("^[a-f0-9]{64}$")
        & trace["confidence"].between(0, 1)
        & trace["review_status"].isin(*REVIEW)
    )
    return F.coalesce(ok, F.lit(False))


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): how many rows break each rule, from one pass; null breaks it too."""
    names = list(rules)
    counts = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return counts.unpivot([], names, "rule", "n") if names else counts


def _ids(*columns: str) -> list[Column]:
    """Two hashes that together stand for ``columns`` where only equality counts."""
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *columns).alias("k2")]


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).count().where("count > 1")


def missing(rows: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key isn't known."""
    return rows.join(known.select(F.col(known_key).alias(key)).distinct(), key, "left_anti")


def one_to_one(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, or either has twice."""
    left, right = (x.groupBy(key).count().withColumnRenamed("count", n) for x, n in ((a, "left"), (b, "right")))
    return left.join(right, key, "full_outer").where("coalesce(left, 0) <> 1 OR coalesce(right, 0) <> 1")


def pair_invariants(pairs: DataFrame) -> DataFrame:
    """Pairs of an id with itself, and unordered pairs that repeat."""
    keyed = pairs.select(F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b"))
    return keyed.groupBy("a", "b").count().where("count > 1 OR a = b")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two results are equal as multisets: one aggregation, in which equal rows of both sides cancel out."""
    both = a.withColumn("_side", F.lit(1)).union(b.withColumn("_side", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("_side").alias("_more")).where("_more <> 0").isEmpty()


def stable(build: Callable[[], DataFrame], spark, partitions: tuple[int, int] = (3, 11)) -> bool:
    """Whether a build gives the same rows whatever the number of shuffle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got.append(sorted(map(str, build().collect())))
        return got[0] == got[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def brief(document: DataFrame, least: int = 20) -> DataFrame:
    """(useful, ready) of a text document (value): lines that aren't headings, quotations or open boxes, and
    whether there are ``least`` of them and no mark that it is pending."""
    lines = F.transform(F.split(F.trim("value"), "\r?\n"), F.trim)
    useful = F.size(F.filter(lines, lambda x: (x != "") & ~x.startswith("#") & ~x.startswith(">") & ~x.startswith("- [ ]")))
    return document.select(useful.alias("useful"), ((useful >= least) & ~F.col("value").rlike(r"(?i)WEBSITE_BRIEF_STATUS:\s*PENDING")).alias("ready"))


# --- schemas ---------------------------------------------------------------------------------------

#: What each layer's records must be, in the words of JSON Schema.
SCHEMAS: dict[str, dict[str, dict]] = {
    "words": {"id": {"minLength": 1}, "word": {"minLength": 1}, "language": {"enum": ["vi"]}, "syllable_count": {"minimum": 1}, "sources": {"minItems": 1}, "definitions": {"minItems": 1}},
    "han_characters": {"id": {"pattern": "^u\\+[0-9A-F]{4,6}$"}, "character": {"minLength": 1}, "total_stroke_count": {"minimum": 0, "nullable": True}},
    "lexemes": {"id": {"minLength": 1}, "headword": {"minLength": 1}, "language": {"enum": ["vi"]}, "evidence": {"minItems": 1}},
    "nom": {"id": {"minLength": 1}, "quoc_ngu": {"minLength": 1}, "characters": {"minLength": 1}, "frequency": {"minimum": 0, "nullable": True}},
    "semantics": {"synset_id": {"pattern": "^[0-9]{8}-[asnvr]$"}, "lemmas": {"minItems": 1}},
    "variants": {"key": {"minLength": 1}, "forms": {"minItems": 2}},
    "evidence": {"id": {"pattern": "^evidence-[0-9a-f]{8}$"}, "text": {"minLength": 1}},
}


def schema_rules(schema: dict[str, dict]) -> dict[str, Column]:
    """A predicate for each keyword of each property; what is null breaks it, unless the property is nullable."""
    rules: dict[str, Column] = {}
    for name, words in schema.items():
        c = F.col(name)
        of = {
            "minLength": lambda v, c=c: F.length(c) >= v,
            "pattern": lambda v, c=c: c.rlike(v),
            "enum": lambda v, c=c: c.isin(*v),
            "minimum": lambda v, c=c: c >= v,
            "maximum": lambda v, c=c: c <= v,
            "minItems": lambda v, c=c: F.size(c) >= v,
        }
        for word, value in words.items():
            if word != "nullable":
                ok = of[word](value)
                rules[f"{name}: {word}"] = c.isNull() | ok if words.get("nullable") else c.isNotNull() & ok
    return rules


def schema_errors(rows: DataFrame, layer: str) -> DataFrame:
    """(layer, rule, n): all errors of a layer, from one pass."""
    return violations(rows, schema_rules(SCHEMAS[layer])).select(F.lit(layer).alias("layer"), "rule", "n")


# --- gates -----------------------------------------------------------------------------------------

#: Labels that a pair may have, and how many pairs there must be.
GOLD_LABELS = ("same_sense", "near_paraphrase", "different_sense", "encyclopedic_or_name", "unclear")
GOLD_LEAST = 1000


def gold(pairs: DataFrame, least: int = GOLD_LEAST) -> DataFrame:
    """(rows, invalid, duplicates, passed) of labelled pairs: id, word, label, left and right meaning; ids once each."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    ok = text("id") & text("word") & F.coalesce(F.col("label").isin(*GOLD_LABELS), F.lit(False)) & text("left_meaning") & text("right_meaning")
    got = pairs.agg(F.count("*").alias("rows"), F.count_if(~ok).alias("invalid"), (F.count("*") - F.count_distinct(F.nullif("id", F.lit("")))).alias("duplicates"))
    return got.withColumn("passed", (F.col("rows") >= least) & (F.col("invalid") == 0) & (F.col("duplicates") == 0))


def reconcile(claimed: DataFrame, counted: DataFrame) -> DataFrame:
    """(name, claimed, counted) of the figures that differ, or that only one side has."""
    both = claimed.select("name", F.col("n").alias("claimed")).join(counted.select("name", F.col("n").alias("counted")), "name", "full_outer")
    return both.where(~F.col("claimed").eqNullSafe(F.col("counted")))


def passed(results: DataFrame) -> DataFrame:
    """(checks, failed, passed) of named figures (name, n) that all have to be 0."""
    return results.agg(F.count("*").alias("checks"), F.count_if(F.col("n") != 0).alias("failed")).withColumn("passed", F.col("failed") == 0)


def _counted(rows: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for name, df in rows:
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def cluster_invariants(clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(rule, n) for clusters (cluster_id, cluster_type, status, tier, has_vi, sense_id) and members (cluster_id, sense_id)."""
    of = _ids("cluster_id", "sense_id")
    return _counted(
        [
            ("duplicate cluster id", duplicates(clusters.select(*_ids("cluster_id")), ["k1", "k2"])),
            ("canonical is no member", clusters.select(*of).join(members.select(*of), ["k1", "k2"], "left_anti")),
            ("duplicate sense id", duplicates(members.select(*_ids("sense_id")), ["k1", "k2"])),
            ("auto_accepted, but not exact and high", clusters.where("status = 'auto_accepted' AND (cluster_type <> 'exact' OR tier <> 'high')")),
            ("reference_non_vi with a native definition", clusters.where("status = 'reference_non_vi' AND has_vi")),
        ]
    )


def entity_invariants(entities: DataFrame, clusters: DataFrame, risks: tuple[str, ...]) -> DataFrame:
    """(rule, n) for entities (sense_id, cluster_id, scope, status, risk_tags) and clusters (cluster_id, status)."""
    known = clusters.select(*_ids("cluster_id"), F.col("status").alias("_status"))
    of = entities.select(*_ids("cluster_id"), "scope", "status")
    other = of.join(known, ["k1", "k2"]).where((F.col("status") != F.col("_status")) | ((F.col("scope") == "cluster") != (F.col("_status") == "entity_or_encyclopedic")))
    return _counted(
        [
            ("no parent", of.join(known, ["k1", "k2"], "left_anti")),
            ("other status", other),
            ("duplicate definition", duplicates(entities.select(*_ids("sense_id")), ["k1", "k2"])),
            ("member without a risk", entities.where((F.col("scope") == "member") & ~F.arrays_overlap("risk_tags", F.array(*[F.lit(x) for x in risks])))),
        ]
    )


def pronunciation_invariants(facts: DataFrame, dialects: tuple[str, ...]) -> DataFrame:
    """(rule, n) for facts (pronunciation_id, word, ipa, dialect, tags, note, record_hash, confidence)."""
    said = F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array(F.coalesce("note", F.lit(""))))
    named = F.forall(F.split("dialect", "; "), lambda x: F.array_contains(said, x) & x.isin(*dialects))
    return _counted(
        [
            ("duplicate id", duplicates(facts, ["pronunciation_id"])),
            ("form of the id", facts.where(~F.col("pronunciation_id").rlike("^pronunciation-.+-[0-9a-f]{8}$"))),
            ("empty transcription", facts.where("coalesce(ipa, '') = ''")),
            ("form of the hash", facts.where(~F.coalesce(F.col("record_hash").rlike("^[a-f0-9]{64}$"), F.lit(False)))),
            ("dialect that nothing says", facts.where(F.col("dialect").isNotNull() & ~named)),
        ]
    )


def provenance(layer: str, traces: DataFrame, active: DataFrame) -> DataFrame:
    """(layer, rule, n) for traces (id, source, source_id, raw_record_hash) against active sources (key), tens of rows."""
    known = F.broadcast(active.select(F.col("key").alias("source_id")).distinct())
    rules = [
        ("inactive source", traces.join(known, "source_id", "left_anti")),
        ("other source", traces.where("source <> source_id")),
        ("form of the hash", traces.where(~F.coalesce(F.col("raw_record_hash").rlike("^[a-f0-9]{64}$"), F.lit(False)))),
        ("duplicate id", duplicates(traces, ["id"])),
    ]
    return _counted(rules).select(F.lit(layer).alias("layer"), "rule", "n")


def variant_faults(groups: DataFrame) -> DataFrame:
    """Groups of spellings (key, forms) with fewer than two forms, or more than one base or tone signature."""
    from ..functions import text as T

    several = lambda f: F.size(F.array_distinct(F.transform("forms", f))) != 1
    return groups.where((F.size("forms") < 2) | several(T.strip_tone) | several(T.tone_signature))


def repeated_definitions(rows: DataFrame) -> DataFrame:
    """(word, n): definitions of a word beyond the first with the same source and text, whatever its case."""
    per = rows.groupBy("word", "source", F.lower("meaning").alias("m")).agg((F.count("*") - 1).alias("n"))
    return per.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def contributions(layers: dict[str, DataFrame]) -> DataFrame:
    """(source, layer, n) and totals with a null layer: what each source gives to each layer (source)."""
    long = None
    for name, df in layers.items():
        one = df.select("source", F.lit(name).alias("layer"))
        long = one if long is None else long.unionByName(one)
    return long.groupingSets([["source", "layer"], ["source"]], "source", "layer").agg(F.count("*").alias("n"))

"""How the test tables stand for the lexical model, in Spark and in SQL.

A line of a document is a definition; its headword is the language and the
first two words of its key; `source` is the source, with rights and quality by
its number; labels give confidence and review status.  Events are
pronunciation facts, parts are headwords of the search index.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.unicode_tables import tone_table
from ..operators import senses

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL twins of the text functions ------------------------------------------------------------


def sql_clean(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(coalesce({x}, ''), '[ \t\r\n\x0B\x0C]+', ' ', 'g'), ' +([,.;:!?])', '\1', 'g'))"


def sql_fold(x: str) -> str:
    return f"lower(strip_accents(replace(replace({x}, 'đ', 'd'), 'Đ', 'D')))"


def sql_tone(x: str) -> str:
    frm, to = tone_table()
    return f"lower(translate({x}, '{frm}', '{to}'))"


def sql_slug(x: str) -> str:
    s = f"regexp_replace(regexp_replace({sql_fold(x)}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"(CASE WHEN {s} = '' THEN 'word-' || left(sha1({x}), 8) ELSE {s} END)"


def sql_key(x: str) -> str:
    k = rf"regexp_replace({sql_fold(sql_clean(x))}, '^ *[0-9]+[).]? *', '')"
    k = rf"regexp_replace({k}, '^(d|dt|tt|t|dong tu|danh tu|tinh tu|ph|pht|trt|l|c|id)\. +', '')"
    return rf"trim(regexp_replace({k}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def sql_tokens(key: str) -> str:
    return f"list_filter(string_split({key}, ' '), lambda t: length(t) > 1 AND NOT list_contains({STOP_SQL}, t))"


# --- definitions ---------------------------------------------------------------------------------


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it comes in fewer parts: a small table is one file,
    and what is derived from its texts takes long.  A large one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").where(F.col("text").isNotNull()))
    return d.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("idx", "meaning"))


def definitions(spark: SparkSession, sf_dir: str, entries: DataFrame | None = None) -> DataFrame:
    """Lines with a key as definitions; ``entries``: those of texts in these buckets alone."""
    lab = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    n = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    # a line is cleaned and keyed where it leaves its text: a filter on the key can't be pushed below that and make it anew
    # labels come to whole texts, not to lines with all that is made of them, which take five times the room
    texts = table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select("doc_id", "lang", "source", "text")
    if entries is not None:
        texts = texts.withColumn("bucket", senses.entry_bucket(F.xxhash64("doc_id"))).join(F.broadcast(entries), "bucket", "left_semi").drop("bucket")
    texts = spread(texts).join(lab, "doc_id", "left")
    cleaned = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("meaning"), T.clean(x).alias("clean")))
    keyed = F.transform(cleaned, lambda x: F.struct(x["meaning"].alias("meaning"), x["clean"].alias("clean"), T.key_of_clean(x["clean"]).alias("k")))
    rows = texts.select("doc_id", "lang", "source", "q", F.posexplode(keyed).alias("idx", "line")).select("doc_id", "lang", "source", "q", "idx", "line.*").where("k <> ''")

    def pick(i, *names):
        out = F.lit(names[-1])
        for j, name in reversed(list(enumerate(names[:-1]))):
            out = F.when(i == j, name).otherwise(out)
        return out

    labels = F.array_compact(
        F.array(
            F.when(F.col("meaning").rlike("^[A-Z][a-z]+ [A-Z][a-z]+"), "proper-name-candidate"),
            F.when(F.contains("meaning", F.lit("|")), "punctuation-headword-candidate"),
            F.when(F.col("meaning").rlike("[0-9]{6,}"), "domain-or-encyclopedic-candidate"),
            F.when(n == 19, "documented-unclear"),
            F.when(F.col("doc_id") % 13 == 5, "place-name-candidate"),
        )
    )
    pos = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.when(F.col("doc_id") % 7 == 0, "N").otherwise("danh từ")))
    return rows.select(
        F.concat_ws(":", "lang", F.substring_index("k", " ", 2)).alias("word"),
        "meaning",
        "source",
        F.col("doc_id").alias("entry_id"),
        F.col("idx").alias("definition_index"),
        F.sha2("meaning", 256).alias("record_hash"),
        F.when(F.col("lang") == "en", "vi").otherwise(F.col("lang")).alias("language"),
        F.when(F.col("q").isNotNull(), "human-reviewed").otherwise("machine-checked").alias("review_status"),
        F.when(F.col("q") == 1, 0.9).when(F.col("q") == 0, 0.6).otherwise(0.8).alias("confidence"),
        labels.alias("labels"),
        pos.alias("part_of_speech"),
        pick(n % 3, "open", "public-domain", "documented-unclear").alias("rights"),
        pick(n % 4, *senses.QUALITY).alias("quality"),
        "clean",
        F.col("k").alias("key"),
    )


def facts(spark: SparkSession, sf_dir: str, keep: bool = True, entries: DataFrame | None = None) -> DataFrame:
    """Definition facts, materialised once: the clusters read them four times.

    In memory or on the executors' disks; a lost part is computed anew.  Not
    ``keep``: made where they are read, for what reads few columns of them, as
    all columns take several times the room of the texts.
    """
    rows = senses.definition_facts(definitions(spark, sf_dir, entries))
    return rows.persist(StorageLevel.MEMORY_AND_DISK) if keep else rows


def near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near pairs of all facts; members of pairs are made anew of the texts that have one."""
    return senses.near_pairs(facts(spark, sf_dir, keep=False), again=lambda entries: facts(spark, sf_dir, keep=False, entries=entries))


def members(spark: SparkSession, sf_dir: str, *more: str | Column) -> tuple[DataFrame, DataFrame]:
    """Facts as ``senses.brief`` has them, and the same with their clusters; both materialised once, as they are small."""
    rows = senses.brief(facts(spark, sf_dir, keep=False), *more).persist(StorageLevel.MEMORY_AND_DISK)
    return rows, senses.clustered(rows).persist(StorageLevel.MEMORY_AND_DISK)


LINES_SQL = """lines AS (
  SELECT doc_id, lang, source, unnest(range(len(parts)))::INT AS idx, unnest(parts) AS meaning
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL))"""

_ENTITY = "['" + "', '".join(senses.ENTITY_RISKS) + "']"

FACTS_SQL = rf"""{LINES_SQL},
keyed AS (SELECT *, {sql_key('meaning')} AS key, CAST(regexp_extract(source, '[0-9]+') AS INT) AS n FROM lines),
lab AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id),
defs AS (
  SELECT lang || ':' || array_to_string(string_split(key, ' ')[1:2], ' ') AS word, meaning, source, k.doc_id AS entry_id, idx AS definition_index,
    sha256(meaning) AS record_hash, CASE WHEN lang = 'en' THEN 'vi' ELSE lang END AS language,
    CASE WHEN q IS NOT NULL THEN 'human-reviewed' ELSE 'machine-checked' END AS review_status,
    CASE WHEN q = 1 THEN 0.9::DOUBLE WHEN q = 0 THEN 0.6::DOUBLE ELSE 0.8::DOUBLE END AS confidence,
    list_filter([CASE WHEN regexp_matches(meaning, '^[A-Z][a-z]+ [A-Z][a-z]+') THEN 'proper-name-candidate' END,
      CASE WHEN contains(meaning, '|') THEN 'punctuation-headword-candidate' END,
      CASE WHEN regexp_matches(meaning, '[0-9]{{6,}}') THEN 'domain-or-encyclopedic-candidate' END,
      CASE WHEN n = 19 THEN 'documented-unclear' END, CASE WHEN k.doc_id % 13 = 5 THEN 'place-name-candidate' END], lambda x: x IS NOT NULL) AS labels,
    CASE WHEN k.doc_id % 5 = 0 THEN []::VARCHAR[] WHEN k.doc_id % 7 = 0 THEN ['N'] ELSE ['danh từ'] END AS pos,
    CASE n % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'public-domain' ELSE 'documented-unclear' END AS rights,
    CASE n % 4 WHEN 0 THEN 'học thuật' WHEN 1 THEN 'cộng đồng' WHEN 2 THEN 'tổng hợp' ELSE 'OCR cần soát' END AS quality, key
  FROM keyed k LEFT JOIN lab USING (doc_id) WHERE key <> ''),
tagged AS (
  SELECT *, {sql_tokens('key')} AS tokens, {sql_clean('meaning')} AS m FROM defs),
ruled AS (
  SELECT *, list_filter([
      CASE WHEN rights = 'documented-unclear' OR list_contains(labels, 'documented-unclear') THEN 'documented-unclear-source' END,
      CASE WHEN confidence < 0.75 THEN 'low-confidence' END, CASE WHEN len(pos) = 0 THEN 'missing-pos' END,
      CASE WHEN list_contains(pos, 'N') THEN 'raw-pos-code' END, CASE WHEN language <> 'vi' THEN 'non-vi-definition' END,
      CASE WHEN length(m) < 12 OR len(string_split(key, ' ')) < 2 THEN 'too-short' END, CASE WHEN length(m) > 500 THEN 'too-long' END,
      CASE WHEN regexp_matches(m, '^ *[0-9]+[.)] +') OR regexp_matches(m, '^ *[0-9]+[.)]? *$') THEN 'leading-sense-marker' END],
      lambda x: x IS NOT NULL) || list_filter(labels, lambda x: list_contains({_ENTITY}, x)) AS risk_tags FROM tagged),
facts AS (
  SELECT *, list_has_any(risk_tags, {_ENTITY}) AS hard_risk,
    'sense-' || {sql_slug('word')} || '-' || left(sha1(lower({sql_clean('word')}) || ':' || source || ':' || entry_id || ':' || record_hash || ':' || definition_index || ':' || key), 8) AS sense_id,
    'def-' || left(sha1(entry_id || ':' || definition_index || ':' || source || ':' || record_hash), 8) AS definition_uid,
    round(CASE rights WHEN 'public-domain' THEN 35 WHEN 'open' THEN 28 ELSE -18 END
      + CASE quality WHEN 'học thuật' THEN 30 WHEN 'cộng đồng' THEN 16 WHEN 'tổng hợp' THEN 8 ELSE 2 END
      + CASE WHEN language = 'vi' THEN 18 ELSE -20 END + confidence * 25 + CASE review_status WHEN 'human-reviewed' THEN 20 ELSE 6 END
      + CASE WHEN len(labels) > 0 THEN 2 ELSE 0 END
      - coalesce(list_sum(list_transform(risk_tags, lambda t: CASE WHEN list_contains({_ENTITY}, t) THEN 45 WHEN t = 'documented-unclear-source' THEN 25
          WHEN t = 'low-confidence' THEN 12 WHEN t = 'non-vi-definition' THEN 15 ELSE 4 END)), 0), 4) AS score,
    language = 'vi' AND rights IN ('open', 'public-domain') AND confidence >= 0.75 AND NOT list_has_any(risk_tags, {_ENTITY}) AS trusted
  FROM ruled)"""

CLUSTERS_SQL = rf"""{FACTS_SQL},
grouped AS (SELECT word, key FROM facts GROUP BY word, key HAVING count(*) > 1 AND count(DISTINCT source) > 1),
members AS (
  SELECT f.*, g.word IS NOT NULL AS exact, CASE WHEN g.word IS NOT NULL THEN 'exact' ELSE 'singleton' END AS cluster_type,
    CASE WHEN g.word IS NOT NULL THEN 'cluster-exact-' || {sql_slug('f.word')} || '-' || left(sha1(f.word || ':' || f.key), 8)
      ELSE 'cluster-single-' || {sql_slug('f.word')} || '-' || left(sha1(f.sense_id), 8) END AS cluster_id
  FROM facts f LEFT JOIN grouped g ON f.word = g.word AND f.key = g.key),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, confidence DESC, length(meaning), source, sense_id) AS r FROM members),
sums AS (
  SELECT cluster_id, count(*) AS member_count, count(DISTINCT source) AS source_count, count(DISTINCT CASE WHEN trusted THEN source END) AS trusted_source_count,
    count(*) FILTER (trusted) AS trusted_count, bool_or(language = 'vi') AS has_vi, count(*) FILTER (hard_risk) AS risky,
    count(*) FILTER (list_contains(risk_tags, 'documented-unclear-source')) AS unclear, count(*) FILTER (list_contains(risk_tags, 'low-confidence')) AS low,
    count(*) FILTER (list_contains(risk_tags, 'missing-pos')) AS no_pos, max(score) FILTER (r = 2) AS runner_up FROM ranked GROUP BY cluster_id),
based AS (
  SELECT s.*, c.word, c.key, c.cluster_type, c.exact, c.sense_id, c.source, c.language, c.meaning, c.confidence, c.score, c.hard_risk AS canon_risk,
    c.trusted AS canon_trusted, (len(c.tokens) >= 3 OR (len(c.tokens) >= 2 AND length(c.key) >= 10 AND s.trusted_count >= 3)) AS safe
  FROM sums s JOIN ranked c ON s.cluster_id = c.cluster_id AND c.r = 1),
clusters AS (
  SELECT *, CASE WHEN NOT has_vi THEN 'reference_non_vi' WHEN canon_risk OR risky = member_count THEN 'entity_or_encyclopedic'
      WHEN exact AND trusted_source_count >= 2 AND safe THEN 'auto_accepted'
      WHEN exact AND source_count >= 2 AND safe AND canon_trusted AND risky > 0 AND risky < member_count THEN 'machine_clustered'
      WHEN exact AND source_count >= 2 AND safe AND risky = 0 THEN 'machine_clustered'
      WHEN exact AND source_count >= 2 AND risky > 0 AND risky < member_count THEN 'needs_review'
      WHEN risky > 0 THEN 'quarantined' WHEN unclear > 0 OR low > 0 OR no_pos > 0 THEN 'needs_review' ELSE 'machine_retained' END AS status,
    CASE WHEN NOT has_vi THEN ['no-vietnamese-definition']
      WHEN canon_risk OR risky = member_count THEN ['entity-or-encyclopedic-layer'] || CASE WHEN canon_risk THEN ['canonical-definition-has-entity-risk'] ELSE [] END
        || CASE WHEN risky = member_count THEN ['all-source-definitions-have-entity-risk'] ELSE [] END
      WHEN exact AND trusted_source_count >= 2 AND safe THEN ['exact-normalized-definition', 'trusted-source-agreement'] || CASE WHEN risky > 0 THEN ['risky-members-routed-to-entity-review'] ELSE [] END
      WHEN exact AND source_count >= 2 AND safe AND canon_trusted AND risky > 0 AND risky < member_count THEN ['exact-normalized-definition', 'trusted-canonical-with-member-level-entity-risk', 'risky-members-routed-to-entity-review']
      WHEN exact AND source_count >= 2 AND safe AND risky = 0 THEN ['exact-normalized-definition', 'source-agreement-but-not-enough-trusted-sources']
      WHEN exact AND source_count >= 2 AND risky > 0 AND risky < member_count THEN ['exact-normalized-definition', 'low-information-definition-kept-for-review', 'risky-members-routed-to-entity-review']
      WHEN risky > 0 THEN ['hard-risk-label']
      WHEN unclear > 0 OR low > 0 OR no_pos > 0 THEN CASE WHEN unclear > 0 THEN ['documented-unclear-source'] ELSE [] END || CASE WHEN low > 0 THEN ['low-confidence'] ELSE [] END || CASE WHEN no_pos > 0 THEN ['missing-pos'] ELSE [] END
      ELSE ['singleton-or-unmerged-machine-retained'] END AS reasons,
    CASE WHEN exact THEN floor(least(1.0, 0.56::DOUBLE + least(0.18::DOUBLE, (source_count - 1) * 0.06::DOUBLE) + least(0.2::DOUBLE, trusted_source_count * 0.08::DOUBLE)) * 10000 + 0.5::DOUBLE) / 10000 ELSE 1.0::DOUBLE END AS cluster_confidence,
    CASE WHEN exact THEN floor(least(1.0, 0.45::DOUBLE + confidence * 0.3::DOUBLE + least(0.24::DOUBLE, coalesce(greatest(0.0::DOUBLE, score - runner_up), 0.0::DOUBLE) / 80)) * 10000 + 0.5::DOUBLE) / 10000 ELSE 1.0::DOUBLE END AS selection_confidence
  FROM based)"""

NEAR_SQL = f"""{FACTS_SQL},
own AS (SELECT word, sense_id, source, key, trusted, list_distinct(tokens) AS set_ FROM facts WHERE len(tokens) >= 4),
pairs AS (
  SELECT a.word, a.sense_id AS left_id, b.sense_id AS right_id, a.source AS left_source, b.source AS right_source, a.trusted AND b.trusted AS both_trusted,
    len(list_intersect(a.set_, b.set_))::DOUBLE / len(list_distinct(a.set_ || b.set_)) AS raw
  FROM own a JOIN own b ON a.word = b.word AND a.sense_id < b.sense_id AND a.key <> b.key),
near AS (
  SELECT *, round(raw, 4) AS score, CASE WHEN raw >= 0.94 AND both_trusted THEN 'machine_cluster_candidate' ELSE 'review_only' END AS action FROM pairs WHERE raw >= 0.82),
triaged AS (
  SELECT *, CASE WHEN action = 'machine_cluster_candidate' AND score >= 0.98 AND left_source <> right_source THEN 'auto_safe_candidate'
    WHEN action = 'machine_cluster_candidate' THEN 'machine_cluster_candidate' ELSE 'blocked_review_only' END AS triage_group FROM near)"""


# --- pronunciation -------------------------------------------------------------------------------


def pronunciations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    m = F.col("event_id") % 3
    ipa = F.when(m == 0, F.concat(F.lit("["), F.col("event_type"), F.lit("]"))).when(m == 1, F.concat(F.lit("/"), F.col("event_type"), F.lit("/"))).otherwise(F.col("event_type"))
    return e.select(
        F.col("user_id").alias("headword"),
        F.when(F.col("event_id") % 40 == 0, F.concat(F.lit("x"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string")).alias("word"),
        ipa.alias("ipa"),
        F.concat(F.lit("src"), (k % 3).cast("string")).alias("source"),
        F.when(k % 4 == 0, "Hà Nội").when(k % 4 == 1, "Sài Gòn").alias("dialect"),
        F.lit("IPA").alias("system"),
        F.date_format("ts", "yyyy-MM-dd").alias("record"),
        F.when(k % 5 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.when(k % 7 == 1, "Hà Nội, old").when(k % 7 == 2, "rare").when(k % 7 == 3, "some note").alias("note"),
        "event_id",
        F.when(k % 2 == 0, "N").otherwise("V").alias("pos"),
        F.concat(F.lit("e"), (F.col("event_id") % 4).cast("string")).alias("entry_id"),
    )


PRON_SQL = """pron AS (
  SELECT user_id AS headword, CASE WHEN event_id % 40 = 0 THEN 'x' ELSE '' END || user_id AS word, CASE event_id % 3 WHEN 0 THEN '[' || event_type || ']' WHEN 1 THEN '/' || event_type || '/' ELSE event_type END AS ipa,
    event_type AS shown, 'src' || (k % 3) AS source, CASE k % 4 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Sài Gòn' END AS dialect, 'IPA' AS system,
    strftime(ts, '%Y-%m-%d') AS record, k % 5 = 0 AS tagged,
    CASE k % 7 WHEN 1 THEN 'Hà Nội, old' WHEN 2 THEN 'rare' WHEN 3 THEN 'some note' END AS note, event_id, CASE WHEN k % 2 = 0 THEN 'N' ELSE 'V' END AS pos, 'e' || (event_id % 4) AS entry_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""

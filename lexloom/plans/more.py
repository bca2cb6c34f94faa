"""More queries: labels, audits, merges of layers, reviews, invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import kangxi
from ..functions import text as T
from ..operators import audit, checks, layers, merge, pronunciation, review, senses
from ..sources import registry
from . import mapping as M
from .queries import n, query

# --- the registry ----------------------------------------------------------------------------------

_REG = "reg AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{r}', '{q}', {'NULL' if c is None else f'{c}::DOUBLE'})" for k, r, q, c in registry.SOURCES) + ") t(key, rights, quality, confidence))"


@query(f"WITH {_REG} SELECT key, rights FROM reg WHERE rights IN ('open', 'public-domain') AND key NOT IN ('hunspell_vi')")
def selected_sources(s, d):
    return registry.selected(registry.registry(s), registry.Policy.parse("open-only", "hunspell_vi")).select("key", "rights")


@query(
    f"WITH {_REG}, r AS (SELECT *, CASE WHEN rights = 'documented-unclear' THEN 1 ELSE 0 END AS u, CASE WHEN confidence IS NULL OR confidence < 0.75 THEN 1 ELSE 0 END AS l FROM reg) "
    "SELECT key, (u + l)::BIGINT AS risks, CASE WHEN u + l = 0 THEN 'ready' WHEN u = 1 THEN 'documented-with-rollback' ELSE 'needs-followup' END AS verdict FROM r"
)
def source_dossier(s, d):
    return registry.dossier(registry.registry(s)).select("key", n(F.size("risks")).alias("risks"), "verdict")


# --- labels of pairs -------------------------------------------------------------------------------

_CODE = r"^(?:[IVX]+ +)?(d|dt|đt|đg|đgt|t|tt|trt|tht|lt|l|pt|pht|ph|c)\."


def _core_sql(x: str) -> str:
    c = rf"regexp_replace({M.sql_clean(x)}, '(?i){_CODE} *', '')"
    c = rf"regexp_replace(regexp_replace({c}, '^\([^)]{{1,50}}\) *', ''), '\[[^\]]{{1,100}}\]|\([^)]{{1,50}}\)', '', 'g')"
    return rf"trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


_PAIRS = f"""{M.NEAR_SQL}, texts AS (SELECT sense_id, meaning FROM facts),
p AS (SELECT n.*, l.meaning AS lm, r.meaning AS rm FROM near n JOIN texts l ON l.sense_id = left_id JOIN texts r ON r.sense_id = right_id),
c AS (SELECT *, {_core_sql('lm')} AS a, {_core_sql('rm')} AS b, CASE WHEN left_source <> right_source AND score >= 0.99 THEN 'exact_cross_source_duplicate' ELSE 'near_duplicate' END AS category FROM p),
o AS (SELECT *, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s_, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l_ FROM c),
w AS (SELECT *, len(list_filter(string_split(l_, ' '), lambda t: t <> '')) - len(list_filter(string_split(s_, ' '), lambda t: t <> '')) AS more FROM o)"""


def _pairs(s: SparkSession, d: str) -> DataFrame:
    p = M.near_pairs(s, d)
    return p.withColumn("category", F.when((F.col("left_source") != F.col("right_source")) & (F.col("score") >= 0.99), "exact_cross_source_duplicate").otherwise("near_duplicate"))


@query(
    f"WITH {_PAIRS} SELECT left_id, right_id, CASE WHEN category = 'exact_cross_source_duplicate' THEN 'exact-cross-source-positive-control' WHEN length(a) >= 8 AND a = b THEN 'semantic-core-exact' "
    "WHEN length(s_) >= 20 AND contains(l_, s_) AND more BETWEEN 1 AND 3 THEN 'core-contained-small-extension' ELSE 'insufficient-independent-silver-evidence' END AS rule FROM w"
)
def silver_labels(s, d):
    return _pairs(s, d).select("left_id", "right_id", review.silver_label(F.col("left_meaning"), F.col("right_meaning"), F.col("category"))["rule"].alias("rule"))


_PLAIN = r"""trim(regexp_replace(regexp_replace(lower({x}), '[“”"''.:;!?()\[\]{{}}]', ' ', 'g'), '[ \t\n]+', ' ', 'g'))"""


@query(
    f"WITH {_PAIRS}, q AS (SELECT *, {_PLAIN.format(x='lm')} AS pl, {_PLAIN.format(x='rm')} AS pr FROM w), "
    "t AS (SELECT *, list_distinct(list_filter(string_split(pl, ' '), lambda x: length(x) >= 2)) AS tl, list_distinct(list_filter(string_split(pr, ' '), lambda x: length(x) >= 2)) AS tr FROM q), "
    "u AS (SELECT *, CASE WHEN len(list_distinct(tl || tr)) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(tl, tr))::DOUBLE / len(list_distinct(tl || tr)) END AS o FROM t) "
    "SELECT left_id, right_id, CASE WHEN pl = pr THEN 'same_sense' WHEN category = 'exact_cross_source_duplicate' AND o >= 0.82 THEN 'same_sense' WHEN contains(pl, pr) OR contains(pr, pl) OR o >= 0.62 THEN 'near_paraphrase' "
    "WHEN category = 'near_duplicate' AND o <= 0.24 THEN 'different_sense' ELSE 'unclear' END AS label FROM u"
)
def proxy_labels(s, d):
    return _pairs(s, d).select("left_id", "right_id", review.proxy_label(F.col("left_meaning"), F.col("right_meaning"), F.col("category"))["label"].alias("label"))


@query(f"WITH {M.NEAR_SQL}, p AS (SELECT left_id, right_id FROM near UNION ALL SELECT right_id, left_id FROM near WHERE score >= 0.9 UNION ALL SELECT left_id, left_id FROM near WHERE score = 1) SELECT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b, count(*) AS count FROM p GROUP BY 1, 2 HAVING count(*) > 1 OR least(left_id, right_id) = greatest(left_id, right_id)")
def pair_invariants(s, d):
    """Pairs as they are break nothing; here some are turned round or joined to themselves."""
    near = M.near_pairs(s, d).select("left_id", "right_id", "score")
    turned = near.where("score >= 0.9").select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"))
    own = near.where("score = 1").select("left_id", F.col("left_id").alias("right_id"))
    return checks.pair_invariants(near.drop("score").unionByName(turned).unionByName(own))


@query(
    f"WITH {M.FACTS_SQL}, f AS (SELECT word, sense_id, source, key, list_distinct(tokens) AS t FROM facts WHERE len(tokens) >= 4) "
    "SELECT a.word, a.sense_id AS left_id, b.sense_id AS right_id FROM f a JOIN f b ON a.word = b.word AND a.sense_id < b.sense_id AND a.key <> b.key AND a.source <> b.source "
    "WHERE len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(a.t || b.t)) <= 0.2 ORDER BY a.word, left_id, right_id LIMIT 5000"
)
def distant_pairs(s, d):
    """The first 5000 pairs of a headword, in a stated order, that have little in common."""
    return audit.distant_pairs(M.facts(s, d, keep=False), 5000).select("word", "left_id", "right_id")


# --- audits ----------------------------------------------------------------------------------------


@query(
    f"WITH {M.FACTS_SQL}, f AS (SELECT sense_id, unnest(list_filter(risk_tags || [CASE WHEN review_status <> 'human-reviewed' THEN 'not-human-reviewed' END, CASE WHEN len(labels) = 0 THEN 'missing-labels' END, "
    "CASE WHEN regexp_matches(m, '^ *[0-9]+[).]? *(?:[A-Za-zĐđ]{1,6}\\.)? *') THEN 'loose-sense-marker' END], lambda x: x IS NOT NULL)) AS flag FROM facts) SELECT flag, count(*) AS n FROM f GROUP BY flag"
)
def audit_flags(s, d):
    marker = T.clean(F.col("meaning")).rlike(r"^ *[0-9]+[).]? *(?:[A-Za-zĐđ]{1,6}\.)? *")
    own = F.array_compact(
        F.array(F.when(F.col("review_status") != "human-reviewed", "not-human-reviewed"), F.when(F.size("labels") == 0, "missing-labels"), F.when(marker, "loose-sense-marker"))
    )
    return M.facts(s, d).select(F.explode(F.concat("risk_tags", own)).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query(f"WITH {M.FACTS_SQL} SELECT 'bad hash' AS rule, count(*) FILTER (NOT regexp_matches(record_hash, '^[a-f0-9]{{64}}$')) AS n FROM facts UNION ALL SELECT 'confidence', count(*) FILTER (confidence NOT BETWEEN 0 AND 1) FROM facts UNION ALL SELECT 'long', count(*) FILTER (length(meaning) > 500) FROM facts")
def rule_violations(s, d):
    rules = {"bad hash": F.col("record_hash").rlike("^[a-f0-9]{64}$"), "confidence": F.col("confidence").between(0, 1), "long": F.length("meaning") <= 500}
    return checks.violations(M.facts(s, d), rules)


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.c AS left, l.c AS right FROM (SELECT doc_id, count(*) AS c FROM documents GROUP BY 1) d FULL JOIN (SELECT doc_id, count(*) AS c FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id WHERE coalesce(d.c, 0) <> 1 OR coalesce(l.c, 0) <> 1")
def one_to_one(s, d):
    return checks.one_to_one(M.table(s, d, "documents"), M.table(s, d, "labels"), "doc_id")


@query("WITH b AS (SELECT lang || ':' || source AS bucket, count(*) AS c FROM documents GROUP BY 1), s AS (SELECT bucket, c, sum(c) OVER (ORDER BY bucket)::BIGINT AS upto, sum(c) OVER ()::BIGINT AS total FROM b) SELECT bucket, c, upto FROM s WHERE upto > (0.37 * total)::BIGINT AND upto - c <= (0.37 * total)::BIGINT")
def weighted_pick(s, d):
    """The bucket that a point of the cumulative count falls in; buckets are few."""
    b = M.table(s, d, "documents").groupBy(F.concat_ws(":", "lang", "source").alias("bucket")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("bucket"))
    point = F.round(F.lit(0.37) * F.sum("c").over(Window.partitionBy())).cast("long")
    return b.withColumn("upto", upto).withColumn("point", point).where((F.col("upto") > F.col("point")) & (F.col("upto") - F.col("c") <= F.col("point"))).drop("point")


# --- merges of layers ------------------------------------------------------------------------------


@query(
    f"WITH {M.FACTS_SQL}, o AS (SELECT *, entry_id * 100000 + definition_index AS ord, CASE language WHEN 'vi' THEN 3 WHEN 'de' THEN 2 WHEN 'fr' THEN 1 ELSE 0 END AS rank FROM facts) "
    "SELECT word, arg_min(meaning, ord) FILTER (len(pos) > 0) AS first_meaning, arg_max(quality, struct_pack(a := rank, b := -ord)) AS origin, count(*) AS merged, count(DISTINCT source) AS sources, count(DISTINCT key) AS meanings FROM o GROUP BY word"
)
def merge_words(s, d):
    rank = F.when(F.col("language") == "vi", 3).when(F.col("language") == "de", 2).when(F.col("language") == "fr", 1).otherwise(0)
    f = M.facts(s, d).withColumn("ord", F.col("entry_id") * 100000 + F.col("definition_index")).withColumn("value", F.when(F.size("part_of_speech") > 0, F.col("meaning")))
    return f.groupBy("word").agg(
        merge.first_non_null("value", "ord").alias("first_meaning"),
        merge.rank_max("quality", rank, "ord").alias("origin"),
        F.count("*").alias("merged"),
        F.count_distinct("source").alias("sources"),
        F.count_distinct("key").alias("meanings"),
    )


@query("SELECT conv_id, count(*) AS turns, count(DISTINCT role) AS roles, max(turn) - min(turn) + 1 = count(*) AS dense, sum(length(text))::BIGINT AS size FROM conversations GROUP BY conv_id")
def ordinal_audit(s, d):
    c = M.table(s, d, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_distinct("role").alias("roles"), (F.max("turn") - F.min("turn") + 1 == F.count("*")).alias("dense"), n(F.sum(F.length("text"))).alias("size"))


# --- reviews ---------------------------------------------------------------------------------------

_GAP = (
    "CASE WHEN tagged THEN 'unrecognized_explicit_tag' WHEN coalesce(note, '') = '' THEN 'no_explicit_source_label' WHEN starts_with(note, 'Hà Nội,') THEN 'recognized_geographic_label_with_qualifier' "
    "WHEN starts_with(note, 'rare') THEN 'non_geographic_note_qualifier' ELSE 'unrecognized_explicit_note' END"
)


@query(f"WITH {M.PRON_SQL}, g AS (SELECT *, {_GAP} AS gap FROM pron WHERE dialect IS NULL) SELECT gap, 'insufficient_evidence' AS decision, CASE WHEN gap = 'unrecognized_explicit_note' THEN 'medium' ELSE 'high' END AS priority, count(*) AS n FROM g GROUP BY ALL")
def dialect_decisions(s, d):
    p = M.pronunciations(s, d).where(F.col("dialect").isNull())
    g = p.withColumn("gap", pronunciation.gap_reason(F.col("tags"), F.col("note"), ["Hà Nội", "Sài Gòn"], "^rare"))
    x = g.withColumn("x", review.dialect_decision(F.col("gap"), F.col("note")))
    return x.groupBy("gap", F.col("x.decision").alias("decision"), F.col("x.priority").alias("priority")).agg(F.count("*").alias("n"))


@query("SELECT headword, n FROM (SELECT user_id AS headword, count(DISTINCT event_type) AS n FROM events GROUP BY 1) WHERE n > 1")
def ipa_conflict_headwords(s, d):
    p = M.pronunciations(s, d).withColumn("shown", T.strip_brackets(F.col("ipa")))
    return p.groupBy("headword").agg(F.count_distinct("shown").alias("n")).where("n > 1")


# --- layers ----------------------------------------------------------------------------------------

_STROKES = "CASE WHEN r < 1 THEN NULL " + " ".join(f"WHEN r <= {last} THEN {i}" for i, last in enumerate(kangxi.LAST, 1)) + " END"


@query(f"WITH p AS (SELECT p_partkey, (p_partkey % 230)::INT AS r FROM part) SELECT p_partkey, r AS radical, ({_STROKES})::INT AS strokes FROM p")
def radical_strokes(s, d):
    p = M.table(s, d, "part").select("p_partkey", (F.col("p_partkey") % 230).cast("int").alias("radical"))
    return p.withColumn("strokes", kangxi.strokes(F.col("radical")))


@query("SELECT count(DISTINCT CASE WHEN r BETWEEN 1 AND 214 THEN r END) AS radicals, round(count(DISTINCT CASE WHEN r BETWEEN 1 AND 214 THEN r END) * 100 / 214, 2) AS percent FROM (SELECT p_size * 4 AS r FROM part)")
def radical_coverage(s, d):
    return kangxi.coverage(M.table(s, d, "part").select((F.col("p_size") * 4).alias("radical")))


def _entries(s: SparkSession, d: str) -> DataFrame:
    f = M.facts(s, d)
    return f.select(
        "word",
        "source",
        F.when(F.col("trusted"), F.col("key")).alias("ipa"),
        F.get("part_of_speech", F.lit(0)).alias("pos"),
        F.when(F.col("language") == "vi", "thuần Việt").when(F.col("language") == "de", "Hán Việt").alias("origin"),
        "meaning",
        (F.col("entry_id") * 100000 + F.col("definition_index")).alias("ord"),
    )


@query(
    f"WITH {M.FACTS_SQL}, e AS (SELECT *, lower({M.sql_clean('word')}) AS k, entry_id * 100000 + definition_index AS ord, trim(regexp_replace({M.sql_fold('meaning')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS folded FROM facts WHERE regexp_matches(word, '\\p{{Latin}}')), "
    "m AS (SELECT k, count(*) AS definitions FROM (SELECT DISTINCT k, source, folded FROM e WHERE folded <> '') GROUP BY k), "
    "b AS (SELECT k, arg_min(word, ord) AS word, arg_min(key, ord) FILTER (trusted) AS ipa, CASE WHEN bool_or(language = 'de') THEN 'Hán Việt' WHEN bool_or(language = 'vi') THEN 'thuần Việt' END AS origin, count(*) AS merged, count(DISTINCT source) AS sources FROM e GROUP BY k) "
    "SELECT b.k AS key, word, ipa, origin, merged, sources, definitions FROM b JOIN m ON b.k = m.k"
)
def word_layer(s, d):
    w = layers.words(_entries(s, d))
    return w.select("key", "word", "ipa", "origin", "merged", n(F.size("sources")).alias("sources"), n(F.size("definitions")).alias("definitions"))


@query(
    f"WITH {M.PRON_SQL}, g AS (SELECT {_GAP} AS gap FROM pron WHERE dialect IS NULL) SELECT CASE gap WHEN 'unrecognized_explicit_tag' THEN 'manual_label_review' WHEN 'recognized_geographic_label_with_qualifier' THEN 'manual_label_parsing_review' "
    "WHEN 'non_geographic_note_qualifier' THEN 'not_a_dialect_label' WHEN 'unrecognized_explicit_note' THEN 'manual_label_review' ELSE 'source_metadata_unavailable' END AS route, count(*) AS n FROM g GROUP BY 1"
)
def gap_routes(s, d):
    p = M.pronunciations(s, d).where(F.col("dialect").isNull())
    gap = pronunciation.gap_reason(F.col("tags"), F.col("note"), ["Hà Nội", "Sài Gòn"], "^rare")
    return p.groupBy(pronunciation.route(gap).alias("route")).agg(F.count("*").alias("n"))


@query(
    f"WITH {M.PRON_SQL}, h AS (SELECT headword, count(*) AS facts, count(*) FILTER (dialect IS NULL) AS w, count(DISTINCT ipa) AS r FROM pron GROUP BY headword HAVING count(DISTINCT ipa) >= 2) SELECT count(*) AS headwords, sum(facts)::BIGINT AS facts, sum(w)::BIGINT AS without_dialect FROM h"
)
def conflict_totals(s, d):
    return pronunciation.rollup(pronunciation.conflicts(M.pronunciations(s, d))).where(F.col("bucket").isNull()).drop("bucket")

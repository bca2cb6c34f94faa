"""Queries of reviews and gates: tasks, decisions, invariants, reconciliations, coverage."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import checks, layers, merge, pronunciation, review, search, senses
from ..sources import readers
from . import mapping as M
from .queries import _INDEX, _TIER, _TONES, _VARIANTS, _index, _spelt, n, query

# --- pronunciation reviews -------------------------------------------------------------------------

_GAP = (
    "CASE WHEN tagged THEN 'unrecognized_explicit_tag' WHEN coalesce(note, '') = '' THEN 'no_explicit_source_label' WHEN starts_with(note, 'Hà Nội,') THEN 'recognized_geographic_label_with_qualifier' "
    "WHEN starts_with(note, 'rare') THEN 'non_geographic_note_qualifier' ELSE 'unrecognized_explicit_note' END"
)
_ROUTE = "CASE gap WHEN 'unrecognized_explicit_tag' THEN 'manual_label_review' WHEN 'recognized_geographic_label_with_qualifier' THEN 'manual_label_parsing_review' WHEN 'non_geographic_note_qualifier' THEN 'not_a_dialect_label' WHEN 'unrecognized_explicit_note' THEN 'manual_label_review' ELSE 'source_metadata_unavailable' END"

_OPEN = f"""{M.PRON_SQL}, p AS (SELECT * REPLACE (coalesce(dialect, '') AS dialect), shown AS v FROM pron),
rec AS (SELECT headword, source, dialect, record, count(DISTINCT shown) AS k FROM p GROUP BY ALL),
grp AS (SELECT headword, source, dialect, count(DISTINCT shown) AS k FROM p GROUP BY ALL),
r2 AS (SELECT headword, source, dialect, count(*) AS records, count(*) FILTER (k > 1) AS mixed FROM rec GROUP BY ALL),
src AS (SELECT headword, count(*) FILTER (k > 1) AS varied, count(*) FILTER (k > 1 AND NOT (records = 1 AND mixed = 1)) = 0 AS attested FROM grp JOIN r2 USING (headword, source, dialect) GROUP BY headword),
hd AS (SELECT headword, count(DISTINCT ipa) AS raws, count(DISTINCT shown) AS shows, count(DISTINCT word) AS words FROM p GROUP BY headword),
open_ AS (SELECT headword, words FROM hd JOIN src USING (headword) WHERE raws >= 2 AND shows > 1 AND varied > 0 AND NOT (words = 1 AND attested)),
inn AS (SELECT p.* FROM p JOIN grp USING (headword, source, dialect) JOIN open_ USING (headword) WHERE grp.k > 1),
ig AS (SELECT headword, source, dialect, count(DISTINCT record) AS records FROM inn GROUP BY ALL),
im AS (SELECT headword, bool_or(k > 1) AS mixed FROM (SELECT headword, source, dialect, record, count(DISTINCT shown) AS k FROM inn GROUP BY ALL) GROUP BY headword),
iv AS (SELECT headword, bool_or(records > 1) AS several FROM ig GROUP BY headword),
ip AS (SELECT headword, count(DISTINCT pos) AS pos FROM inn GROUP BY headword),
ie AS (SELECT headword, bool_or(k > 1) AS reused FROM (SELECT headword, entry_id, count(DISTINCT record) AS k FROM inn GROUP BY ALL) GROUP BY headword),
un AS (SELECT headword, words, list_filter([CASE WHEN words > 1 THEN 'case_or_form_variant_present' END, CASE WHEN several THEN 'multiple_raw_records_same_source_dialect' END, CASE WHEN mixed THEN 'same_raw_record_multiple_ipa_same_source_dialect' END], lambda x: x IS NOT NULL) AS r0,
  list_filter([CASE WHEN pos > 1 THEN 'cross_pos_scope' END, CASE WHEN words > 1 THEN 'normalized_form_collision' END], lambda x: x IS NOT NULL) AS s0, several, reused FROM open_ JOIN im USING (headword) JOIN iv USING (headword) JOIN ip USING (headword) JOIN ie USING (headword)),
unresolved AS (SELECT headword, words, CASE WHEN len(r0) = 0 THEN ['source_dialect_internal_variant'] ELSE r0 END AS reasons,
  CASE WHEN len(s0) > 0 THEN s0 WHEN several THEN [CASE WHEN reused THEN 'source_entry_id_reused_across_raw_records' ELSE 'same_form_same_pos_distinct_source_records' END] ELSE [] END AS scopes FROM un),
routed AS (SELECT *, CASE WHEN list_contains(scopes, 'source_entry_id_reused_across_raw_records') THEN 'parser_fix' ELSE 'human_review' END AS route FROM unresolved),
gaps AS (SELECT *, {_ROUTE} AS groute FROM (SELECT event_id, headword, note, {_GAP} AS gap FROM pron WHERE dialect IS NULL)),
tasks AS (
  SELECT 'review-conflict-' || headword AS task_id, 'pronunciation_conflict_review' AS task_type, 0 AS task_order, headword::VARCHAR AS headword, reasons, scopes, route, NULL AS gap, NULL AS note FROM routed
  UNION ALL SELECT 'review-dialect-label-' || headword || '-' || left(sha1(event_id || ':' || groute || ':' || coalesce(note, '')), 8), 'dialect_label_review', 1, headword::VARCHAR, NULL, NULL, groute, gap, note FROM gaps WHERE groute IN ('manual_label_parsing_review', 'manual_label_review')),
decided AS (SELECT *, CASE WHEN task_order = 0 THEN CASE WHEN list_contains(scopes, 'source_entry_id_reused_across_raw_records') THEN 'requires_parser_followup' WHEN list_has_any(scopes, ['normalized_form_collision', 'cross_pos_scope']) THEN 'split_by_source_entry_or_pos' ELSE 'insufficient_evidence' END
    WHEN gap = 'recognized_geographic_label_with_qualifier' AND contains(note, ';') THEN 'split_label_and_qualifier' ELSE 'insufficient_evidence' END AS decision,
  CASE WHEN task_order = 0 THEN CASE WHEN list_contains(scopes, 'source_entry_id_reused_across_raw_records') THEN 'high' WHEN list_has_any(scopes, ['normalized_form_collision', 'cross_pos_scope']) THEN 'medium' ELSE 'low' END ELSE 'low' END AS confidence,
  CASE WHEN task_order = 0 THEN CASE WHEN NOT list_has_any(scopes, ['source_entry_id_reused_across_raw_records', 'normalized_form_collision', 'cross_pos_scope']) AND list_contains(reasons, 'same_raw_record_multiple_ipa_same_source_dialect') THEN 'medium' ELSE 'high' END
    WHEN gap = 'unrecognized_explicit_note' THEN 'medium' ELSE 'high' END AS priority FROM tasks)"""


def _gaps(s: SparkSession, d: str) -> DataFrame:
    p = M.pronunciations(s, d).where(F.col("dialect").isNull())
    gap = pronunciation.gap_reason(F.col("tags"), F.col("note"), ["Hà Nội", "Sài Gòn"], "^rare")
    return p.select("headword", F.col("event_id").alias("fact"), "note", gap.alias("gap")).withColumn("route", pronunciation.route(F.col("gap")))


def _tasks(s: SparkSession, d: str) -> DataFrame:
    return review.conflict_tasks(pronunciation.unresolved(M.pronunciations(s, d))).unionByName(review.dialect_tasks(_gaps(s, d)))


@query(f"WITH {_OPEN} SELECT headword, words, array_to_string(reasons, ',') AS reasons, array_to_string(scopes, ',') AS scopes, route FROM routed")
def unresolved_analysis(s, d):
    u = pronunciation.unresolved(M.pronunciations(s, d))
    return u.select("headword", "words", F.array_join("reasons", ",").alias("reasons"), F.array_join("scopes", ",").alias("scopes"), "route")


@query(f"WITH {_OPEN} SELECT task_id, task_type, headword, row_number() OVER (ORDER BY task_order, headword COLLATE vi, task_id)::INT AS place FROM tasks")
def review_tasks(s, d):
    t = layers.numbered(_tasks(s, d), [F.col("task_order"), F.collate("headword", "vi"), F.col("task_id")], "place")
    return t.select("task_id", "task_type", "headword", F.col("place").cast("int").alias("place"))


@query(f"WITH {_OPEN} SELECT task_id, 'review-' || left(sha1(task_id || ':' || decision || ':review-v1'), 8) AS review_id, decision, confidence, priority FROM decided")
def review_decisions(s, d):
    return review.decided(_tasks(s, d)).select("task_id", "review_id", "decision", "confidence", "priority")


@query(f"WITH {_OPEN}, l AS (SELECT unnest(['decision', 'confidence', 'priority']) AS counter, unnest([decision, confidence, priority]) AS value FROM decided) SELECT counter, value, count(*) AS n FROM l GROUP BY ALL")
def decision_counters(s, d):
    return review.counters(review.decided(_tasks(s, d)))


@query(
    f"WITH {_OPEN}, x AS (SELECT *, left(sha1(task_id || ':' || decision || ':review-v1'), 8) AS h FROM decided) SELECT 'accepted-proxy-' || h AS review_id, 'proxy-' || h AS proxy_review_id, task_id, decision, 'human-reviewed' AS review_status, "
    "'ai_owner_authorized_by_project_owner' AS reviewer_type, CASE decision WHEN 'split_by_source_entry_or_pos' THEN 'do_not_project_scalar_ipa' WHEN 'insufficient_evidence' THEN 'leave_projection_unchanged' WHEN 'split_label_and_qualifier' THEN 'record_label_split_candidate_without_scalar_promotion' ELSE 'none' END AS action, false AS scalar_allowed, false AS eligible FROM x"
)
def accepted_reviews(s, d):
    p = review.proxies(review.decided(_tasks(s, d)))
    a = review.projected(review.accepted(p, "owner", "2026-01-01"))
    return a.join(p.select("proxy_review_id", "task_id", F.col("import_eligible").alias("eligible")), ["proxy_review_id", "task_id"]).select("review_id", "proxy_review_id", "task_id", "decision", "review_status", "reviewer_type", "action", "scalar_allowed", "eligible")


_REVIEWED = "reviewed AS (SELECT task_id, CASE WHEN length(task_id) % 3 = 0 THEN 'other' ELSE decision END AS decision FROM decided), proposed AS (SELECT task_id, decision FROM decided WHERE length(task_id) % 5 <> 0)"


def _reviewed(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = review.decided(_tasks(s, d)).select("task_id", "task_type", "decision")
    size = F.length("task_id")
    return x.withColumn("decision", F.when(size % 3 == 0, "other").otherwise(F.col("decision"))), x.where(size % 5 != 0)


@query(f"WITH {_OPEN}, {_REVIEWED} SELECT r.task_id, coalesce(p.decision, 'missing') AS proposed, r.decision FROM reviewed r LEFT JOIN proposed p ON p.task_id = r.task_id WHERE coalesce(p.decision, 'missing') <> r.decision")
def review_disagreements(s, d):
    return review.disagreements(*_reviewed(s, d))


@query(f"WITH {_OPEN}, {_REVIEWED} SELECT r.decision, count(*) AS total, count(*) FILTER (p.decision = r.decision) AS agree, count(*) FILTER (p.decision IS NULL) AS missing, round(count(*) FILTER (p.decision = r.decision)::DOUBLE / count(*), 4) AS rate FROM reviewed r LEFT JOIN proposed p ON p.task_id = r.task_id GROUP BY r.decision")
def review_agreement(s, d):
    return review.agreement(*_reviewed(s, d))


@query(
    f"WITH {_OPEN}, {_REVIEWED} SELECT 'no task' AS rule, count(*) FILTER (length(task_id) % 4 = 0) AS n FROM reviewed UNION ALL SELECT 'other type', 0 UNION ALL SELECT 'not allowed', count(*) FILTER (length(task_id) % 4 <> 0 AND length(task_id) % 3 = 0) FROM reviewed "
    "UNION ALL SELECT 'decided twice', count(*) FILTER (k > 1) FROM (SELECT task_id, count(*) AS k FROM reviewed GROUP BY task_id)"
)
def review_invariants(s, d):
    reviewed, _ = _reviewed(s, d)
    return review.invariants(reviewed, _tasks(s, d).where(F.length("task_id") % 4 != 0))


@query(f"WITH {M.PRON_SQL} SELECT source, 'normalized-scalar-no-explicit-dialect' AS method, dialect, count(*) AS n, CASE WHEN dialect IS NULL THEN 'no explicit dialect in tags or note' END AS reason FROM pron GROUP BY source, dialect")
def dialect_histogram(s, d):
    return pronunciation.dialect_histogram(M.pronunciations(s, d))


# --- invariants ------------------------------------------------------------------------------------


@query(
    "WITH p AS (SELECT *, p_partkey % 20 AS k FROM part) SELECT count(*) AS rows, count(*) FILTER (k IN (0, 1, 2)) AS invalid, count(*) - count(DISTINCT CASE WHEN k = 3 THEN 'same' WHEN k <> 0 THEN 'g' || p_partkey END) AS duplicates, false AS passed FROM p "
    "UNION ALL SELECT count(*), 0, 0, count(*) >= 100 FROM part"
)
def gold_gate(s, d):
    k = F.col("p_partkey") % 20
    p = M.table(s, d, "part")
    label = F.when(F.col("p_size") % 2 == 0, "same_sense").otherwise("unclear")
    good = p.select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("word"), label.alias("label"), F.col("p_type").alias("left_meaning"), F.col("p_brand").alias("right_meaning"), k.alias("k"))
    bad = good.withColumn("id", F.when(F.col("k") == 3, "same").when(F.col("k") != 0, F.col("id"))).withColumn("label", F.when(F.col("k") == 1, "maybe").otherwise(F.col("label"))).withColumn("right_meaning", F.when(F.col("k") == 2, "").otherwise(F.col("right_meaning")))
    return checks.gold(bad).unionByName(checks.gold(good, 100))


@query(
    f"WITH {M.CLUSTERS_SQL}, c AS (SELECT status AS name, count(*) AS n FROM clusters GROUP BY status), m AS (SELECT name, n + CASE WHEN name = 'needs_review' THEN 1 ELSE 0 END AS claimed, n AS counted FROM c), "
    "x AS (SELECT * FROM m UNION ALL SELECT 'definitions', (SELECT count(*) FROM facts), (SELECT sum(member_count) FROM clusters)::BIGINT UNION ALL SELECT 'lost', 7, NULL) SELECT name, claimed, counted FROM x WHERE claimed IS DISTINCT FROM counted"
)
def count_reconciliation(s, d):
    """Figures that a report claims against those that its rows give; one is changed, one has no rows."""
    rows, members = M.members(s, d)
    c = senses.clusters(members).groupBy("status").agg(F.count("*").alias("n"), F.sum("member_count").alias("member_count")).persist()  # a row for each status
    counted = c.select(F.col("status").alias("name"), "n")
    claimed = counted.withColumn("n", F.col("n") + F.when(F.col("name") == "needs_review", 1).otherwise(0))
    total = rows.agg(F.count("*").alias("n")).select(F.lit("definitions").alias("name"), "n")
    lost = total.select(F.lit("lost").alias("name"), F.lit(7).cast("long").alias("n"))
    kept = c.agg(F.sum("member_count").alias("n")).select(F.lit("definitions").alias("name"), "n")
    return checks.reconcile(claimed.unionByName(total).unionByName(lost), counted.unionByName(kept))


_BROKEN = f"""cl AS (SELECT cluster_id, cluster_type, CASE WHEN member_count = 2 AND has_vi THEN 'reference_non_vi' WHEN word LIKE 'en:a%' THEN 'auto_accepted' ELSE status END AS status, {_TIER} AS tier, has_vi, CASE WHEN word LIKE 'en:b%' THEN 'none' ELSE sense_id END AS sense_id FROM clusters),
cl2 AS (SELECT * FROM cl UNION ALL SELECT * FROM cl WHERE cluster_type = 'exact')"""


@query(
    f"WITH {M.CLUSTERS_SQL}, {_BROKEN} SELECT 'duplicate cluster id' AS rule, (SELECT count(*) FROM (SELECT 1 FROM cl2 GROUP BY cluster_id HAVING count(*) > 1)) AS n "
    "UNION ALL SELECT 'canonical is no member', (SELECT count(*) FROM cl2 WHERE sense_id NOT IN (SELECT sense_id FROM members)) UNION ALL SELECT 'duplicate sense id', (SELECT count(*) FROM (SELECT 1 FROM members GROUP BY sense_id HAVING count(*) > 1)) "
    "UNION ALL SELECT 'auto_accepted, but not exact and high', (SELECT count(*) FROM cl2 WHERE status = 'auto_accepted' AND (cluster_type <> 'exact' OR tier <> 'high')) UNION ALL SELECT 'reference_non_vi with a native definition', (SELECT count(*) FROM cl2 WHERE status = 'reference_non_vi' AND has_vi)"
)
def cluster_invariants(s, d):
    """Clusters of which some are broken on purpose."""
    _, members = M.members(s, d, "word")
    c = senses.clusters(members).select("cluster_id", "cluster_type", "status", "tier", "has_vi", F.col("canonical.sense_id").alias("sense_id"), "member_count", "word")
    c = c.withColumn("status", F.when((F.col("member_count") == 2) & F.col("has_vi"), "reference_non_vi").when(F.startswith("word", F.lit("en:a")), "auto_accepted").otherwise(F.col("status")))
    c = c.withColumn("sense_id", F.when(F.startswith("word", F.lit("en:b")), "none").otherwise(F.col("sense_id"))).drop("member_count", "word").persist(StorageLevel.MEMORY_AND_DISK)
    return checks.cluster_invariants(c.unionByName(c.where("cluster_type = 'exact'")), members.select("cluster_id", "sense_id"))


@query(
    f"WITH {M.CLUSTERS_SQL}, e AS (SELECT m.sense_id, c.cluster_id, CASE WHEN c.status = 'entity_or_encyclopedic' THEN 'cluster' WHEN m.hard_risk THEN 'member' END AS scope, CASE WHEN m.source = 'src1' THEN 'other' ELSE c.status END AS status, CASE WHEN m.source = 'src2' THEN [] ELSE m.risk_tags END AS risk_tags FROM members m JOIN clusters c USING (cluster_id)), "
    "x AS (SELECT * FROM e WHERE scope IS NOT NULL), k AS (SELECT cluster_id, status AS s2 FROM clusters WHERE word NOT LIKE 'fr:%') "
    f"SELECT 'no parent' AS rule, (SELECT count(*) FROM x WHERE cluster_id NOT IN (SELECT cluster_id FROM k)) AS n UNION ALL SELECT 'other status', (SELECT count(*) FROM x JOIN k USING (cluster_id) WHERE status <> s2 OR (scope = 'cluster') <> (s2 = 'entity_or_encyclopedic')) "
    f"UNION ALL SELECT 'duplicate definition', (SELECT count(*) FROM (SELECT 1 FROM x GROUP BY sense_id HAVING count(*) > 1)) UNION ALL SELECT 'member without a risk', (SELECT count(*) FROM x WHERE scope = 'member' AND NOT list_has_any(risk_tags, {M._ENTITY}))"
)
def entity_invariants(s, d):
    risks = F.filter("risk_tags", lambda t: t.isin(*senses.ENTITY_RISKS))  # others aren't asked for
    _, members = M.members(s, d, "word", risks.alias("risk_tags"))
    e = senses.entity_layer(members).select("sense_id", "cluster_id", "scope", F.when(F.col("source") == "src1", "other").otherwise(F.col("status")).alias("status"), F.when(F.col("source") == "src2", F.array().cast("array<string>")).otherwise(F.col("risk_tags")).alias("risk_tags")).persist(StorageLevel.MEMORY_AND_DISK)
    known = senses.clusters(members).where(~F.startswith("word", F.lit("fr:"))).select("cluster_id", "status")
    return checks.entity_invariants(e, known, senses.ENTITY_RISKS)


@query(
    f"WITH {M.PRON_SQL}, x AS (SELECT event_id, 'pronunciation-' || word || '-' || left(sha1(CASE WHEN event_id % 30 = 0 THEN 'same' ELSE event_id::VARCHAR END), CASE WHEN event_id % 45 = 1 THEN 7 ELSE 8 END) AS pid, CASE WHEN event_id % 50 = 2 THEN '' ELSE ipa END AS ipa, dialect, note, CASE WHEN event_id % 60 = 3 THEN 'x' ELSE sha256(record) END AS h FROM pron) "
    "SELECT 'duplicate id' AS rule, (SELECT count(*) FROM (SELECT 1 FROM x GROUP BY pid HAVING count(*) > 1)) AS n UNION ALL SELECT 'form of the id', (SELECT count(*) FROM x WHERE event_id % 45 = 1) UNION ALL SELECT 'empty transcription', (SELECT count(*) FROM x WHERE ipa = '') "
    "UNION ALL SELECT 'form of the hash', (SELECT count(*) FROM x WHERE h = 'x') UNION ALL SELECT 'dialect that nothing says', (SELECT count(*) FROM x WHERE dialect IS NOT NULL AND NOT (dialect = 'Hà Nội' AND event_id % 2 = 0))"
)
def pronunciation_invariants(s, d):
    e = F.col("event_id")
    seed = F.when(e % 30 == 0, "same").otherwise(e.cast("string"))
    short = F.when(e % 45 == 1, F.substring(F.sha1(seed), 1, 7)).otherwise(F.substring(F.sha1(seed), 1, 8))
    x = M.pronunciations(s, d).select(
        F.concat(F.lit("pronunciation-"), "word", F.lit("-"), short).alias("pronunciation_id"), "word", F.when(e % 50 == 2, "").otherwise(F.col("ipa")).alias("ipa"), "dialect",
        F.when(e % 2 == 0, F.array(F.lit("Hà Nội"))).otherwise(F.array(F.lit("y"))).alias("tags"), "note", F.when(e % 60 == 3, "x").otherwise(F.sha2("record", 256)).alias("record_hash"), F.lit(0.8).alias("confidence"),
    )
    return checks.pronunciation_invariants(x, ("Hà Nội",))


@query(
    f"WITH {M.FACTS_SQL}, t AS (SELECT entry_id || ':' || definition_index AS id, source, CASE WHEN entry_id % 50 = 0 THEN 'elsewhere' ELSE source END AS source_id, CASE WHEN entry_id % 30 = 0 THEN 'x' ELSE record_hash END AS h FROM facts), u AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE source = 'src4') "
    "SELECT 'facts' AS layer, 'inactive source' AS rule, (SELECT count(*) FROM u WHERE source_id IN ('elsewhere', 'src7')) AS n UNION ALL SELECT 'facts', 'other source', (SELECT count(*) FROM u WHERE source <> source_id) "
    "UNION ALL SELECT 'facts', 'form of the hash', (SELECT count(*) FROM u WHERE h = 'x') UNION ALL SELECT 'facts', 'duplicate id', (SELECT count(*) FROM (SELECT 1 FROM u GROUP BY id HAVING count(*) > 1))"
)
def provenance_invariants(s, d):
    f = M.facts(s, d)
    k = F.col("entry_id")
    t = f.select(F.concat_ws(":", k.cast("string"), "definition_index").alias("id"), "source", F.when(k % 50 == 0, "elsewhere").otherwise(F.col("source")).alias("source_id"), F.when(k % 30 == 0, "x").otherwise(F.col("record_hash")).alias("raw_record_hash"))
    active = f.select(F.col("source").alias("key")).distinct().where("key <> 'src7'")
    return checks.provenance("facts", t.unionByName(t.where("source = 'src4'")), active)


@query(
    "SELECT 'words' AS layer, * FROM (VALUES ('id: minLength', (SELECT count(*) FILTER (p_partkey % 9 = 0) FROM part)), ('word: minLength', 0), ('language: enum', (SELECT count(*) FILTER (p_partkey % 7 = 0) FROM part)), ('syllable_count: minimum', (SELECT count(*) FILTER (p_size % 5 = 0) FROM part)), ('sources: minItems', 0), ('definitions: minItems', (SELECT count(*) FILTER (p_size % 3 = 0) FROM part))) t(rule, n) "
    "UNION ALL SELECT 'han_characters', * FROM (VALUES ('id: pattern', (SELECT count(*) FILTER (p_partkey % 9 = 0) FROM part)), ('character: minLength', 0), ('total_stroke_count: minimum', (SELECT count(*) FILTER (p_size % 5 = 0) FROM part))) t(rule, n) "
    "UNION ALL SELECT 'lexemes', * FROM (VALUES ('id: minLength', (SELECT count(*) FILTER (p_partkey % 9 = 0) FROM part)), ('headword: minLength', 0), ('language: enum', (SELECT count(*) FILTER (p_partkey % 7 = 0) FROM part)), ('evidence: minItems', (SELECT count(*) FILTER (p_size % 3 = 0) FROM part))) t(rule, n) "
    "UNION ALL SELECT 'nom', * FROM (VALUES ('id: minLength', (SELECT count(*) FILTER (p_partkey % 9 = 0) FROM part)), ('quoc_ngu: minLength', 0), ('characters: minLength', 0), ('frequency: minimum', (SELECT count(*) FILTER (p_size % 5 = 0) FROM part))) t(rule, n) "
    "UNION ALL SELECT 'semantics', * FROM (VALUES ('synset_id: pattern', (SELECT count(*) FILTER (p_partkey % 9 = 0) FROM part)), ('lemmas: minItems', (SELECT count(*) FILTER (p_size % 3 = 0) FROM part))) t(rule, n) "
    "UNION ALL SELECT 'variants', * FROM (VALUES ('key: minLength', 0), ('forms: minItems', (SELECT count(*) FROM part))) t(rule, n) "
    "UNION ALL SELECT 'evidence', * FROM (VALUES ('id: pattern', (SELECT count(*) FROM part)), ('text: minLength', 0)) t(rule, n)"
)
def schema_errors(s, d):
    """Records of all seven layers, of which some break a rule."""
    k, size = F.col("p_partkey"), F.col("p_size")
    some = F.when(size % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("p_name"))
    rows = M.table(s, d, "part").select(
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.lit("u+4E00")).alias("id"), F.col("p_name").alias("word"), F.when(k % 7 == 0, "en").otherwise("vi").alias("language"), F.when(size % 5 == 0, 0).otherwise(1).alias("syllable_count"),
        F.array("p_brand").alias("sources"), some.alias("definitions"), F.col("p_name").alias("character"), F.when(size % 5 == 0, -1).when(size % 5 == 1, 3).cast("int").alias("total_stroke_count"), F.col("p_name").alias("headword"), some.alias("evidence"),
        F.col("p_name").alias("quoc_ngu"), F.col("p_name").alias("characters"), F.when(size % 5 == 0, -1).when(size % 5 == 1, 3).cast("int").alias("frequency"), F.when(k % 9 == 0, "1-n").otherwise("00000001-n").alias("synset_id"), some.alias("lemmas"),
        F.col("p_brand").alias("key"), F.array("p_name").alias("forms"), F.col("p_name").alias("text"),
    )
    out = None
    for layer in checks.SCHEMAS:
        got = checks.schema_errors(rows, layer).select("layer", "rule", n("n").alias("n"))
        out = got if out is None else out.unionByName(got)
    return out


@query(f"WITH {M.FACTS_SQL} SELECT word, sum(k - 1)::BIGINT AS n FROM (SELECT word, source, lower(meaning) AS m, count(*) AS k FROM facts GROUP BY ALL) GROUP BY word HAVING sum(k - 1) > 0")
def repeated_definitions(s, d):
    return checks.repeated_definitions(M.facts(s, d))


@query(
    f"WITH {_VARIANTS}, g AS (SELECT key, list_sort(list(headword)) AS forms FROM k GROUP BY key), x AS (SELECT key, CASE WHEN length(key) % 3 = 0 THEN list_append(forms, 'khác') ELSE forms END AS forms FROM g WHERE len(forms) > 1), "
    f"y AS (SELECT key, forms, len(list_distinct(list_transform(forms, lambda f: {M.sql_tone('f')}))) AS bases, len(list_distinct(list_transform(forms, lambda f: array_to_string(list_filter(list_transform(string_split(f, ''), lambda c: CASE {_TONES} END), lambda t: t IS NOT NULL), '-')))) AS tones FROM x) "
    "SELECT key, len(forms)::INT AS n FROM y WHERE bases <> 1 OR tones <> 1"
)
def variant_faults(s, d):
    g = readers.variants(_spelt(s, d))
    broken = g.withColumn("forms", F.when(F.length("key") % 3 == 0, F.concat("forms", F.array(F.lit("khác")))).otherwise(F.col("forms")))
    return checks.variant_faults(broken).select("key", F.size("forms").alias("n"))


@query(
    f"WITH {M.FACTS_SQL}, c AS (SELECT source, 'definitions' AS layer FROM facts UNION ALL SELECT DISTINCT ON (source, word) source, 'words' FROM facts UNION ALL SELECT source, 'etymologies' FROM facts WHERE definition_index % 2 = 0 UNION ALL SELECT source, 'lexemes' FROM facts WHERE entry_id % 4 <> 0 "
    "UNION ALL SELECT source, 'evidence' FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'src' || p_size % 20, 'characters' FROM part UNION ALL SELECT 'src' || p_size % 20, 'nom' FROM part WHERE p_size > 20) "
    "SELECT source, layer, count(*) AS n FROM c GROUP BY source, layer UNION ALL SELECT source, NULL, count(*) FROM c GROUP BY source"
)
def source_contributions(s, d):
    f = M.facts(s, d)
    part = M.table(s, d, "part").withColumn("source", F.concat(F.lit("src"), (F.col("p_size") % 20).cast("string")))
    return checks.contributions(
        {
            "definitions": f,
            "words": f.select("source", "word").distinct(),
            "etymologies": f.where("definition_index % 2 = 0"),
            "lexemes": f.where("entry_id % 4 <> 0"),
            "evidence": M.table(s, d, "documents").where("text IS NOT NULL"),
            "characters": part,
            "nom": part.where("p_size > 20"),
        }
    )


@query(f"WITH {M.CLUSTERS_SQL}, rest AS (SELECT * FROM facts WHERE source <> 'src3') SELECT (SELECT count(*) FROM facts WHERE source = 'src3') AS removed, 0::BIGINT AS left_over, (SELECT count(*) FROM (SELECT 1 FROM rest GROUP BY word, key HAVING count(*) > 1 AND count(DISTINCT source) > 1)) AS clusters, true AS restored")
def source_removal(s, d):
    """A source is disabled, the build has nothing of it, and with the source again it is as it was."""
    rows, members = M.members(s, d)
    rest, own = rows.where("source <> 'src3'"), rows.where("source = 'src3'")
    build = lambda x: senses.clusters(x).select("cluster_id", "status", "member_count", "source_count")
    restored = checks.same_rows(build(members), build(senses.clustered(rest.unionByName(own))))
    exact = senses.clusters(senses.clustered(rest)).agg(F.count_if(F.col("cluster_type") == "exact").alias("clusters"), F.count_if(F.col("canonical.source") == "src3").alias("left_over"))
    return own.agg(F.count("*").alias("removed")).crossJoin(exact).select("removed", "left_over", "clusters", F.lit(restored).alias("restored"))


@query(
    f"WITH {M.FACTS_SQL}, w AS (SELECT word, bool_or(language = 'vi') AS vi, bool_or(language = 'en') AS en, bool_or(trusted) AS ipa, bool_or(len(pos) > 0) AS pos, bool_or(len(labels) > 0) AS labels, count(DISTINCT source) > 1 AS multi, bool_or(definition_index % 2 = 0) AS etymology FROM facts GROUP BY word), "
    "h AS (SELECT count(*) AS headwords, count(*) FILTER (vi) AS with_vi, count(*) FILTER (en) AS with_en, count(*) FILTER (ipa) AS with_ipa, count(*) FILTER (pos) AS with_pos, count(*) FILTER (etymology) AS with_etymology, count(*) FILTER (labels) AS with_labels, count(*) FILTER (multi) AS multi_source FROM w), "
    "d AS (SELECT count(*) AS definitions, count(DISTINCT language) AS languages, count(DISTINCT source) AS sources FROM facts), "
    "c AS (SELECT count(DISTINCT p_size) AS radicals, round(count(DISTINCT p_size) * 100.0::DOUBLE / 214, 2) AS radical_percent, count(*) FILTER (p_size > 20) AS with_definition, count(*) FILTER (p_size > 30) AS with_frequency, count(*) FILTER (p_partkey % 4 = 1) AS supplementary FROM part) "
    "SELECT * FROM (UNPIVOT (SELECT headwords::DOUBLE AS headwords, with_vi::DOUBLE AS with_vi, with_en::DOUBLE AS with_en, with_ipa::DOUBLE AS with_ipa, with_pos::DOUBLE AS with_pos, with_etymology::DOUBLE AS with_etymology, with_labels::DOUBLE AS with_labels, multi_source::DOUBLE AS multi_source, definitions::DOUBLE AS definitions, "
    "languages::DOUBLE AS languages, sources::DOUBLE AS sources, radicals::DOUBLE AS radicals, radical_percent, with_definition::DOUBLE AS with_definition, with_frequency::DOUBLE AS with_frequency, supplementary::DOUBLE AS supplementary FROM h, d, c) ON COLUMNS(*) INTO NAME measure VALUE value)"
)
def layer_coverage(s, d):
    """Sixteen measures of words, definitions and characters, each from one pass of conditional counts."""
    f = M.facts(s, d)
    has = lambda c, name: F.bool_or(c).alias(name)
    words = f.groupBy("word").agg(
        has(F.col("language") == "vi", "vi"), has(F.col("language") == "en", "en"), has(F.col("trusted"), "ipa"), has(F.size("part_of_speech") > 0, "pos"), has(F.col("definition_index") % 2 == 0, "etymology"), has(F.size("labels") > 0, "labels"),
        (F.count_distinct("source") > 1).alias("multi"),
    )
    flags = {"vi": "with_vi", "en": "with_en", "ipa": "with_ipa", "pos": "with_pos", "etymology": "with_etymology", "labels": "with_labels", "multi": "multi_source"}
    a = words.agg(F.count("*").alias("headwords"), *[F.count_if(c).alias(name) for c, name in flags.items()])
    b = f.agg(F.count("*").alias("definitions"), F.count_distinct("language").alias("languages"), F.count_distinct("source").alias("sources"))
    radicals = F.count_distinct("p_size")
    c = M.table(s, d, "part").agg(
        radicals.alias("radicals"), F.round(radicals * 100.0 / 214, 2).alias("radical_percent"), F.count_if(F.col("p_size") > 20).alias("with_definition"), F.count_if(F.col("p_size") > 30).alias("with_frequency"), F.count_if(F.col("p_partkey") % 4 == 1).alias("supplementary"),
    )
    long = lambda x: x.select(*[F.col(k).cast("double").alias(k) for k in x.columns]).unpivot([], x.columns, "measure", "value")
    return long(a).unionByName(long(b)).unionByName(long(c))


@query(
    f"WITH {M.FACTS_SQL} SELECT 4::BIGINT AS checks, (CASE WHEN (SELECT count(*) FROM facts) <> (SELECT count(*) FROM facts WHERE word <> '') THEN 1 ELSE 0 END + CASE WHEN (SELECT count(*) - count(DISTINCT definition_uid || sense_id) FROM facts) <> 0 THEN 1 ELSE 0 END + CASE WHEN (SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY word, source, lower(meaning) HAVING count(*) > 1)) <> 0 THEN 1 ELSE 0 END)::BIGINT AS failed, "
    "(SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY word, source, lower(meaning) HAVING count(*) > 1)) = 0 AND (SELECT count(*) - count(DISTINCT definition_uid || sense_id) FROM facts) = 0 AS passed"
)
def hard_checks(s, d):
    """The gate of a build: figures that have to be 0."""
    f = M.facts(s, d)
    figure = lambda name, df: df.agg(F.count("*").cast("long").alias("n")).select(F.lit(name).alias("name"), "n")
    ids = f.agg((F.count("*") - F.count_distinct(F.concat("definition_uid", "sense_id"))).alias("n")).select(F.lit("duplicate ids").alias("name"), "n")
    rows = figure("empty headwords", f.where("word = ''")).unionByName(ids).unionByName(figure("repeated definitions", checks.repeated_definitions(f))).unionByName(figure("other hashes", f.where(~F.col("record_hash").rlike("^[a-f0-9]{64}$"))))
    return checks.passed(rows)


@query("SELECT sha256(array_to_string(list(layer || ':' || id ORDER BY layer || ':' || id), chr(10))) AS digest, count(*) AS n FROM (SELECT 'part' AS layer, p_partkey::VARCHAR AS id FROM part UNION ALL SELECT 'nation', n_nationkey::VARCHAR FROM nation)")
def sorted_digest(s, d):
    """The digest of all ids in order, the same whatever the order and the partitions of the rows."""
    ids = M.table(s, d, "part").select(F.lit("part").alias("layer"), F.col("p_partkey").cast("string").alias("id")).unionByName(M.table(s, d, "nation").select(F.lit("nation").alias("layer"), F.col("n_nationkey").cast("string").alias("id")))
    digests = {merge.line_digest(ids), merge.line_digest(ids.repartition(7))}
    return ids.agg(F.count("*").alias("n")).select(F.lit(",".join(sorted(digests))).alias("digest"), "n")


@query(
    f"WITH {M.FACTS_SQL}, e AS (SELECT * FROM facts WHERE definition_index % 2 = 0) SELECT 'etymology source' AS rollup, source AS value, count(*) AS n, count(*) FILTER (entry_id % 30 = 0) AS invalid FROM e GROUP BY source UNION ALL SELECT 'etymology language', language, count(*), count(*) FILTER (entry_id % 30 = 0) FROM e GROUP BY language "
    "UNION ALL SELECT 'origin', CASE language WHEN 'vi' THEN 'thuần Việt' WHEN 'de' THEN 'Hán Việt' ELSE 'không rõ' END, count(*), 0 FROM facts GROUP BY 2 UNION ALL SELECT 'relation', CASE WHEN p_size % 2 = 0 THEN 'tone' ELSE 'spelling' END, count(*), count(*) FILTER (p_partkey % 9 = 0) FROM part GROUP BY 2"
)
def audit_rollups(s, d):
    f = M.facts(s, d)
    trace = F.struct(F.col("source").alias("source_id"), F.when(F.col("entry_id") % 30 == 0, "x").otherwise(F.col("record_hash")).alias("raw_record_hash"), "confidence", "review_status")
    e = f.where("definition_index % 2 = 0").withColumn("ok", checks.valid_trace(trace))
    origin = F.when(F.col("language") == "vi", "thuần Việt").when(F.col("language") == "de", "Hán Việt").otherwise("không rõ")
    p = M.table(s, d, "part").withColumn("ok", F.col("p_partkey") % 9 != 0)

    def rollup(rows, name, value, ok):
        return rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"), F.count_if(~ok).alias("invalid")).select(F.lit(name).alias("rollup"), "value", "n", "invalid")

    parts = [
        rollup(e, "etymology source", F.col("source"), F.col("ok")),
        rollup(e, "etymology language", F.col("language"), F.col("ok")),
        rollup(f, "origin", origin, F.lit(True)),
        rollup(p, "relation", F.when(F.col("p_size") % 2 == 0, "tone").otherwise("spelling"), F.col("ok")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- the search index ------------------------------------------------------------------------------


@query(
    f"WITH {_INDEX} SELECT 'letter' AS facet, b AS value, count(*) AS n FROM idx GROUP BY b UNION ALL SELECT 'source', p_brand, count(*) FROM part GROUP BY p_brand UNION ALL SELECT 'radical', p_size::VARCHAR, count(*) FROM part GROUP BY p_size UNION ALL SELECT 'shard', shard, count(*) FROM sh GROUP BY shard"
)
def index_facets(s, d):
    x, p = _index(s, d), M.table(s, d, "part")
    facet = lambda df, name, c: df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("facet"), "value", "n")
    return facet(x, "letter", "b").unionByName(facet(p, "source", "p_brand")).unionByName(facet(p, "radical", "p_size")).unionByName(facet(search.shards(x), "shard", "shard"))


@query(
    f"WITH {_INDEX}, sc AS (SELECT i, w, n, CASE WHEN n = 'small' AND lower(w) = 'small' THEN 210 WHEN n = 'small' THEN 200 WHEN starts_with(n, 'small') THEN 140 WHEN contains(t, '|small|') THEN 130 WHEN contains(t, '|small') THEN 120 WHEN contains(n, 'small') THEN 90 ELSE 0 END::INT AS score FROM sh WHERE shard = 's'), "
    "tiers AS (SELECT *, row_number() OVER (PARTITION BY score ORDER BY n, w, i) AS r FROM sc WHERE score > 0) SELECT i, w, score FROM tiers WHERE r <= 5 ORDER BY score DESC, n, w, i LIMIT 12"
)
def search_tiers(s, d):
    """The best of each tier of scores, then the best of those."""
    return search.search(search.shards(_index(s, d)), "small", most=12, each=5).select("i", "w", "score")


@query(f"WITH {_INDEX} SELECT shard, count(*) AS n FROM sh GROUP BY shard")
def index_shards_sink(s, d):
    """Shards of the index as folders, and their numbers as they are read back."""
    from ..sources import exports, storage

    path = storage.scratch(s, "shards")
    exports.shards(search.shards(_index(s, d)).drop("tokens"), path)
    return s.read.schema("i long, w string, shard string").json(path).groupBy("shard").agg(F.count("*").alias("n"))

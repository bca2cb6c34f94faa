"""The registry of queries; each has its SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.unicode_tables import tone_classes
from ..operators import audit, checks, evaluate, merge, pronunciation, search, senses
from ..sources import readers
from . import mapping as M

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def n(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("long")


LINE = ["doc_id", "idx"]

# --- scalar functions ------------------------------------------------------------------------------


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, {M.sql_clean('meaning')} AS v FROM lines")
def clean_text(s, d):
    return M.lines(s, d).select(*LINE, T.clean(F.col("meaning")).alias("v"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, {M.sql_fold('meaning')} AS v FROM lines")
def fold_key(s, d):
    return M.lines(s, d).select(*LINE, T.fold(F.col("meaning")).alias("v"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, {M.sql_tone('meaning')} AS v FROM lines")
def strip_tone(s, d):
    return M.lines(s, d).select(*LINE, T.strip_tone(F.col("meaning")).alias("v"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, {M.sql_slug('meaning')} AS v FROM lines")
def slug_id(s, d):
    return M.lines(s, d).select(*LINE, T.slug(F.col("meaning")).alias("v"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, left(sha1(meaning), 8) AS v, sha256(meaning) AS h FROM lines")
def record_hashes(s, d):
    return M.lines(s, d).select(*LINE, T.short_hash(F.col("meaning")).alias("v"), F.sha2("meaning", 256).alias("h"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, coalesce(nullif(regexp_extract({M.sql_fold('meaning')}, '[a-z]'), ''), 'other') AS v FROM lines")
def word_bucket(s, d):
    return M.lines(s, d).select(*LINE, T.bucket(F.col("meaning")).alias("v"))


@query(
    f"WITH {M.LINES_SQL} SELECT doc_id, idx, CASE WHEN regexp_matches(left(trim({M.sql_tone('meaning')}), 1), '^[a-z]$') THEN left(trim({M.sql_tone('meaning')}), 1) ELSE 'other' END AS v FROM lines"
)
def first_char_bucket(s, d):
    return M.lines(s, d).select(*LINE, T.first_char_bucket(F.col("meaning")).alias("v"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, greatest(1, len(list_filter(regexp_split_to_array({M.sql_clean('meaning')}, '[ -]+'), lambda x: x <> '')))::BIGINT AS v FROM lines")
def syllables(s, d):
    return M.lines(s, d).select(*LINE, n(T.syllables(F.col("meaning"))).alias("v"))


_TONES = " ".join(f"WHEN regexp_matches(c, '{cls}') THEN '{code}'" for code, cls in tone_classes())


@query(
    f"WITH {M.LINES_SQL} SELECT doc_id, idx, array_to_string(list_filter(list_transform(string_split(meaning, ''), lambda c: CASE {_TONES} END), lambda t: t IS NOT NULL), '-') AS v FROM lines"
)
def tone_signature(s, d):
    return M.lines(s, d).select(*LINE, T.tone_signature(F.col("meaning")).alias("v"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, {M.sql_key('meaning')} AS v FROM lines")
def definition_key(s, d):
    return M.lines(s, d).select(*LINE, T.definition_key(F.col("meaning")).alias("v"))


@query(f"WITH {M.FACTS_SQL} SELECT entry_id, definition_index, array_to_string(tokens, ' ') AS v, len(tokens)::BIGINT AS n FROM facts")
def content_tokens(s, d):
    return M.facts(s, d).select("entry_id", F.col("definition_index").cast("int").alias("definition_index"), F.array_join("tokens", " ").alias("v"), n(F.size("tokens")).alias("n"))


@query(f"WITH {M.LINES_SQL} SELECT doc_id, idx, CASE WHEN length(meaning) <= 180 THEN meaning ELSE rtrim(left(meaning, 179)) || '…' END AS v FROM lines")
def snippets(s, d):
    return M.lines(s, d).select(*LINE, T.snippet(F.col("meaning")).alias("v"))


@query(
    f"WITH {M.LINES_SQL} SELECT doc_id, idx, CASE WHEN length(m) < 40 THEN '0-39' WHEN length(m) < 120 THEN '40-119' WHEN length(m) < 300 THEN '120-299' ELSE '300+' END AS v FROM (SELECT *, {M.sql_clean('meaning')} AS m FROM lines)"
)
def length_bucket(s, d):
    return M.lines(s, d).select(*LINE, T.length_bucket(T.clean(F.col("meaning"))).alias("v"))


_POS = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in T.POS_CODES.items()) + " ELSE 'khác' END"


@query(f"WITH c AS (SELECT p_partkey, chr((65 + p_partkey % 26)::INT) AS code FROM part) SELECT p_partkey, code, {_POS} AS v FROM c UNION ALL SELECT p_partkey, lower(p_type), lower(p_type) FROM part")
def pos_map(s, d):
    p = M.table(s, d, "part")
    code = F.char(F.lit(65) + F.col("p_partkey") % 26)
    rows = p.select("p_partkey", code.alias("code")).unionByName(p.select("p_partkey", F.lower("p_type").alias("code")))
    return rows.select("p_partkey", "code", T.part_of_speech(F.col("code")).alias("v"))


@query(
    "WITH c AS (SELECT p_partkey, (CASE p_partkey % 4 WHEN 0 THEN 19968 WHEN 1 THEN 131072 WHEN 2 THEN 13312 ELSE 65 END + p_partkey % 5000)::INT AS cp FROM part) "
    "SELECT p_partkey, 'u+' || upper(to_hex(cp)) AS id, (cp BETWEEN 13312 AND 19903 OR cp BETWEEN 19968 AND 40959 OR cp BETWEEN 131072 AND 173791 OR cp BETWEEN 63744 AND 64255) AS han FROM c"
)
def han_codepoints(s, d):
    k = F.col("p_partkey") % 4
    cp = (F.when(k == 0, 19968).when(k == 1, 131072).when(k == 2, 13312).otherwise(65) + F.col("p_partkey") % 5000).cast("int")
    c = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    return M.table(s, d, "part").select("p_partkey", T.code_point_id(c).alias("id"), T.is_single_han(c).alias("han"))


@query("SELECT o_orderkey, CASE WHEN regexp_matches(o_orderpriority, '^[ ]*[+-]?[0-9]+') THEN CAST(regexp_extract(o_orderpriority, '[0-9]+') AS BIGINT) END AS v FROM orders")
def int_prefix(s, d):
    return M.table(s, d, "orders").select("o_orderkey", T.int_prefix(F.col("o_orderpriority")).alias("v"))


@query(
    "WITH RECURSIVE x AS (SELECT event_id, event_id % 7 AS k, repeat(CASE WHEN event_id % 2 = 0 THEN '[/ ' ELSE '[[' END, (event_id % 7)::INT) || event_type || repeat(CASE WHEN event_id % 2 = 0 THEN ' /]' ELSE ']]' END, (event_id % 7)::INT) || CASE WHEN event_id % 11 = 0 THEN ']' ELSE '' END AS v FROM events), "
    "r AS (SELECT event_id, v, 0 AS i FROM x UNION ALL SELECT event_id, trim(v[2:-2]), i + 1 FROM r WHERE length(v) >= 2 AND (starts_with(v, '[') AND ends_with(v, ']') OR starts_with(v, '/') AND ends_with(v, '/'))) "
    "SELECT event_id, arg_max(v, i) AS v FROM r GROUP BY event_id"
)
def ipa_display(s, d):
    """Brackets to any depth: up to fourteen pairs here, some unpaired."""
    e = M.table(s, d, "events")
    depth, even = (F.col("event_id") % 7).cast("int"), F.col("event_id") % 2 == 0
    wrapped = F.concat(F.when(even, F.repeat(F.lit("[/ "), depth)).otherwise(F.repeat(F.lit("[["), depth)), "event_type", F.when(even, F.repeat(F.lit(" /]"), depth)).otherwise(F.repeat(F.lit("]]"), depth)), F.when(F.col("event_id") % 11 == 0, "]").otherwise(""))
    return e.select("event_id", T.strip_brackets(wrapped).alias("v"))


@query(
    f"WITH {M.LINES_SQL} SELECT doc_id, idx, array_to_string(list_distinct_in_order, '; ') AS v FROM (SELECT doc_id, idx, list_filter(list_transform(regexp_split_to_array(meaning, ' +~ +| +\\| +'), lambda x: {M.sql_clean('x')}), lambda x: x <> '') AS l, "
    "list_transform(list_filter(range(1, len(l) + 1), lambda i: list_position(l, l[i]) = i), lambda i: l[i]) AS list_distinct_in_order FROM lines)"
)
def split_examples(s, d):
    return M.lines(s, d).select(*LINE, F.array_join(T.split_examples(F.col("meaning")), "; ").alias("v"))


@query(
    r"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(?:script\b.*?</script\s*|style\b.*?</style\s*|!--.*?--)>', '', 'g'),
  '(?i)<br\s*/?>', chr(10), 'g'), '(?s)<[^>]*>', '', 'g') AS x FROM pages)
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&') || ' éệ… &amp; 😀 &unknown; &#; & it''s' AS v FROM t"""
)
def html_to_text(s, d):
    more = F.lit(" <font color='white'>hidden</font>&#233;&#x1EC7;&hellip; &amp;amp; &#128512; &unknown; &#; & it&#39;s")
    return M.table(s, d, "pages").select("page_id", T.html_to_text(F.concat(F.coalesce("html", F.lit("")), more)).alias("v"))


_NUMBERED = r"""lines AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'đgt. 1. ' || p_name || ' 2. costs ' || p_size || ' or 5. of it 3) c 4. d' WHEN 1 THEN p_name || ' has 10 of 2. and 1. them'
  WHEN 2 THEN '1. ' || p_name || ' 2. 3. ' || p_brand WHEN 3 THEN '49 days after ' || p_name ELSE '2. ' || p_name || ' 1) first 2) second' END AS line FROM part),
w AS (SELECT p_partkey, string_split(line, ' ') AS w FROM lines),
marks AS (
  SELECT p_partkey, w, 0 AS k, 0::BIGINT AS spot FROM w
  UNION ALL SELECT p_partkey, w, k + 1, list_min(list_filter(range(spot + 1, len(w) + 1), lambda i: regexp_extract(w[i], '^([0-9]{1,2})[.)]$', 1) = (k + 1)::VARCHAR)) FROM marks WHERE spot IS NOT NULL),
bounds AS (SELECT *, lead(spot) OVER (PARTITION BY p_partkey ORDER BY k) AS next FROM marks WHERE spot IS NOT NULL),
parts AS (SELECT p_partkey, k, array_to_string(CASE WHEN k = 0 AND next IS NULL THEN w WHEN k = 1 THEN w[1:(SELECT min(m.spot) FROM marks m WHERE m.p_partkey = bounds.p_partkey AND m.k = 1) - 1] || w[spot + 1:coalesce(next - 1, len(w))]
  ELSE w[spot + 1:coalesce(next - 1, len(w))] END, ' ') AS part FROM bounds WHERE k > 0 OR next IS NULL)"""


@query(f"WITH RECURSIVE {_NUMBERED} SELECT p_partkey, count(*) FILTER (part <> '') AS n, array_to_string(list(part ORDER BY k) FILTER (part <> ''), '|') AS parts FROM parts GROUP BY p_partkey")
def numbered_split(s, d):
    k, p = F.col("p_partkey") % 5, M.table(s, d, "part")
    line = (
        F.when(k == 0, F.concat(F.lit("đgt. 1. "), "p_name", F.lit(" 2. costs "), F.col("p_size").cast("string"), F.lit(" or 5. of it 3) c 4. d")))
        .when(k == 1, F.concat("p_name", F.lit(" has 10 of 2. and 1. them")))
        .when(k == 2, F.concat(F.lit("1. "), "p_name", F.lit(" 2. 3. "), "p_brand"))
        .when(k == 3, F.concat(F.lit("49 days after "), "p_name"))
        .otherwise(F.concat(F.lit("2. "), "p_name", F.lit(" 1) first 2) second")))
    )
    parts = T.numbered_parts(line)
    return p.select("p_partkey", n(F.size(parts)).alias("n"), F.array_join(parts, "|").alias("parts"))


# --- facts, rules, clusters ------------------------------------------------------------------------


@query(f"WITH {M.FACTS_SQL} SELECT sense_id, definition_uid, word, array_to_string(risk_tags, ',') AS tags FROM facts")
def risk_tags(s, d):
    return M.facts(s, d).select("sense_id", "definition_uid", "word", F.array_join("risk_tags", ",").alias("tags"))


@query(f"WITH {M.FACTS_SQL} SELECT sense_id, score, trusted, hard_risk FROM facts")
def canonical_score(s, d):
    return M.facts(s, d).select("sense_id", "score", "trusted", "hard_risk")


FLAG_WEIGHTS = audit.FLAG_WEIGHTS


@query(
    f"WITH {M.FACTS_SQL} SELECT sense_id, coalesce(list_sum(list_transform(risk_tags, lambda t: CASE "
    + " ".join(f"WHEN t = '{k}' THEN {v}" for k, v in FLAG_WEIGHTS.items())
    + " ELSE 1 END)), 0)::BIGINT AS priority FROM facts"
)
def priority_score(s, d):
    return M.facts(s, d).select("sense_id", n(audit.priority("risk_tags")).alias("priority"))


@query(f"WITH {M.CLUSTERS_SQL} SELECT cluster_id, word, key, member_count, source_count, trusted_source_count FROM clusters WHERE exact")
def exact_clusters(s, d):
    c = senses.clusters(M.facts(s, d)).where("cluster_type = 'exact'")
    return c.select("cluster_id", "word", "key", "member_count", "source_count", "trusted_source_count")


@query(f"WITH {M.CLUSTERS_SQL} SELECT count(*) AS n, count(DISTINCT cluster_id) AS ids FROM members WHERE NOT exact")
def singletons_anti(s, d):
    f = M.facts(s, d)
    groups = f.groupBy("word", "key").agg(F.count("*").alias("m"), F.count_distinct("source").alias("k")).where("m > 1 AND k > 1")
    single = f.join(groups, ["word", "key"], "left_anti")
    return single.agg(F.count("*").alias("n"), F.count_distinct("sense_id").alias("ids"))


@query(f"WITH {M.CLUSTERS_SQL} SELECT cluster_id, sense_id, source, meaning, score FROM clusters")
def canonical_choice(s, d):
    return senses.clusters(M.facts(s, d)).select("cluster_id", "canonical.sense_id", "canonical.source", "canonical.meaning", "canonical.score")


_TIER = "CASE status WHEN 'auto_accepted' THEN 'high' WHEN 'machine_clustered' THEN 'medium' WHEN 'machine_retained' THEN 'medium' WHEN 'needs_review' THEN 'low' WHEN 'quarantined' THEN 'quarantine' WHEN 'entity_or_encyclopedic' THEN 'entity' ELSE 'reference' END"


@query(f"WITH {M.CLUSTERS_SQL} SELECT cluster_id, status, {_TIER} AS tier, array_to_string(reasons, ',') AS reasons FROM clusters")
def cluster_status(s, d):
    return senses.clusters(M.facts(s, d)).select("cluster_id", "status", "tier", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {M.CLUSTERS_SQL} SELECT cluster_id, round(confidence, 4) AS source_confidence, cluster_confidence, selection_confidence FROM clusters")
def cluster_confidence(s, d):
    return senses.clusters(M.facts(s, d)).select("cluster_id", "source_confidence", "cluster_confidence", "selection_confidence")


_STATUS_ROWS = "(VALUES " + ", ".join(f"('{x}')" for x in senses.STATUSES) + ") v(status)"


@query(
    f"WITH {M.CLUSTERS_SQL} SELECT v.status, count(c.status) AS clusters, coalesce(sum(member_count), 0)::BIGINT AS definitions FROM {_STATUS_ROWS} LEFT JOIN clusters c ON c.status = v.status GROUP BY v.status"
)
def status_zero_fill(s, d):
    dim = s.createDataFrame([(x,) for x in senses.STATUSES], "status string")
    got = senses.clusters(M.facts(s, d)).groupBy("status").agg(F.count("*").alias("clusters"), F.sum("member_count").alias("definitions"))
    return dim.join(got, "status", "left").na.fill(0, ["clusters", "definitions"])


@query(f"WITH {M.CLUSTERS_SQL} SELECT status, NULL AS source, floor(sum(confidence::DECIMAL(18,4))::DOUBLE / count(confidence) * 10000 + 0.5) / 10000 AS conf, count(*) AS n FROM clusters GROUP BY status UNION ALL SELECT NULL, source, floor(sum(confidence::DECIMAL(18,4))::DOUBLE / count(confidence) * 10000 + 0.5) / 10000, count(*) FROM clusters GROUP BY source")
def confidence_grouping_sets(s, d):
    c = senses.clusters(M.facts(s, d)).select("status", F.col("canonical.source").alias("source"), F.col("canonical.confidence").alias("conf"))
    return c.groupingSets([["status"], ["source"]], "status", "source").agg(evaluate.mean("conf").alias("conf"), F.count("*").alias("n")).select("status", "source", "conf", "n")


@query(
    f"WITH {M.CLUSTERS_SQL} SELECT reason, count(DISTINCT cluster_id) AS clusters, count(*) AS definitions, count(*) FILTER (status = 'needs_review') AS in_review FROM "
    "(SELECT c.cluster_id, c.status, unnest(list_distinct(c.reasons || m.risk_tags)) AS reason FROM clusters c JOIN members m USING (cluster_id)) GROUP BY reason"
)
def reason_breakdown(s, d):
    f = M.facts(s, d)
    rows = senses.clustered(f).select("cluster_id", "risk_tags").join(senses.clusters(f).select("cluster_id", "status", "reasons"), "cluster_id")
    r = rows.select("cluster_id", "status", F.explode(F.array_union("reasons", "risk_tags")).alias("reason"))
    return r.groupBy("reason").agg(F.count_distinct("cluster_id").alias("clusters"), F.count("*").alias("definitions"), F.count_if(F.col("status") == "needs_review").alias("in_review"))


@query(
    f"WITH {M.FACTS_SQL}, c AS (SELECT reason, source, count(*) AS n FROM (SELECT source, unnest(risk_tags) AS reason FROM facts) GROUP BY ALL) "
    "SELECT reason, source, n, r FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY n DESC, source)::INT AS r FROM c) WHERE r <= 10"
)
def top_sources_per_reason(s, d):
    c = M.facts(s, d).select("source", F.explode("risk_tags").alias("reason")).groupBy("reason", "source").agg(F.count("*").alias("n"))
    w = Window.partitionBy("reason").orderBy(F.col("n").desc(), "source")
    return c.withColumn("r", F.row_number().over(w)).where("r <= 10")


@query(
    f"WITH {M.CLUSTERS_SQL} SELECT cluster_id, status, member_count, word FROM clusters WHERE status IN ('needs_review', 'quarantined') ORDER BY member_count DESC, status, word, cluster_id LIMIT 5000"
)
def review_remainder_topk(s, d):
    c = senses.clusters(M.facts(s, d)).where(F.col("status").isin("needs_review", "quarantined"))
    return c.select("cluster_id", "status", "member_count", "word").orderBy(F.col("member_count").desc(), "status", "word", "cluster_id").limit(5000)


@query(
    f"WITH {M.CLUSTERS_SQL}, e AS (SELECT m.sense_id, CASE WHEN c.status = 'entity_or_encyclopedic' THEN 'cluster' WHEN m.hard_risk THEN 'member' END AS scope, "
    f"list_filter(m.risk_tags, lambda t: list_contains({M._ENTITY}, t)) AS kinds FROM members m JOIN clusters c USING (cluster_id)) "
    "SELECT sense_id, scope, CASE WHEN len(kinds) = 1 THEN kinds[1] ELSE 'mixed' END AS entity_type FROM e WHERE scope IS NOT NULL"
)
def entity_layer(s, d):
    return senses.entity_layer(M.facts(s, d)).select("sense_id", "scope", "entity_type")


@query(f"WITH {M.NEAR_SQL} SELECT word, left_id, right_id, score, action FROM near")
def near_pairs_jaccard(s, d):
    return M.near_pairs(s, d).select("word", "left_id", "right_id", "score", "action")


@query(f"WITH {M.NEAR_SQL} SELECT triage_group, count(*) AS n FROM triaged GROUP BY triage_group")
def near_triage(s, d):
    return senses.triage(M.near_pairs(s, d)).groupBy("triage_group").agg(F.count("*").alias("n"))


_BUCKET = "CASE WHEN score = 1 THEN '1.00' WHEN score >= 0.98 THEN '0.98-0.9999' WHEN score >= 0.94 THEN '0.94-0.9799' WHEN score >= 0.9 THEN '0.90-0.9399' ELSE '0.82-0.8999' END"


@query(f"WITH {M.NEAR_SQL} SELECT {_BUCKET} AS bucket, count(*) AS n FROM near GROUP BY 1")
def score_buckets(s, d):
    return M.near_pairs(s, d).groupBy(senses.score_bucket(F.col("score")).alias("bucket")).agg(F.count("*").alias("n"))


# --- evaluation and sampling -----------------------------------------------------------------------


def _confusion_sql(rows: str, thresholds: tuple[float, ...]) -> str:
    values = ", ".join(f"({t}::DOUBLE)" for t in thresholds)
    return (
        f"{rows}, c AS (SELECT threshold, count(*) FILTER (score >= threshold AND y) AS tp, count(*) FILTER (score >= threshold AND NOT y) AS fp, "
        f"count(*) FILTER (score < threshold AND NOT y) AS tn, count(*) FILTER (score < threshold AND y) AS fn FROM rows, (VALUES {values}) t(threshold) GROUP BY threshold), "
        "p AS (SELECT *, round(tp / nullif(tp + fp, 0), 4) AS precision, round(tp / nullif(tp + fn, 0), 4) AS recall FROM c)"
    )


_CALIB = "WITH rows AS (SELECT least(1.0::DOUBLE, round(length(text) / 4000.0::DOUBLE, 4)) AS score, quality = 1 AND toxic = 0 AS y FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL)"


def _scored(s: SparkSession, d: str) -> DataFrame:
    j = M.table(s, d, "documents").where("text IS NOT NULL").join(M.table(s, d, "labels"), "doc_id")
    return j.select(F.least(F.lit(1.0), F.round(F.length("text") / 4000.0, 4)).alias("score"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("y"))


@query(_confusion_sql(_CALIB, evaluate.CALIBRATION_THRESHOLDS) + " SELECT threshold, tp, fp, tn, fn, precision, recall FROM p")
def calibration_table(s, d):
    return evaluate.confusion(_scored(s, d), "score", F.col("y"), evaluate.CALIBRATION_THRESHOLDS).drop("f1")


@query(_confusion_sql(_CALIB, evaluate.CALIBRATION_THRESHOLDS) + " SELECT threshold, tp, fp FROM p WHERE tp + fp > 0 AND tp / (tp + fp) >= 0.7 ORDER BY tp / nullif(tp + fn, 0) DESC NULLS LAST, threshold LIMIT 1")
def calibration_argmax(s, d):
    return evaluate.calibrate(_scored(s, d), "score", F.col("y"), 0.7)


@query(
    f"WITH {M.CLUSTERS_SQL}, x AS (SELECT cluster_id, unnest(['status', 'type', 'language']) AS dimension, unnest([status, cluster_type, language]) AS bucket FROM clusters) "
    "SELECT dimension, bucket, cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY dimension, bucket ORDER BY sha256(dimension || ':' || bucket || ':' || cluster_id), cluster_id) AS r FROM x) WHERE r <= 50"
)
def stratified_top50(s, d):
    c = senses.clusters(M.facts(s, d)).select("cluster_id", F.col("status"), F.col("cluster_type").alias("type"), F.col("canonical.language").alias("language"))
    rows = c.unpivot("cluster_id", ["status", "type", "language"], "dimension", "bucket")
    return evaluate.top_by_hash(rows, ["dimension", "bucket"], "cluster_id", 50).select("dimension", "bucket", "cluster_id")


@query(
    f"WITH {M.CLUSTERS_SQL}, x AS (SELECT cluster_id, unnest(['by-status', 'by-source', 'by-confidence-tier', 'by-length']) AS dimension, unnest([status, source, {_TIER}, "
    "CASE WHEN length(meaning) < 40 THEN 'short-under-40' WHEN length(meaning) < 120 THEN 'medium-40-119' WHEN length(meaning) < 300 THEN 'long-120-299' ELSE 'very-long-300-plus' END]) AS bucket FROM clusters) "
    "SELECT dimension, bucket, cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY dimension, bucket ORDER BY sha256(dimension || ':' || bucket || ':' || cluster_id), cluster_id) AS r FROM x) WHERE r <= 50"
)
def stratified_dimensions(s, d):
    size = F.col("canonical.size")
    bucket = F.when(size < 40, "short-under-40").when(size < 120, "medium-40-119").when(size < 300, "long-120-299").otherwise("very-long-300-plus")
    names = ["by-status", "by-source", "by-confidence-tier", "by-length"]
    of = [F.col("status"), F.col("canonical.source"), F.col("tier"), bucket]
    _, members = M.members(s, d)
    c = senses.clusters(members).select("cluster_id", *[x.alias(n) for n, x in zip(names, of)])
    rows = c.unpivot("cluster_id", names, "dimension", "bucket")
    return evaluate.top_by_hash(rows, ["dimension", "bucket"], "cluster_id", 50).select("dimension", "bucket", "cluster_id")


_QUOTAS = {"1.00": 150, "0.98-0.9999": 1, "0.94-0.9799": 200, "0.90-0.9399": 200, "0.82-0.8999": 249}


@query(
    f"WITH {M.NEAR_SQL}, b AS (SELECT left_id || ':' || right_id AS id, {_BUCKET} AS bucket FROM near), q AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{k}', {v})" for k, v in _QUOTAS.items())
    + ") t(bucket, quota)), r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY sha256(bucket || ':' || id), id) AS r FROM b JOIN q USING (bucket)) SELECT bucket, id FROM r WHERE r <= quota"
)
def quota_sample(s, d):
    p = M.near_pairs(s, d).select(F.concat_ws(":", "left_id", "right_id").alias("id"), senses.score_bucket(F.col("score")).alias("bucket"))
    quota = F.coalesce(*[F.when(F.col("bucket") == k, v) for k, v in _QUOTAS.items()])
    return evaluate.top_by_hash(p, ["bucket"], "id", quota).select("bucket", "id")


@query(
    "WITH k AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS i, count(*) OVER () AS k FROM (SELECT DISTINCT source FROM documents)), "
    "r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(source || ':' || doc_id), doc_id) AS r FROM documents) "
    "SELECT doc_id, source FROM r JOIN k USING (source) WHERE r <= 505 // k + CASE WHEN i < 505 % k THEN 1 ELSE 0 END"
)
def even_quota_remainder(s, d):
    return evaluate.even_quota(M.table(s, d, "documents").select("doc_id", "source"), "source", "doc_id", 505).select("doc_id", "source")


@query("SELECT source, quality, count(*) AS total, count(*) FILTER (quality = 1 - toxic) AS agree, round(count(*) FILTER (quality = 1 - toxic) / count(*), 4) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY source, quality")
def agreement_rate(s, d):
    j = M.table(s, d, "documents").select("doc_id", "source").join(M.table(s, d, "labels"), "doc_id")
    agree = F.count_if(F.col("quality") == 1 - F.col("toxic"))
    return j.groupBy("source", "quality").agg(F.count("*").alias("total"), agree.alias("agree"), F.round(agree / F.count("*"), 4).alias("rate"))


# --- merges, joins, sets ---------------------------------------------------------------------------


@query(
    f"WITH w AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) ELSE p_name || ' !' END AS word FROM part), s AS (SELECT word, {M.sql_slug('word')} AS slug FROM w) "
    "SELECT word, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY word) = 1 THEN slug ELSE slug || '-' || left(sha1(word), 8) END AS id FROM s"
)
def slug_collision(s, d):
    k = F.col("p_partkey") % 3
    word = F.when(k == 0, F.col("p_name")).when(k == 1, F.upper("p_name")).otherwise(F.concat("p_name", F.lit(" !")))
    return merge.assign_slugs(M.table(s, d, "part").select(word.alias("word")).distinct()).select("word", "id")


@query(
    "SELECT l_partkey, min_by(l_returnflag, o) FILTER (l_returnflag <> 'N') AS first_flag, max_by(l_linestatus, o) AS last_status, count(*) AS merged, count(DISTINCT l_suppkey) AS sources "
    "FROM (SELECT *, l_orderkey * 10 + l_linenumber AS o FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1) GROUP BY l_partkey"
)
def keyed_merge(s, d):
    li = M.table(s, d, "lineitem")
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    li = li.withColumn("rn", F.row_number().over(w)).where("rn = 1").withColumn("o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    flagged = li.withColumn("flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return flagged.groupBy("l_partkey").agg(
        merge.first_non_null("flag", "o").alias("first_flag"), merge.last_wins("l_linestatus", "o").alias("last_status"), F.count("*").alias("merged"), F.count_distinct("l_suppkey").alias("sources")
    )


@query("SELECT o_custkey, max_by(o_orderpriority, struct_pack(a := 6 - CAST(left(o_orderpriority, 1) AS INT), b := -o_orderkey)) AS best FROM orders GROUP BY o_custkey")
def rank_max_origin(s, d):
    rank = F.lit(6) - F.substring("o_orderpriority", 1, 1).cast("int")
    return M.table(s, d, "orders").groupBy("o_custkey").agg(merge.rank_max("o_orderpriority", rank, "o_orderkey").alias("best"))


@query("SELECT l_suppkey, array_to_string(list(l_shipmode ORDER BY o), ',') AS flags FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS l_shipmode, min(l_orderkey * 10 + l_linenumber) AS o FROM lineitem GROUP BY ALL) GROUP BY l_suppkey")
def ordered_union_distinct(s, d):
    li = M.table(s, d, "lineitem").select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("v"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return merge.union_distinct(li, ["l_suppkey"], "v", "o").select("l_suppkey", F.array_join("v", ",").alias("flags"))


@query(f"WITH {M.LINES_SQL} SELECT source, k, count(*) AS n, min(doc_id * 100000 + idx) AS first FROM (SELECT source, doc_id, idx, trim(regexp_replace({M.sql_fold('meaning')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS k FROM lines) WHERE k <> '' GROUP BY source, k")
def unique_by_meaning(s, d):
    k = F.trim(F.regexp_replace(T.fold(F.col("meaning")), r"[^\p{L}\p{N}]+", " "))
    x = M.lines(s, d).select("source", k.alias("k"), (F.col("doc_id") * 100000 + F.col("idx")).alias("o")).where("k <> ''")
    return x.groupBy("source", "k").agg(F.count("*").alias("n"), F.min("o").alias("first"))


@query("SELECT p.p_partkey, p_name, s.n AS lines FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) s ON s.l_partkey = p.p_partkey")
def enrich_only_join(s, d):
    meta = M.table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("lines"))
    return merge.enrich_only(M.table(s, d, "part").select("p_partkey", "p_name"), meta, "p_partkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey % 9 = 0)")
def lexeme_anti_join(s, d):
    known = M.table(s, d, "orders").where("o_orderkey % 9 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return merge.unseen(M.table(s, d, "customer").select("c_custkey", "c_name"), known, ["c_custkey"])


@query("SELECT DISTINCT user_id, event_type FROM events e WHERE EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type AND x.value > 100)")
def projection_semi_join(s, d):
    e = M.table(s, d, "events")
    return e.select("user_id", "event_type").distinct().join(e.where("value > 100").select("user_id", "event_type"), ["user_id", "event_type"], "left_semi")


@query("SELECT 'orders without customer' AS name, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lines without order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'labels without document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0)")
def ref_integrity(s, d):
    t = lambda x: M.table(s, d, x)
    checked = [
        ("orders without customer", checks.missing(t("orders"), "o_custkey", t("customer"), "c_custkey")),
        ("lines without order", checks.missing(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey")),
        ("labels without document", checks.missing(t("labels"), "doc_id", t("documents").where("doc_id % 3 <> 0"), "doc_id")),
    ]
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, rows in checked]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT 'documents' AS layer, count(*) - count(DISTINCT text) AS repeated, count(*) - count(DISTINCT doc_id) AS ids FROM documents")
def duplicate_ids(s, d):
    return M.table(s, d, "documents").agg((F.count("*") - F.count_distinct("text")).alias("repeated"), (F.count("*") - F.count_distinct("doc_id")).alias("ids")).select(F.lit("documents").alias("layer"), "*")


@query(
    "WITH h AS (SELECT layer, sha256(layer || ':' || id) AS h FROM (SELECT 'part' AS layer, p_partkey AS id FROM part UNION ALL SELECT 'supplier', s_suppkey FROM supplier)), "
    "p AS (SELECT layer, left(h, 2) AS p, count(*) AS n, sum(('0x' || substr(h, 3, 12))::BIGINT) AS s FROM h GROUP BY ALL) "
    "SELECT layer, sum(n)::BIGINT AS n, sha256(array_to_string(list(p || ':' || n || ':' || s ORDER BY p), chr(10))) AS fingerprint FROM p GROUP BY layer"
)
def layer_fingerprint(s, d):
    ids = M.table(s, d, "part").select(F.lit("part").alias("layer"), F.col("p_partkey").alias("id")).unionByName(M.table(s, d, "supplier").select(F.lit("supplier").alias("layer"), F.col("s_suppkey").alias("id")))
    return merge.fingerprint(ids)


_TONED = "['hoà', 'hòa', 'hoá', 'hóa', 'thuỷ', 'thủy', 'quy']"
_VARIANTS = f"v AS (SELECT {_TONED}[(p_partkey % 7 + 1)::INT] || ' ' || p_name AS headword FROM part), k AS (SELECT DISTINCT headword, {M.sql_tone('headword')} || ':' || array_to_string(list_filter(list_transform(string_split(headword, ''), lambda c: CASE {_TONES} END), lambda t: t IS NOT NULL), '-') AS key FROM v)"


def _spelt(s: SparkSession, d: str) -> DataFrame:
    forms = F.array(*[F.lit(x) for x in ("hoà", "hòa", "hoá", "hóa", "thuỷ", "thủy", "quy")])
    return M.table(s, d, "part").select(F.concat_ws(" ", F.get(forms, (F.col("p_partkey") % 7).cast("int")), "p_name").alias("headword"))


@query(f"WITH {_VARIANTS} SELECT key, array_to_string(list_sort(list(headword)), ',') AS forms FROM k GROUP BY key HAVING count(*) > 1")
def variant_groups(s, d):
    return readers.variants(_spelt(s, d)).select("key", F.array_join("forms", ",").alias("forms"))


@query(
    "SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN last_value(CASE WHEN role <> 'assistant' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE length(text) END AS v FROM conversations"
)
def locf_placeholder(s, d):
    c = M.table(s, d, "conversations").withColumn("size", F.length("text").cast("long"))
    return merge.carry_forward(c, ["conv_id"], "turn", "size", F.col("role") == "assistant", "v").select("conv_id", "turn", "v")


# --- histograms, audits ----------------------------------------------------------------------------


@query(f"WITH {M.FACTS_SQL} SELECT source, count(DISTINCT word) AS headwords, count(*) AS definitions, count(*) FILTER (trusted) AS trusted, count(*) FILTER (hard_risk) AS risky, count(*) FILTER (len(risk_tags) = 0) AS clean, floor(sum(confidence::DECIMAL(18,4))::DOUBLE / count(confidence) * 10000 + 0.5) / 10000 AS confidence, max(length(meaning))::BIGINT AS longest FROM facts GROUP BY source")
def source_stats(s, d):
    return M.facts(s, d).groupBy("source").agg(
        F.count_distinct("word").alias("headwords"),
        F.count("*").alias("definitions"),
        F.count_if("trusted").alias("trusted"),
        F.count_if("hard_risk").alias("risky"),
        F.count_if(F.size("risk_tags") == 0).alias("clean"),
        evaluate.mean("confidence").alias("confidence"),
        n(F.max(F.length("meaning"))).alias("longest"),
    )


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def nested_histogram(s, d):
    return M.table(s, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def value_histogram(s, d):
    return M.table(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "event_type")


@query(f"WITH {M.FACTS_SQL} SELECT word, count(*) AS definitions, count(DISTINCT source) AS sources FROM facts GROUP BY word HAVING count(*) >= 12 OR (count(DISTINCT source) >= 3 AND count(*) >= 8)")
def high_definition_headwords(s, d):
    return M.facts(s, d).groupBy("word").agg(F.count("*").alias("definitions"), F.count_distinct("source").alias("sources")).where("definitions >= 12 OR (sources >= 3 AND definitions >= 8)")


@query(
    "SELECT count(*) AS docs, count(text) AS with_text, count(*) FILTER (length(text) > 1000) AS long, count(*) FILTER (contains(text, chr(10))) AS with_lines, count(*) FILTER (regexp_matches(text, '[0-9]')) AS with_digits, round(100.0 * count(*) FILTER (lang = 'en') / count(*), 2) AS percent_en FROM documents"
)
def coverage_block(s, d):
    return M.table(s, d, "documents").agg(
        F.count("*").alias("docs"),
        F.count("text").alias("with_text"),
        F.count_if(F.length("text") > 1000).alias("long"),
        F.count_if(F.contains("text", F.lit("\n"))).alias("with_lines"),
        F.count_if(F.col("text").rlike("[0-9]")).alias("with_digits"),
        F.round(100.0 * F.count_if(F.col("lang") == "en") / F.count("*"), 2).alias("percent_en"),
    )


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(text) || ':' || doc_id, doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r <= 100")
def structural_sample(s, d):
    x = M.table(s, d, "documents").where("text IS NOT NULL")
    w = Window.partitionBy("source").orderBy(F.concat_ws(":", F.sha2("text", 256), F.col("doc_id").cast("string")), "doc_id")
    return x.select("doc_id", "source", F.row_number().over(w).alias("r")).where("r <= 100").drop("r")


# --- pronunciation ---------------------------------------------------------------------------------


@query(
    f"""WITH {M.PRON_SQL}, p AS (SELECT * REPLACE (coalesce(dialect, '') AS dialect) FROM pron),
rec AS (SELECT headword, source, dialect, record, count(DISTINCT shown) AS n FROM p GROUP BY ALL),
g AS (SELECT headword, source, dialect, count(DISTINCT shown) AS v FROM p GROUP BY ALL),
r2 AS (SELECT headword, source, dialect, count(*) AS records, count(*) FILTER (n > 1) AS mixed FROM rec GROUP BY ALL),
src AS (SELECT headword, count(*) FILTER (v > 1) AS varied, count(*) FILTER (v > 1 AND NOT (records = 1 AND mixed = 1)) = 0 AS attested, count(*) AS groups FROM g JOIN r2 USING (headword, source, dialect) GROUP BY headword),
h AS (SELECT headword, count(*) AS facts, count(DISTINCT ipa) AS raw_values, count(DISTINCT shown) AS shown_values, count(DISTINCT word) AS words, count(*) FILTER (dialect = '') AS without_dialect, min(shown) AS any_ FROM p GROUP BY headword)
SELECT headword, facts, raw_values, shown_values, words, without_dialect, varied, groups,
 CASE WHEN shown_values = 1 THEN 'formatting_only' WHEN varied = 0 THEN 'dialect_source_variant' WHEN words = 1 AND attested THEN 'source_attested_variant' ELSE 'unresolved' END AS bucket,
 CASE WHEN shown_values = 1 THEN any_ END AS safe_ipa FROM h JOIN src USING (headword) WHERE raw_values >= 2"""
)
def conflict_3grain(s, d):
    return pronunciation.conflicts(M.pronunciations(s, d))


@query(
    f"WITH {M.PRON_SQL} SELECT source, gap, count(*) AS n FROM (SELECT source, CASE WHEN tagged THEN 'unrecognized_explicit_tag' WHEN coalesce(note, '') = '' THEN 'no_explicit_source_label' "
    "WHEN note = 'Hà Nội' OR starts_with(note, 'Hà Nội;') OR starts_with(note, 'Hà Nội,') OR starts_with(note, 'Hà Nội (') THEN 'recognized_geographic_label_with_qualifier' "
    "WHEN regexp_matches(note, '^rare') THEN 'non_geographic_note_qualifier' ELSE 'unrecognized_explicit_note' END AS gap FROM pron WHERE dialect IS NULL) GROUP BY ALL"
)
def dialect_gap_case(s, d):
    p = M.pronunciations(s, d).where(F.col("dialect").isNull())
    gap = pronunciation.gap_reason(F.col("tags"), F.col("note"), ["Hà Nội", "Sài Gòn"], "^rare")
    return p.groupBy("source", gap.alias("gap")).agg(F.count("*").alias("n"))


@query(f"WITH {M.PRON_SQL} SELECT source, count(*) AS facts, count(dialect) AS with_dialect, count(*) - count(dialect) AS without_dialect FROM pron GROUP BY source")
def dialect_coverage(s, d):
    return pronunciation.coverage(M.pronunciations(s, d))


# --- search ----------------------------------------------------------------------------------------

_INDEX = f"""named AS (SELECT * REPLACE (CASE p_partkey % 40 WHEN 0 THEN 'small' WHEN 1 THEN 'Smáll' WHEN 2 THEN 'a smallish ' || p_name WHEN 3 THEN 'unsmall' ELSE p_name END AS p_name) FROM part),
ix AS (SELECT p_partkey AS i, p_name AS w, {M.sql_tone('p_name')} AS n, regexp_extract_all({M.sql_tone('p_name')}, '[a-z]+') AS tokens,
 (CASE WHEN p_size > 25 THEN 1 ELSE 0 END + 2 + CASE WHEN p_type = 'PROMO' THEN 4 ELSE 0 END)::INT AS f FROM named),
idx AS (SELECT *, '|' || array_to_string(tokens, '|') || '|' AS t, CASE WHEN regexp_matches(left(trim(n), 1), '^[a-z]$') THEN left(trim(n), 1) ELSE 'other' END AS b FROM ix),
sh AS (SELECT *, unnest(CASE WHEN len(tokens) > 0 THEN list_distinct(list_transform(tokens, lambda t: left(t, 1))) ELSE ['other'] END) AS shard FROM idx)"""


def _index(s: SparkSession, d: str) -> DataFrame:
    flags = (F.when(F.col("p_size") > 25, search.IPA).otherwise(0) + F.lit(search.NATIVE) + F.when(F.col("p_type") == "PROMO", search.HAN).otherwise(0)).cast("int")
    k = F.col("p_partkey") % 40
    # so that every rung of the score is reached
    name = F.when(k == 0, "small").when(k == 1, "Smáll").when(k == 2, F.concat(F.lit("a smallish "), "p_name")).when(k == 3, "unsmall").otherwise(F.col("p_name"))
    return search.index(M.table(s, d, "part").withColumn("p_name", name), "p_partkey", "p_name", flags)


@query(f"WITH {_INDEX} SELECT i, w, n, t, b, f FROM idx")
def search_index(s, d):
    return _index(s, d).drop("tokens")


@query(f"WITH {_INDEX} SELECT shard, count(*) AS n, count(DISTINCT i) AS ids FROM sh GROUP BY shard")
def search_shards(s, d):
    return search.shards(_index(s, d)).groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("i").alias("ids"))


@query(
    f"WITH {_INDEX}, sc AS (SELECT i, w, n, CASE WHEN n = 'small' AND lower(w) = 'small' THEN 210 WHEN n = 'small' THEN 200 WHEN starts_with(n, 'small') THEN 140 WHEN contains(t, '|small|') THEN 130 WHEN contains(t, '|small') THEN 120 WHEN contains(n, 'small') THEN 90 ELSE 0 END::INT AS score FROM sh WHERE shard = 's' AND f & 1 <> 0) "
    "SELECT i, w, score FROM sc WHERE score > 0 ORDER BY score DESC, n, w, i LIMIT 80"
)
def search_scored_topk(s, d):
    return search.search(search.shards(_index(s, d)), "small", mask=search.IPA).select("i", "w", "score")


@query(f"WITH {_INDEX} SELECT 'letter' AS facet, b AS value, count(*) AS n FROM idx GROUP BY b UNION ALL SELECT 'flags', f::VARCHAR, count(*) FROM idx GROUP BY f")
def facet_counts(s, d):
    x = _index(s, d)
    a = x.groupBy(F.col("b").alias("value")).agg(F.count("*").alias("n")).select(F.lit("letter").alias("facet"), "value", "n")
    return a.unionByName(x.groupBy(F.col("f").cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit("flags").alias("facet"), "value", "n"))

"""Queries of entries: text functions, default records, provenance, cleaning, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import entries as E
from ..operators import layers, review
from . import mapping as M
from .queries import n, query

# --- text functions --------------------------------------------------------------------------------

#: Decomposed texts, marks in either order; written as escapes, as editors compose.
_DECOMPOSED = "ệ ặ ớ  ệt й ά , å"


@query(f"WITH x AS (SELECT p_partkey, p_name || '{_DECOMPOSED}' || p_brand AS v FROM part) SELECT p_partkey, {M.sql_clean('nfc_normalize(v)')} AS cleaned, {M.sql_fold('nfc_normalize(v)')} AS folded, sha256(nfc_normalize(v)) AS hash FROM x")
def composed_texts(s, d):
    v = F.concat("p_name", F.lit(_DECOMPOSED), "p_brand")
    return M.table(s, d, "part").select("p_partkey", T.clean_text(v).alias("cleaned"), T.fold(T.compose(v)).alias("folded"), T.record_hash(v).alias("hash"))


@query(
    "WITH x AS (SELECT p_partkey, p_partkey % 6 AS k, p_name FROM part), y AS (SELECT *, CASE k WHEN 0 THEN 'từ Hán Việt ' || p_name WHEN 1 THEN 'Sino-Vietnamese ' || p_name WHEN 2 THEN 'mượn từ ' || p_name WHEN 3 THEN 'a Loanword ' || p_name WHEN 4 THEN 'GỐC HÁN' ELSE p_name END AS v FROM x) "
    "SELECT p_partkey, CASE WHEN k IN (0, 1, 4) THEN 'Hán Việt' WHEN k IN (2, 3) THEN 'vay mượn khác' ELSE 'không rõ' END AS origin, CASE WHEN k % 2 = 0 THEN '天地' ELSE '' END AS han, list_aggregate(list_transform(string_split(lower(v), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title FROM y"
)
def origins(s, d):
    k = F.col("p_partkey") % 6
    v = F.coalesce(*[F.when(k == i, F.concat(F.lit(t), "p_name")) for i, t in enumerate(["từ Hán Việt ", "Sino-Vietnamese ", "mượn từ ", "a Loanword "])], F.when(k == 4, "GỐC HÁN"), F.col("p_name"))
    han = F.array_join(T.han_chars(F.when(k % 2 == 0, "a天b地 天ư").otherwise("abc")), "")
    return M.table(s, d, "part").select("p_partkey", T.infer_origin(F.array(v)).alias("origin"), han.alias("han"), T.title_case(v).alias("title"))


_CODES = ["d", "dt", "đt", "đg", "đgt", "t", "tt", "trt", "tht", "lt", "l", "pt", "pht", "ph"]
_MEANS = ["danh từ", "danh từ", "đại từ", "động từ", "động từ", "tính từ", "tính từ", "trạng từ", "thán từ", "liên từ", "liên từ", "phụ từ", "phó từ", "phó từ"]


@query(
    f"WITH x AS (SELECT p_partkey, p_partkey % 17 AS k, p_name, {_CODES} AS c, {_MEANS} AS m FROM part) "
    "SELECT p_partkey, CASE WHEN k < 14 THEN p_name WHEN k = 14 THEN '2. ' || p_name WHEN k = 15 THEN 'x. ' || p_name ELSE '2.' END AS meaning, CASE WHEN k < 14 THEN m[k + 1] END AS pos, CASE WHEN k < 14 AND k % 2 = 0 THEN c[k + 1] || '. ' || p_name WHEN k < 14 THEN upper(c[k + 1]) || '. ' || p_name WHEN k = 14 THEN p_name WHEN k = 15 THEN 'x. ' || p_name ELSE '2.' END AS bare FROM x"
)
def stripped_markers(s, d):
    k = (F.col("p_partkey") % 17).cast("int")
    codes = F.array(*[F.lit(c) for c in _CODES])
    code = F.when(k % 2 == 0, F.get(codes, k)).otherwise(F.upper(F.get(codes, k)))
    x = F.when(k < 14, F.concat(F.when(k % 2 == 0, F.lit("12. ")).otherwise(""), code, F.lit(". "), "p_name")).when(k == 14, F.concat(F.lit("2. "), "p_name")).when(k == 15, F.concat(F.lit("x. "), "p_name")).otherwise("2.")
    m = T.marked(x)
    return M.table(s, d, "part").select("p_partkey", m["meaning"].alias("meaning"), m["pos"].alias("pos"), T.strip_line_marker(x).alias("bare"))


@query(
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Bắc Bộ' WHEN 1 THEN 'Huế' END AS dialect, CASE p_partkey % 4 WHEN 0 THEN 'old; ' || p_name WHEN 1 THEN p_name ELSE '' END AS qualifier, "
    "replace(regexp_replace('Ế ' || p_name || '/' || p_brand, '[^A-Za-z0-9._Ế-]+', '-', 'g'), 'Ế', 'E') AS file, CASE WHEN p_partkey % 3 = 0 THEN '\"' || p_name || ', \"\"x\"\"\"' ELSE p_name END AS csv, 'a &lt; b &amp; ' || p_name || ' &quot;&apos;' AS xml FROM part"
)
def notes_and_escapes(s, d):
    k = F.col("p_partkey") % 4
    note = F.when(k == 0, F.concat(F.lit("Bắc Bộ ; old; "), "p_name")).when(k == 1, F.concat(F.lit("Huế;"), "p_name")).when(k == 2, F.col("p_name")).otherwise(F.concat("p_name", F.lit("; ")))
    parts = review.split_note(note)
    csv = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(', "x"'))).otherwise(F.col("p_name"))
    return M.table(s, d, "part").select(
        "p_partkey", parts["dialect"].alias("dialect"), parts["qualifier"].alias("qualifier"), T.file_name(F.concat(F.lit("Ế "), "p_name", F.lit("/"), "p_brand")).alias("file"),
        T.escape_csv(csv).alias("csv"), T.escape_xml(F.concat(F.lit("a < b & "), "p_name", F.lit(" \"'"))).alias("xml"),
    )


@query(
    "SELECT o_orderkey, regexp_replace(format('{:,}', (o_orderkey * o_custkey)::BIGINT), ',', '.', 'g') AS grouped, CASE WHEN o_custkey % 5 = 0 THEN 0.0::DOUBLE ELSE round((o_custkey % 7)::DOUBLE / (o_custkey % 5) * 100, 2) END AS percent, "
    "CASE WHEN o_orderkey * o_orderkey >= 1048576 THEN format('{:.2f} MB', o_orderkey * o_orderkey / 1048576.0::DOUBLE) WHEN o_orderkey * o_orderkey >= 1024 THEN format('{:.2f} KB', o_orderkey * o_orderkey / 1024.0::DOUBLE) ELSE (o_orderkey * o_orderkey) || ' B' END AS size FROM orders WHERE o_orderkey * o_orderkey < 1073741824"
)
def formatted_numbers(s, d):
    o = M.table(s, d, "orders").where("o_orderkey * o_orderkey < 1073741824")
    square = F.col("o_orderkey") * F.col("o_orderkey")
    return o.select("o_orderkey", T.grouped_number(F.col("o_orderkey") * F.col("o_custkey")).alias("grouped"), T.percent(F.col("o_custkey") % 7, F.col("o_custkey") % 5).alias("percent"), T.human_bytes(square).alias("size"))


@query(
    "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name || '|b' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'x|' || p_brand ELSE '' END AS texts, "
    "CASE p_partkey % 3 WHEN 0 THEN p_name || '|two|t|e' WHEN 1 THEN p_name ELSE '' END AS examples FROM part"
)
def json_arrays_of_texts(s, d):
    k, e = F.col("p_partkey") % 5, F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit('["'), "p_name", F.lit('", 1, null, {"a": "b"}, "b", true]'))).when(k == 1, '{"a": ["b"]}').when(k == 2, F.lit(None)).when(k == 3, F.concat(F.lit('["x", "'), "p_brand", F.lit('", 2.5]'))).otherwise("7")
    examples = F.when(e == 0, F.concat(F.lit('["'), "p_name", F.lit('", {"text": "two", "translation": "t", "english": "e", "ref": "r"}, "two"]'))).when(e == 1, F.concat(F.lit('[{"text": " '), "p_name", F.lit(' "}, {"note": "n"}]'))).otherwise(F.lit(None))
    return M.table(s, d, "part").select("p_partkey", F.array_join(E.string_array(raw), "|").alias("texts"), F.array_join(E.sense_examples(examples), "|").alias("examples"))


# --- records ---------------------------------------------------------------------------------------


@query(
    f"SELECT p_partkey, p_name AS word, {M.sql_slug('p_name')} AS id, lower({M.sql_clean('p_name')}) AS normalized, {M.sql_tone('p_name')} AS no_tone, greatest(1, len(list_filter(regexp_split_to_array({M.sql_clean('p_name')}, '[ -]+'), lambda x: x <> '')))::BIGINT AS syllables, "
    "'vi' AS language, 'không rõ' AS origin, 0::BIGINT AS definitions, 'src' || p_size AS source, sha256(p_brand) AS hash, 0.8::DOUBLE AS confidence, 'machine-checked' AS review, p_partkey::VARCHAR AS entry FROM part"
)
def default_entries(s, d):
    p = M.table(s, d, "part").withColumn("src", F.concat(F.lit("src"), F.col("p_size").cast("string")))
    t = E.trace(F.col("src"), F.col("p_partkey"), F.col("p_brand"))
    w = p.select("p_partkey", t.alias("t"), F.struct(*E.word_entry(F.col("p_name"), F.col("src"))).alias("w"), F.struct(*E.lexeme_entry(F.col("p_name"), F.col("src"), F.col("p_partkey"), F.col("p_brand"))).alias("x"))
    return w.select(
        "p_partkey", "w.word", "x.id", F.col("w.headword_normalized").alias("normalized"), F.col("x.headword_no_tone").alias("no_tone"), n(F.col("w.syllable_count")).alias("syllables"), "w.language", "w.origin",
        n(F.size("w.definitions")).alias("definitions"), F.get("w.sources", F.lit(0)).alias("source"), F.get("x.evidence", F.lit(0))["raw_record_hash"].alias("hash"), "t.confidence", F.col("t.review_status").alias("review"), F.col("t.source_entry_id").alias("entry"),
    )


@query("SELECT p_partkey, 'u+' || upper(to_hex((19968 + p_partkey % 3000)::INT)) AS id, chr((19968 + p_partkey % 3000)::INT) AS character, 'Hán' AS systems, p_brand AS sources, 0::BIGINT AS known FROM part")
def default_characters(s, d):
    c = F.decode(F.unhex(F.lpad(F.hex((F.col("p_partkey") % 3000 + 19968).cast("int")), 8, "0")), "UTF-32")
    h = M.table(s, d, "part").select("p_partkey", F.struct(*E.han_entry(c, F.col("p_brand"))).alias("h"))
    known = F.size("h.meanings") + F.size("h.readings_nom") + F.when(F.col("h.radical").isNotNull(), 1).otherwise(0)
    return h.select("p_partkey", "h.id", "h.character", F.array_join("h.writing_systems", ",").alias("systems"), F.array_join("h.sources", ",").alias("sources"), n(known).alias("known"))


def _trace(of: str):
    return E.trace(F.col("source"), F.col("p_partkey"), F.col(of))


def _raw_words(s: SparkSession, d: str) -> DataFrame:
    """Entries whose definitions carry markers, placeholders and repeats."""
    p = M.table(s, d, "part").withColumn("source", F.when(F.col("p_partkey") % 2 == 0, E.PLACEHOLDER_SOURCE).otherwise("other"))

    def definition(meaning, source=None, labels=None):
        return F.struct(
            meaning.alias("meaning"), F.array(F.lit(" e "), F.lit("e"), F.lit("")).alias("examples"), (F.col("source") if source is None else source).alias("source"), F.lit("vi").alias("language"),
            _trace("p_brand").alias("provenance"), F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("labels"),
        )

    definitions = F.array(
        definition(F.concat(F.lit("1. d. "), "p_name")), definition(F.lit("id.")), definition(F.concat(F.upper("p_name"), F.lit(" ?"))), definition(F.concat("p_name", F.lit(" nữa"))), definition(F.lit("...")), definition(F.lit("x"), F.lit(" ")),
    )
    etymology = lambda text: F.struct(text.alias("text"), F.lit("vi").alias("language"), F.col("source").alias("source"), _trace("p_name").alias("provenance"))
    base = p.select("p_partkey", "p_name", "p_brand", "p_type", "source", *E.word_entry(F.concat(F.lit(" "), "p_name", F.lit("  x")), F.col("source")))
    etymologies = F.when(F.col("p_partkey") % 3 == 0, F.array(etymology(F.lit(" ")), etymology(F.col("p_brand")))).otherwise(F.array().cast(f"array<{E.ETYMOLOGY}>"))
    return (
        base.withColumn("definitions", definitions).withColumn("etymologies", etymologies).withColumn("part_of_speech", F.array(F.lit("V"), F.lit("noun"), F.lit("động từ"))).withColumn("synonyms", F.array(F.col("p_brand"), F.lit(" "), F.col("p_brand")))
    )


_MARKED_SQL = "SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN 'dai_nam_quoc_am_tu_vi' ELSE 'other' END AS source, p_brand FROM part"


@query(
    f"WITH p AS ({_MARKED_SQL}) SELECT trim(p_name) || ' x' AS word, array_to_string([p_name] || CASE WHEN p_partkey % 2 = 0 THEN [] ELSE ['id.'] END || [p_name || ' nữa'], '|') AS meanings, 'động từ,danh từ' AS pos, p_brand AS synonyms, 'e' AS examples, 'b,a' AS labels, "
    "CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE '' END AS etymologies, sha256(CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_brand END) AS best, CASE WHEN p_partkey % 3 = 0 THEN source ELSE source END || '/' || trim(p_name) || ' x:origin' AS traced, p_partkey AS k FROM p"
)
def sanitised_words(s, d):
    raw = _raw_words(s, d)
    keyed = raw.withColumn("id", F.col("p_partkey").cast("string"))
    w = E.sanitise_words(keyed)
    first = F.get("definitions", F.lit(0))
    traced = E.trace_for(F.col("word"), F.get("sources", F.lit(0)), "origin", F.col("etymologies"), F.col("definitions"))
    return w.select(
        "word", F.array_join(F.transform("definitions", lambda x: x["meaning"]), "|").alias("meanings"), F.array_join("part_of_speech", ",").alias("pos"), F.array_join("synonyms", ",").alias("synonyms"),
        F.array_join(first["examples"], ",").alias("examples"), F.array_join(first["labels"], ",").alias("labels"), F.array_join(F.transform("etymologies", lambda x: x["text"]), ",").alias("etymologies"),
        E.best_trace(F.col("etymologies"), F.col("definitions"))["raw_record_hash"].alias("best"), F.concat_ws("/", traced["source_id"], traced["source_entry_id"]).alias("traced"), F.col("id").cast("long").alias("k"),
    )


def _characters(s: SparkSession, d: str) -> DataFrame:
    """Entries of fifty characters: some numbers unknown, meanings that repeat."""
    p = M.table(s, d, "part").withColumn("source", F.concat(F.lit("s"), (F.col("p_partkey") % 3).cast("string"))).withColumn("ord", F.col("p_partkey"))
    c = F.decode(F.unhex(F.lpad(F.hex((F.col("p_partkey") % 50 + 19968).cast("int")), 8, "0")), "UTF-32")
    meaning = lambda text: F.struct(text.alias("meaning"), F.col("source").alias("source"), F.lit("vi").alias("language"), _trace("p_name").alias("provenance"))
    base = p.select("ord", "p_name", "p_brand", "p_size", "p_type", "p_partkey", "source", *E.han_entry(c, F.col("source")))
    return (
        base.withColumn("radical", F.when(F.col("p_size") > 25, F.col("p_brand")))
        .withColumn("total_stroke_count", F.when(F.col("p_size") > 40, F.col("p_size")))
        .withColumn("readings_han_viet", F.split("p_name", " "))
        .withColumn("meanings", F.array(meaning(F.col("p_type")), meaning(F.upper("p_type")), meaning(F.lit("?")), meaning(F.lit(""))))
    )


@query(
    "WITH p AS (SELECT *, 'u+' || upper(to_hex((19968 + p_partkey % 50)::INT)) AS id, 's' || p_partkey % 3 AS source FROM part), "
    "r AS (SELECT id, unnest(string_split(p_name, ' ')) AS v, p_partkey * 100 + generate_subscripts(string_split(p_name, ' '), 1) AS o FROM p), "
    "q AS (SELECT id, array_to_string(list(v ORDER BY o), ',') AS readings FROM (SELECT id, v, min(o) AS o FROM r GROUP BY id, v) GROUP BY id), "
    "m AS (SELECT id, count(*) AS meanings, array_to_string(list(p_type ORDER BY o), ',') AS texts FROM (SELECT id, source, lower(p_type) AS t, arg_min(p_type, p_partkey) AS p_type, min(p_partkey) AS o FROM p GROUP BY id, source, lower(p_type)) GROUP BY id) "
    "SELECT p.id, arg_min(p_brand, p_partkey) FILTER (p_size > 25) AS radical, (arg_min(p_size, p_partkey) FILTER (p_size > 40))::INT AS strokes, any_value(readings) AS readings, any_value(meanings) AS meanings, any_value(texts) AS texts, count(*) AS merged FROM p JOIN q ON q.id = p.id JOIN m ON m.id = p.id GROUP BY p.id"
)
def merged_characters(s, d):
    e = _characters(s, d)
    clean = E.sanitise_han(e.withColumn("id", F.concat_ws("/", "id", F.col("ord").cast("string"))))
    back = clean.withColumn("ord", F.element_at(F.split("id", "/"), -1).cast("long")).withColumn("id", F.split("id", "/")[0])
    h = E.merge_han(back)
    return h.select("id", "radical", F.col("total_stroke_count").alias("strokes"), F.array_join("readings_han_viet", ",").alias("readings"), n(F.size("meanings")).alias("meanings"), F.array_join(F.transform("meanings", lambda x: x["meaning"]), ",").alias("texts"), "merged")


@query(
    f"WITH {M.FACTS_SQL}, e AS (SELECT *, lower({M.sql_clean('word')}) AS k, entry_id * 100000 + definition_index AS ord, trim(regexp_replace({M.sql_fold('meaning')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS folded FROM facts), "
    "l AS (SELECT k, unnest(tokens[1:3]) AS v, ord * 10 + generate_subscripts(tokens[1:3], 1) AS o FROM e), s AS (SELECT k, array_to_string(list(v ORDER BY o), ',') AS synonyms FROM (SELECT k, v, min(o) AS o FROM l GROUP BY k, v) GROUP BY k), "
    "r AS (SELECT k, array_to_string(list(source ORDER BY o), ',') AS sources FROM (SELECT k, source, min(ord) AS o FROM e GROUP BY k, source) GROUP BY k), "
    "d AS (SELECT k, count(*) AS definitions, sha256(array_to_string(list(meaning ORDER BY o), chr(10))) AS meanings FROM (SELECT k, source, folded, min(ord) AS o, arg_min(meaning, ord) AS meaning FROM e WHERE folded <> '' GROUP BY k, source, folded) GROUP BY k), "
    "y AS (SELECT k, count(*) AS etymologies FROM (SELECT DISTINCT k, source, quality FROM e WHERE definition_index % 2 = 0) GROUP BY k), "
    "b AS (SELECT k, arg_min(word, ord) AS word, arg_min(key, ord) FILTER (trusted) AS ipa, CASE WHEN bool_or(language = 'de') THEN 'Hán Việt' WHEN bool_or(language = 'vi') THEN 'thuần Việt' ELSE 'không rõ' END AS origin, count(*) AS merged FROM e GROUP BY k) "
    "SELECT b.k AS key, word, ipa, origin, merged, coalesce(synonyms, '') AS synonyms, sources, coalesce(definitions, 0) AS definitions, coalesce(meanings, sha256('')) AS meanings, coalesce(etymologies, 0) AS etymologies "
    "FROM b LEFT JOIN s ON s.k = b.k LEFT JOIN r ON r.k = b.k LEFT JOIN d ON d.k = b.k LEFT JOIN y ON y.k = b.k"
)
def merged_words(s, d):
    f = M.facts(s, d)
    t = E.trace(F.col("source"), F.col("entry_id"), F.col("meaning"))
    definition = F.struct("meaning", F.array().cast("array<string>").alias("examples"), "source", "language", t.alias("provenance"), "labels")
    etymology = F.struct(F.col("quality").alias("text"), "language", "source", t.alias("provenance"))
    none = F.array().cast("array<string>")
    lists = {x: none for x in E.LISTS} | {"part_of_speech": F.col("part_of_speech"), "synonyms": F.slice("tokens", 1, 3), "sources": F.array("source")}
    rows = f.select(
        "word", (F.col("entry_id") * 100000 + F.col("definition_index")).alias("ord"), F.when(F.col("trusted"), F.col("key")).alias("pronunciation_ipa"),
        F.when(F.col("language") == "vi", "thuần Việt").when(F.col("language") == "de", "Hán Việt").otherwise(E.UNKNOWN_ORIGIN).alias("origin"), F.array(definition).alias("definitions"),
        F.when(F.col("definition_index") % 2 == 0, F.array(etymology)).otherwise(F.array().cast(f"array<{E.ETYMOLOGY}>")).alias("etymologies"), *[c.alias(x) for x, c in lists.items()],
    )
    w = E.merge_words(rows)
    meanings = F.sha2(F.array_join(F.transform("definitions", lambda x: x["meaning"]), "\n"), 256)
    return w.select("key", "word", F.col("pronunciation_ipa").alias("ipa"), "origin", "merged", F.array_join("synonyms", ",").alias("synonyms"), F.array_join("sources", ",").alias("sources"), n(F.size("definitions")).alias("definitions"), meanings.alias("meanings"), n(F.size("etymologies")).alias("etymologies"))


def _nom(s: SparkSession, d: str) -> DataFrame:
    p = M.table(s, d, "part")
    c = F.decode(F.unhex(F.lpad(F.hex((F.col("p_partkey") % 3 + 19968).cast("int")), 8, "0")), "UTF-32")
    return p.select(
        F.col("p_partkey").alias("ord"), F.initcap("p_name").alias("quoc_ngu"), c.alias("characters"), F.array("p_brand", F.lit("v")).alias("variants"), F.when(F.col("p_size") > 20, F.col("p_type")).alias("definition"),
        F.when(F.col("p_size") > 20, F.lit("vi")).alias("definition_language"), F.when(F.col("p_size") > 30, F.col("p_size")).alias("frequency"),
    )


@query(
    "WITH p AS (SELECT *, lower(p_name) || ':' || chr((19968 + p_partkey % 3)::INT) AS key FROM part), v AS (SELECT key, p_brand AS v, p_partkey * 2 AS o FROM p UNION ALL SELECT key, 'v', p_partkey * 2 + 1 FROM p), "
    "q AS (SELECT key, array_to_string(list(v ORDER BY o), ',') AS variants FROM (SELECT key, v, min(o) AS o FROM v GROUP BY key, v) GROUP BY key) "
    "SELECT p.key, arg_min(p_type, p_partkey) FILTER (p_size > 20) AS definition, CASE WHEN max(p_size) > 20 THEN 'vi' END AS definition_language, (arg_min(p_size, p_partkey) FILTER (p_size > 30))::INT AS frequency, any_value(variants) AS variants, count(*) AS merged FROM p JOIN q ON p.key = q.key GROUP BY p.key"
)
def merge_nom(s, d):
    return E.merge_nom(_nom(s, d)).select("key", "definition", "definition_language", "frequency", F.array_join("variants", ",").alias("variants"), "merged")


@query(
    "WITH c AS (SELECT c_nationkey AS k, c_mktsegment AS v, c_custkey AS o, 's' || c_custkey % 3 AS source, sha256(c_mktsegment) AS hash FROM customer), "
    "l AS (SELECT k, array_to_string(list(v ORDER BY o), ',') AS lemmas FROM (SELECT k, v, min(o) AS o FROM c GROUP BY k, v) GROUP BY k), t AS (SELECT k, count(*) AS traces, array_to_string(list(source ORDER BY o), ',') AS sources FROM (SELECT k, source, hash, min(o) AS o FROM c GROUP BY ALL) GROUP BY k) "
    "SELECT c.k AS synset, any_value(lemmas) AS lemmas, any_value(traces) AS traces, any_value(sources) AS sources, count(*) AS merged FROM c JOIN l ON l.k = c.k JOIN t ON t.k = c.k GROUP BY c.k"
)
def merge_synsets(s, d):
    c = M.table(s, d, "customer").withColumn("source", F.concat(F.lit("s"), (F.col("c_custkey") % 3).cast("string")))
    rows = c.select(F.col("c_nationkey").alias("synset"), F.col("c_custkey").alias("ord"), F.array("c_mktsegment").alias("lemmas"), F.array(E.trace(F.col("source"), F.col("c_custkey"), F.col("c_mktsegment"))).alias("provenance"))
    m = E.merge_traced(rows, "synset", ("lemmas",))
    return m.select("synset", F.array_join("lemmas", ",").alias("lemmas"), n(F.size("provenance")).alias("traces"), F.array_join(F.transform("provenance", lambda x: x["source_id"]), ",").alias("sources"), "merged")


@query(f"WITH {M.LINES_SQL} SELECT h AS id, doc_id, idx FROM (SELECT 'evidence-' || left(sha1(meaning), 8) AS h, doc_id, idx, row_number() OVER (PARTITION BY left(sha1(meaning), 8) ORDER BY doc_id DESC, idx DESC) AS r FROM lines) WHERE r = 1")
def evidence_last_wins(s, d):
    x = M.lines(s, d).select(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("idx").cast("string")).alias("headword"), F.col("meaning").alias("text"), "source", (F.col("doc_id") * 100000 + F.col("idx")).alias("ord"))
    at = F.split("headword", ":")
    return layers.evidence(x).select("id", at[0].cast("long").alias("doc_id"), at[1].cast("int").alias("idx"))


@query(f"WITH {M.FACTS_SQL}, e AS (SELECT lower({M.sql_clean('word')}) AS key, source, record_hash FROM facts WHERE entry_id % 4 <> 0), k AS (SELECT DISTINCT lower({M.sql_clean('word')}) AS key FROM facts WHERE entry_id % 4 = 0) SELECT key, count(DISTINCT source || record_hash) AS evidence, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM e WHERE key NOT IN (SELECT key FROM k) GROUP BY key")
def merge_lexemes(s, d):
    f = M.facts(s, d)
    known = f.where("entry_id % 4 = 0").select(T.merge_key(F.col("word")).alias("key")).distinct()
    rows = f.where("entry_id % 4 <> 0").select(F.col("word").alias("headword"), "source", "record_hash", (F.col("entry_id") * 100000 + F.col("definition_index")).alias("ord"))
    x = layers.lexemes(rows, known)
    return x.select("key", n(F.size("evidence")).alias("evidence"), F.array_join(F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["source"]))), ",").alias("sources"))


@query(
    f"WITH {M.FACTS_SQL} SELECT 'words' AS layer, count(*) AS read, count(DISTINCT lower({M.sql_clean('word')})) AS unique, count(*) - count(DISTINCT lower({M.sql_clean('word')})) AS merged FROM facts "
    "UNION ALL SELECT 'nom', count(*), count(DISTINCT lower(p_name) || ':' || p_partkey % 3), count(*) - count(DISTINCT lower(p_name) || ':' || p_partkey % 3) FROM part "
    "UNION ALL SELECT 'characters', count(*), count(DISTINCT p_partkey % 50), count(*) - count(DISTINCT p_partkey % 50) FROM part"
)
def merge_bookkeeping(s, d):
    f = M.facts(s, d).select("word")
    words = f.select(T.merge_key(F.col("word")).alias("key")).distinct()
    return E.bookkeeping({"words": (f, words), "nom": (_nom(s, d), E.merge_nom(_nom(s, d))), "characters": (_characters(s, d), E.merge_han(_characters(s, d)))})


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 2 WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END::BIGINT AS kept, trim(p_name) AS headword FROM part")
def sanitised_lexemes(s, d):
    k = F.col("p_partkey") % 3
    item = lambda source, hash_: F.struct(source.alias("source_id"), F.lit("e").alias("source_entry_id"), hash_.alias("raw_record_hash"))
    good, no_hash, no_source = item(F.lit("s"), F.lit("h")), item(F.lit("s"), F.lit(None).cast("string")), item(F.lit(""), F.lit("h"))
    evidence = F.when(k == 0, F.array(good, good, no_hash)).when(k == 1, F.array(no_source, good)).otherwise(F.array(no_hash, no_source))
    rows = M.table(s, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("  "), "p_name").alias("headword"), evidence.alias("evidence"))
    return E.sanitise_lexemes(rows).select(F.col("id").alias("p_partkey"), n(F.size("evidence")).alias("kept"), "headword")

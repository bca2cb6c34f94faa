"""One reader for each kind of source file; all give plain columns, and merging comes later.

Texts are read by Spark, so that any file system will do.  A record's ordinal
within its file, where an entry has no id of its own, is counted by
:func:`numbered`, which reads each file in one task (such files are word lists
of a few MB; line-delimited JSON, the large kind, has ids of its own).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.window import Window

from ..functions import text as T

SENSE = "struct<definition:string,example:string,pos:string,sub_pos:string>"
SOUND = "struct<ipa:string,tags:array<string>,note:string,han_viet:string,hanviet:string,roman:string,reading:string>"
ENTRY = (
    "word string, lang string, lang_code string, pos string, etymology_text string, "
    f"sounds array<{SOUND}>, senses array<struct<glosses:array<string>,raw_glosses:array<string>,tags:array<string>>>, _bad string"
)


def whole(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of each file, as one text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, line), n from 1 in each file; without a byte order mark."""
    lines = F.split(F.regexp_replace("value", "^\\x{feff}", ""), "\r?\n")
    return whole(spark, path).select("path", F.posexplode(lines).alias("n", "line")).withColumn("n", F.col("n") + 1)


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """(word, idx, definition, ...) of a JSON object of words and lists of senses.

    Values that aren't lists, and senses without a definition, are dropped.
    """
    raw = whole(spark, path).select(F.explode(F.from_json("value", "map<string,string>")).alias("word", "list"))
    senses = raw.select("word", F.posexplode(F.from_json("list", f"array<{SENSE}>")).alias("idx", "s")).select("word", "idx", "s.*")
    return senses.where(T.clean(F.col("definition")) != "")


#: What tags and notes of a sound may say of where it is spoken.
DIALECTS = ("Hà-Nội", "Huế", "Saigon", "Vinh", "Thanh-Chương", "Hà-Tĩnh", "Hanoi", "Quảng Nam", "Hội An", "Hoài Nhơn", "Phong Nha", "Đồng Hới", "Wanwei, Wutou")


def has_definitions(senses: Column, numbers: bool = False) -> Column:
    """Whether one of an entry's senses has a gloss."""
    return F.coalesce(F.exists(senses, lambda x: F.size(glosses(x, numbers)) > 0), F.lit(False))


def raw_pronunciations(spark: SparkSession, path: str, source: str, numbers: bool = False, dialects: tuple[str, ...] = DIALECTS) -> DataFrame:
    """Pronunciation facts of a raw file: one for each sound with a transcription of an entry that has definitions.

    A line that is no JSON fails the read.  A dialect is what tags or the note
    name outright, never inferred.  Equal facts of one record are one.
    """
    e = json_lines(spark, path, strict=True).where(is_vietnamese(F.col("lang"), F.col("lang_code")) & has_definitions(F.col("senses"), numbers))
    e = e.select(T.clean(F.col("word")).alias("word"), F.coalesce(F.nullif(T.clean(F.col("pos")), F.lit("")), F.lit("unknown")).alias("pos"), T.record_hash(F.col("raw")).alias("record_hash"), F.posexplode("sounds").alias("i", "s"))
    tags = T.dedupe_strings(F.coalesce(F.col("s.tags"), F.array().cast("array<string>")))
    rows = e.select("word", "pos", "record_hash", (F.col("i") + 1).alias("sound"), T.clean(F.col("s.ipa")).alias("ipa"), tags.alias("tags"), F.nullif(T.clean(F.col("s.note")), F.lit("")).alias("note"))
    rows = rows.where("word <> '' AND ipa <> ''").withColumn("dialect", T.explicit_dialect(F.col("tags"), F.col("note"), list(dialects)))
    seed = F.concat_ws(":", T.merge_key(F.col("word")), "word", F.lit(source), "ipa", F.coalesce("dialect", F.lit("")), "record_hash", F.col("sound").cast("string"))
    entry = F.concat(F.col("word"), F.lit(":"), F.col("pos"), F.lit(":record:"), F.substring("record_hash", 1, 12), F.lit(":pronunciation:"), F.col("sound").cast("string"))
    named = rows.withColumn("pronunciation_id", F.concat(F.lit("pronunciation-"), T.slug(F.col("word")), F.lit("-"), T.short_hash(seed))).withColumn("source_entry_id", entry)
    # by all that the id is made of, as short hashes may meet
    return named.dropDuplicates(["word", "ipa", "dialect", "record_hash", "sound"]).withColumn("headword", T.merge_key(F.col("word"))).withColumn("source", F.lit(source)).withColumn("system", F.lit("IPA")).withColumn("confidence", F.lit(0.85))


def json_lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Dictionary entries of (gzipped) JSON lines, with the line itself as ``raw``.

    A line that is no JSON is dropped, or fails the read where ``strict``.
    gzip can't be split, so rows are dealt out anew after the scan.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").repartition(max(2, spark.sparkContext.defaultParallelism))
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    schema = ENTRY.removesuffix(", _bad string") if strict else ENTRY
    parsed = lines.select(F.col("value").alias("raw"), F.from_json("value", schema, mode).alias("e")).select("raw", "e.*")
    return parsed if strict else parsed.where(F.col("_bad").isNull() & F.col("word").isNotNull()).drop("_bad")


def is_vietnamese(lang: Column, code: Column) -> Column:
    return (F.lower(T.clean(code)) == "vi") | F.lower(T.clean(lang)).isin("tiếng việt", "vietnamese")


def is_han_entry(word: Column, lang: Column, code: Column, pos: Column) -> Column:
    lang, pos = F.lower(T.clean(lang)), F.lower(T.clean(pos))
    named = F.lower(T.clean(code)).isin("zh", "cmn", "lzh", "vi") | lang.contains("trung") | lang.contains("hán")
    return T.is_single_han(word) & (named | pos.isin("character", "han character"))


def first_ipa(sounds: Column) -> Column:
    ipas = F.filter(F.transform(sounds, lambda s: F.trim(s["ipa"])), lambda x: x.isNotNull() & (x != ""))
    return T.clean(F.get(ipas, F.lit(0)))


def han_readings(sounds: Column) -> Column:
    """Readings that a sound gives outright, or in general fields where its tags say so."""

    def of(s: Column) -> Column:
        sino = F.exists(F.coalesce(s["tags"], F.array().cast("array<string>")), lambda x: F.lower(x).rlike("hán|han-viet|sino-vietnamese"))
        return F.array(s["han_viet"], s["hanviet"], F.when(sino, s["roman"]), F.when(sino, s["reading"]))

    found = F.filter(F.flatten(F.transform(F.coalesce(sounds, F.array().cast(f"array<{SOUND}>")), of)), lambda x: x.rlike("[A-Za-zÀ-ỹ]"))
    return T.dedupe_strings(F.transform(found, T.title_case))


def glosses(sense: Column, numbers: bool = False) -> Column:
    none = F.array().cast("array<string>")
    plain = T.dedupe_strings(F.concat(F.coalesce(sense["glosses"], none), F.coalesce(sense["raw_glosses"], none)))
    return T.dedupe_strings(F.flatten(F.transform(plain, lambda g: T.numbered_parts(g, needs_marker=True)))) if numbers else plain


def relation_words(values: Column) -> Column:
    """Words of a JSON list that holds texts and objects with a word."""
    parts = F.from_json(values, "array<string>")
    return T.dedupe_strings(F.transform(parts, lambda x: F.coalesce(F.get_json_object(x, "$.word"), F.when(~x.startswith("{"), x), F.lit(""))))


def valid_lexeme(x: Column) -> Column:
    c = T.clean(x)
    ends = F.when(F.length(c) == 1, F.concat(c, c)).otherwise(c)
    return (F.length(c) > 0) & (F.length(c) <= 120) & c.rlike(r"\p{L}") & ends.rlike(r"^[\p{L}\p{N}].*[\p{L}\p{N}]$") & ~c.rlike(r"[\p{C}\p{S}]") & ~T.is_single_han(c)


def word_list(spark: SparkSession, path: str, json: bool = False) -> DataFrame:
    """(entry_id, headword) of a list with a word in each line, or an object with its text."""
    lines = numbered(spark, path)
    word = F.get_json_object("line", "$.text") if json else F.col("line")
    return lines.select(F.col("n").cast("string").alias("entry_id"), T.clean(word).alias("headword")).where(valid_lexeme(F.col("headword")))


def hunspell(spark: SparkSession, path: str) -> DataFrame:
    """(entry_id, headword) of .dic files: the first line is a count, flags follow a slash."""
    lines = numbered(spark, path).where("n > 1")
    name = F.element_at(F.split("path", "/"), -1)
    return lines.select(F.concat_ws(":", name, F.col("n").cast("string")).alias("entry_id"), T.clean(F.split("line", "/")[0]).alias("headword")).where(valid_lexeme(F.col("headword")))


def variants(lexemes: DataFrame) -> DataFrame:
    """(key, forms): spellings that differ in where the tone stands."""
    key = F.concat_ws(":", T.strip_tone(F.col("headword")), T.tone_signature(F.col("headword")))
    return lexemes.groupBy(key.alias("key")).agg(F.array_sort(F.collect_set("headword")).alias("forms")).where(F.size("forms") > 1)


def tab_html(spark: SparkSession, path: str) -> DataFrame:
    """(headword, section, html) of lines `headword TAB html`; `hr` parts sections, `##` comments."""
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("##")) & F.contains("value", F.lit("\t")))
    pair = F.split("value", "\t", 2)
    rows = lines.select(pair[0].alias("raw"), F.posexplode(F.split(pair[1], r"(?i)<hr\s*/?>")).alias("section", "html"))
    head = F.regexp_extract("html", r"(?is)<h3[^>]*>(.*?)</h3>", 1)
    own = F.when((F.col("section") == 0) | (head == ""), F.col("raw")).otherwise(T.html_to_text(head))
    name = F.trim(F.regexp_replace(F.regexp_replace(T.clean(own), r"^\x{feff}?@+", ""), "[：:]+$", ""))
    return rows.select(name.alias("headword"), "section", definition_lines(F.col("html")).alias("definitions")).where((F.col("headword") != "") & (F.size("definitions") > 0))


def definition_lines(html: Column) -> Column:
    """The definitions of a fragment: its lines, split at numbers, without list marks."""
    hidden = F.regexp_replace(html, r"(?is)<font[^>]*color=[\"']?\s*white[^>]*>.*?</font>|<h3[^>]*>.*?</h3>", "")
    lines = F.transform(F.split(T.html_to_text(hidden), "\n+"), lambda x: F.regexp_replace(F.regexp_replace(T.clean(x), r"^[-–—]\s*", ""), r"\(\${2,}\)\s*|^\|+\s*", ""))
    parts = F.flatten(F.transform(T.non_empty(lines), lambda x: T.numbered_parts(x)))
    return T.dedupe_strings(F.transform(parts, lambda x: F.regexp_replace(x, r"^[1-9][0-9]?[.)]\s+(?=\S)", "")))


def ragged_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(character, readings, meaning) of lines `char TAB r1|r2 TAB html, perhaps with TABs`."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).select(T.clean(cells[0]).alias("character"), F.split(F.get(cells, F.lit(1)), r"\|").alias("readings"), F.array_join(F.slice(cells, 3, F.greatest(F.size(cells) - 2, F.lit(0))), "\t").alias("html"))
    return rows.where(T.is_single_han(F.col("character"))).select("character", T.dedupe_strings("readings").alias("readings"), T.clean(T.html_to_text(F.col("html"))).alias("meaning"))


def header_tsv(spark: SparkSession, path: str, missing: int = 9_999_999) -> DataFrame:
    """(characters, quoc_ngu, frequency, definition); a frequency of ``missing`` or more is null."""
    cells = F.split("line", "\t")
    rows = numbered(spark, path).where("n > 1 AND line <> ''")
    f = T.int_prefix(F.get(cells, F.lit(1)))
    return rows.select(
        F.col("n").cast("string").alias("entry_id"),
        F.array_join(T.han_chars(F.coalesce(F.get(cells, F.lit(2)), F.lit(""))), "").alias("characters"),
        T.clean(F.get(cells, F.lit(3))).alias("quoc_ngu"),
        F.when(f < missing, f).alias("frequency"),
        F.nullif(T.clean(F.array_join(F.slice(cells, 5, F.greatest(F.size(cells) - 4, F.lit(0))), " ")), F.lit("")).alias("definition"),
    ).where("characters <> ''")


def synset_tab(spark: SparkSession, path: str) -> DataFrame:
    """(synset_id, pos, lemma) of lines `8 digits-pos TAB vie:lemma TAB lemma`."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.startswith("value", F.lit("#")))
    rows = rows.select(cells[0].alias("synset_id"), F.get(cells, F.lit(1)).alias("relation"), T.clean(F.get(cells, F.lit(2))).alias("lemma"))
    pos = F.coalesce(*[F.when(F.right("synset_id", F.lit(1)) == k, v) for k, v in {"n": "danh từ", "v": "động từ", "a": "tính từ", "s": "tính từ", "r": "phó từ"}.items()])
    return rows.where(F.col("synset_id").rlike("^[0-9]{8}-[asnvr]$") & (F.col("relation") == "vie:lemma") & F.col("lemma").rlike(r"\p{IsLatin}")).select("synset_id", pos.alias("pos"), "lemma")


def unihan(spark: SparkSession, path: str) -> DataFrame:
    """Properties of Han characters from a zip of `U+hex TAB field TAB value` files, one row each.

    Of a field with several values the last counts; variants add up.
    """
    members = ("Unihan_Readings.txt", "Unihan_IRGSources.txt", "Unihan_RadicalStrokeCounts.txt", "Unihan_Variants.txt")

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    at = 0
                    for name in z.namelist():
                        if name in members:
                            rows = [x.split("\t")[:3] for x in z.read(name).decode().splitlines() if x and not x.startswith("#") and x.count("\t") >= 2]
                            yield pd.DataFrame([(c, f, v, at + i) for i, (c, f, v) in enumerate(rows)], columns=["code", "field", "value", "ord"])
                            at += len(rows)

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unzip, "code string, field string, value string, ord long")
    hex_ = F.regexp_replace("code", r"^U\+", "")
    last = lambda f: F.max_by("value", F.when(F.col("field") == f, F.col("ord"))).alias(f)
    linked = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("field").endswith("Variant"), F.struct("ord", "value")))), lambda x: F.split(x["value"], r"\s+")))
    wide = rows.groupBy(hex_.alias("hex")).agg(*[last(f) for f in ("kVietnamese", "kDefinition", "kRSUnicode", "kTotalStrokes")], linked.alias("linked"))
    total = T.int_prefix(F.regexp_extract("kTotalStrokes", "[0-9]+", 0))
    radical = F.regexp_extract("kRSUnicode", r"([0-9]+)'?\.([0-9]+)", 1).try_cast("int")
    rest = F.regexp_extract("kRSUnicode", r"([0-9]+)'?\.([0-9]+)", 2).try_cast("int")
    char = lambda h: F.decode(F.unhex(F.lpad(h, 8, "0")), "UTF-32")
    known = F.coalesce("kVietnamese", "kDefinition", radical.cast("string"), total.cast("string")).isNotNull()
    return wide.where(known).select(
        char(F.col("hex")).alias("character"),
        F.coalesce(T.dedupe_strings(F.split("kVietnamese", r"\s+")), F.array().cast("array<string>")).alias("readings"),
        F.col("kDefinition").alias("meaning"),
        radical.alias("radical"),
        # a total of 0 or none leaves the rest unknown
        F.when(total > 0, rest).alias("residual_strokes"),
        total.alias("total_strokes"),
        T.dedupe_strings(F.transform(F.filter("linked", lambda h: F.regexp_replace(h, r"^U\+", "").rlike("^[0-9A-Fa-f]{4,6}$")), lambda h: char(F.regexp_replace(h, r"^U\+", "")))).alias("variants"),
    )


def yaml_map(spark: SparkSession, path: str) -> DataFrame:
    """(word, tag, definition, idx) of `word: [{tag, defs: [{def, examples}]}]`.

    Needs PyYAML; without it, JSON, which is YAML too, can still be read.
    """
    try:
        import yaml
    except ImportError:
        yaml = None

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for frame in batches:
            for text in frame["value"]:
                data = yaml.safe_load(text) if yaml else json.loads(text)
                rows = []
                for word, senses in (data or {}).items():
                    idx = 0
                    for sense in senses or []:
                        for d in sense.get("defs") or []:
                            rows.append((str(word), sense.get("tag"), d.get("def"), idx, [str(x) for x in d.get("examples") or []]))
                            idx += 1
                yield pd.DataFrame(rows, columns=["word", "tag", "definition", "idx", "examples"])

    rows = whole(spark, path).select("value").mapInPandas(parse, "word string, tag string, definition string, idx int, examples array<string>")
    return rows.where(T.clean(F.col("definition")) != "")


def layer(spark: SparkSession, path: str, schema: str | t.StructType) -> DataFrame:
    """Strict JSON lines of a layer; a path that doesn't exist is an empty layer."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    if "*" not in path and not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


#: Abbreviations of an old dictionary, folded.
HISTORICAL_POS = {"c": "danh từ", "d": "động từ", "dg": "động từ", "n": "thán từ", "t": "tính từ"}


class _Tree(HTMLParser):
    """Elements as lists [tag, attributes, children], texts as strings."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root: list = ["", {}, []]
        self.open = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = [tag, {k: v or "" for k, v in attrs}, []]
        self.open[-1][2].append(node)
        if tag not in self.VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1][2].append(data)


def _below(node: list, tag: str) -> Iterator[list]:
    """Elements of a tag below ``node``, outermost ones, in page order."""
    for x in node[2]:
        if isinstance(x, list):
            if x[0] == tag:
                yield x
            else:
                yield from _below(x, tag)


def _all(node: list) -> Iterator[list]:
    """``node`` and all elements below it."""
    yield node
    for x in node[2]:
        if isinstance(x, list):
            yield from _all(x)


def _text(node: list | str, without: tuple = ()) -> str:
    """The text of an element without some of its parts; a line break is a line end."""
    if isinstance(node, str):
        return node
    if node[0] in ("script", "style") or any(node is x for x in without):
        return ""
    return "\n" if node[0] == "br" else "".join(_text(x, without) for x in node[2])


def _blocks(node: list) -> Iterator[tuple]:
    """(is_row, hani, first, head, italic, rest) of the rows and, between them, of the outermost divs that hold none."""
    for x in node[2]:
        if not isinstance(x, list):
            continue
        if x[0] == "tr":
            cells = list(_below(x, "td"))
            if len(cells) < 2:
                yield True, False, "", "", "", ""
                continue
            head = next((y for y in _below(cells[1], "span") if re.search(r"font-size:\s*larger", y[1].get("style", ""))), None)
            italic = next(_below(cells[1], "i"), None)
            yield True, any("Hani" in y[1].get("class", "") for y in _all(cells[0])), _text(cells[0]), _text(head) if head else "", _text(italic) if italic else "", _text(cells[1], (head, italic))
        elif x[0] == "div" and next(_below(x, "tr"), None) is None:
            italic = next(_below(x, "i"), None)
            yield False, False, "", "", _text(italic) if italic else "", _text(x, (italic,))
        else:
            yield from _blocks(x)


def page_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """(page, row, compound, word, pos, han, meaning, parent) of saved wiki pages of an old dictionary.

    Pages of a letter hold tables with a head in each row, then `div`s with
    compounds, whose dashes stand for the head; `id.` repeats the meaning of
    the compound before.  A row's place in the page is its number.  Elements
    may be nested; pages are parsed in batches.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = [(page, at, *x) for page, html in zip(frame["pageid"], frame["html"]) for at, x in enumerate(_blocks(_Tree(html or "").root))]
            yield pd.DataFrame(rows, columns=["page", "at", "is_row", "hani", "first", "head", "italic", "rest"])

    pages = whole(spark, path).select(F.explode(F.from_json("value", "pages array<struct<pageid:long,title:string,revid:long,html:string>>")["pages"]).alias("p")).select("p.*")
    section = F.element_at(F.split("title", "/"), -1)
    wanted = pages.where(section.rlike(r"^[A-ZĐ](?: \(tiếp theo(?: [0-9]+)?\))?$")).select("pageid", "html")
    blocks = wanted.mapInPandas(parse, "page long, at int, is_row boolean, hani boolean, first string, head string, italic string, rest string")
    in_page = Window.partitionBy("page").orderBy("at")
    rows = blocks.withColumn("row", F.sum(F.col("is_row").cast("int")).over(in_page) - 1)
    name = F.regexp_replace(T.clean(F.col("head")), "[.：:]$", "")
    rest = F.regexp_replace(T.clean(F.col("rest")), r"^[.\s:]+", "")
    heads = rows.where("is_row AND hani").select(
        "page", "row", "at", name.alias("word"), T.fold(F.regexp_replace(T.clean(F.col("italic")), "[.()]", "")).alias("code"), T.clean(F.col("italic")).alias("code_text"), T.han_chars(F.col("first")).alias("han"), rest.alias("meaning"),
    ).where(valid_lexeme(F.col("word")) & (F.col("meaning") != ""))
    pos = F.coalesce(*[F.when(F.trim("code") == k, v) for k, v in HISTORICAL_POS.items()], F.nullif(F.col("code_text"), F.lit("")))
    entries = heads.select("page", "row", F.lit(0).alias("compound"), "word", pos.alias("pos"), "han", "meaning", F.lit(None).cast("string").alias("parent"))
    dash = "[―—–-]"
    parts = rows.where("NOT is_row").select("page", "row", "at", T.clean(F.col("italic")).alias("raw"), F.regexp_replace(T.clean(F.col("rest")), r"^[|.\s:]+", "").alias("meaning"))
    of = parts.join(heads.select("page", "row", F.col("word").alias("parent")), ["page", "row"])
    phrase = F.regexp_replace(F.regexp_replace(F.col("raw"), f"^{dash}+", F.concat("parent", F.lit(" "))), f"{dash}+$", F.concat(F.lit(" "), "parent"))
    phrase = F.regexp_replace(T.clean(F.regexp_replace(phrase, "[―—–]+", F.col("parent"))), r"^[.\s:]+|[.\s:]+$", "")
    of = of.withColumn("word", phrase)
    of = of.where(valid_lexeme(F.col("word")) & (F.col("word") != F.col("parent")) & (F.col("meaning") != ""))
    run = Window.partitionBy("page", "row").orderBy("at")
    same = F.col("meaning").rlike(r"(?i)^id\.?$")
    before = F.last(F.when(~same, F.col("meaning")), ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, -1))
    compounds = of.select(
        "page", "row", F.row_number().over(run).alias("compound"), "word", F.lit(None).cast("string").alias("pos"), F.array().cast("array<string>").alias("han"),
        F.when(same, F.coalesce(before, F.col("meaning"))).otherwise(F.col("meaning")).alias("meaning"), "parent",
    )
    return entries.unionByName(compounds)


def json_arrays(spark: SparkSession, folder: str, schema: str | t.StructType) -> DataFrame:
    """The records of a folder of buckets, each file one JSON array."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(folder)


def document(spark: SparkSession, path: str, schema: str) -> dict | None:
    """One JSON document, or None where there is no such file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    row = spark.read.schema(schema).option("multiLine", "true").json(path).first()
    return row.asDict(recursive=True) if row else None


def per_source(spark: SparkSession, root: str, name: str, schema: str, sources: list[str] | None = None) -> DataFrame:
    """Normalised records below ``root/source=<key>/name``; a filter on sources prunes folders.

    Without ``sources`` every folder counts, selected or not.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", root)
    rows = reader.json(f"{root}/source=*/{name}")
    return rows if sources is None else rows.where(F.col("source").isin(*sources))

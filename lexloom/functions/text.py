"""Text functions of the lexical model: cleaning, folding, keys, ids, parsing.

All stay in the JVM.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .unicode_tables import compositions, fold_table, tone_classes, tone_table

#: White space as ECMAScript has it, for use in a class.
WS = r"\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
MARKS = r"[\x{300}-\x{36f}]"
#: The blocks of Han characters.
HAN = (
    r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}\x{2b740}-\x{2b81f}"
    r"\x{2b820}-\x{2ceaf}\x{2ceb0}-\x{2ebef}\x{30000}-\x{3134f}\x{31350}-\x{323af}]"
)
#: Folded words that carry no content.
STOPWORDS = (
    "a", "an", "and", "bi", "boi", "cac", "cho", "co", "con", "cua", "duoc", "de", "la", "lam", "mot", "nhieu", "nhung", "nguoi", "nhu", "o", "su",
    "the", "thu", "trong", "va", "voi",
)
#: Names of parts of speech.
POS_ALIASES = {
    "danh từ": "danh từ", "động từ": "động từ", "tính từ": "tính từ", "phó từ": "phó từ", "trạng từ": "trạng từ", "đại từ": "đại từ",
    "định từ": "định từ", "liên từ": "liên từ", "thán từ": "thán từ", "số từ": "số từ", "noun": "danh từ", "proper noun": "danh từ", "verb": "động từ",
    "adjective": "tính từ", "adj": "tính từ", "adverb": "phó từ", "pronoun": "đại từ", "determiner": "định từ", "conjunction": "liên từ",
    "interjection": "thán từ", "numeral": "số từ", "number": "số từ", "particle": "phụ từ", "prefix": "phụ tố", "suffix": "hậu tố",
    "circumfix": "phụ tố", "character": "khác", "letter": "khác", "symbol": "khác", "other": "khác",
}
POS_CODES = {
    "A": "tính từ", "C": "liên từ", "D": "định từ", "I": "thán từ", "M": "số từ", "N": "danh từ", "P": "đại từ", "R": "phó từ", "V": "động từ", "X": "khác",
}


def compose(x: Column) -> Column:
    """Letters and combining marks as composed letters, as far as Latin, Greek and Cyrillic have them.

    A look at most texts: only one that holds a mark is gone through, letter by
    letter, with the last letter and the next mark looked up as a pair.
    """
    table = F.from_json(F.lit(json.dumps(compositions())), "map<string,string>")

    def pair(done: Column, last: Column) -> Column:
        return F.named_struct(F.lit("done"), done, F.lit("last"), last)

    def step(state: Column, c: Column) -> Column:
        done, last = state["done"], state["last"]
        one = F.when(c.rlike(MARKS), F.try_element_at(table, F.concat(last, c)))
        return F.when(one.isNotNull(), pair(done, one)).otherwise(pair(F.concat(done, last), c))

    return F.when(x.rlike(MARKS), F.aggregate(F.split(x, ""), pair(F.lit(""), F.lit("")), step, lambda s: F.concat(s["done"], s["last"]))).otherwise(x)


def record_hash(x: Column) -> Column:
    """The hash of a raw record, the same for composed and decomposed text."""
    return F.sha2(compose(x), 256)


def clean(x: Column) -> Column:
    """White space collapsed, none before punctuation, trimmed; null gives an empty text.

    Input is taken to be composed, as readers give it; see :func:`clean_text`.
    """
    one = F.regexp_replace(F.coalesce(x, F.lit("")), f"[{WS}]+", " ")
    return F.trim(F.regexp_replace(one, " +([,.;:!?])", "$1"))


def clean_text(x: Column) -> Column:
    """:func:`clean` of any text, which is composed first."""
    return clean(compose(x))


def fold(x: Column) -> Column:
    """Lower case without diacritics."""
    frm, to = fold_table()
    return F.lower(F.regexp_replace(F.translate(x, frm, to), MARKS, ""))


def strip_tone(x: Column) -> Column:
    """Lower case without the five tones; â ă ê ô ơ ư đ stay."""
    frm, to = tone_table()
    return F.lower(F.regexp_replace(F.translate(x, frm, to), "[̣̀́̃̉]", ""))


def short_hash(x: Column) -> Column:
    return F.substring(F.sha1(x.cast("binary")), 1, 8)


def slug(x: Column) -> Column:
    """Folded, runs of other than a-z and 0-9 as one hyphen; a hash where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(fold(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.concat(F.lit("word-"), short_hash(x))).otherwise(s)


def bucket(x: Column) -> Column:
    """The first a-z letter anywhere in the folded word, else `other`."""
    return F.coalesce(F.nullif(F.regexp_extract(fold(x), "[a-z]", 0), F.lit("")), F.lit("other"))


def first_char_bucket(x: Column) -> Column:
    """The first character without its tone, if it is a-z, else `other`: the search index's bucket."""
    c = F.substring(F.trim(strip_tone(x)), 1, 1)
    return F.when(c.rlike("^[a-z]$"), c).otherwise("other")


def merge_key(x: Column) -> Column:
    return F.lower(clean(x))


def non_empty(parts: Column) -> Column:
    return F.filter(parts, lambda p: p != "")


def syllables(x: Column) -> Column:
    return F.greatest(F.lit(1), F.size(non_empty(F.split(clean(x), f"[{WS}-]+"))))


def tone_signature(x: Column) -> Column:
    """Hex code points of the tones, in order, joined by hyphens."""
    chars = F.split(x, "")
    tone = lambda c: F.coalesce(*[F.when(c.rlike(cls), F.lit(code)) for code, cls in tone_classes()])
    return F.array_join(F.filter(F.transform(chars, tone), lambda t: t.isNotNull()), "-")


def dedupe_strings(xs: Column) -> Column:
    return F.array_distinct(non_empty(F.transform(xs, clean)))


def split_examples(x: Column) -> Column:
    """The distinct examples of a text, parted by ` ~ ` or ` | `; see :func:`all_examples` for several."""
    return F.when(clean(x) == "", F.array().cast("array<string>")).otherwise(dedupe_strings(F.split(clean(x), r" +~ +| +\| +")))


def all_examples(xs: Column) -> Column:
    """The distinct examples of an array of texts, each of which may hold several."""
    return dedupe_strings(F.flatten(F.transform(xs, split_examples)))


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key)


def part_of_speech(x: Column) -> Column:
    t = clean(x)
    code = F.when(F.upper(t).rlike("^[A-Z]$"), F.coalesce(_lookup(POS_CODES, F.upper(t)), F.lit("khác")))
    return F.coalesce(_lookup(POS_ALIASES, F.lower(t)), code, t)


def infer_origin(texts: Column, fallback: str = "không rõ") -> Column:
    h = fold(F.array_join(texts, " "))
    sino = h.contains("han viet") | h.contains("sino-vietnamese") | h.contains("goc han")
    loan = h.contains("muon") | h.contains("loanword")
    return F.when(sino, "Hán Việt").when(loan, "vay mượn khác").otherwise(fallback)


def han_chars(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(x, F.lit(HAN), 0))


def is_single_han(x: Column) -> Column:
    return (F.length(x) == 1) & x.rlike(HAN)


def code_point_id(x: Column) -> Column:
    return F.concat(F.lit("u+"), F.hex(F.ascii(x)))


def title_case(x: Column) -> Column:
    """Lower case with a capital at the start of every word; only white space parts words."""
    words = F.split(F.lower(clean(x)), " ")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), " ")


def definition_key(x: Column) -> Column:
    """The key by which definitions are equal: folded, without number, abbreviated part of speech or punctuation."""
    return key_of_clean(clean(x))


def key_of_clean(x: Column) -> Column:
    """:func:`definition_key` of a text that is clean already."""
    k = F.regexp_replace(fold(x), r"^ *[0-9]+[).]? *", "")
    k = F.regexp_replace(k, r"^(d|dt|tt|t|dong tu|danh tu|tinh tu|ph|pht|trt|l|c|id)\. +", "")
    return F.trim(F.regexp_replace(k, r"[^\p{L}\p{N}]+", " "))


def content_tokens(key: Column) -> Column:
    """Tokens of a key of two characters or more that aren't stop words; repeats stay."""
    return F.filter(F.split(key, " "), lambda t: (F.length(t) > 1) & ~t.isin(*STOPWORDS))


def jaccard(a: Column, b: Column, empty: float = 0.0) -> Column:
    """Of two arrays as sets; ``empty`` if both are empty, 0 if one is."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(empty)).otherwise(both / either)


def snippet(x: Column, most: int = 180) -> Column:
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.rtrim(F.substring(x, 1, most - 1)), F.lit("…")))


def length_bucket(x: Column) -> Column:
    """The names of lengths up to 40, 120, 300 characters and beyond."""
    size = F.length(x)
    return F.when(size < 40, "0-39").when(size < 120, "40-119").when(size < 300, "120-299").otherwise("300+")


def token_count(x: Column) -> Column:
    return F.size(non_empty(F.split(x, " ")))


def int_prefix(x: Column) -> Column:
    """The integer that a text starts with, or null: 12abc is 12."""
    return F.regexp_extract(x, f"^[{WS}]*([+-]?[0-9]+)", 1).try_cast("bigint")


def strip_brackets(x: Column) -> Column:
    """Paired [] or // around a transcription removed, and white space within them, at any depth.

    What opens and closes a text is compared from both ends inwards in one
    pass: the pairs that are peeled off are the runs of brackets at its start
    and its end, as long as they match.
    """
    t = F.trim(x)
    opens, closes = F.regexp_extract(t, r"^[\[/ ]*", 0), F.regexp_extract(t, r"[\]/ ]*$", 0)
    left = F.split(F.regexp_replace(opens, " ", ""), "")
    right = F.split(F.reverse(F.regexp_replace(closes, " ", "")), "")
    fits = F.zip_with(left, right, lambda a, b: F.coalesce(((a == "[") & (b == "]")) | ((a == "/") & (b == "/")), F.lit(False)))
    # pairs before the first that doesn't match
    depth = F.when((F.size(fits) == 0) | ~F.exists(fits, lambda f: ~f), F.size(fits)).otherwise((F.array_position(fits, F.lit(False)) - 1).cast("int"))

    def peel(state: Column, _: Column) -> Column:
        return F.trim(F.substring(state, F.lit(2), F.length(state) - 2))

    # a text of brackets alone can't be opened and closed by the same one
    most = F.least(depth, F.floor(F.length(F.regexp_replace(t, " ", "")) / 2).cast("int"))
    return F.when(most > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), t, peel)).otherwise(t)


def numbered_parts(x: Column, needs_marker: bool = False) -> Column:
    """A definition split at its markers `1.`, `2.`, ... in sequence.

    A number that is not the next in turn is part of the text.  What precedes
    the first marker stays with the first part; with ``needs_marker`` a text
    that doesn't start with a marker is one part, and counting starts from it.
    """
    words = F.split(clean(x), " ")
    marker = lambda w: F.regexp_extract(w, r"^([0-9]{1,2})[.)]$", 1).try_cast("int")
    state = F.struct(
        F.array().cast("array<string>").alias("parts"),
        F.lit("").alias("now"),
        (marker(F.get(words, F.lit(0))) if needs_marker else F.lit(1)).alias("next"),
        F.lit(False).alias("begun"),
    )

    def step(s: Column, w: Column) -> Column:
        hit = F.coalesce(marker(w) == s["next"], F.lit(False))
        joined = F.when(s["now"] == "", w).otherwise(F.concat_ws(" ", s["now"], w))
        done = F.when(s["begun"] & (s["now"] != ""), F.concat(s["parts"], F.array(s["now"]))).otherwise(s["parts"])
        return F.when(hit, F.struct(done.alias("parts"), F.when(s["begun"], F.lit("")).otherwise(s["now"]).alias("now"), (s["next"] + 1).alias("next"), F.lit(True).alias("begun"))).otherwise(
            F.struct(s["parts"].alias("parts"), joined.alias("now"), s["next"].alias("next"), s["begun"].alias("begun"))
        )

    return F.aggregate(words, state, step, lambda s: F.when(s["now"] == "", s["parts"]).otherwise(F.concat(s["parts"], F.array(s["now"]))))


#: Character references by name, besides those by number.
REFERENCES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "middot": "·", "copy": "©", "ndash": "–", "mdash": "—", "hellip": "…", "laquo": "«", "raquo": "»"}


def decode_references(x: Column) -> Column:
    """Character references by number, decimal or hexadecimal, and the names of ``REFERENCES``; others stay."""
    parts = F.split(x, "&(?=#?[A-Za-z0-9]{1,8};)")

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, "^([^;]*);", 1)
        point = F.coalesce(F.conv(F.nullif(F.regexp_extract(name, "^#[xX]([0-9A-Fa-f]{1,6})$", 1), F.lit("")), 16, 10).cast("int"), F.regexp_extract(name, "^#([0-9]{1,7})$", 1).try_cast("int"))
        valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        char = F.coalesce(_lookup(REFERENCES, name), F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")))
        return F.when(char.isNotNull(), F.concat(char, F.substring(part, F.length(name) + 2, F.length(part)))).otherwise(F.concat(F.lit("&"), part))

    return F.when(F.contains(x, F.lit("&")), F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")).otherwise(x)


def html_to_text(x: Column) -> Column:
    """Markup and white print removed, `br` as line end, character references decoded."""
    t = F.regexp_replace(F.coalesce(x, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<font[^>]*color=[\"']?\s*white[^>]*>.*?</font>", "")
    return decode_references(F.regexp_replace(F.regexp_replace(t, r"(?i)<br\s*/?>", "\n"), r"(?s)<[^>]*>", ""))


#: Abbreviations of parts of speech in definitions.
ABBREVIATED = {
    "danh từ": "dt|d", "động từ": "đgt|đg", "tính từ": "tt|t", "đại từ": "đt", "trạng từ": "trt", "thán từ": "tht", "liên từ": "lt|l", "phụ từ": "pt",
}


def abbreviated_pos(x: Column, ascii_edges: bool = False) -> Column:
    """Parts of speech that a definition names by abbreviation.

    ``ascii_edges``: a word begins only between an ASCII word character and
    another character, so that abbreviations in đ are never found after a
    space, as in regex dialects that know ASCII words alone.
    """
    edge = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))" if ascii_edges else r"(?<![\p{L}\p{N}_])"
    return F.array_compact(F.array(*[F.when(F.lower(x).rlike(rf"{edge}(?:{codes})\."), F.lit(name)) for name, codes in ABBREVIATED.items()]))


def headword_labels(word: Column, definitions: Column) -> Column:
    """Labels that a headword and its definitions give: names, places, terms, punctuation."""
    text = F.array_join(definitions, " ")
    places = r"(?iu)\((?:xã|huyện|thị trấn|tỉnh|sông|núi|đảo|quận|phường)\)|(?<![\p{L}\p{N}_])[ht]\.\s"
    terms = r"(?iu)(?<![\p{L}\p{N}_])(?:kí hiệu|ký hiệu|viết tắt|nguyên tố|đơn vị đo|bệnh|ngôn ngữ|kinh phật)(?![\p{L}\p{N}_])"
    return F.array_compact(
        F.array(
            F.when(word.rlike("^[A-ZÀ-ỸĐ]"), "proper-name-candidate"),
            F.when(word.rlike("[,;]"), "punctuation-headword-candidate"),
            F.when(text.rlike(places), "place-name-candidate"),
            F.when(text.rlike(terms), "domain-or-encyclopedic-candidate"),
        )
    )


def explicit_dialect(tags: Column, note: Column, known: list[str]) -> Column:
    """Dialects that a sound's tags or note name outright, joined by `; `; null where none does."""
    found = F.array_distinct(F.filter(F.concat(F.coalesce(tags, F.array().cast("array<string>")), F.array(note)), lambda x: x.isin(*known)))
    return F.when(F.size(found) > 0, F.array_join(found, "; "))


def marked(x: Column) -> Column:
    """Struct (meaning, pos): a definition without number and abbreviation, and what that stands for."""
    codes = {
        "d": "danh từ", "dt": "danh từ", "đt": "đại từ", "đg": "động từ", "đgt": "động từ", "t": "tính từ", "tt": "tính từ", "trt": "trạng từ",
        "tht": "thán từ", "lt": "liên từ", "l": "liên từ", "pt": "phụ từ", "pht": "phó từ", "ph": "phó từ",
    }
    c, pattern = clean(x), r"(?iu)^(?:[0-9]+[).]?\s*)?(d|dt|đt|đg|đgt|t|tt|trt|tht|lt|l|pt|pht|ph)\.\s+(.+)$"
    rest = clean(F.regexp_extract(c, pattern, 2))
    hit = c.rlike(pattern) & (rest != "")
    return F.struct(F.when(hit, rest).otherwise(c).alias("meaning"), F.when(hit, _lookup(codes, F.lower(F.regexp_extract(c, pattern, 1)))).alias("pos"))


def strip_line_marker(x: Column) -> Column:
    """A leading `n.` or `n)` removed, where text follows it."""
    return F.regexp_replace(x, r"^[1-9][0-9]?[.)]\s+(?=\S)", "")


def file_name(x: Column) -> Column:
    """A name that every file system takes: folded, other characters as one hyphen."""
    return F.regexp_replace(fold_case(x), "[^A-Za-z0-9._-]+", "-")


def fold_case(x: Column) -> Column:
    """Without diacritics, in the case that it has."""
    frm, to = fold_table()
    return F.regexp_replace(F.translate(x, frm, to), MARKS, "")


def escape_xml(x: Column) -> Column:
    out = F.coalesce(x, F.lit(""))
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def escape_csv(x: Column) -> Column:
    """Quoted where a comma, a quote or a line end asks for it."""
    t = F.coalesce(x.cast("string"), F.lit(""))
    return F.when(t.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)


def cell_text(xs: Column) -> Column:
    """An array in one cell of a sheet."""
    return F.array_join(F.coalesce(xs, F.array().cast("array<string>")), "; ")


def grouped_number(x: Column) -> Column:
    """An integer with a full stop between groups of three digits."""
    return F.regexp_replace(x.cast("bigint").cast("string"), r"(?<=[0-9])(?=(?:[0-9]{3})+$)", ".")


def percent(part: Column, whole: Column) -> Column:
    """Of a hundred, to two places; 0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part / whole * 100, 2))


def human_bytes(x: Column) -> Column:
    """Bytes with a unit and two places."""
    units = ["B", "KB", "MB", "GB", "TB"]
    out = F.concat(x.cast("bigint").cast("string"), F.lit(" B"))
    for i, unit in enumerate(units[1:], 1):
        out = F.when(x >= 1024**i, F.concat(F.format_string("%.2f", x / F.lit(float(1024**i))), F.lit(f" {unit}"))).otherwise(out)
    return out

"""Layers from small entries; radicals; labels and marks of definitions."""

from pyspark.sql import functions as F

from lexloom.functions import kangxi
from lexloom.functions import text as T
from lexloom.operators import layers


def test_words(spark):
    rows = [
        ("Đi", "a", None, "V", "không rõ", "di chuyển", 0),
        ("đi", "b", "/ɗi/", "động từ", "thuần Việt", "Di chuyển!", 1),
        ("đi", "a", "/x/", "V", "không rõ", "di  chuyển.", 2),
        ("di", "a", None, "V", None, "...", 3),
        ("dì", "a", None, "N", None, "em mẹ", 4),
        ("字", "a", None, "N", None, "chữ", 5),
    ]
    rank = spark.createDataFrame([("a", 0), ("b", 1)], "source string, rank int")
    e = spark.createDataFrame(rows, "word string, source string, ipa string, pos string, origin string, meaning string, ordinal long")
    got = {r.key: r for r in layers.words(layers.ordered(e, rank)).collect()}
    assert set(got) == {"đi", "dì"}
    r = got["đi"]
    assert (r.word, r.ipa, r.origin, r.merged, r.sources, r.part_of_speech) == ("Đi", "/x/", "thuần Việt", 3, ["a", "b"], ["động từ"])
    assert [(d.source, d.meaning) for d in r.definitions] == [("a", "di chuyển"), ("b", "Di chuyển!")]
    assert sorted(x.id.split("-")[0] for x in got.values()) == ["di", "di"] and len({x.id for x in got.values()}) == 2


def test_lexemes_are_no_words(spark):
    e = spark.createDataFrame([("nhà", "a", "h1", 1), ("Nhà", "a", "h1", 0), ("nhà", "b", "h2", 2), ("đi", "a", "h3", 3)], "headword string, source string, record_hash string, ord long")
    got = layers.lexemes(e, spark.createDataFrame([("đi",)], "key string")).collect()
    assert [(r.headword, [tuple(x) for x in r.evidence]) for r in got] == [("Nhà", [("a", "h1"), ("b", "h2")])]


def test_han_is_enriched_only(spark):
    base = spark.createDataFrame([("字", ["tự"], None), ("ab", ["x"], "y")], "character string, readings array<string>, meaning string")
    meta = spark.createDataFrame([("字", ["chữ"], "letter", 39, 6), ("漢", ["hán"], "Han", 85, 14)], "character string, readings array<string>, meaning string, radical int, total_strokes int")
    assert [tuple(r) for r in layers.han(base, meta).collect()] == [("u+5B57", "字", ["tự", "chữ"], "letter", 39, 6)]


def test_evidence_last_wins(spark):
    e = spark.createDataFrame([("a", "x", "s1", 1), ("b", "x", "s2", 2), ("c", "y", "s1", 3)], "headword string, text string, source string, ord long")
    assert sorted((r.headword, r.text) for r in layers.evidence(e).collect()) == [("b", "x"), ("c", "y")]


def test_compact(spark):
    d = "array<struct<meaning:string,language:string,examples:array<string>,labels:array<string>>>"
    rows = [([("m", "en", ["1", "2", "3"], []), ("n", "vi", [], list("abcdef"))],), ([(str(i), "en", [], []) for i in range(5)],)]
    got = [[x.meaning for x in r.v] for r in spark.createDataFrame(rows, f"d {d}").select(layers.compact(F.col("d")).alias("v")).collect()]
    assert got == [["n"], ["0", "1", "2"]]


def test_radicals(spark):
    t = {r.number: (r.radical, r.strokes) for r in kangxi.table(spark).collect()}
    assert len(t) == 214 and t[1] == ("一", 1) and t[39] == ("子", 3) and t[85] == ("水", 4) and t[214] == ("龠", 17)
    df = spark.createDataFrame([(39,), (39,), (300,), (None,)], "radical int")
    assert kangxi.coverage(df).first().radicals == 1
    assert [r.s for r in df.select(kangxi.strokes(F.col("radical")).alias("s")).collect()] == [3, 3, None, None]
    assert kangxi.with_radicals(df, spark).where("radical_character = '子'").count() == 2


def test_marks_and_labels(spark):
    df = spark.createDataFrame([("2. đgt. làm việc", "Hà Nội", ["thủ đô (tỉnh)", "kí hiệu"])], "x string, w string, d array<string>")
    r = df.select(
        T.marked(F.col("x")).alias("m"), T.abbreviated_pos(F.col("x")).alias("p"), T.abbreviated_pos(F.col("x"), True).alias("q"), T.headword_labels(F.col("w"), F.col("d")).alias("l"),
        T.explicit_dialect(F.array(F.lit("Hà Nội"), F.lit("z")), F.lit("Huế"), ["Huế", "Hà Nội"]).alias("e"),
    ).first()
    assert tuple(r.m) == ("làm việc", "động từ") and r.p == ["động từ"] and r.q == []
    assert r.l == ["proper-name-candidate", "place-name-candidate", "domain-or-encyclopedic-candidate"] and r.e == "Hà Nội; Huế"


def test_han_index_and_search(spark):
    c = spark.createDataFrame([("u+1", "水", 85, 4, ["thuỷ"], "water"), ("u+2", "字", 39, 6, ["tự"], None), ("u+3", "一", 1, None, ["nhất"], "one")], "id string, character string, radical int, total_strokes int, readings array<string>, meaning string")
    assert [r.character for r in layers.han_index(c).collect()] == ["一", "水", "字"]
    assert [r.character for r in layers.search_han(c, "").collect()] == ["一", "水"]
    assert [r.character for r in layers.search_han(c, "Wat").collect()] == ["水"]
    assert [r.character for r in layers.search_han(c, "tự").collect()] == ["字"]

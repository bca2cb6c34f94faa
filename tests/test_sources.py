"""Readers on small files of each format, registry, sinks, checks, streaming."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lexloom.operators import checks, merge, review
from lexloom.sources import readers, registry, sinks
from lexloom.streaming import ingest


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_map(spark, tmp_path):
    p = write(tmp_path / "a.json", json.dumps({"đi": [{"definition": "di chuyển", "pos": "V"}, {"definition": " "}], "x": "no list"}))
    assert rows(readers.json_map(spark, p), "word", "idx", "definition") == [("đi", 0, "di chuyển")]


def test_json_lines(spark, tmp_path):
    entry = {"word": "字", "lang": "Vietnamese", "lang_code": "vi", "pos": "character", "sounds": [{"ipa": " "}, {"ipa": "/tɨ˧˥/", "tags": ["Hán-Việt"], "reading": "tự"}], "senses": [{"glosses": ["1. chữ 2. viết"]}]}
    p = tmp_path / "a.jsonl.gz"
    p.write_bytes(gzip.compress(("\n".join([json.dumps(entry, ensure_ascii=False), "{broken", ""])).encode()))
    df = readers.json_lines(spark, str(p))
    got = df.select(
        "word",
        readers.first_ipa(F.col("sounds")).alias("ipa"),
        readers.han_readings(F.col("sounds")).alias("readings"),
        readers.glosses(F.col("senses")[0], numbers=True).alias("glosses"),
        readers.is_han_entry(F.col("word"), F.col("lang"), F.col("lang_code"), F.col("pos")).alias("han"),
        readers.is_vietnamese(F.col("lang"), F.col("lang_code")).alias("vi"),
    ).collect()
    assert [tuple(r) for r in got] == [("字", "/tɨ˧˥/", ["Tự"], ["chữ", "viết"], True, True)]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(p), strict=True).collect()


def test_word_lists(spark, tmp_path):
    p = write(tmp_path / "w.txt", "﻿xin chào\n\n字\n$$$\nđi\n")
    assert rows(readers.word_list(spark, p), "entry_id", "headword") == [("1", "xin chào"), ("5", "đi")]
    p = write(tmp_path / "w.jsonl", '{"text": "nhà"}\n{"other": 1}\n')
    assert rows(readers.word_list(spark, p, json=True), "headword") == [("nhà",)]
    p = write(tmp_path / "vi.dic", "3\nhoà/AB\nhòa\nba\n")
    lexemes = readers.hunspell(spark, p)
    assert rows(lexemes, "entry_id", "headword") == [("vi.dic:2", "hoà"), ("vi.dic:3", "hòa"), ("vi.dic:4", "ba")]
    assert [r.forms for r in readers.variants(lexemes).collect()] == [["hoà", "hòa"]]


def test_tab_html(spark, tmp_path):
    p = write(tmp_path / "t.tab", "## x\ty\n@nhà:\t<font color=white>ẩn</font>1. nơi ở<br>- 2. gia đình<hr/><h3>nhà cửa</h3>chỗ ở\nno tab\n")
    assert [(r.headword, r.section, r.definitions) for r in readers.tab_html(spark, p).orderBy("section").collect()] == [("nhà", 0, ["nơi ở", "gia đình"]), ("nhà cửa", 1, ["chỗ ở"])]


def test_tables(spark, tmp_path):
    p = write(tmp_path / "r.tsv", "字\ttự|chữ\t<b>chữ</b>\tviết\nab\tx\ty\n")
    assert [tuple(r) for r in readers.ragged_tsv(spark, p).collect()] == [("字", ["tự", "chữ"], "chữ viết")]
    p = write(tmp_path / "n.tsv", "id\tf\tc\tq\tg\n1\t12abc\t字x\tchữ\tletter\tmore\n2\t9999999\t漢\thán\n3\t5\tabc\tkhông\n")
    assert rows(readers.header_tsv(spark, p), "entry_id", "characters", "quoc_ngu", "frequency") == [("2", "字", "chữ", 12), ("3", "漢", "hán", None)]
    p = write(tmp_path / "s.tab", "# c\n00001740-n\tvie:lemma\tthực thể\n00001740-q\tvie:lemma\tx\n00001741-v\teng:lemma\ty\n00001742-r\tvie:lemma\t字\n")
    assert rows(readers.synset_tab(spark, p), "synset_id", "pos", "lemma") == [("00001740-n", "danh từ", "thực thể")]


def test_unihan(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "u.zip", "w") as z:
        z.writestr("Unihan_Readings.txt", "# c\nU+5B57\tkVietnamese\tchữ tự\nU+5B57\tkDefinition\told\nU+5B57\tkDefinition\tletter\nU+0041\tkOther\tx\n")
        z.writestr("Unihan_RadicalStrokeCounts.txt", "U+5B57\tkRSUnicode\t39'.3\nU+5B57\tkTotalStrokes\t6 7\n")
        z.writestr("Unihan_Variants.txt", "U+5B57\tkSemanticVariant\tU+5B56 U+21A38\n")
        z.writestr("other.txt", "U+5B57\tkDefinition\tno\n")
    got = readers.unihan(spark, str(tmp_path / "u.zip")).collect()
    assert [tuple(r) for r in got] == [("字", ["chữ", "tự"], "letter", 39, 3, 6, ["孖", "𡨸"])]


def test_yaml_map(spark, tmp_path):
    p = write(tmp_path / "u.yaml", json.dumps({"đi": [{"tag": "V", "defs": [{"def": "move", "examples": ["đi chơi"]}, {"def": ""}]}]}))
    assert rows(readers.yaml_map(spark, p), "word", "tag", "definition", "idx") == [("đi", "V", "move", 0)]


def test_page_snapshot(spark, tmp_path):
    row = '<table><tr><td><span class="Hani">衣</span></td><td><span style="font-size: larger">Áo.</span> <i>c.</i>: đồ mặc trên</td></tr></table>'
    divs = "<div><i>― dài</i> | áo phủ xuống</div><div><i>— lót</i> id.</div><p>x</p><div><i>―</i> không</div>"
    pages = [
        {"pageid": 7, "title": "Từ điển/A", "revid": 1, "html": row + divs + "<table><tr><td>no</td><td>x</td></tr></table>"},
        {"pageid": 8, "title": "Từ điển/Lời tựa", "revid": 1, "html": row},
    ]
    p = write(tmp_path / "d.json", json.dumps({"pages": pages}))
    got = readers.page_snapshot(spark, p)
    assert rows(got, "page", "row", "compound", "word", "pos", "meaning", "parent") == [
        (7, 0, 0, "Áo", "danh từ", "đồ mặc trên", None),
        (7, 0, 1, "Áo dài", None, "áo phủ xuống", "Áo"),
        (7, 0, 2, "Áo lót", None, "áo phủ xuống", "Áo"),
    ]
    assert got.where("compound = 0").first().han == ["衣"]


def test_layer_that_does_not_exist(spark, tmp_path):
    assert readers.layer(spark, str(tmp_path / "none"), "id string").count() == 0


def test_relation_words(spark):
    df = spark.createDataFrame([('["a", {"word": "b"}, {"x": 1}, "a"]',)], "v string")
    assert df.select(readers.relation_words(F.col("v")).alias("w")).first().w == ["a", "b"]


def test_policy(spark):
    sources = registry.registry(spark)
    assert registry.selected(sources, registry.Policy()).count() == 13
    assert registry.selected(sources, registry.Policy.parse("open-only", " hunspell_vi ,")).count() == 10
    data = sources.select(F.col("key").alias("source"))
    without = registry.Policy().without("hunspell_vi")
    assert registry.only_selected(data, sources, without).count() == 12
    assert registry.only_selected(data, sources, without.with_source("hunspell_vi")).count() == 13
    with pytest.raises(PermissionError):
        registry.Policy(frozen=True).check_collection()
    verdicts = {r.key: r.verdict for r in registry.dossier(sources).collect()}
    assert verdicts["chunom_standard"] == "documented-with-rollback" and verdicts["unicode_unihan"] == "ready"


def test_sheets_hold_all_rows(spark):
    assert sinks.csv_with_bom(spark.range(100_003)).count("\r\n") == 100_004
    assert sinks.markdown(spark.range(3), most=3).count("\n") == 5
    with pytest.raises(ValueError):
        sinks.markdown(spark.range(1001))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("áo", 1), ("bà", 2), ("字", 3)], "w string, n int")
    counts = sinks.bucketed(df, F.substring("w", 1, 1), str(tmp_path / "b"))
    assert counts.count() == 3
    sinks.json_lines(df, str(tmp_path / "j"), gzip=True)
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    sums = sinks.checksums(spark, str(tmp_path / "j"))
    assert sums.where("length(sha256) = 64 AND bytes >= 0").count() >= 1
    assert sinks.csv_with_bom(df.limit(1)) == "﻿w,n\r\náo,1\r\n"
    assert sinks.markdown(df.limit(1)).count("|") == 9
    assert json.loads(sinks.document(df.limit(1))) == {"w": "áo", "n": 1}
    sinks.strata(spark.createDataFrame([("d", "a/b", 1)], "dimension string, bucket string, x int"), str(tmp_path / "s"))
    assert (tmp_path / "s" / "dimension=d" / "bucket=a-b").is_dir()
    assert len(sinks.build_id({"a": "1"})) == 16


def test_checks(spark):
    a = spark.createDataFrame([("x", 1), ("y", None), ("x", 2)], "id string, v int")
    b = spark.createDataFrame([("x",), ("z",)], "id string")
    assert rows(checks.violations(a, {"has_v": F.col("v").isNotNull(), "small": F.col("v") < 2}), "rule", "n") == [("has_v", 1), ("small", 2)]
    assert rows(checks.duplicates(a, ["id"]), "id") == [("x",)]
    assert rows(checks.missing(a, "id", b, "id"), "id") == [("y",)]
    assert rows(checks.one_to_one(a, b, "id"), "id") == [("x",), ("y",), ("z",)]
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("d", "e")], "left_id string, right_id string")
    assert rows(checks.pair_invariants(pairs), "a", "b") == [("a", "b"), ("c", "c")]
    assert checks.same_rows(a, a) and not checks.same_rows(a, a.limit(1))
    assert checks.stable(lambda: merge.assign_slugs(spark.createDataFrame([("áo",), ("ao",), ("Ao",)], "word string")).select("word", "id"), spark)
    trace = "struct<source_id:string,raw_record_hash:string,confidence:double,review_status:string>"
    t = spark.createDataFrame([(("s", "a" * 64, 0.5, "machine-checked"),), (("s", "zz", 0.5, "machine-checked"),), (("s", "a" * 64, None, "x"),)], f"t {trace}")
    assert [r.v for r in t.select(checks.valid_trace(F.col("t")).alias("v")).collect()] == [True, False, False]


def test_slugs_and_fingerprint(spark):
    got = {r.word: r.id for r in merge.assign_slugs(spark.createDataFrame([("áo",), ("ao",), ("bà",)], "word string")).collect()}
    assert got["ao"] == "ao" and got["áo"].startswith("ao-") and got["bà"] == "ba"
    ids = spark.createDataFrame([("w", str(i)) for i in range(50)], "layer string, id string")
    assert merge.fingerprint(ids).first() == merge.fingerprint(ids.repartition(7).orderBy(F.desc("id"))).first()


def label(spark, f, left, right, category="near_duplicate"):
    df = spark.createDataFrame([(left, right, category)], "l string, r string, c string")
    return df.select(f(F.col("l"), F.col("r"), F.col("c")).alias("x")).first().x


def test_labels(spark):
    s = review.silver_label
    assert label(spark, s, "x", "y", "exact_cross_source_duplicate").rule == "exact-cross-source-positive-control"
    assert label(spark, s, "dt. đồ dùng lớn", "đồ dùng (cũ) lớn").rule == "semantic-core-exact"
    assert label(spark, s, "Sino-Vietnamese reading of 字", "Sino-Vietnamese reading of 漢").rule == "different-explicit-han-target"
    assert label(spark, s, "dt. một vật", "đgt. làm việc").rule == "different-explicit-pos"
    assert label(spark, s, "một loại cây lớn trong rừng", "một loại cây lớn trong rừng già").label == "near_paraphrase"
    assert label(spark, s, "a", "b").label == "unclear"
    p = review.proxy_label
    assert label(spark, p, "Cây lớn.", "cây lớn").label == "same_sense"
    assert label(spark, p, "", "").score == 0.96
    assert label(spark, p, "một hai ba bốn", "một hai ba bốn năm").label == "near_paraphrase"
    assert label(spark, p, "một hai", "ba bốn", "distant_same_headword").label == "different_sense"


def test_decisions(spark):
    d = spark.createDataFrame([(["x"], ["cross_pos_scope"], "r"), ([], [], "parser_fix"), (["same_raw_record_multiple_ipa_same_source_dialect"], [], "")], "a array<string>, b array<string>, c string")
    got = d.select(review.pronunciation_decision(F.col("a"), F.col("b"), F.col("c")).alias("x")).collect()
    assert [(r.x.decision, r.x.priority) for r in got] == [("split_by_source_entry_or_pos", "high"), ("requires_parser_followup", "high"), ("insufficient_evidence", "medium")]
    n = spark.createDataFrame([("recognized_geographic_label_with_qualifier", "Hà Nội; old; rare"), ("recognized_geographic_label_with_qualifier", "Hà Nội"), ("unrecognized_explicit_note", None)], "g string, n string")
    got = n.select(review.dialect_decision(F.col("g"), F.col("n")).alias("x")).collect()
    assert [(r.x.decision, r.x.dialect, r.x.qualifier, r.x.priority) for r in got] == [
        ("split_label_and_qualifier", "Hà Nội", "old; rare", "high"),
        ("insufficient_evidence", None, "", "high"),
        ("insufficient_evidence", None, "", "medium"),
    ]


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        write(folder / f"{i}.jsonl", "\n".join(json.dumps({"word": w, "lang_code": "vi", "sounds": [{"ipa": "/a/"}], "senses": [{"glosses": ["g"]}]}) for w in ("Đi", "đi", f"w{i}")) + "\n{bad\n")
    q = ingest.headwords(ingest.entries(spark, str(folder), 1)).writeStream.outputMode("complete").format("memory").queryName("heads").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("heads"), "headword", "entries", "senses", "with_ipa") == [("w0", 1, 1, 1), ("w1", 1, 1, 1), ("w2", 1, 1, 1), ("đi", 6, 6, 6)]


def test_folders(spark, tmp_path):
    (tmp_path / "w").mkdir()
    write(tmp_path / "w" / "a.json", '[{"id": "a"}, {"id": "á"}]')
    write(tmp_path / "w" / "b.json", '[{"id": "b"}]')
    assert readers.json_arrays(spark, str(tmp_path / "w"), "id string").count() == 3
    assert readers.document(spark, str(tmp_path / "none.json"), "id string") is None
    assert readers.document(spark, write(tmp_path / "d.json", '{"id": "x"}'), "id string") == {"id": "x"}
    for key in ("a", "b"):
        folder = tmp_path / "n" / f"source={key}"
        folder.mkdir(parents=True)
        write(folder / "words.jsonl", '{"id": "1"}\n\n{"id": "2"}\n')
    assert readers.per_source(spark, str(tmp_path / "n"), "words.jsonl", "id string").count() == 4
    assert rows(readers.per_source(spark, str(tmp_path / "n"), "words.jsonl", "id string", ["b"]), "source", "id") == [("b", "1"), ("b", "2")]


def _parts(spark, tmp_path, keys):
    rows = [(k, "tên gọi", "Brand#1", "TYPE", 7) for k in keys]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").repartition(3, "p_partkey").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_count_of_a_word_list_is_before_key_0_and_negative_keys(spark, tmp_path):
    from lexloom.plans import formats

    got = formats.hunspell_scan(spark, _parts(spark, tmp_path, [-2, -1, 0, 1])).collect()
    assert sorted((r.k, r.headword) for r in got) == [(str(i), "tên gọi") for i in range(2, 6)]


def test_parts_that_differ_in_their_key_alone_are_records_of_their_own(spark, tmp_path):
    from lexloom.plans import formats

    # 13 divides both, and all other rules of the query give both the same
    keys = [26, 26 + 500 * 13 * 3 * 7 * 11 * 2]
    got = formats.raw_facts(spark, _parts(spark, tmp_path, keys)).collect()
    assert len(got) == 4 and len({r.word for r in got}) == 1

"""Expected values of the text functions, from the cases that the model's rules name."""

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T


def value(spark, f, *args):
    df = spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first().v


@pytest.mark.parametrize(
    "f,arg,want",
    [
        (T.clean, "  a  b ,c﻿ !", "a b,c!"),
        (T.clean, None, ""),
        (T.fold, "Đường Việt Nam Ắ", "duong viet nam a"),
        (T.strip_tone, "Đường Ằ ế", "đương ă ê"),
        (T.slug, "Hán-Việt (từ)", "han-viet-tu"),
        (T.bucket, "đi", "d"),
        (T.first_char_bucket, "đi", "other"),
        (T.first_char_bucket, "Ánh", "a"),
        (T.syllables, "hán-việt từ", 3),
        (T.syllables, "", 1),
        (T.tone_signature, "hòa bính", "300-301"),
        (T.definition_key, "2. dt. Đồ dùng!", "do dung"),
        (T.definition_key, "dt. Đồ, dùng", "do dung"),
        (T.part_of_speech, "n", "danh từ"),
        (T.part_of_speech, "Q", "khác"),
        (T.part_of_speech, "Verb", "động từ"),
        (T.part_of_speech, "đặc biệt", "đặc biệt"),
        (T.title_case, "hán-việt TỪ", "Hán-việt Từ"),
        (T.code_point_id, "𡨸", "u+21A38"),
        (T.is_single_han, "字", True),
        (T.is_single_han, "ab", False),
        (T.int_prefix, "12abc", 12),
        (T.int_prefix, "abc", None),
        (T.strip_brackets, "[/ha/]", "ha"),
        (T.strip_brackets, "[ha/", "[ha/"),
        (T.compose, "e\u0301e\u0302\u0323x", "éệx"),
        (T.split_examples, "một ~ hai | một", ["một", "hai"]),
        (T.han_chars, "a字b漢字", ["字", "漢"]),
        (T.snippet, "x" * 200, "x" * 179 + "…"),
    ],
)
def test_function(spark, f, arg, want):
    assert value(spark, f, arg) == want


@pytest.mark.parametrize(
    "arg,needs,want",
    [
        ("1. Phân ra 2. Tìm: 10 chia 2 được 5. 3. Thôi", False, ["Phân ra", "Tìm: 10 chia 2 được 5.", "Thôi"]),
        ("đgt. 1. Một 2. Hai", False, ["đgt. Một", "Hai"]),
        ("10 đồng (tiền)", False, ["10 đồng (tiền)"]),
        ("14. Hùng Anh", True, ["Hùng Anh"]),
        ("49 days after 1. x", True, ["49 days after 1. x"]),
        ("2.", True, []),
        ("", True, []),
    ],
)
def test_numbered_parts(spark, arg, needs, want):
    assert value(spark, lambda x: T.numbered_parts(x, needs), arg) == want


def test_jaccard_of_nothing(spark):
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    rows = df.select(T.jaccard(F.col("a"), F.col("b")).alias("x"), T.jaccard(F.col("a"), F.col("b"), 1.0).alias("y")).collect()
    assert [(r.x, r.y) for r in rows] == [(0, 1), (0, 0), (pytest.approx(1 / 3), pytest.approx(1 / 3))]

import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from pairscore.functions import text
from pairscore.plans.features import text_features

# source, target, then the expected features in the order of NAMES
GOLDEN = [
    ("बारिश रुक गई।", "雨停了。", 13, 4, 3, 3, 2.6, 0, 0, 0, 0, 0.75, 0.8, 0.0),
    ("दुकान नौ बजे खुलती है!", "商店九点开门！", 22, 7, 5, 6, 2.75, 1, 0, 0, 0, 0.833333, 0.875, 0.0),
    ("रेलगाड़ी देर से आई", "火车晚点了", 18, 5, 4, 5, 3.0, 0, 0, 0, 0, 0.8, 0.833333, 0.0),
    ("नदी, पहाड़, जंगल", "河、山、森林", 16, 6, 3, 4, 2.285714, 2, 0, 0, 0, 0.75, 0.714286, 0.0),
    ("वह धीरे धीरे बोलता है।", "他慢慢地说话。", 22, 7, 5, 6, 2.75, 0, 0, 0, 0, 0.666667, 0.75, 0.0),
    ("कीमत ₹१२३ या 45%, (2024)", "价格 45%, (2024) 年。", 24, 17, 5, 3, 1.333333, 3, 3, 9, 6, 0.833333, 0.722222, 0.391304),
    ("", "", 0, 0, 0, 0, 0.0, 0, 0, 0, 0, 0.0, 0.0, 0.0),
]
NAMES = [
    "hindi_length",
    "chinese_length",
    "hindi_word_count",
    "chinese_char_count",
    "length_ratio",
    "punctuation_count_hi",
    "punctuation_count_zh",
    "digit_count_hi",
    "digit_count_zh",
    "vocab_diversity_hi",
    "vocab_diversity_zh",
    "char_alignment",
]


def test_golden_rows(spark):
    rows = [(i, r[0], r[1]) for i, r in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "line_no long, source string, target string")
    got = {r["line_no"]: r for r in text_features(df).collect()}
    for i, row in enumerate(GOLDEN):
        assert [round(got[i][n], 6) for n in NAMES] == list(row[2:]), i


def test_null_texts_give_null_features(spark):
    df = spark.createDataFrame([(0, None, "a b")], "line_no long, source string, target string")
    row = text_features(df).first()
    assert row["hindi_length"] is None and row["char_alignment"] is None
    assert row["chinese_length"] == 3


def test_white_space_is_the_python_set(spark):
    """All code points: a character is stripped here exactly when Python strips it."""
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    ids = spark.range(1, sys.maxunicode + 1).filter("id < 55296 or id > 57343")
    code = F.concat(F.lit("00000078"), F.lpad(F.hex("id"), 8, "0"))  # the letter x first
    made = ids.select("id", F.decode(F.unhex(code), "UTF-32").alias("c"))
    stripped = made.filter(text.strip(F.col("c")) == "x")
    got = {r["id"] for r in stripped.select("id").collect()}
    assert got == {c for c in points if chr(c).isspace()}


def test_digits_and_han_follow_unicode(spark):
    points = [*range(1, 0x3000), *range(0x4DFE, 0x4E02), *range(0x9FFD, 0xA002), 0x1D7D8, 0xFF15]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "id long, c string")
    got = df.select("id", text.digit_count(F.col("c")).alias("d"), text.han_count(F.col("c")).alias("h"))
    for r in got.collect():
        assert r["d"] == (unicodedata.category(chr(r["id"])) == "Nd"), hex(r["id"])
        assert r["h"] == (0x4E00 <= r["id"] <= 0x9FFF), hex(r["id"])


def test_words_split_on_wide_spaces(spark):
    df = spark.createDataFrame([("a　b c\x1fd \x85e",)], "s string")
    assert df.select(text.words(F.col("s"))).first()[0] == "a　b c\x1fd \x85e".split()


@pytest.mark.parametrize("a,b", [("ΟΔΟΣ ΟΔΟΣ", "οδος"), ("İSTANBUL", "istanbul"), ("ÉCOLE", "école")])
def test_lower_case_sets_match_python(spark, a, b):
    df = spark.createDataFrame([(0, a, b)], "line_no long, source string, target string")
    x, y = set(a.lower()), set(b.lower())
    got = text_features(df).first()["char_alignment"]
    assert got == pytest.approx(len(x & y) / len(x | y))


def _overlap(a, b, n):
    if len(a) < n or len(b) < n:
        return 0.0
    x = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    y = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngram_overlaps(spark, n):
    pairs = [
        ("abcabd", "zabcab"),
        ("ab", "abc"),
        ("", ""),
        ("the cat sat on the mat", "on the mat the cat sat"),
        ("我们😀去去", "去去😀我们"),
        ("a b", "ab"),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s string, t string")
    made = text.char_ngram_overlap(df, "s", "t", n, "chars")
    made = text.word_ngram_overlap(made, "s", "t", n, "words")
    for r in made.collect():
        assert r["chars"] == pytest.approx(_overlap(r["s"], r["t"], n))
        assert r["words"] == pytest.approx(_overlap(r["s"].split(), r["t"].split(), n))

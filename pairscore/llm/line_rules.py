"""Line-first cleaning with built-in functions only.

Every line is judged by itself: punctuation (symbols, shouting, marks), navigation (separators,
menu lines) and boilerplate (legal and site phrases in short lines). Failing lines go; a document
goes if too much of its text went, or if it fails the base rules (few words, repeated words).

Null and empty texts have no words and are rejected. Blank lines neither fail nor count.
Whole texts are judged, of any length: repeated three-word windows are found by sorting the
windows of a text, not by comparing them with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
#: Percent of words in repeated windows above which a document fails.
MAX_REPEATED = 50
#: Percent of its word characters that a document must keep.
MIN_KEPT = 50

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# Characters and phrases that the line rules look for.
SEPARATOR = r"[|>»•·]"
MARK = r"[.,;:!?…]"
CALL = r"[!?]"
UPPER_CASE = r"\p{Lu}"
LETTER = r"\p{L}"
MENU = (
    "home", "menu", "next", "previous", "log in", "login", "sign in", "sign up", "search", "share", "back to top",
    "read more", "contact us", "about us", "sitemap", "skip to content",
)
BOILERPLATE = (
    "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "licensed under", "copyright (c)", "copyright ©", "subscribe to our", "lorem ipsum", "powered by",
)
#: Words of a line up to which a phrase makes it boilerplate.
BOILERPLATE_WORDS = 50


def chars_in_words(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\f\r", ""))


def line_fails(line: Column) -> Column:
    """Whether a line breaks one of the rules; blank lines break none."""
    words = F.regexp_count(line, F.lit(WORD))
    chars = chars_in_words(line)
    low = F.lower(line)
    punctuation = (
        (10 * F.regexp_count(line, F.lit(SYMBOL)) > chars)
        | ((words >= 8) & (F.regexp_count(line, F.lit(MARK)) == 0))
        | ((F.regexp_count(line, F.lit(CALL)) >= 5) & (3 * F.regexp_count(line, F.lit(CALL)) > words))
        | (
            (F.regexp_count(line, F.lit(UPPER_CASE)) >= 20)
            & (10 * F.regexp_count(line, F.lit(UPPER_CASE)) > 7 * F.regexp_count(line, F.lit(LETTER)))
        )
    )
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = ((separators >= 3) & (4 * separators >= words)) | F.trim(low).isin(*MENU)
    boilerplate = (words <= BOILERPLATE_WORDS) & any_of([low.contains(p) for p in BOILERPLATE])
    return (words > 0) & (navigation | punctuation | boilerplate)


def any_of(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def shifted(way: str, value: Column, bits: Column) -> Column:
    return F.call_function(f"shift{way}", value, bits)


def repeated_positions(words: str, keys: str) -> Column:
    """Sorted starts of the three-word windows that occur twice or more.

    ``keys`` holds a number per window, sorted: the window's hash above, its position in the low bits. Equal
    hashes stand side by side; the words themselves decide.
    """
    bits = F.length(F.bin(F.size(words)))
    place = lambda key: (key.bitwiseAND(shifted("left", F.lit(1).cast("long"), bits) - 1)).cast("int")
    word = lambda i: F.get(F.col(words), i)

    def same(a: Column, b: Column) -> Column:
        hashes = shifted("right", a, bits) == shifted("right", b, bits)
        return hashes & all_of([word(place(a) + k) == word(place(b) + k) for k in range(3)])

    def repeated(key: Column, i: Column) -> Column:
        before = F.get(F.col(keys), i - 1)
        after = F.get(F.col(keys), i + 1)
        return F.coalesce(same(key, before), F.lit(False)) | F.coalesce(same(key, after), F.lit(False))

    return F.array_sort(F.transform(F.filter(F.col(keys), repeated), place))


def all_of(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def covered(starts: str) -> Column:
    """Words in windows of three at these sorted starts."""
    after = F.concat(F.slice(F.col(starts), 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.lit(2**31 - 1)))
    steps = F.zip_with(F.col(starts), after, lambda a, b: F.least(b - a, F.lit(3)))
    return F.when(F.size(starts) == 0, F.lit(0)).otherwise(
        F.aggregate(steps, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
    )


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the counts of the base rules, the cleaned text and the verdict.

    New columns (existing ones of these names are replaced): n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), base_failed, n_failed_lines, kept_chars (long), cleaned (string), kept (boolean).
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    names += ["n_failed_lines", "kept_chars", "cleaned", "kept"]
    passed = [c for c in df.columns if c not in names]
    body = F.coalesce(F.col(text), F.lit(""))
    first = df.select(
        F.struct(*passed).alias("_doc"),  # so that no column of ``df`` meets the names below
        body.alias("_body"),
        F.array_remove(F.split(body, GAP), "").alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(WORD))).alias("_lines"),
    )
    bits = F.length(F.bin(F.size("_words")))
    word = lambda i: F.get(F.col("_words"), i)
    key = lambda i: shifted(
        "left", shifted("right", F.xxhash64(word(i), word(i + 1), word(i + 2)), bits), bits
    ).bitwiseOR(i.cast("long"))
    windows = F.when(
        F.size("_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("_words") - 3), key)
    ).otherwise(F.array().cast("array<long>"))
    second = first.withColumns(
        {
            "_keys": F.sort_array(windows),
            "_good": F.filter(F.col("_lines"), lambda line: ~line_fails(line)),
        }
    )
    third = second.withColumns(
        {"_starts": repeated_positions("_words", "_keys"), "cleaned": F.array_join("_good", "\n")}
    )
    fourth = third.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": chars_in_words(F.col("_body")).cast("long"),
            "n_symbols": F.regexp_count("_body", F.lit(SYMBOL)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered("_starts").cast("long"),
            "n_failed_lines": (F.size("_lines") - F.size("_good")).cast("long"),
            "kept_chars": chars_in_words(F.col("cleaned")).cast("long"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return fourth.withColumn("base_failed", failed).select(
        "_doc.*",
        *names[:-1],
        (~failed & (100 * F.col("kept_chars") >= MIN_KEPT * F.col("word_chars"))).alias("kept"),
    )

"""Character and word expressions over one text column.

Everything here is a built-in Spark expression, so it stays in the JVM next to
the scan.  Counting by class deletes everything outside the class and takes the
length of the rest: one pass per text and no array of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The character classes of the text features.  ``(?U)`` makes
# ``\s`` cover all Unicode white space; \x1c-\x1f are the four ASCII separators
# it leaves out.
WHITESPACE = r"\s\x1c-\x1f"
HAN = r"一-鿿"
PUNCTUATION = r""".,!?;:()\[\]{}"'"""
DIGIT = r"\p{Nd}"


def strip(text: Column) -> Column:
    """Text without leading and trailing Unicode white space."""
    return F.regexp_replace(text, rf"(?U)^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def count_class(text: Column, char_class: str) -> Column:
    """Number of characters of ``text`` in a regular-expression class."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", ""))


def han_count(text: Column) -> Column:
    return count_class(text, HAN)


def punctuation_count(text: Column) -> Column:
    return count_class(text, PUNCTUATION)


def digit_count(text: Column) -> Column:
    return count_class(text, DIGIT)


def marks(text: Column) -> Column:
    """Only the punctuation and digits of a text, for counting either without a second pass."""
    return F.regexp_replace(text, f"[^{PUNCTUATION}{DIGIT}]+", "")


def words(text: Column) -> Column:
    """White-space separated words; an empty array for blank text."""
    return F.regexp_extract_all(text, F.lit(rf"(?U)[^{WHITESPACE}]+"), F.lit(0))


def chars(text: Column) -> Column:
    """Characters (code points); an empty array for empty text."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.split(text, "")
    )


def char_set(text: Column) -> Column:
    return F.array_distinct(chars(text))


def lower_char_set(text: Column, distinct: Column) -> Column:
    """Characters of the lower-cased text, from the text and its distinct characters.

    Lower-casing looks at one character at a time, so the few distinct ones are
    enough.  The capital sigma is the exception: its lower case depends on its
    neighbours, so a text that has one is lower-cased whole.
    """
    short = F.lower(F.array_join(distinct, ""))
    return F.when(F.contains(text, F.lit("Σ")), char_set(F.lower(text))).otherwise(char_set(short))


def diversity(distinct_items: Column, total: Column) -> Column:
    """Distinct items over total + 1."""
    return F.size(distinct_items) / (total + F.lit(1))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays without repeats; 0.0 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(0.0)).otherwise(shared / F.nullif(union, F.lit(0)))


def char_ngrams(text: Column, n: int) -> Column:
    """All runs of ``n`` characters: look ahead for the run, then move on by one character."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def word_ngrams(items: Column, n: int) -> Column:
    """All runs of ``n`` words, joined by a blank, from ``n`` shifted copies of the word array."""
    count = F.greatest(F.size(items) - F.lit(n - 1), F.lit(0))
    joined = F.slice(items, 1, count)
    for i in range(1, n):
        joined = F.zip_with(
            joined,
            F.slice(items, i + 1, count),
            lambda left, right: F.concat(left, F.lit(" "), right),
        )
    return joined


def _overlap_of_sets(df: DataFrame, output: str, too_short: Column) -> DataFrame:
    overlap = jaccard(F.col("_grams_a"), F.col("_grams_b"))
    return df.withColumn(output, F.when(too_short, F.lit(0.0)).otherwise(overlap)).drop(
        "_grams_a", "_grams_b"
    )


def char_ngram_overlap(
    df: DataFrame, a: str, b: str, n: int = 1, output: str = "char_ngram_overlap"
) -> DataFrame:
    """Adds the Jaccard of two character n-gram sets; 0.0 if either text is shorter than n."""
    staged = df.withColumns(
        {
            "_grams_a": F.array_distinct(char_ngrams(F.col(a), n)),
            "_grams_b": F.array_distinct(char_ngrams(F.col(b), n)),
        }
    )
    return _overlap_of_sets(staged, output, (F.length(a) < n) | (F.length(b) < n))


def word_ngram_overlap(
    df: DataFrame, a: str, b: str, n: int = 1, output: str = "word_ngram_overlap"
) -> DataFrame:
    """The same for words.  The word arrays are made in a step of their own, so only once."""
    staged = df.withColumns({"_words_a": words(F.col(a)), "_words_b": words(F.col(b))})
    staged = staged.withColumns(
        {
            "_grams_a": F.array_distinct(word_ngrams(F.col("_words_a"), n)),
            "_grams_b": F.array_distinct(word_ngrams(F.col("_words_b"), n)),
        }
    )
    too_short = (F.size("_words_a") < n) | (F.size("_words_b") < n)
    return _overlap_of_sets(staged, output, too_short).drop("_words_a", "_words_b")

"""Column names and the feature list every other module refers to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The names and the order of the 31 features.  The order decides
# which of two collinear features survives.
FEATURES = [
    "hindi_length",
    "chinese_length",
    "hindi_word_count",
    "chinese_char_count",
    "length_ratio",
    "length_diff",
    "hindi_avg_word_length",
    "chinese_avg_char_length",
    "length_ratio_normalized",
    "embedding_similarity",
    "labse_similarity",
    "chinese_perplexity",
    "chinese_fluency",
    "embedding_labse_interaction",
    "similarity_avg",
    "similarity_diff",
    "embedding_similarity_squared",
    "labse_similarity_squared",
    "similarity_ratio",
    "char_alignment",
    "length_similarity_interaction",
    "length_perplexity_interaction",
    "length_perplexity_ratio",
    "punctuation_count_hi",
    "punctuation_count_zh",
    "digit_count_hi",
    "digit_count_zh",
    "punctuation_ratio_hi",
    "punctuation_ratio_zh",
    "vocab_diversity_hi",
    "vocab_diversity_zh",
]

# The target column of a feature table and the columns a scoring
# CSV has to carry.
TARGET = "ccmatrix_score"
CSV_SOURCE = "hindi"
CSV_TARGET = "chinese"

# What stands in for a missing signal.
SCORING_DEFAULTS = {
    "embedding_similarity": 0.5,
    "labse_similarity": 0.5,
    "chinese_perplexity": 30.0,
}
FAILED_SENTENCE_PERPLEXITY = 100.0

INT_FEATURES = {
    "hindi_length",
    "chinese_length",
    "hindi_word_count",
    "chinese_char_count",
    "length_diff",
    "punctuation_count_hi",
    "punctuation_count_zh",
    "digit_count_hi",
    "digit_count_zh",
}


@dataclass(frozen=True)
class PairColumns:
    """Where a pair table keeps its id, its two texts and its score."""

    key: str = "line_no"
    source: str = "source"
    target: str = "target"
    score: str = "score"


PAIRS = PairColumns()

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("line_no", T.LongType(), False),
        T.StructField("source", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def feature_schema(features: list[str], target: str = TARGET) -> T.StructType:
    """Schema of a stored feature table: counts are INT, the rest DOUBLE."""
    fields = [
        T.StructField(f, T.IntegerType() if f in INT_FEATURES else T.DoubleType())
        for f in features
    ]
    return T.StructType(fields + [T.StructField(target, T.DoubleType())])

"""The feature job: pair table in, feature table out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairscore.functions import derived, text
from pairscore.operators import signals
from pairscore.operators.collinear import COLLINEAR_LIMIT, Pruned, prune_collinear
from pairscore.operators.filters import select_training
from pairscore.operators.joins import scalar
from pairscore.schema import FEATURES, PAIRS, TARGET, PairColumns
from pairscore.session import materialize


def text_features(df: DataFrame, cols: PairColumns = PAIRS, distinct: tuple[str, str] | None = None) -> DataFrame:
    """Length, punctuation, digit, diversity and overlap features of both texts.

    ``distinct`` names two columns with the distinct characters of the texts, which are dropped; without them
    they are found here.
    """
    s, t = F.col(cols.source), F.col(cols.target)
    sets = [text.chars(F.col(c)) for c in distinct] if distinct else [text.char_set(s), text.char_set(t)]
    # words, marks and character sets are needed more than once: build them in a first step
    staged = df.withColumns(
        {
            "hindi_length": F.length(s),
            "chinese_length": F.length(t),
            "chinese_char_count": text.han_count(t),
            "_marks_s": text.marks(s),
            "_marks_t": text.marks(t),
            "_words": text.words(s),
            "_chars_s": sets[0],
            "_chars_t": sets[1],
        }
    )
    sl, tl = F.col("hindi_length"), F.col("chinese_length")
    one = F.lit(1)
    counted = staged.withColumns(
        {
            "hindi_word_count": F.size("_words"),
            "punctuation_count_hi": text.punctuation_count(F.col("_marks_s")),
            "punctuation_count_zh": text.punctuation_count(F.col("_marks_t")),
            "digit_count_hi": text.digit_count(F.col("_marks_s")),
            "digit_count_zh": text.digit_count(F.col("_marks_t")),
            "_lower_s": text.lower_char_set(s, F.col("_chars_s")),
            "_lower_t": text.lower_char_set(t, F.col("_chars_t")),
        }
    )
    return counted.withColumns(
        {
            "length_ratio": sl / (tl + one),
            "length_diff": F.abs(sl - tl),
            "hindi_avg_word_length": sl / (F.col("hindi_word_count") + one),
            "chinese_avg_char_length": tl / (F.col("chinese_char_count") + one),
            "punctuation_ratio_hi": F.col("punctuation_count_hi") / (sl + one),
            "punctuation_ratio_zh": F.col("punctuation_count_zh") / (tl + one),
            "vocab_diversity_hi": text.diversity(
                F.array_distinct("_words"), F.col("hindi_word_count")
            ),
            "vocab_diversity_zh": text.diversity(F.col("_chars_t"), tl),
            "char_alignment": text.jaccard(F.col("_lower_s"), F.col("_lower_t")),
        }
    ).drop("_words", "_marks_s", "_marks_t", "_chars_s", "_chars_t", "_lower_s", "_lower_t", *(distinct or ()))


def signal_features(
    df: DataFrame,
    lm: DataFrame,
    cols: PairColumns = PAIRS,
    embedding_loader=signals.trigram_encoder,
    labse_loader=signals.bigram_encoder,
) -> DataFrame:
    """The two similarities and the target's perplexity."""
    df = signals.similarity(df, embedding_loader, cols.source, cols.target, "embedding_similarity")
    df = signals.similarity(df, labse_loader, cols.source, cols.target, "labse_similarity")
    return signals.char_lm_perplexity(df, cols.target, lm, "chinese_perplexity", cols.key)


@dataclass(frozen=True)
class RatioRange:
    """Smallest and largest length ratio of the training pairs, kept for scoring."""

    low: float
    high: float

    def normalized(self) -> Column:
        return derived.guarded_minmax(F.col("length_ratio"), F.lit(self.low), F.lit(self.high))


def ratio_bounds(df: DataFrame, cols: PairColumns = PAIRS) -> tuple[Column, Column]:
    """The same range as scalar subqueries, for a plan that runs without a fitted range."""
    ratio = F.length(cols.source) / (F.length(cols.target) + F.lit(1))
    stats = df.agg(F.min(ratio).alias("low"), F.max(ratio).alias("high"))
    return scalar(stats, "low"), scalar(stats, "high")


def derived_features(df: DataFrame) -> DataFrame:
    """Interactions, squares and ratios of the text features and signals."""
    return df.withColumns(
        derived.interaction_features(
            F.col("embedding_similarity"),
            F.col("labse_similarity"),
            F.col("chinese_perplexity"),
            F.col("length_ratio"),
            F.col("chinese_length"),
        )
    )


def row_features(
    df: DataFrame, lm: DataFrame, cols: PairColumns = PAIRS, **loaders
) -> DataFrame:
    """``df`` with the 30 features that depend on nothing but the row itself."""
    made = signal_features(df, lm, cols, **loaders)
    distinct = ("_distinct_s", "_distinct_t")
    for column, output in zip((cols.source, cols.target), distinct):
        made = signals.distinct_characters(made, column, output)
    return derived_features(text_features(made, cols, distinct))


def all_features(
    df: DataFrame,
    lm: DataFrame,
    ratio_range: RatioRange | None = None,
    cols: PairColumns = PAIRS,
    **loaders,
) -> DataFrame:
    """``df`` with the 31 features added, as one lazy plan."""
    made = row_features(df, lm, cols, **loaders)
    if ratio_range is not None:
        return made.withColumn("length_ratio_normalized", ratio_range.normalized())
    low, high = ratio_bounds(df, cols)
    return made.withColumn(
        "length_ratio_normalized", derived.guarded_minmax(F.col("length_ratio"), low, high)
    )


def training_table(
    df: DataFrame,
    lm: DataFrame,
    cols: PairColumns = PAIRS,
    features: list[str] = FEATURES,
    split: str | None = None,
    **loaders,
) -> tuple[DataFrame, RatioRange]:
    """Complete rows ``(key, features, target)`` and the ratio range, fitted on those outside the test split.

    The row features are written first.  The range then comes from one stored
    column and not from another pass over the texts.  Incomplete rows are dropped
    after the write as well: a filter on computed columns would be pushed below
    them, and every text and model would be worked twice.
    """
    made = row_features(df, lm, cols, **loaders).withColumnRenamed(cols.score, TARGET)
    per_row = [f for f in features if f not in ("length_ratio", "length_ratio_normalized")]
    keep = [cols.key, *([split] if split else [])]
    stored = materialize(made.select(*keep, "length_ratio", *per_row, TARGET), "features")
    low, high = fitting_rows(stored, split).agg(F.min("length_ratio"), F.max("length_ratio")).first()
    ratio_range = RatioRange(low, high)
    full = stored.withColumn("length_ratio_normalized", ratio_range.normalized())
    return select_training(full, features, TARGET, keep=keep), ratio_range


def fitting_rows(df: DataFrame, split: str | None) -> DataFrame:
    """The rows that may be fitted on: all but those whose ``split`` is test."""
    return df.filter(F.col(split) != "test") if split else df


@dataclass(frozen=True)
class FeatureJob:
    table: DataFrame
    features: list[str]
    pruned: Pruned
    lm: DataFrame
    ratio_range: RatioRange


def build_features(
    df: DataFrame,
    cols: PairColumns = PAIRS,
    limit: float = COLLINEAR_LIMIT,
    features: list[str] = FEATURES,
    lm: DataFrame | None = None,
    split: str | None = None,
    **loaders,
) -> FeatureJob:
    """Signals, features, cleaning and pruning.

    ``split`` names a column that tells test rows: they get features like all others, but the
    language model, the ratio range and the pruning never see them.

    The texts are read twice: the target side for the language model, both sides
    for the features.  The feature table is written once; the correlation pass,
    every later fit and the final selection read it.
    """
    if lm is None:
        lm = materialize(signals.fit_char_lm(fitting_rows(df, split), cols.target), "char-lm")
    table, ratio_range = training_table(df, lm, cols, features, split, **loaders)
    pruned = prune_collinear(fitting_rows(table, split), features, limit)
    keep = [cols.key, *([split] if split else [])]
    return FeatureJob(
        table.select(*keep, *pruned.kept, TARGET), pruned.kept, pruned, lm, ratio_range
    )

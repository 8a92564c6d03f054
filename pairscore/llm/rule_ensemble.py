"""Quality as a sparse ensemble of rules over text statistics.

Small trees are grown on the labelled texts' statistics; every path from a root becomes a
conjunctive rule; a logistic model with a lasso penalty over the rules keeps few of them; the
kept rules are compiled into one column expression, so scoring is a projection without Python.

Statistics are built-in expressions over the whole text; a class is counted by the length of what is
left of the text, never by an array of its members. Null texts count as empty texts, which
have all statistics 0 and get a score like any other. Without labels of both kinds the score is
the share of label 1 (0.5 without labels). A doc_id with several labels trains with each of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_class
from ..session import materialize
from .line_rules import GAP, WORD, chars_in_words

#: Labelled rows that are used for fitting, about; the rows with the lowest hashes.
MAX_ROWS = 20_000
TREES, DEPTH, LASSO = 16, 3, 0.002
SEED = 7

STATISTICS = (
    "words", "word_length", "longest_word", "short_words", "distinct_words", "echoed_words", "lines", "line_words",
    "distinct_lines", "symbols", "separators", "marks", "calls", "upper", "digits", "letters", "ended_lines",
)

# Members of the character classes that are counted.
SYMBOLS, SEPARATORS, MARKS, CALLS, DIGITS = r"#*$%&<>{}^~=@\\", "|»•·", ".,;:", "!?", "0-9"
#: Only these are left of a text before they are counted one class after the other.
SIGNS = SYMBOLS + SEPARATORS + MARKS + CALLS + DIGITS


def share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def with_statistics(df: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """``df`` plus the struct ``into`` of ``STATISTICS``; a column of that name is replaced."""
    kept = [c for c in df.columns if c != into]
    body = F.coalesce(F.col(text), F.lit(""))
    parts = df.select(
        F.struct(*kept).alias("_doc"),  # so that no column of ``df`` meets the names below
        body.alias("_body"),
        F.array_remove(F.split(body, GAP), "").alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(WORD))).alias("_lines"),
        F.regexp_replace(body, f"[^{SIGNS}]+", "").alias("_signs"),
        chars_in_words(body).alias("_chars"),  # a divisor of many: a pass over the text for each use otherwise
    )
    words, lines, chars = F.size("_words"), F.size("_lines"), F.col("_chars")
    count = lambda members, of="_signs": count_class(F.col(of), members)
    echoed = F.zip_with(
        F.col("_words"), F.slice(F.col("_words"), 2, F.greatest(words, F.lit(1))), lambda a, b: F.coalesce(a == b, F.lit(False))
    )
    values = {
        "words": words,
        "word_length": share(chars, words),
        "longest_word": F.aggregate("_words", F.lit(0), lambda a, w: F.greatest(a, F.length(w))),
        "short_words": share(F.size(F.filter("_words", lambda w: F.length(w) <= 2)), words),
        "distinct_words": share(F.size(F.array_distinct("_words")), words),
        "echoed_words": share(F.size(F.filter(echoed, lambda x: x)), words),
        "lines": lines,
        "line_words": share(words, lines),
        "distinct_lines": share(F.size(F.array_distinct("_lines")), lines),
        "symbols": share(count(SYMBOLS), chars),
        "separators": share(count(SEPARATORS), words),
        "marks": share(count(MARKS), words),
        "calls": share(count(CALLS), words),
        "upper": share(count(r"\p{Lu}", "_body"), chars),
        "digits": share(count(DIGITS), chars),
        "letters": share(count(r"\p{L}", "_body"), chars),
        "ended_lines": share(F.size(F.filter("_lines", lambda x: F.regexp_like(x, F.lit(r"[.!?]\s*$")))), lines),
    }
    struct = F.struct(*[values[name].cast("double").alias(name) for name in STATISTICS])
    return parts.select("_doc.*", struct.alias(into))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, "<=" or ">", threshold) and its weight."""

    tests: tuple[tuple[str, str, float], ...]
    weight: float = 0.0

    def holds(self, statistics: str) -> Column:
        out = None
        for name, sign, threshold in self.tests:
            value = F.col(f"{statistics}.{name}")
            test = value <= threshold if sign == "<=" else value > threshold
            out = test if out is None else out & test
        return out


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, statistics: str = "statistics") -> Column:
        """Probability of label 1 as one column expression."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.holds(statistics), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def constant(probability: float) -> RuleModel:
    import math

    p = min(max(probability, 1e-6), 1 - 1e-6)
    return RuleModel((), math.log(p / (1 - p)))


def paths(node, tests: tuple, found: set) -> None:
    """The conjunctions of all nodes below the root."""
    if tests:
        found.add(simplified(tests))
    if node.subtreeDepth() == 0:
        return
    split = node.split()
    name, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
    paths(node.leftChild(), (*tests, (name, "<=", threshold)), found)
    paths(node.rightChild(), (*tests, (name, ">", threshold)), found)


def simplified(tests: tuple) -> tuple:
    """One bound per statistic and side, sorted."""
    bounds: dict[tuple[str, str], float] = {}
    for name, sign, threshold in tests:
        old = bounds.get((name, sign))
        keep = threshold if old is None else min(old, threshold) if sign == "<=" else max(old, threshold)
        bounds[name, sign] = keep
    return tuple(sorted((name, sign, threshold) for (name, sign), threshold in bounds.items()))


def labelled(docs: DataFrame, labels: DataFrame, text: str, max_rows: int) -> DataFrame:
    """Texts of about ``max_rows`` labelled documents, chosen by a hash of doc_id, with the column ``label``.

    ``labels`` has doc_id and label. The chosen labels are at most about ``max_rows`` small rows, so they are
    broadcast and the texts are filtered where they lie.
    """
    usable = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", F.col("label").cast("double"))
    count = usable.count()
    if count > max_rows:
        level = int(max_rows / count * 2**31)
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < level)
    return docs.select("doc_id", text).join(F.broadcast(usable), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = MAX_ROWS) -> RuleModel:
    """Rules and weights from ``labels`` (doc_id, label 0 or 1) and the texts of those documents."""
    chosen = with_statistics(labelled(docs, labels, text, max_rows), text).select(
        "label", F.array(*[F.col(f"statistics.{name}") for name in STATISTICS]).alias("values")
    )
    stored = materialize(chosen, "quality-training").coalesce(8)
    seen = {float(r["label"]): r["count"] for r in stored.groupBy("label").count().collect()}
    if len(seen) < 2:
        return constant(seen.get(1.0, 0) / sum(seen.values()) if seen else 0.5)
    rows = stored.withColumn("features", array_to_vector("values"))
    forest = RandomForestClassifier(
        labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="0.5", subsamplingRate=0.8, seed=SEED
    ).fit(rows)
    found: set = set()
    for tree in forest.trees:
        paths(tree._call_java("rootNode"), (), found)
    if not found:
        return constant(seen[1.0] / sum(seen.values()))
    rules = [Rule(tests) for tests in sorted(found)]
    struct = F.struct(*[F.get(F.col("values"), i).alias(name) for i, name in enumerate(STATISTICS)])
    flags = F.array(*[rule.holds("statistics").cast("double") for rule in rules])
    ruled = stored.select("label", struct.alias("statistics")).select("label", array_to_vector(flags).alias("features"))
    lasso = LogisticRegression(
        labelCol="label", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60, tol=1e-5
    ).fit(materialize(ruled, "quality-rules").coalesce(8))
    weighted = tuple(
        Rule(rule.tests, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w != 0
    )
    return RuleModel(weighted, float(lasso.intercept))


def score(df: DataFrame, model: RuleModel, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` plus ``into``: the probability of label 1."""
    kept = [c for c in df.columns if c != into]
    judged = with_statistics(df.select(F.struct(*kept).alias("doc"), F.col(text).alias("text")), "text")
    return judged.select("doc.*", model.score().alias(into))

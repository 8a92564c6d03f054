"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in the features of its words: the word and its prefixes,
hashed into ``BUCKETS``. A document's probability is the noisy-or of its sentences, and that is
what the labels train, so blame goes to the sentences that explain a label. Scoring also
locates the offending sentences.

Only buckets that differ between the labels get a weight; they and the weights have a fixed
bound, whatever the size of the corpus. Texts without words score 0, null texts too. Without
labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .columns import add_columns
from .rule_ensemble import labelled

#: Labelled documents used for fitting, about.
MAX_ROWS = 20_000
BUCKETS = 1 << 18
#: Buckets with a weight at most: those that differ most.
WEIGHTED = 4096
PREFIXES = (3, 4, 5, 6)
STEPS, RATE, DECAY = 40, 0.2, 3e-6
#: Words that a task remembers.
REMEMBERED = 200_000

SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
EDGE = "\"'()[]{}.,;:!?*#$%&<>|-_«»¿¡"
SCORED = "score double, offending array<struct<start:int,end:int,score:double>>"


def buckets(word: str) -> list[int]:
    """The hashed features of a word."""
    word = word.strip(EDGE).lower()
    if not word:
        return []
    parts = ["w " + word] + [f"p {word[:n]}" for n in PREFIXES if len(word) > n]
    return [xxhash.xxh3_64_intdigest(p) % BUCKETS for p in parts]


class Remembered(dict):
    """Values of words, computed once; forgotten when there are too many."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = self.value(word)
        return found


@dataclass(frozen=True)
class SentenceModel:
    """Weights of the chosen buckets, and the bias."""

    index: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        table = dict(zip(self.index.tolist(), self.weights.tolist()))
        words = Remembered(lambda w: sum(table.get(b, 0.0) for b in buckets(w)))
        at = words.__getitem__

        def score(text: str | None) -> tuple[float, list[dict]]:
            clean, offending = 0.0, []
            for match in SENTENCE.finditer(text or ""):
                found = match.group().split()
                if not found:
                    continue
                z = min(self.bias + sum(map(at, found)), 40.0)
                clean -= np.logaddexp(0.0, z) if z > -20 else np.exp(z)
                if z >= 0:
                    start, end = match.span()
                    offending.append({"start": start, "end": end, "score": float(1 / (1 + np.exp(-z)))})
            return float(-np.expm1(clean)), offending

        return score


NOTHING = SentenceModel(np.zeros(0, np.int64), np.zeros(0), -np.inf)


def bucket_counts(rows: DataFrame) -> dict:
    """Documents by bucket and label; at most BUCKETS rows reach the driver."""

    def run(batches):
        words = Remembered(buckets)
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen = {b for w in set((text or "").split()) for b in words[w]}
                total[int(label), list(seen)] += 1
        used = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(total[0, used]), pa.array(total[1, used])], names=["bucket", "clean", "toxic"]
        )

    parts = rows.mapInArrow(run, "bucket bigint, clean bigint, toxic bigint")
    return parts.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()


def choose(counts, clean: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets whose log odds differ by over three standard errors, at most the clearest ``WEIGHTED``, and the odds."""
    a, b = counts["toxic"].to_numpy() + 0.5, counts["clean"].to_numpy() + 0.5
    odds = np.log(a / (toxic + 1 - a).clip(0.5)) - np.log(b / (clean + 1 - b).clip(0.5))
    strength = np.abs(odds) / np.sqrt(1 / a + 1 / b)
    order = np.lexsort((counts["bucket"].to_numpy(), -strength))
    order = order[strength[order] > 3][:WEIGHTED]
    chosen = counts["bucket"].to_numpy()[order]
    by_bucket = np.argsort(chosen)
    return chosen[by_bucket], odds[order][by_bucket]


def bags(rows: DataFrame, index: np.ndarray) -> DataFrame:
    """Per document its label, the number of its sentences, and (sentence, chosen feature) pairs."""

    def run(batches):
        words = Remembered(lambda w: [int(p) for b in buckets(w) if (p := np.searchsorted(index, b)) < len(index) and index[p] == b])
        for batch in batches:
            out = {"label": [], "sentences": [], "sentence": [], "feature": []}
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                places, features, number = [], [], 0
                for match in SENTENCE.finditer(text or ""):
                    found = match.group().split()
                    if found:
                        mine = [f for w in found for f in words[w]]
                        features += mine
                        places += [number] * len(mine)
                        number += 1
                if number:
                    for name, value in zip(out, (label, number, places, features)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, BAGS)

    return rows.mapInArrow(run, "label double, sentences int, sentence array<int>, feature array<int>")


BAGS = pa.schema(
    [("label", pa.float64()), ("sentences", pa.int32()), ("sentence", pa.list_(pa.int32())), ("feature", pa.list_(pa.int32()))]
)


def gradient(stored: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """Gradient of the log-likelihood, summed over documents; the last entry is the bias's."""

    def run(batches):
        total, rows = np.zeros(len(weights)), 0
        for batch in batches:
            label = batch.column("label").to_numpy()
            sizes = batch.column("sentences").to_numpy().astype(np.int64)
            first = np.cumsum(sizes) - sizes
            lists, features = batch.column("sentence"), batch.column("feature").flatten().to_numpy()
            lengths = np.diff(lists.offsets.to_numpy())
            sentence = lists.flatten().to_numpy() + np.repeat(first, lengths)
            z = np.bincount(sentence, weights[features], minlength=int(sizes.sum())) + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            clean = np.exp(np.add.reduceat(np.log1p(-p.clip(max=1 - 1e-12)), first)) if len(sizes) else np.zeros(0)
            blame = np.where(label > 0.5, clean / np.maximum(1 - clean, 1e-12), -1.0)
            step = p * np.repeat(blame, sizes)
            total[:-1] += np.bincount(features, step[sentence], minlength=len(weights) - 1)
            total[-1] += step.sum()
            rows += len(label)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([rows])], names=["gradient", "rows"])

    parts = stored.mapInArrow(run, "gradient array<double>, rows bigint").collect()
    return sum((np.array(r["gradient"]) for r in parts), np.zeros(len(weights))), sum(r["rows"] for r in parts)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = MAX_ROWS) -> SentenceModel:
    """Sentence weights from ``labels`` (doc_id, label 0 or 1) and the texts of those documents."""
    chosen = labelled(docs.select("doc_id", F.col(text).alias("text")), labels, "text", max_rows)
    rows = materialize(chosen.select("label", "text"), "toxicity-training")
    seen = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    if len(seen) < 2:
        return NOTHING
    index, odds = choose(bucket_counts(rows), seen[0], seen[1])
    if not len(index):
        return NOTHING
    stored = materialize(bags(rows, index), "toxicity-bags").coalesce(8)
    weights = np.append(odds.clip(-2, 6) / 2, -8.0)  # begins where each feature alone would stand
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):  # Adam; each step is one pass over the bags
        slope, rows_seen = gradient(stored, weights)
        slope = slope / max(rows_seen, 1) - DECAY * np.append(weights[:-1], 0.0)
        mean, square = 0.9 * mean + 0.1 * slope, 0.95 * square + 0.05 * slope**2
        weights = weights + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.95**step)) + 1e-9)
    return SentenceModel(index, weights[:-1], float(weights[-1]))


def score(df: DataFrame, model: SentenceModel, text: str = "text") -> DataFrame:
    """``df`` plus score (noisy-or of the sentences) and offending (sentences of 0.5 or more, with code point offsets)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        of = shared.value.scorer()

        def compute(texts):
            rows = [of(t) for t in texts]
            return {"score": [r[0] for r in rows], "offending": [r[1] for r in rows]}

        return compute

    return add_columns(df, SCORED, text, make)

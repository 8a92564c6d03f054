"""Model signals as batch jobs: sentence vectors, similarities, fluency.

A model is given as a *loader*: a function without arguments that returns the
model.  Every Python worker calls it once and keeps the result, so a task does
not load weights again.  The two shipped models need no weights: hashed
character n-grams as the encoder and a character bigram model for fluency.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.joins import HOT_SHARE, lookup, scalar
from pairscore.schema import FAILED_SENTENCE_PERPLEXITY
from pairscore.session import materialize

Encoder = Callable[[list[str]], np.ndarray]
Scorer = Callable[[list[str]], np.ndarray]

# Batch sizes, and the width of the two vectors.
ENCODER_BATCH = 64
SCORER_BATCH = 8
EMBEDDING_DIM = 384
LABSE_DIM = 768

# Texts that are ordered by length together before they are cut into batches.
REORDERED = 2048

# Characters whose n-grams are held at once: a longer text goes through in pieces, short ones together.
PORTION = 1 << 19
# Distinct bigrams that a task holds before it passes them on.
COUNTED = 1 << 20

LM_BROADCAST_ROWS = 2_000_000
# Pairs of characters whose log p is held as a table by every worker.
MOST_CHANCES = 1 << 20
# Marks that a portion may need for which characters its pieces have; beyond that they are sorted.
MOST_MARKS = 1 << 24
CODE_BITS = 21
START = 0x110000


@lru_cache(maxsize=4)
def loaded(loader):
    """The model of a loader, kept for the life of the Python worker.

    This needs a loader the worker can import, from a module sent with
    ``--py-files``; one defined in a script is called once per task.
    """
    return loader()


def joined_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of a batch as one array, and the length of each text."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4"), lengths


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of a batch as one array, and the row each belongs to."""
    codes, lengths = joined_codes(texts)
    return codes.astype(np.int64), np.repeat(np.arange(len(texts)), lengths)


def portions(texts: list[str], lead: int):
    """Pieces of the texts with about ``PORTION`` characters at a time, as (pieces, their rows, whether each goes on a text).

    A piece that goes on a text starts with the ``lead`` characters before it.
    """
    pieces, rows, goes_on, held = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), PORTION):
            if held and held + min(len(text) - at, PORTION) > PORTION:
                yield pieces, np.array(rows), np.array(goes_on)
                pieces, rows, goes_on, held = [], [], [], 0
            pieces.append(text[max(at - lead, 0) : at + PORTION])
            rows.append(row)
            goes_on.append(at > 0)
            held += len(pieces[-1])
    if pieces:
        yield pieces, np.array(rows), np.array(goes_on)


class HashedNgrams:
    """Unit vectors of hashed character n-gram counts; zeros for shorter texts."""

    def __init__(self, n: int, dim: int, multiplier: int):
        self.n, self.dim, self.multiplier = n, dim, multiplier

    def __call__(self, texts: list[str]) -> np.ndarray:
        # half as wide, a hash is made and divided several times as fast
        largest = START * sum(self.multiplier**i for i in range(self.n))
        width = np.uint32 if largest < 1 << 32 else np.int64
        dim = width(self.dim)
        counts = np.zeros(len(texts) * self.dim, dtype=np.int64)
        for pieces, of, _ in portions(texts, self.n - 1):
            codes, lengths = joined_codes(pieces)
            codes = codes.astype(width, copy=False)
            held = max(len(codes) - self.n + 1, 0)
            hashed = codes[:held].copy()
            for i in range(1, self.n):
                hashed *= width(self.multiplier)
                hashed += codes[i : i + held]
            hashed -= hashed // dim * dim
            cells = np.repeat(of * self.dim, lengths)[:held]
            cells += hashed
            # runs that reach into the next piece go to a cell behind all others
            ends = np.cumsum(lengths)
            for i in range(1, self.n):
                across = ends - i
                cells[across[(across >= 0) & (across < held)]] = len(counts)
            counts += np.bincount(cells, minlength=len(counts) + 1)[:-1]
        vectors = counts.reshape(len(texts), self.dim).astype(np.float64)
        norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return vectors / np.where(norms == 0.0, 1.0, norms)


def trigram_encoder() -> Encoder:
    return HashedNgrams(3, EMBEDDING_DIM, 31)


def bigram_encoder() -> Encoder:
    return HashedNgrams(2, LABSE_DIM, 131)


def _parts(*columns: pa.Array, size: int = REORDERED):
    """``size`` rows of Arrow columns at a time as lists, so that the strings of a whole batch are never held."""
    for at in range(0, len(columns[0]), size):
        yield tuple(c.slice(at, size).to_pylist() for c in columns)


def by_length(texts: list, size: int, run: Callable[[list[str]], list], together: int = REORDERED) -> list:
    """What ``run`` gives for every text, in the order of the texts; NULL counts as empty.

    ``run`` takes up to ``size`` texts. ``together`` texts at a time are put in order of length
    first, so those of a batch are of like length and a model that pads them pads little. The
    order of equal lengths is kept, and ``together`` bounds what is held.
    """
    out: list = []
    for at in range(0, len(texts), together):
        part = [t if t is not None else "" for t in texts[at : at + together]]
        order = np.argsort([len(t) for t in part], kind="stable")
        values: list = [None] * len(part)
        for start in range(0, len(part), size):
            places = order[start : start + size]
            for place, value in zip(places, run([part[i] for i in places]), strict=True):
                values[place] = value
        out.extend(values)
    return out


def encode(
    df: DataFrame,
    column: str,
    loader: Callable[[], Encoder] = trigram_encoder,
    output: str = "embedding",
    batch: int = ENCODER_BATCH,
) -> DataFrame:
    """Adds the sentence vector of a text column as ``ARRAY<FLOAT>``; NULL for NULL."""

    @F.arrow_udf("array<float>")
    def vectors(texts: pa.Array) -> pa.Array:
        made = [pa.array([], type=pa.list_(pa.float32()))]
        for (values,) in _parts(texts):
            out = by_length(values, batch, lambda part: np.asarray(loaded(loader)(part), dtype=np.float32))
            rows = [v if t is not None else None for t, v in zip(values, out)]
            made.append(pa.array(rows, type=pa.list_(pa.float32())))
        return pa.concat_arrays(made)

    return df.withColumn(output, vectors(F.col(column)))


def similarity(
    df: DataFrame,
    loader: Callable[[], Encoder] = trigram_encoder,
    source: str = "source",
    target: str = "target",
    output: str = "embedding_similarity",
    batch: int = ENCODER_BATCH,
) -> DataFrame:
    """Cosine of both sides' vectors.  The vectors stay in the worker; one number returns."""

    @F.arrow_udf("double")
    def cosines(a: pa.Array, b: pa.Array) -> pa.Array:
        model = loaded(loader)
        sims: list[float | None] = []
        for left, right in _parts(a, b):
            # each side in its own order of length
            x, y = (by_length(side, batch, lambda part: np.asarray(model(part))) for side in (left, right))
            known = (s is not None and t is not None for s, t in zip(left, right))
            sims.extend(float((u * v).sum()) if k else None for u, v, k in zip(x, y, known))
        return pa.array(sims, type=pa.float64())

    return df.withColumn(output, cosines(F.col(source), F.col(target)))


def score_text(
    df: DataFrame,
    column: str,
    loader: Callable[[], Scorer],
    output: str = "chinese_perplexity",
    default: float | None = FAILED_SENTENCE_PERPLEXITY,
    batch: int = SCORER_BATCH,
    flag: str | None = None,
) -> DataFrame:
    """One number per sentence from a pluggable scorer; ``default`` where it fails, NULL for NULL.

    A batch counts only as a whole: if the scorer fails midway or returns another number of
    values, its sentences are scored one by one.  ``flag`` names a column that tells which failed.
    """

    def of_batch(scorer: Scorer, texts: list[str]) -> list[tuple]:
        try:
            values = [float(v) for v in scorer(texts)]
            if len(values) == len(texts):
                return [(v, False) for v in values]
        except Exception:
            pass
        if len(texts) == 1:
            return [(default, True)]
        return [pair for text in texts for pair in of_batch(scorer, [text])]

    scored = pa.struct([("value", pa.float64()), ("failed", pa.bool_())])

    @F.arrow_udf("value double, failed boolean")
    def scores(texts: pa.Array) -> pa.Array:
        scorer = loaded(loader)
        present = [t for t in texts.to_pylist() if t is not None]
        found = iter(by_length(present, batch, lambda part: of_batch(scorer, part)))
        rows = [next(found) if known else (None, False) for known in texts.is_valid().to_pylist()]
        return pa.array([{"value": v, "failed": f} for v, f in rows], type=scored)

    result = df.withColumn("_scored", scores(F.col(column))).withColumn(output, F.col("_scored.value"))
    if flag:
        result = result.withColumn(flag, F.col("_scored.failed"))
    return result.drop("_scored")


def distinct_characters(df: DataFrame, column: str, output: str) -> DataFrame:
    """Adds the distinct characters of a text, as a text; NULL for NULL.

    For tables whose texts go to Python anyway: in the JVM each character becomes a string of its own."""

    @F.arrow_udf("string")
    def distinct(texts: pa.Array) -> pa.Array:
        made = [pa.array([], type=pa.string())]
        for (part,) in _parts(texts):
            made.append(pa.array(_distinct(part), type=pa.string()))
        return pa.concat_arrays(made)

    return df.withColumn(output, distinct(F.col(column)))


def _distinct(texts: list[str | None]) -> list[str | None]:
    """The distinct characters of each text."""
    out = [None if t is None else "" for t in texts]
    known, places = np.zeros(0, dtype=np.uint32), np.full(START, -1, dtype=np.int32)
    for pieces, of, _ in portions([t or "" for t in texts], 0):
        codes, lengths = joined_codes(pieces)
        at = places[codes]
        if at.min() < 0:
            new = np.unique(codes[at < 0])
            places[new] = np.arange(len(known), len(known) + len(new))
            known = np.concatenate([known, new])
            at = places[codes]
        cells = np.repeat(np.arange(len(pieces)) * len(known), lengths)
        cells += at
        if len(known) * len(pieces) > MOST_MARKS:
            found = np.unique(cells)
        else:
            marked = np.zeros(len(known) * len(pieces), dtype=bool)
            marked[cells] = True
            found = np.flatnonzero(marked)
        piece, place = np.divmod(found, len(known))
        text = known[place].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        ends = np.cumsum(np.bincount(piece, minlength=len(pieces))).tolist()
        for row, start, end in zip(of.tolist(), [0, *ends], ends):
            out[row] = "".join(dict.fromkeys(out[row] + text[start:end])) if out[row] else text[start:end]
    return out


def _bigrams(texts: list[str]):
    """Bigram keys (previous << 21 | next) of the texts and the row of each, a portion at a time."""
    for pieces, of, goes_on in portions(texts, 1):
        codes, place = code_points(pieces)
        first = np.ones(len(codes), dtype=bool)
        first[1:] = place[1:] != place[:-1]
        keys = np.empty_like(codes)
        keys[1:] = codes[:-1]
        keys[first] = START
        keys <<= CODE_BITS
        keys |= codes
        # what a piece starts with belongs to the piece before
        mine = ~(first & goes_on[place])
        yield keys[mine], of[place[mine]]


def chance_table(bigrams, counts, contexts, context_n, vocabulary: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The characters of a model in order, and log p of every pair of them; a last row and column are for all others.

    None for an alphabet of which this would be more than ``MOST_CHANCES``."""
    following = bigrams & ((1 << CODE_BITS) - 1)
    known = np.unique(np.concatenate([contexts, following, [START]]))
    wide = len(known) + 1
    if wide * wide > MOST_CHANCES:
        return None
    n, context = np.zeros((wide, wide), dtype=np.int64), np.zeros((wide, 1), dtype=np.int64)
    n[np.searchsorted(known, bigrams >> CODE_BITS), np.searchsorted(known, following)] = counts
    context[np.searchsorted(known, contexts), 0] = context_n
    with np.errstate(divide="ignore"):  # a model of no text
        return known, np.log((n + 1.0) / (context + vocabulary))


def character_places(known: np.ndarray) -> np.ndarray:
    """Where each code point is among the ``known`` ones; behind them if it isn't."""
    places = np.full(START + 1, len(known), dtype=np.int64)
    places[known] = np.arange(len(known))
    return places


def _looked_up(texts: list[str], places: np.ndarray, log_p: np.ndarray):
    """log p of each character after the one before it, and its row, a portion at a time.

    What a piece that goes on a text starts with belongs to the piece before: it gets 0."""
    for pieces, of, goes_on in portions(texts, 1):
        codes, lengths = joined_codes(pieces)
        at = places[codes]
        cells = np.empty_like(at)
        cells[1:] = at[:-1]
        starts = np.cumsum(lengths) - lengths
        cells[starts] = places[START]
        cells *= len(log_p)
        cells += at
        found = log_p.ravel()[cells]
        found[starts[goes_on]] = 0.0
        yield found, np.repeat(of, lengths)


def _added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their counts, each key once."""
    keys, inverse = np.unique(np.concatenate([k for k, _ in counts]), return_inverse=True)
    n = np.zeros(len(keys), dtype=np.int64)
    np.add.at(n, inverse, np.concatenate([n for _, n in counts]))
    return keys, n


def fit_char_lm(df: DataFrame, column: str) -> DataFrame:
    """Character bigram counts ``(bigram, n)`` of a text column.

    A task counts portion by portion before anything is shuffled, so the shuffle
    carries distinct bigrams and not characters; it holds about ``COUNTED`` of them.
    """

    def count(batches):
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(counts):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in counts], ["bigram", "n"])

        for b in batches:
            for (texts,) in _parts(b.column(0)):
                for keys, _ in _bigrams([t or "" for t in texts]):
                    waiting.append(np.unique(keys, return_counts=True))
                    if sum(len(k) for k, _ in waiting) > COUNTED:
                        waiting = [_added(waiting)]
                        if 2 * len(waiting[0][0]) > COUNTED:
                            yield rows(waiting.pop())
        if waiting:
            yield rows(_added(waiting))

    counted = df.select(column).mapInArrow(count, "bigram long, n long")
    return counted.groupBy("bigram").agg(F.sum("n").alias("n"))


def _contexts(lm: DataFrame) -> DataFrame:
    """Occurrences of each character as a context: at most one row per Unicode character."""
    previous = F.shiftright("bigram", CODE_BITS).alias("previous")
    return lm.groupBy(previous).agg(F.sum("n").alias("context_n"))


def vocabulary_size(lm: DataFrame) -> int:
    """Distinct characters the model has seen."""
    following = F.col("bigram").bitwiseAND(F.lit((1 << CODE_BITS) - 1))
    return lm.agg(F.count_distinct(following)).first()[0]


def hot_bigrams(lm: DataFrame) -> list[int]:
    """Bigrams with more than a 1/1000 share of all occurrences."""
    total = lm.agg(F.sum("n").alias("total"))
    return [
        r[0] for r in lm.filter(F.col("n") * HOT_SHARE > scalar(total, "total")).select("bigram").collect()
    ]


def char_lm_perplexity(
    df: DataFrame,
    column: str,
    lm: DataFrame,
    output: str = "chinese_perplexity",
    key: str = "line_no",
    broadcast_rows: int | None = None,
) -> DataFrame:
    """exp(-mean log p) per text under add-one bigram probabilities; NULL for empty text.

    A model of at most ``broadcast_rows`` bigrams goes to the workers whole and
    is looked up there.  A larger one is joined, by a row number of its own; both give
    the same rows, whatever the rows' keys.  ``df`` cannot be a stream then.
    """
    if fits_workers(lm, broadcast_rows):
        return _perplexity_broadcast(df, column, lm, output)
    return _perplexity_joined(df, column, lm, output)


def fits_workers(lm: DataFrame, broadcast_rows: int | None = None) -> bool:
    """Whether a language model is small enough to be looked up in the workers."""
    if broadcast_rows is None:
        broadcast_rows = LM_BROADCAST_ROWS
    return lm.limit(broadcast_rows + 1).count() <= broadcast_rows


def _perplexity_broadcast(df: DataFrame, column: str, lm: DataFrame, output: str) -> DataFrame:
    table = lm.toArrow()
    order = np.argsort(table["bigram"].to_numpy())
    bigrams, counts = table["bigram"].to_numpy()[order], table["n"].to_numpy()[order]
    contexts, first = np.unique(bigrams >> CODE_BITS, return_index=True)
    context_n = np.add.reduceat(counts, first) if len(first) else counts
    vocabulary = len(np.unique(bigrams & ((1 << CODE_BITS) - 1)))
    chances = chance_table(bigrams, counts, contexts, context_n, vocabulary)
    model = df.sparkSession.sparkContext.broadcast(
        (bigrams, counts, contexts, context_n, vocabulary, chances)
    )

    def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0)

    @F.arrow_udf("double")
    def perplexity(texts: pa.Array) -> pa.Array:
        bigrams, counts, contexts, context_n, vocabulary, chances = model.value
        places = chances and character_places(chances[0])
        out: list = []
        for (part,) in _parts(texts):
            part = [t or "" for t in part]
            sums, lengths = np.zeros(len(part)), [len(t) for t in part]
            for log_p, rows in _looked_up(part, places, chances[1]) if chances else ():
                sums += np.bincount(rows, weights=log_p, minlength=len(part))
            for keys, rows in () if chances else _bigrams(part):
                # long texts repeat their bigrams: look each one up once
                distinct, inverse = np.unique(keys, return_inverse=True)
                n = found(bigrams, counts, distinct)
                context = found(contexts, context_n, distinct >> CODE_BITS)
                log_p = np.log((n + 1.0) / (context + vocabulary))
                sums += np.bincount(rows, weights=log_p[inverse], minlength=len(part))
            for total, length in zip(sums, lengths):
                out.append(float(np.exp(-total / length)) if length else None)
        return pa.array(out, type=pa.float64())

    return df.withColumn(output, perplexity(F.col(column)))


def _perplexity_joined(df: DataFrame, column: str, lm: DataFrame, output: str) -> DataFrame:
    key = "_lm_row"
    # numbered and stored once: a row keeps its number whatever runs again
    numbered = df.drop(output).withColumn(key, F.monotonically_increasing_id())
    df = materialize(numbered, "lm-rows")

    def spread(batches):
        for b in batches:
            for numbers, texts in _parts(b.column(0), b.column(1)):
                for grams, rows in _bigrams([t or "" for t in texts]):
                    order = np.lexsort((grams, rows))
                    grams, rows = grams[order], rows[order]
                    new = np.ones(len(grams), dtype=bool)
                    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
                    starts = np.flatnonzero(new)
                    times = np.diff(np.append(starts, len(grams)))
                    keys = np.array(numbers, dtype=np.int64)[rows[starts]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array(grams[starts], pa.int64()), pa.array(times, pa.int64())],
                        [key, "bigram", "times"],
                    )

    used = df.select(key, column).mapInArrow(spread, f"{key} long, bigram long, times long")
    # a bigram that makes up much of the text is in most rows
    hot = hot_bigrams(fit_char_lm(df, column))
    used = lookup(used, lm, "bigram", "left", broadcast_rows=0, hot=hot, spread_by=[key])
    used = used.withColumn("previous", F.shiftright("bigram", CODE_BITS)).join(
        F.broadcast(_contexts(lm)), "previous", "left"
    )
    chance = (F.coalesce("n", F.lit(0)) + F.lit(1.0)) / (
        F.coalesce("context_n", F.lit(0)) + F.lit(vocabulary_size(lm))
    )
    per_text = used.groupBy(key).agg(
        F.exp(-F.sum(F.col("times") * F.log(chance)) / F.sum("times")).alias(output)
    )
    return df.join(per_text, key, "left").drop(key)


def apply_translator(
    df: DataFrame,
    loader: Callable[[], Callable[[list[str]], list[str]]],
    source: str = "source",
    output: str = "target",
    batch: int = ENCODER_BATCH,
) -> DataFrame:
    """Adds the translations that a user function gives for the source texts."""

    @F.arrow_udf("string")
    def translations(texts: pa.Array) -> pa.Array:
        made = [pa.array([], type=pa.string())]
        for (part,) in _parts(texts):
            made.append(pa.array(by_length(part, batch, loaded(loader)), type=pa.string()))
        return pa.concat_arrays(made)

    return df.withColumn(output, translations(F.col(source)))

"""Character language models of any order, with back-off.

Every character counts once for each context of 0 to ``n - 1`` characters before it (texts are padded with
start marks).  Witten-Bell interpolation gives the chance of a character: a context seen ``t`` times, with
``d`` different characters after it, keeps ``t / (t + d)`` for its own counts and passes the rest to the
context that is one character shorter; the empty context passes it to 1 / (known characters + 1).

A gram is a binary key of three bytes per character, so a key of any order keeps its context as a prefix and
its shorter gram as a suffix.  A stored model has one row ``(gram, n, p, bow)`` per gram and context: the
chance of its last character after the others, and what it passes on as a context.

Null and empty texts have no characters: they teach nothing and their perplexity is NULL.  Repeated rows count
as often as they occur.  A model of no text gives each character the chance 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.joins import HOT_SHARE, lookup, scalar
from pairscore.operators.signals import CODE_BITS, START, code_points, fits_workers
from pairscore.session import materialize

KEY_BYTES = 3
# Characters that one numpy pass holds: longer batches go through in parts, long texts as well.
CHARS_AT_ONCE = 1 << 20


def _padded(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the texts behind ``n - 1`` start marks each, the places of characters, and their rows."""
    codes, rows = code_points(texts)
    at = np.arange(len(codes)) + (rows + 1) * (n - 1)
    padded = np.full(len(codes) + len(texts) * (n - 1), START, dtype=np.int64)
    padded[at] = codes
    return padded, at, rows


def _windows(padded: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` codes that end at each place, one row per place."""
    return padded[ends[:, None] + np.arange(1 - k, 1)]


def _keys(windows: np.ndarray) -> pa.Array:
    """Rows of codes as binary keys."""
    width = KEY_BYTES * windows.shape[1]
    data = np.stack([windows >> 16, (windows >> 8) & 255, windows & 255], axis=-1).astype(np.uint8)
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(windows), [None, pa.py_buffer(np.ascontiguousarray(data))]
    )
    return fixed.cast(pa.binary())


def _numbered(padded: np.ndarray, n: int):
    """For each order, a number per place that is equal where the grams ending there are equal."""
    ids = np.unique(padded, return_inverse=True)[1]
    yield ids
    for _ in range(1, n):
        before = np.concatenate([[0], ids[:-1]])
        ids = np.unique((before << CODE_BITS) | padded, return_inverse=True)[1]
        yield ids


def _parts(texts: list, n: int):
    """Slices of a batch of at most ``CHARS_AT_ONCE`` characters: (codes, places, row numbers).

    A long text is cut; its next slice starts with the last characters of the one before as context.
    """
    held, numbers, chars = [], [], 0
    for number, text in enumerate(texts):
        if not text:
            continue
        if held and chars + len(text) > CHARS_AT_ONCE:
            padded, at, rows = _padded(held, n)
            yield padded, at, np.array(numbers)[rows]
            held, numbers, chars = [], [], 0
        if len(text) <= CHARS_AT_ONCE:
            held.append(text)
            numbers.append(number)
            chars += len(text)
            continue
        padded, at, _ = _padded([text], n)
        for start in range(0, len(text), CHARS_AT_ONCE):
            mine = padded[start : start + CHARS_AT_ONCE + n - 1]
            yield mine, np.arange(n - 1, len(mine)), np.full(len(mine) - n + 1, number)
    if held:
        padded, at, rows = _padded(held, n)
        yield padded, at, np.array(numbers)[rows]


def count_grams(df: DataFrame, column: str, n: int) -> DataFrame:
    """Occurrences ``(gram, n)`` of all grams of 1 to ``n`` characters, counted per slice before the shuffle."""
    if n < 1:
        raise ValueError("the order is at least 1")

    def count(batches):
        for b in batches:
            for padded, at, _ in _parts(b.column(0).to_pylist(), n):
                for k, ids in enumerate(_numbered(padded, n), 1):
                    _, first, times = np.unique(ids[at], return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [_keys(_windows(padded, at[first], k)), pa.array(times, pa.int64())], ["gram", "n"]
                    )

    counted = df.select(column).mapInArrow(count, "gram binary, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def _length(gram: str = "gram"):
    return F.octet_length(gram) / F.lit(KEY_BYTES)


def _shorter(gram: str = "gram"):
    """The gram without its first character."""
    return F.substring(F.col(gram), KEY_BYTES + 1, 1 << 30)


def _context(gram: str = "gram"):
    """The gram without its last character."""
    return F.substring(F.col(gram), F.lit(1), F.octet_length(gram) - KEY_BYTES)


def fit_ngram_lm(df: DataFrame, column: str, n: int) -> DataFrame:
    """The stored model ``(gram, n, p, bow)`` of order ``n``.

    No join key is hot: grams are distinct, so a context or a suffix is in no more rows than there are characters.
    """
    counts = materialize(count_grams(df, column, n), "ngram-counts")
    followed = counts.groupBy(_context().alias("gram")).agg(
        F.sum("n").alias("seen"), F.count(F.lit(1)).alias("kinds")
    )
    contexts = materialize(followed, "ngram-contexts")
    characters = counts.filter(_length() == 1).agg(F.count(F.lit(1)).alias("c"))
    empty = df.sparkSession.range(1).select(F.lit(b"").alias("gram"), F.lit(None).cast("long").alias("n"))
    level = empty.withColumn("p", F.lit(1.0) / (scalar(characters, "c") + F.lit(1)))
    levels = [level]
    for k in range(1, n + 1):
        mine = counts.filter(_length() == k).withColumn("context", _context()).withColumn("suffix", _shorter())
        below = level.select(F.col("gram").alias("suffix"), F.col("p").alias("p_below"))
        joined = mine.join(contexts.withColumnRenamed("gram", "context"), "context").join(below, "suffix")
        p = (F.col("n") + F.col("kinds") * F.col("p_below")) / (F.col("seen") + F.col("kinds"))
        level = materialize(joined.select("gram", "n", p.alias("p")), "ngram-level")
        levels.append(level)
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    passed = contexts.select("gram", (F.col("kinds") / (F.col("seen") + F.col("kinds"))).alias("bow"))
    return materialize(grams.join(passed, "gram", "full").select("gram", "n", "p", "bow"), "ngram-lm")


def order_of(lm: DataFrame) -> int:
    """Characters in the longest gram."""
    return int(lm.agg(F.max(_length())).first()[0])


def ngram_perplexity(
    df: DataFrame, column: str, lm: DataFrame, output: str = "perplexity", broadcast_rows: int | None = None
) -> DataFrame:
    """exp(-mean log p) per text, as ``output``; NULL for null and empty texts.

    A model of at most ``broadcast_rows`` rows is looked up in the workers as a tree of sorted arrays.  A
    larger one is joined with the distinct grams of the texts, level by level; both give the same rows.
    ``df`` cannot be a stream then.
    """
    if fits_workers(lm, broadcast_rows):
        return _looked_up(df, column, lm, output)
    return _joined(df, column, lm, output)


class GramTree:
    """A model as one sorted array per level: a node's key is its parent's number and its own character."""

    def __init__(self, table: pa.Table):
        grams = table["gram"].to_pylist()
        lengths = np.fromiter((len(g) // KEY_BYTES for g in grams), dtype=np.int64, count=len(grams))
        values = {c: table[c].to_numpy(zero_copy_only=False).astype(float) for c in ("p", "bow")}
        self.order = int(lengths.max())
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(1, self.order + 1):
            rows = np.flatnonzero(lengths == k)
            data = np.frombuffer(b"".join(grams[i] for i in rows), dtype=np.uint8)
            data = data.reshape(len(rows), k, KEY_BYTES).astype(np.int64)
            codes = (data[..., 0] << 16) | (data[..., 1] << 8) | data[..., 2]
            keys = (self.nodes(codes[:, :-1]) << CODE_BITS) | codes[:, -1]
            order = np.argsort(keys)
            self.levels.append((keys[order], values["p"][rows][order], values["bow"][rows][order]))
        top = np.flatnonzero(lengths == 0)[0]
        self.root = values["p"][top], values["bow"][top]

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The number of each row's node on its level, -1 where the tree has none."""
        at = np.zeros(len(codes), dtype=np.int64)
        for k in range(codes.shape[1]):
            keys = self.levels[k][0]
            wanted = (at << CODE_BITS) | codes[:, k]
            found = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            known = (at >= 0) & (keys[found] == wanted) if len(keys) else np.zeros(len(at), dtype=bool)
            at = np.where(known, found, -1)
        return at

    def values(self, codes: np.ndarray, which: int) -> np.ndarray:
        """Chances (1) or what is passed on (2); NaN where the model has none."""
        k = codes.shape[1]
        if not k:
            return np.full(len(codes), self.root[which - 1])
        at, values = self.nodes(codes), self.levels[k - 1][which]
        return np.where(at >= 0, values[at], np.nan) if len(values) else np.full(len(codes), np.nan)

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        """Log chance of the last character of each row of ``order`` codes."""
        out, open_ = np.zeros(len(codes)), np.arange(len(codes))
        for k in range(self.order, -1, -1):
            mine = codes[open_, self.order - k :]
            p = self.values(mine, 1)
            known = ~np.isnan(p)
            out[open_[known]] += np.log(p[known])
            open_ = open_[~known]
            if k:
                bow = self.values(mine[~known, :-1], 2)
                out[open_] += np.log(np.where(np.isnan(bow), 1.0, bow))
        return out


def _looked_up(df: DataFrame, column: str, lm: DataFrame, output: str) -> DataFrame:
    model = df.sparkSession.sparkContext.broadcast(GramTree(lm.toArrow()))

    @F.arrow_udf("double")
    def perplexity(texts: pa.Array) -> pa.Array:
        tree = model.value
        n = max(tree.order, 1)
        sums, lengths = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        for padded, at, rows in _parts(texts.to_pylist(), n):
            ids = list(_numbered(padded, n))[-1][at]
            _, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
            log_p = tree.log_p(_windows(padded, at[first], n)[:, n - tree.order :])
            sums += np.bincount(rows, weights=log_p[inverse], minlength=len(texts))
            lengths += np.bincount(rows, minlength=len(texts))
        means = np.exp(-sums / np.maximum(lengths, 1))
        return pa.array(means, type=pa.float64(), mask=lengths == 0)

    return df.withColumn(output, perplexity(F.col(column)))


def _joined(df: DataFrame, column: str, lm: DataFrame, output: str) -> DataFrame:
    n = order_of(lm)
    columns = [c for c in df.columns if c != output]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    # numbered and stored once: a row keeps its number whatever runs again
    numbered = df.select(row.alias("doc"), F.col(column).alias("text"), F.monotonically_increasing_id().alias("row"))
    kept = materialize(numbered, "ngram-rows")

    def spread(batches):
        for b in batches:
            for padded, at, rows in _parts(b.column(1).to_pylist(), max(n, 1)):
                ids = list(_numbered(padded, max(n, 1)))[-1][at]
                _, first, times = np.unique(rows * (ids.max() + 1) + ids, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(rows[first])),
                        _keys(_windows(padded, at[first], n)),
                        pa.array(times, pa.int64()),
                    ],
                    ["row", "gram", "times"],
                )

    used = materialize(
        kept.select("row", "text").mapInArrow(spread, "row long, gram binary, times long"), "ngram-used"
    )
    wanted = materialize(used.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")), "ngram-wanted")
    total = wanted.agg(F.sum("rows").alias("total"))
    hot = [
        r[0] for r in wanted.filter(F.col("rows") * HOT_SHARE > scalar(total, "total")).select("gram").collect()
    ]
    # an open gram has a suffix that is yet to be found; a closed one has none
    state = wanted.select("gram", F.col("gram").alias("suffix"), F.lit(0.0).alias("log_p"))
    for k in range(n, -1, -1):
        here = lm.filter(_length() == k).select(F.col("gram").alias("suffix"), "p").filter("p IS NOT NULL")
        state = lookup(state, here, "suffix", "left", spread_by=["gram"])
        state = state.withColumn("log_p", F.col("log_p") + F.coalesce(F.log("p"), F.lit(0.0)))
        state = state.withColumn("suffix", F.when(F.col("p").isNull(), F.col("suffix"))).drop("p")
        if k:
            passed = lm.filter((_length() == k - 1) & F.col("bow").isNotNull())
            passed = passed.select(F.col("gram").alias("context"), "bow")
            state = state.withColumn("context", _context("suffix"))
            state = lookup(state, passed, "context", "left", spread_by=["gram"])
            state = state.withColumn("log_p", F.col("log_p") + F.coalesce(F.log("bow"), F.lit(0.0)))
            state = state.withColumn("suffix", _shorter("suffix")).drop("context", "bow")
        state = materialize(state, "ngram-open")
    scored = lookup(used, state.select("gram", "log_p"), "gram", "inner", broadcast_rows=0, hot=hot, spread_by=["row"])
    per_text = scored.groupBy("row").agg(
        F.exp(-F.sum(F.col("times") * F.col("log_p")) / F.sum("times")).alias("score")
    )
    return kept.join(per_text, "row", "left").select("doc.*", F.col("score").alias(output))

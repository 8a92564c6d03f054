"""Phrases whose words stand together, from an FM-index of word ids per shard.

Texts (A-Z lower-cased) are split at ``.,;:!?`` and line breaks into pieces and those at blanks and tabs into
words; everything is counted per group (a language). For a phrase of 2 to ``max_words`` words that occurs
``min_count`` times or more, each cut into two parts gives floor(2000000 * a / (l + r)) from the counts of the
phrase and of its parts; the lowest cut is its score.

1. Texts are read once into shards of about ``SHARD`` bytes: the words as numbers of the shard's own
   vocabulary, 0 between pieces, and that vocabulary with its counts. Counts of words are summed over the shards;
   only words that are frequent as a whole can be part of a phrase, all others become gaps.
2. A shard is indexed both ways: the word before each suffix, suffixes in order of their first words (a BWT of
   limited depth), and the word behind each prefix, prefixes in order of their last words. A phrase is an
   interval in either; extending it by a word on one side moves one interval by a backward step and cuts
   the other (``Index.extend``). So all phrases of a length come from those one word shorter, with their counts.
3. Pairs are summed over the shards and the frequent ones go back to their shards, which extend them, to the
   left and the right in turn, while every pair of neighbours in a phrase is frequent. The sums over all shards are exact.
4. A phrase inside a frequent longer one has a one-word extension that is at least as frequent; its largest left
   and right extension decide whether the longer phrase stands for it.

A shard's index is rebuilt in the task that needs it, so what is stored is the words and counts. Counted
phrases travel packed by (shard, hash of the phrase), and a bucket of hashes is summed in one task. Null texts
are empty; a null group is ``und``. Repeated rows count as often as they occur, an empty table gives an
empty result. Words of any length and bytes are kept; a text longer than a shard is a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

MAX_WORDS = 4
MIN_COUNT = 30
#: Bytes of text in a shard, about.
SHARD = 6 << 20
#: Words of text for each bucket of counted phrases.
BUCKET = 1_000_000
#: Occurrences of phrases that are extended at a time, about.
OCCURRENCES = 250_000
#: Score of a phrase whose parts occur nowhere else.
SCALE = 2_000_000
#: A phrase is dropped if a longer one around it has this percentage of its count.
COVERED = 80

#: Byte by byte: A-Z lower-cased, the characters between pieces become line breaks.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))
BREAK = b"\xff"  # no UTF-8 text contains this byte

SHARDS = "kind int, shard bigint, word_id int, lang string, word string, n bigint, data binary"
SHARDS_ARROW = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int64()), ("word_id", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("data", pa.binary())]
)
WORDS, TEXTS = 0, 1
#: Bits of a word's number in its shard, and of a shard's number in its task.
WORD_BITS, SHARD_BITS = 25, 14


class Vocabulary(dict):
    """Numbers of the words of one group; the groups of a shard share the numbers from 1 on."""

    def __init__(self, shard: list):
        super().__init__()
        self.shard = shard

    def __missing__(self, word: bytes) -> int:
        self.shard.append(None)
        self[word] = number = len(self.shard)
        return number


class ShardWriter:
    """Collects texts until the shard is full."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.words: list = []
        self.groups: dict[str, Vocabulary] = {}
        self.parts: list[np.ndarray] = []

    def add(self, lang: str, text: bytes) -> None:
        tokens = text.translate(FOLD).replace(b"\n", b" \xff ").split()
        if not tokens:
            return
        known = self.groups.get(lang)
        if known is None:
            known = self.groups[lang] = Vocabulary(self.words)
            known[BREAK] = 0
        self.parts += [np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)), np.zeros(1, np.int32)]
        self.size += len(text)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        text = np.concatenate(self.parts)
        counts = np.bincount(text, minlength=len(self.words) + 1)
        for lang, known in self.groups.items():
            del known[BREAK]
            ids = np.fromiter(known.values(), np.int32, len(known))
            words = pa.array(list(known), pa.binary()).cast(pa.string())
            yield self.batch(WORDS, len(ids), word_id=ids, lang=pa.array([lang] * len(ids)), word=words, n=counts[ids].astype(np.int64))
        yield self.batch(TEXTS, 1, data=pa.array([pa.compress(text.tobytes(), "zstd", asbytes=True)], pa.binary()), n=np.array([len(text)]))

    def batch(self, kind: int, rows: int, **columns) -> pa.RecordBatch:
        given = {"kind": np.full(rows, kind, np.int32), "shard": np.full(rows, self.number, np.int64), **columns}
        arrays = [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(rows, f.type) for f in SHARDS_ARROW]
        return pa.RecordBatch.from_arrays(arrays, schema=SHARDS_ARROW)


def read_shards(texts: DataFrame, shard_bytes: int) -> DataFrame:
    """``SHARDS`` of (lang, text): per shard its vocabulary with counts, and its words."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        writer = ShardWriter(task << SHARD_BITS)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, batch.column("text").cast(pa.binary())):
                writer.add(lang, text.as_py())
                if writer.size >= shard_bytes:
                    yield from writer.rows()
                    number += 1
                    if number >> SHARD_BITS:
                        raise ValueError("too many shards in one task: read the texts in more partitions")
                    writer = ShardWriter((task << SHARD_BITS) + number)
        yield from writer.rows()
        del writer
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return texts.mapInArrow(run, SHARDS)


class Index:
    """FM-index both ways over numbers; 0 is a gap, which no phrase contains.

    ``before[i]`` is the number before the i-th suffix, suffixes sorted by their first ``depth`` numbers;
    ``behind[i]`` the number behind the i-th prefix, prefixes sorted by their last ``depth``.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = np.concatenate([[0], text, [0]]).astype(np.int32), depth
        counts = np.bincount(self.text)
        self.size = len(counts)
        self.starts = np.concatenate([[0], np.cumsum(counts)])

    @cached_property
    def before(self) -> np.ndarray:
        return np.roll(self.text, 1)[self.order(self.text)]

    @cached_property
    def behind(self) -> np.ndarray:
        backwards = self.text[::-1]
        return np.roll(backwards, 1)[self.order(backwards)]

    def order(self, text: np.ndarray) -> np.ndarray:
        """Positions by the ``depth`` numbers from there on, by doubling."""
        rank, width = text, 1
        while width < self.depth:
            step = min(width, self.depth - width)
            pair = rank.astype(np.int64) * (int(rank.max()) + 1) + np.roll(rank, -step)
            width += step
            places = np.argsort(pair, kind="stable")
            if width < self.depth:
                pair = pair[places]
                rank = np.empty(len(pair), np.int32)
                rank[places] = np.cumsum(np.concatenate([[False], pair[1:] != pair[:-1]]), dtype=np.int32)
        return places if self.depth > 1 else np.argsort(rank, kind="stable")

    def words(self) -> tuple[np.ndarray, ...]:
        """Phrases of one word: (m, 1) numbers, their first places in both orders, and their counts."""
        numbers = np.arange(1, self.size)
        first, count = self.starts[1:-1], np.diff(self.starts)[1:]
        seen = count > 0
        return numbers[seen, None], first[seen], first[seen], count[seen]

    @cached_property
    def step_before(self) -> np.ndarray:
        return self.steps(self.before)

    @cached_property
    def step_behind(self) -> np.ndarray:
        return self.steps(self.behind)

    @staticmethod
    def steps(column: np.ndarray) -> np.ndarray:
        """The backward step of every place: its occurrence, counted among all occurrences of smaller and equal symbols."""
        step = np.empty(len(column), np.int32)
        step[np.argsort(column, kind="stable")] = np.arange(len(column), dtype=np.int32)
        return step

    def extend(self, phrases, left: bool, last: bool = False) -> tuple[np.ndarray, ...]:
        """All phrases with one number more on the left or the right side; the ``last`` ones come without places."""
        numbers, count = phrases[0], phrases[3]
        ends = np.cumsum(count)
        block = np.searchsorted(ends, np.arange(0, int(ends[-1]) if len(ends) else 0, OCCURRENCES), side="right")
        bounds = np.unique([0, *block, len(count)])
        parts = [self.extend_block([p[a:b] for p in phrases], left, last) for a, b in zip(bounds[:-1], bounds[1:])]
        if not parts:
            return np.zeros((0, numbers.shape[1] + 1), np.int64), *[None if last else np.zeros(0, np.int64)] * 2, np.zeros(0, np.int64)
        return tuple(None if c[0] is None else np.concatenate(c) for c in zip(*parts))

    def extend_block(self, phrases, left: bool, last: bool) -> tuple[np.ndarray, ...]:
        numbers, suffix, prefix, count = phrases
        column, own, other = (self.before, suffix, prefix) if left else (self.behind, prefix, suffix)
        before_group = np.cumsum(count) - count
        # every occurrence: the phrase it belongs to and the symbol beside it; symbols rise within a phrase
        place = np.arange(count.sum()) + np.repeat(own - before_group, count)
        key = np.repeat(np.arange(len(own)) * self.size, count) + column[place]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        found = np.diff(np.append(first, len(key)))
        of, new = np.divmod(key[first], self.size)
        real = new > 0
        at, of, new, found = first[real], of[real], new[real], found[real]
        longer = np.column_stack([new, numbers[of]] if left else [numbers[of], new])
        if last:
            return longer, None, None, found
        # the other order: occurrences with a smaller symbol come first in the interval
        cut = other[of] + at - before_group[of]
        # backward step of the symbol's first occurrence in the interval
        stepped = (self.step_before if left else self.step_behind)[place[order[at]]].astype(np.int64)
        return (longer, stepped, cut, found) if left else (longer, cut, stepped, found)


def unpacked(shard: pa.Table, local: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's words as ranks among its frequent words (0: gaps, in runs of one), and those words' global numbers."""
    text = np.frombuffer(pa.decompress(shard.column("data")[0].as_py(), decompressed_size=4 * shard.column("n")[0].as_py(), codec="zstd"), np.int32)
    table = np.zeros(max(int(text.max(initial=0)), int(local.max(initial=0))) + 1, np.int32)
    table[local] = np.arange(1, len(local) + 1)
    ranks = table[text]
    keep = (ranks > 0) | (np.concatenate([[1], ranks[:-1]]) > 0)
    return ranks[keep], np.concatenate([[0], numbers])


#: Counted phrases travel packed: ``n`` phrases of ``width`` words, column by column, then their counts.
PARTS = "shard bigint, width int, bucket int, n bigint, data binary"
PARTS_ARROW = pa.schema([("shard", pa.int64()), ("width", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
#: Shard of the sums over all shards.
ALL = -1


def packed(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    flat = np.concatenate([*numbers.T, counts]).astype("<i8")
    return pa.compress(flat.tobytes(), "zstd", asbytes=True)


def phrases_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, counts and the shard of all phrases in rows of ``PARTS`` of one width."""
    numbers, counts, shards = [], [], []
    for shard, width, n, data in zip(*(table.column(c).to_pylist() for c in ("shard", "width", "n", "data"))):
        flat = np.frombuffer(pa.decompress(data, decompressed_size=8 * n * (width + 1), codec="zstd"), "<i8").reshape(width + 1, n)
        numbers.append(flat[:-1].T)
        counts.append(flat[-1])
        shards.append(np.full(n, shard))
    return np.concatenate(numbers), np.concatenate(counts), np.concatenate(shards)


def part_table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, PARTS_ARROW)], schema=PARTS_ARROW)


def dealt(shard: int, numbers: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """The phrases of a shard by a hash of their words."""
    mixed = np.zeros(len(numbers), np.uint64)
    for column in numbers.T.astype(np.uint64):
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    home = (mixed % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*numbers.T[::-1], home))
    ends = np.searchsorted(home[order], np.arange(buckets + 1))
    rows = []
    for bucket in np.flatnonzero(np.diff(ends)):
        mine = order[ends[bucket] : ends[bucket + 1]]
        rows.append((shard, numbers.shape[1], int(bucket), len(mine), packed(numbers[mine], counts[mine])))
    return part_table(rows)


def summed(min_count: int, back: bool):
    """Of a bucket's phrases the frequent ones: with their sums, and with ``back`` also by shard."""

    def run(table: pa.Table) -> pa.Table:
        numbers, counts, shards = phrases_in(table)
        width, bucket = numbers.shape[1], table.column("bucket")[0].as_py()
        order = np.lexsort(numbers.T[::-1])
        ordered = numbers[order]
        first = np.flatnonzero(np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(1)]))
        totals = np.add.reduceat(counts[order], first)
        good = totals >= min_count
        rows = [(ALL, width, bucket, int(good.sum()), packed(ordered[first[good]], totals[good]))]
        if back:
            kept = order[np.repeat(good, np.diff(np.append(first, len(order))))]
            kept = kept[np.argsort(shards[kept], kind="stable")]
            for mine in np.split(kept, np.flatnonzero(np.diff(shards[kept])) + 1):
                if len(mine):
                    rows.append((int(shards[mine[0]]), width, bucket, len(mine), packed(numbers[mine], counts[mine])))
        return part_table([r for r in rows if r[3]])

    return run


def pairs_of(buckets: int):
    """The pairs of frequent words in a shard."""

    def run(shard: pa.Table, known: pa.Table) -> pa.Table:
        if not shard.num_rows or not known.num_rows:
            return PARTS_ARROW.empty_table()
        text, numbers = unpacked(shard, *(known.column(c).to_numpy() for c in "xy"))
        index = Index(text, 2)
        found, _, _, count = index.extend(index.words(), left=False, last=True)
        return dealt(shard.column("shard")[0].as_py(), numbers[found], count, buckets)

    return run


def longer_of(max_words: int, buckets: int):
    """Phrases of 3 to ``max_words`` words in a shard, all of whose neighbouring pairs are frequent."""

    def run(shard: pa.Table, known: pa.Table) -> pa.Table:
        pairs = known.filter(pa.compute.is_valid(known.column("data")))
        if not shard.num_rows or not pairs.num_rows:
            return PARTS_ARROW.empty_table()
        words = known.filter(pa.compute.is_null(known.column("data")))
        text, numbers = unpacked(shard, *(words.column(c).to_numpy() for c in "xy"))
        index = Index(text, max_words)
        rank = np.argsort(numbers)
        x, y = rank[np.searchsorted(numbers[rank], phrases_in(pairs)[0])].T
        frequent = np.sort(x * index.size + y)

        def kept(phrases, at: int):
            """Those whose pair at this place is frequent."""
            key = phrases[0][:, at] * index.size + phrases[0][:, at + 1]
            near = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
            good = frequent[near] == key
            return tuple(part if part is None else part[good] for part in phrases)

        phrases, out = kept(index.extend(index.words(), left=False), 0), []
        for size in range(3, max_words + 1):
            left = size % 2 == 1
            phrases = kept(index.extend(phrases, left, size == max_words), 0 if left else size - 2)
            out.append(dealt(shard.column("shard")[0].as_py(), numbers[phrases[0]], phrases[3], buckets))
        return pa.concat_tables(out)

    return run


def spread_out(parts: DataFrame) -> DataFrame:
    """(gram, a) of the sums over all shards."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                numbers, counts, _ = phrases_in(pa.Table.from_batches([batch.slice(i, 1)]))
                offsets = pa.array(np.arange(len(numbers) + 1, dtype=np.int32) * numbers.shape[1])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel())), pa.array(counts)], names=["gram", "a"])

    return parts.where(F.col("shard") == ALL).mapInArrow(run, "gram array<bigint>, a bigint")


def count_phrases(df: DataFrame, text: str, lang: str, max_words: int, min_count: int, shard_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gram, a) of all frequent phrases of 1 to ``max_words`` words, (number, lang, word) of their words, and (lang, total)."""
    texts = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")
    shards = materialize(read_shards(texts, shard_bytes), "phrase-shards")  # in one folder: dealing rows out would sort them
    entries = shards.where(F.col("kind") == WORDS)
    totals = entries.groupBy("lang").agg(F.sum("n").alias("total"))
    size = shards.where(F.col("kind") == TEXTS).agg(F.sum("n")).first()[0] or 0
    buckets = max(16, size // BUCKET)
    # a word's number is that of its first entry
    same = Window.partitionBy("lang", "word")
    own = F.shiftleft("shard", WORD_BITS).bitwiseOR(F.col("word_id").cast("bigint"))
    # the shuffle carries each word's number only, which holds its shard and its number there
    words = entries.select("lang", "word", "n", own.alias("own"))
    words = words.withColumns({"a": F.sum("n").over(same), "y": F.min("own").over(same)}).where(F.col("a") >= min_count)
    first = F.when(F.col("own") == F.col("y"), F.struct("lang", "word", "a")).alias("first")  # spelled out once only
    parts = F.shiftright("own", WORD_BITS).alias("shard"), F.col("own").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).alias("x")
    words = materialize(words.select(*parts, "y", first), "phrase-words")
    sequences = shards.where(F.col("kind") == TEXTS).select("shard", "n", "data").groupBy("shard")
    known = words.select("shard", "x", "y")
    pairs = sequences.cogroup(known.groupBy("shard")).applyInArrow(pairs_of(buckets), PARTS)
    pairs = materialize(pairs.groupBy("bucket").applyInArrow(summed(min_count, max_words > 2), PARTS), "phrase-pairs")
    parts = pairs.where(F.col("shard") == ALL)
    if max_words > 2:
        nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("width", "int"), ("n", "bigint"), ("data", "binary"))]
        mine = pairs.where(F.col("shard") != ALL).select("shard", *[F.lit(None).cast("bigint").alias(c) for c in "xy"], "width", "n", "data")
        both = known.select("shard", "x", "y", *nothing).unionByName(mine)
        longer = sequences.cogroup(both.groupBy("shard")).applyInArrow(longer_of(max_words, buckets), PARTS)
        parts = parts.unionByName(longer.groupBy("width", "bucket").applyInArrow(summed(min_count, False), PARTS))
    first = words.where("first IS NOT NULL").select(F.col("y").alias("number"), "first.*")
    grams = first.select(F.array("number").alias("gram"), "a").unionByName(spread_out(parts))
    return materialize(grams, "phrase-grams"), first.select("number", "lang", "word"), totals


def scored(grams: DataFrame, max_words: int) -> DataFrame:
    """(gram, a, l, r, score) of the phrases of two words or more: the lowest cut, the first of equal ones."""
    size = F.size("gram")
    k = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = grams.where(size.between(2, max_words)).select("gram", "a", k)
    first, rest = F.slice("gram", 1, F.col("k")), F.slice("gram", F.col("k") + 1, size - F.col("k"))
    counts = grams.where(size < max_words)
    cuts = cuts.withColumn("part", first).join(counts.select(F.col("gram").alias("part"), F.col("a").alias("l")), "part")
    cuts = cuts.withColumn("part", rest).join(counts.select(F.col("gram").alias("part"), F.col("a").alias("r")), "part")
    exact = F.expr(f"CAST(a AS DECIMAL(19,0)) * {SCALE} DIV (CAST(l AS DECIMAL(19,0)) + r)")
    cuts = cuts.select("gram", "a", F.struct(exact.cast("bigint").alias("score"), "k", "l", "r").alias("cut"))
    return cuts.groupBy("gram").agg(F.first("a").alias("a"), F.min("cut").alias("cut")).select("gram", "a", "cut.l", "cut.r", "cut.score")


def extensions(grams: DataFrame) -> DataFrame:
    """(gram, before, behind): the largest count of a frequent phrase with one word more in front, or behind."""
    longer = grams.where(F.size("gram") > 2)
    end = F.size("gram") - 1
    inner = longer.select(F.slice("gram", 2, end).alias("gram"), F.col("a").alias("before"), F.lit(None).cast("bigint").alias("behind"))
    outer = longer.select(F.slice("gram", 1, end).alias("gram"), F.lit(None).cast("bigint").alias("before"), F.col("a").alias("behind"))
    return inner.unionByName(outer).groupBy("gram").agg(F.max("before").alias("before"), F.max("behind").alias("behind"))


def find_collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    covered: int = COVERED,
    top: int | None = None,
    shard_bytes: int = SHARD,
) -> DataFrame:
    """lang, phrase, words (array), a, l, r, n, score, before, behind and rank: all phrases that no longer one stands for.

    ``n`` counts all words of the group; ``before`` and ``behind`` are the largest counts of a frequent phrase with
    one word more (null without). ``top`` keeps the first so many of each group by score, count, phrase.
    """
    grams, vocabulary, totals = count_phrases(df, text, lang, max_words, min_count, shard_bytes)
    judged = scored(grams, max_words).join(extensions(grams), "gram", "left")
    longest = F.greatest("before", "behind")
    left = judged.where(longest.isNull() | (longest.cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * covered))
    langs = vocabulary.select(F.col("number").alias("head"), "lang")
    left = left.withColumn("head", F.element_at("gram", 1)).join(langs, "head").drop("head")
    if top is not None:  # phrases are only put together for those that may be among the first
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        left = left.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= top).drop("_rank")
    left = materialize(left, "phrase-kept")
    spelled = left.select("gram", F.posexplode("gram").alias("at", "number")).join(vocabulary.select("number", "word"), "number")
    words = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"])
    named = left.join(spelled.groupBy("gram").agg(words.alias("words")), "gram").join(totals, "lang")
    named = named.withColumn("phrase", F.array_join("words", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "words", "a", "l", "r", F.col("total").alias("n"), "score", "before", "behind")

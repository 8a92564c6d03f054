"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and items are normalised the same way: A-Z lower-cased, words of letters, digits and
characters beyond ASCII, joined by single blanks. Every window of ``WINDOW`` item words is a
pattern (an item of fewer words is one pattern); the automaton finds all of them in one scan
of a text. Matches give the covered words, and their offsets in the original text.

Null or wordless texts have no words and are clean; null or wordless items have no windows.
Items with equal windows are all reported. The characters of the items are counted first: a set
beyond ``MAX_CHARS`` is cut into its distinct windows, which go through in blocks of bounded size, one scan for
each; the covered words are united per row, and the windows' items are joined. Copies of an
item or a window then add nothing to any automaton; only their ids are kept, in one array per text.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..session import materialize
from .columns import add_columns

WINDOW = 10
#: Characters of item texts in one automaton: windows repeat a word up to ten times, so about 100 MB of nodes.
MAX_CHARS = 1_000_000

#: A word in the original text, where A-Z are still upper case.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Byte by byte: word bytes stay (A-Z lower-cased), all others become blanks. Bytes from 0x80 belong to characters beyond ASCII.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
HIT_COLUMNS = {
    "n_words": "bigint",
    "hits": "array<struct<first:int,last:int,start:int,end:int>>",
    "items": "array<bigint>",
}
HITS = ", ".join(f"{name} {kind}" for name, kind in HIT_COLUMNS.items())


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The patterns of an item, each with a blank on both sides."""
    found = words(text)
    if not found:
        return []
    spans = range(max(1, len(found) - size + 1))
    return [b" " + b" ".join(found[i : i + size]) + b" " for i in spans]


class Scanner:
    """The automaton over (item_id, text) pairs; bytes are handled as Latin-1 characters."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int = WINDOW):
        owners: dict[bytes, set] = {}
        for item, text in items:
            for window in windows(text, size):
                owners.setdefault(window, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(ids)))
        self.empty = not owners
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[dict], list[int]]:
        """Word count, runs of covered words with their source offsets, and the items found."""
        found = words(text)
        if self.empty or not found:
            return len(found), [], []
        line = b" " + b" ".join(found) + b" "
        runs: list[list[int]] = []
        ids: set = set()
        seen, seen_at = 0, 0  # words that end before the position seen_at
        for end, (count, owners) in self.automaton.iter(line.decode("latin-1")):
            seen += line.count(b" ", seen_at, end)
            seen_at = end
            last = seen - 1  # the pattern's closing blank follows this word
            first = last - count + 1
            ids.update(owners)
            while runs and runs[-1][0] >= first:
                runs.pop()
            if runs and runs[-1][1] >= first - 1:
                runs[-1][1] = last
            else:
                runs.append([first, last])
        if not runs:
            return len(found), [], []
        places = [m.span() for m in WORD.finditer(text)]
        hits = [
            {"first": a, "last": b, "start": places[a][0], "end": places[b][1]} for a, b in runs
        ]
        return len(found), hits, sorted(i for i in ids if i is not None)


def scan_block(df: DataFrame, items: list[tuple], text: str, size: int) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast((items, size))

    def make():
        scanner = Scanner(*shared.value)

        def compute(texts):
            rows = [scanner.scan(t) for t in texts]
            return dict(zip(("n_words", "hits", "items"), map(list, zip(*rows)) if rows else ([], [], [])))

        return compute

    return add_columns(df, HITS, text, make)


def window_texts(text: str | None, size: int) -> list[str]:
    """The windows of an item as texts of their own."""
    return [w.strip().decode("utf-8", "replace") for w in windows(text, size)]


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """``df`` plus n_words, hits (runs of covered words: first and last word, source offsets) and items (found ids).

    Columns of ``df`` with these names are replaced.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("t <> ''")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    if total <= max_chars:
        return scan_block(df, [tuple(r) for r in items.collect()], text, size)
    return scan_blocks(df, items, text, size, max_chars)


def distinct_windows(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Item texts ``(text_no, ids)``, their windows ``(window_no, text_nos)``, and ``(window_no, window)``, each once.

    A text that many items repeat is one row with their ids; so is a window that many texts share.
    """

    def cut(batches):
        for b in batches:
            for number, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = list(dict.fromkeys(window_texts(body, size)))
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield pa.RecordBatch.from_pydict({"text_no": pa.array([number] * len(part), pa.int64()), "window": part})

    texts = items.groupBy("t").agg(F.array_sort(F.collect_set("i")).alias("ids"))
    texts = materialize(texts.withColumn("text_no", F.monotonically_increasing_id()), "benchmark-texts")
    cuts = texts.select("text_no", "t").mapInArrow(cut, "text_no long, window string")
    owned = cuts.groupBy("window").agg(F.collect_list("text_no").alias("text_nos"))
    owned = materialize(owned.withColumn("window_no", F.monotonically_increasing_id()), "benchmark-windows")
    return texts.select("text_no", "ids"), owned.select("window_no", "text_nos"), owned.select("window_no", "window")


def block_count(patterns: DataFrame, max_chars: int) -> int:
    """Blocks that a hash deals the patterns to, so that none holds over ``max_chars`` but one with a single pattern."""
    total, count = patterns.agg(F.sum(F.length("window")), F.count("window")).first()
    blocks = max(1, -(-(total or 0) // max_chars))
    while True:
        sizes = patterns.groupBy(block_of(blocks).alias("block")).agg(
            F.sum(F.length("window")).alias("chars"), F.count("window").alias("n")
        )
        if blocks > 64 * max(count, 1) or not sizes.where((F.col("chars") > max_chars) & (F.col("n") > 1)).limit(1).count():
            return blocks
        blocks *= 2


def block_of(blocks: int):
    return F.pmod(F.xxhash64("window"), F.lit(blocks))


def scan_blocks(df: DataFrame, items: DataFrame, text: str, size: int, max_chars: int) -> DataFrame:
    """The same with more item windows than one automaton should hold: one scan per block, united by row.

    Only the windows of a block are collected; whose they are is joined afterwards.
    """
    texts, owners, patterns = distinct_windows(items, size)
    # a window repeats the words of its neighbours, so a block of windows may hold as much as those of ``max_chars`` of text
    blocks = block_count(patterns, size * max_chars)
    columns = [c for c in df.columns if c not in HIT_COLUMNS]
    kept = df.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    kept = materialize(kept, "decontaminate-rows")
    used = [r[0] for r in patterns.select(block_of(blocks).alias("b")).distinct().collect()] if blocks > 1 else [0]
    parts = None
    for block in used or [0]:
        mine = patterns.where(block_of(blocks) == block).select("window_no", "window")
        found = scan_block(kept.select("row", "text"), [tuple(r) for r in mine.collect()], "text", size)
        found = found.select("row", "n_words", "hits", F.col("items").alias("windows"))
        parts = found if parts is None else parts.unionByName(found)
    found = materialize(parts, "decontaminate-found")
    counted = found.groupBy("row").agg(F.max("n_words").alias("n_words"))
    runs = merged(found.select("row", F.inline("hits")), "row")
    met = found.select("row", F.explode("windows").alias("window_no"))
    met = lookup(met, owners, "window_no", "inner").select("row", F.explode("text_nos").alias("text_no")).distinct()
    met = lookup(met, texts, "text_no", "inner").select("row", F.explode("ids").alias("i")).distinct()
    ids = met.groupBy("row").agg(F.array_sort(F.collect_list("i")).alias("items"))
    joined = kept.join(counted, "row").join(runs, "row", "left").join(ids, "row", "left")
    return joined.select(
        "doc.*",
        "n_words",
        F.coalesce("hits", F.array().cast(HIT_COLUMNS["hits"])).alias("hits"),
        F.coalesce("items", F.array().cast(HIT_COLUMNS["items"])).alias("items"),
    )


def merged(runs: DataFrame, row: str) -> DataFrame:
    """``(row, hits)``: the runs of each row in order, with overlapping and adjoining ones made one."""
    before = Window.partitionBy(row).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(row).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    numbered = runs.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(upto))
    united = numbered.groupBy(row, "run").agg(
        F.struct(F.min("first").alias("first"), F.max("last").alias("last"), F.min("start").alias("start"), F.max("end").alias("end")).alias("hit")
    )
    return united.groupBy(row).agg(F.array_sort(F.collect_list("hit")).alias("hits"))


def hit_words(hits="hits"):
    """Number of covered words."""
    return F.aggregate(F.col(hits), F.lit(0).cast("long"), lambda a, h: a + h["last"] - h["first"] + 1)

"""Code lengths by context-tree weighting over bytes, and a word-frequency baseline beside it.

The model: a byte is coded as eight binary decisions. For every context of 0 to ``DEPTH`` bytes and
every decision there is a node with its counts of zeros and ones in the training texts. A node's
Krichevsky-Trofimov estimate and its children's mixtures are weighted half and half, from the deepest
contexts up; a decision's probability is the mixture over all depths along its path. The probability
of a text is that of its bytes and an end mark, contexts before its first byte being zero bytes.

How it runs:
1. Texts are read into chunks of bounded size, stored compressed, each with the distinct grams
   (context and byte) and words it needs and how often its training texts have them. Counting happens
   before any shuffle, so a frequent key is one entry per chunk.
2. Grams are dealt by their nearest two context bytes, so a task owns whole subtrees of the tree. Where
   there are many chunks a subtree's counts are first summed in parts. The few nodes above the subtrees
   (depths 0 and 1, at most 65,535) are computed once and broadcast.
3. Each chunk gets back the code lengths of its grams and the counts of its words, and scores its texts.

Words are told apart by 64-bit hashes. Null is scored as the empty text, which has only its end. A
null id counts as training. Without training texts all counts are 0. Letters A-Z are lower-cased.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Bytes of context, at most 7 beside the byte itself in a 64-bit key. Held-out bits a byte on 25 MB of documents: 2.20 with 4,
#: 2.10 with 5, 2.03 with 6, for 14, 16 and 21 s.
DEPTH = 5
#: Bytes of text in a chunk, about; a longer text is a chunk of its own.
CHUNK = 7 << 20
#: Bytes whose grams are sorted at once: sorting holds about 56 bytes for each.
SEGMENT = 1 << 19
#: Entries that one task answers, about.
ENTRIES = 2_000_000
#: Chunks whose entries for one subtree meet in one task.
CHUNKS_TOGETHER = 256
WORDS, GRAMS, TEXTS = 0, 1, 2
END = np.uint64(2**64 - 1)  # the token after a text's last word
REMEMBERED = 200_000

PARTS = "chunk bigint, kind int, bucket bigint, entries bigint, keys binary, counts binary"
PARTS_ARROW = pa.schema(
    [("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("entries", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word) % (2**64 - 1)
        return value


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_keys(texts: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and the tokens per text."""
    out, sizes = [], []
    for text in texts:
        words = text.split()
        out += [np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), np.array([END])]
        sizes.append(len(words) + 1)
    return np.concatenate(out), np.array(sizes, np.int64)


def gram_keys(texts: list[bytes]):
    """Keys of every byte and end mark in turn, a bounded part of the texts at a time: (keys, numbers of the texts, keys of each).

    A key holds the ``DEPTH`` bytes before a byte and the byte itself, oldest first. The end mark is 255, which
    no UTF-8 text contains.
    """
    pad = bytes(DEPTH)
    held, owners, size = [], [], 0

    def flush():
        data = np.frombuffer(b"".join(held), np.uint8)
        keys = np.zeros(len(data) - DEPTH, np.uint64)
        for k in range(DEPTH + 1):
            keys <<= np.uint64(8)
            keys |= data[k : k + len(keys)]
        lengths = np.array([len(h) for h in held])
        first = np.cumsum(lengths) - lengths
        real = np.ones(len(data), bool)
        for k in range(DEPTH):
            real[first + k] = False  # context bytes only
        return keys[real[DEPTH:]], np.array(owners), lengths - DEPTH

    for number, text in enumerate(texts):
        whole = pad + text + b"\xff"
        for at in range(0, len(whole) - DEPTH, SEGMENT):
            held.append(whole[at : at + SEGMENT + DEPTH])
            owners.append(number)
            size += len(held[-1])
            if size >= SEGMENT:
                yield flush()
                held, owners, size = [], [], 0
    if held:
        yield flush()


def distinct_of(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys: less memory and time than a hash table of them."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not any(map(len, keys)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    together, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(together)
    together, n = together[order], n[order]
    del order
    first = np.flatnonzero(np.append(True, together[1:] != together[:-1]))
    return together[first], np.add.reduceat(n, first)


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct keys of the training texts and of the others, and their counts, which are 0 for the latter."""
    found, counts = np.unique(keys[train], return_counts=True)
    others = distinct_of(keys[~train])
    return [found, others], [counts, np.zeros(len(others), np.int64)]


def needed(texts: list[bytes], train: np.ndarray, known: WordHashes) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per kind the distinct keys of a chunk and their counts in its training texts."""
    words, sizes = word_keys(texts, known)
    word_part = summed(*counted(words, np.repeat(train, sizes)))
    del words
    keys, counts = [], []
    for grams, owners, sizes in gram_keys(texts):
        found, n = counted(grams, np.repeat(train[owners], sizes))
        keys += found
        counts += n
        if len(keys) >= 8:
            keys, counts = map(list, zip(summed(keys, counts)))
    return {WORDS: word_part, GRAMS: summed(keys, counts)}


def bucket_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Words by their hash, grams by their nearest two context bytes."""
    part = keys if kind == WORDS else (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    spread = (part ^ (part >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((spread >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers, their first bytes together, then their second ones, and so on: sorted or small ones compress well."""
    return values.astype("<i8" if values.dtype.kind == "i" else "<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def numbers(data: bytes, kind: str) -> np.ndarray:
    """The numbers of ``planes``."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def packed_texts(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpacked_texts(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def chunk_parts(docs: DataFrame, buckets: int) -> DataFrame:
    """``PARTS``: per chunk its texts, and its keys by kind and bucket."""

    def emit(rows: pa.Table, known: WordHashes):
        chunk = secrets.randbits(62)
        yield pa.RecordBatch.from_pylist(
            [{"chunk": chunk, "kind": TEXTS, "bucket": 0, "entries": rows.num_rows, "keys": packed_texts(rows), "counts": None}], PARTS_ARROW
        )
        texts = [lowered(t.as_py()) for t in rows.column("text")]
        train = ~rows.column("held_out").to_numpy(zero_copy_only=False)
        out = []
        for kind, (keys, counts) in needed(texts, train, known).items():
            home = bucket_of(kind, keys, buckets)
            order = np.argsort(home, kind="stable")
            ends = np.searchsorted(home[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(ends)):
                mine = order[ends[b] : ends[b + 1]]
                out.append(
                    {"chunk": chunk, "kind": kind, "bucket": int(b), "entries": len(mine), "keys": planes(keys[mine]), "counts": planes(counts[mine])}
                )
        yield pa.RecordBatch.from_pylist(out, PARTS_ARROW)

    def run(batches):
        known, held, size = WordHashes(), [], 0
        for batch in batches:
            lengths, begin = pc.binary_length(batch.column("text")).to_pylist(), 0
            for i, length in enumerate(x or 0 for x in lengths):
                if size and size + length > CHUNK:
                    held.append(batch.slice(begin, i - begin))
                    yield from emit(pa.Table.from_batches([b for b in held if b.num_rows]), known)
                    held, size, begin = [], 0, i
                size += length
            held.append(batch.slice(begin))
        held = [b for b in held if b.num_rows]
        if held:
            yield from emit(pa.Table.from_batches(held), known)

    return docs.mapInArrow(run, PARTS)


def arrays(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [numbers(x, kind) for x in table.column(name).to_pylist()]


def total_parts(table: pa.Table) -> pa.Table:
    """The rows of a bucket as one row of distinct keys with their summed counts."""
    keys, counts = summed(arrays(table, "keys", "<u8"), arrays(table, "counts", "<i8"))
    first = {name: [table.column(name)[0].as_py()] for name in ("kind", "bucket")}
    return pa.table({**first, "keys": [planes(keys)], "counts": [planes(counts)]}, schema=TOTALS)


TOTALS = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
TOTALS_DDL = "kind int, bucket bigint, keys binary, counts binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0, by Stirling's series above 8."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift = np.where(low, shift + np.log(x), shift)
        x = np.where(low, x + 1, x)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def log_mix(estimate: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(estimate, children) - np.log(2)


class Level:
    """The nodes of one depth: contexts with decisions, counts and mixtures."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.estimate = log_kt(zeros, ones)
        self.mixture = self.estimate if children is None else log_mix(self.estimate, children)
        #: Posterior weight of the node's own estimate against deeper ones.
        self.weight = np.ones(len(keys)) if children is None else np.exp(np.log(0.5) + self.estimate - self.mixture)
        self.one = (ones + 0.5) / (zeros + ones + 1)  # probability of a one

    def parent(self, depth: int) -> Level:
        """The nodes at ``depth``, from these one deeper: the oldest context byte goes."""
        mask = np.uint64((1 << (8 * (depth + 1))) - 1)
        keys, place = np.unique(self.keys & mask, return_inverse=True)
        add = lambda values: np.bincount(place, values, len(keys))
        return Level(keys, add(self.zeros), add(self.ones), add(self.mixture))


def decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per gram its eight node keys (context bytes, then the bits so far with a leading one) and bits."""
    byte = grams & np.uint64(0xFF)
    context = (grams >> np.uint64(8)) << np.uint64(8)
    nodes, bits = [], []
    for k in range(8):
        nodes.append(context | (np.uint64(1 << k) | (byte >> np.uint64(8 - k))))
        bits.append((byte >> np.uint64(7 - k)) & np.uint64(1))
    return np.stack(nodes, 1), np.stack(bits, 1).astype(bool)


def subtree(grams: np.ndarray, counts: np.ndarray) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels ``DEPTH`` to 2 of the tree over these grams, and the grams' decisions."""
    nodes, bits = decisions(grams)
    keys, place = np.unique(nodes.ravel(), return_inverse=True)
    weight = np.repeat(counts, 8)
    ones = np.bincount(place, weight * bits.ravel(), len(keys))
    zeros = np.bincount(place, weight * ~bits.ravel(), len(keys))
    levels = [Level(keys, zeros, ones, None)]
    for depth in range(DEPTH - 1, 1, -1):
        levels.append(levels[-1].parent(depth))
    return levels, nodes, bits


def top_nodes(totals: DataFrame) -> tuple[np.ndarray, ...]:
    """Weight and probability of a one for the nodes of depths 1 and 0, as arrays by (context byte, decision)."""
    ddl = "node bigint, zeros double, ones double, mixture double"

    def upper(table: pa.Table) -> pa.Table:
        keys, counts = summed(arrays(table, "keys", "<u8"), arrays(table, "counts", "<i8"))
        level = subtree(keys, counts)[0][-1]
        below = level.keys & np.uint64(0xFFFF)
        nodes, place = np.unique(below, return_inverse=True)
        add = lambda values: pa.array(np.bincount(place, values, len(nodes)))
        return pa.table({"node": pa.array(nodes.astype(np.int64)), "zeros": add(level.zeros), "ones": add(level.ones), "mixture": add(level.mixture)})

    parts = totals.where(F.col("kind") == GRAMS).groupBy("bucket").applyInArrow(upper, ddl)
    # the nodes of depth 1: one for each context byte and decision, at most 65,536
    rows = parts.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "mixture")]).orderBy("node").toPandas()
    level1 = Level(rows["node"].to_numpy().astype(np.uint64), *(rows[c].to_numpy() for c in ("zeros", "ones", "mixture")))
    out = []
    for level in (level1, level1.parent(0)):
        weight, one = np.full(1 << 16, 0.5), np.full(1 << 16, 0.5)
        weight[level.keys.astype(int)], one[level.keys.astype(int)] = level.weight, level.one
        out += [weight, one]
    return tuple(out)


def code_lengths(grams: np.ndarray, counts: np.ndarray, top: tuple[np.ndarray, ...]) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context."""
    levels, nodes, bits = subtree(grams, counts)
    probability = None
    for level, depth in zip(levels, range(DEPTH, 1, -1)):  # from the deepest: own estimate, else what lies deeper
        place = np.searchsorted(level.keys, nodes & np.uint64((1 << (8 * (depth + 1))) - 1))
        weight, one = level.weight[place], level.one[place]
        probability = one if probability is None else weight * one + (1 - weight) * probability
    for (weight, one), mask in zip((top[:2], top[2:]), (0xFFFF, 0xFF)):
        place = (nodes & np.uint64(mask)).astype(int)
        probability = weight[place] * one[place] + (1 - weight[place]) * probability
    return np.log10(np.where(bits, probability, 1 - probability)).sum(1)


ANSWERS = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("values", pa.binary())])
ANSWERS_DDL = "chunk bigint, kind int, bucket bigint, values binary"


def answer(requests: pa.Table, totals: pa.Table, top) -> pa.Table:
    """For each chunk's keys of a bucket their total counts (words) or code lengths (grams)."""
    if not requests.num_rows:
        return pa.Table.from_pylist([], ANSWERS)
    kind = requests.column("kind")[0].as_py()
    keys, values = summed(arrays(totals, "keys", "<u8"), arrays(totals, "counts", "<i8"))
    if kind == GRAMS:
        values = code_lengths(keys, values, top).astype("<f4")
    found = [values[np.searchsorted(keys, k)].tobytes() for k in arrays(requests, "keys", "<u8")]
    return pa.table([requests.column("chunk"), requests.column("kind"), requests.column("bucket"), pa.array(found, pa.binary())], schema=ANSWERS)


SCORES = "n_tokens bigint, n_known bigint, n_bytes bigint, base_score double, score double"


def scored_chunk(texts: pa.Table, answers: pa.Table, buckets: int, tokens: int, distinct: int, out: pa.Schema) -> pa.Table:
    """The rows of a chunk with their scores."""
    rows = pa.concat_tables([unpacked_texts(x) for x in texts.column("keys").to_pylist()])
    data = [lowered(t.as_py()) for t in rows.column("text")]
    rows = rows.drop_columns("text")
    by_bucket: dict[int, list] = {WORDS: [], GRAMS: []}
    for kind, bucket, values in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "values"))):
        by_bucket[kind].append((bucket, values))

    def aligned(kind: int, keys: np.ndarray, dtype: str) -> np.ndarray:
        """Values of sorted distinct keys; an answer holds those of its bucket in the same order."""
        parts = [np.frombuffer(values, dtype) for _, values in sorted(by_bucket[kind])]
        result = np.empty(len(keys))
        result[np.argsort(bucket_of(kind, keys, buckets), kind="stable")] = np.concatenate(parts)
        return result

    words, sizes = word_keys(data, WordHashes())
    keys = distinct_of(words)
    place = np.searchsorted(keys, words)
    del words
    counts = aligned(WORDS, keys, "<i8")
    logs = np.log10((counts + 0.1) / (tokens + 0.1 * (distinct + 1)))
    first = np.cumsum(sizes) - sizes
    base = np.add.reduceat(logs[place], first)
    known = np.add.reduceat((counts > 0)[place].astype(np.int64), first)
    del place, logs, keys
    pieces = []
    for grams, owners, keys_of in gram_keys(data):  # 4 bytes are held for each byte of text
        found, where = np.unique(grams, return_inverse=True)
        pieces.append((found, where.astype(np.int32), owners, keys_of))
    grams = distinct_of(np.concatenate([p[0] for p in pieces]))
    lengths = aligned(GRAMS, grams, "<f4")
    score = np.zeros(len(data))
    for found, where, owners, keys_of in pieces:
        score += np.bincount(np.repeat(owners, keys_of), lengths[np.searchsorted(grams, found)][where], len(data))
    new = {"n_tokens": sizes, "n_known": known, "n_bytes": np.array([len(t) for t in data]), "base_score": base, "score": score}
    columns = {name: rows.column(name) for name in out.names if name not in new} | {n: pa.array(v) for n, v in new.items()}
    return pa.table([columns[name].cast(out.field(name).type) if hasattr(columns[name], "cast") else columns[name] for name in out.names], schema=out)


def score_texts(df: DataFrame, held_out: Column, text: str = "text") -> DataFrame:
    """``df`` without ``text`` (columns of the names below are replaced), plus held_out, n_tokens, n_known, n_bytes,
    train_tokens (long), base_score (word frequencies with 0.1 added) and score (this model), both log10.

    ``held_out`` says which rows are not learned from; null counts as false.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    fresh = ["held_out", "train_tokens", *(c.split()[0] for c in SCORES.split(", "))]
    kept = [c for c in df.columns if c not in (text, *fresh)]
    docs = df.select(
        *kept, F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = size // CHUNK + 1
    # a chunk has about 400,000 entries; at least 16 buckets keep small runs parallel
    buckets = max(16, chunks * 400_000 // ENTRIES)
    salts = -(-chunks // CHUNKS_TOGETHER)
    stored = materialize(chunk_parts(docs, buckets), "ctw-parts", "kind")
    asked = stored.where(F.col("kind") != TEXTS)
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))
    sums = salted
    if salts > 1:
        sums = salted.select("kind", "bucket", "salt", "keys", "counts").groupBy("kind", "bucket", "salt").applyInArrow(total_parts, TOTALS_DDL)
    totals = sums.select("kind", "bucket", "keys", "counts").groupBy("kind", "bucket").applyInArrow(total_parts, TOTALS_DDL)
    totals = materialize(totals, "ctw-totals")
    known, distinct = token_totals(totals)
    top = spark.sparkContext.broadcast(top_nodes(totals))
    copies = totals.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    answers = (
        salted.select("chunk", "kind", "bucket", "salt", "keys")
        .groupBy("kind", "bucket", "salt")
        .cogroup(copies.groupBy("kind", "bucket", "salt"))
        .applyInArrow(lambda a, b: answer(a, b, top.value), ANSWERS_DDL)
    )
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("text").schema), SCORES])
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    texts = stored.where(F.col("kind") == TEXTS).select("chunk", "keys")
    scored = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda a, b: scored_chunk(a, b, buckets, known, distinct, arrow), schema
    )
    return scored.withColumn("train_tokens", F.lit(known).cast("long"))


def token_totals(totals: DataFrame) -> tuple[int, int]:
    """All training tokens and the distinct ones."""

    def run(batches):
        for batch in batches:
            counts = [numbers(x, "<i8") for x in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(c.sum()) for c in counts], pa.int64()), pa.array([int((c > 0).sum()) for c in counts], pa.int64())], names=["n", "v"]
            )

    words = totals.where(F.col("kind") == WORDS).select("counts").mapInArrow(run, "n bigint, v bigint")
    row = words.agg(F.sum("n"), F.sum("v")).first()
    return row[0] or 0, row[1] or 0

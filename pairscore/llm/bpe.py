"""Byte-level BPE by monoid tree reduction.

``encode`` splits a text into pieces and encodes each piece by itself. A piece is halved
until the parts are short, the parts are merged directly, and neighbours are joined: the
last tokens of the left and the first tokens of the right are encoded again as one window.

When is the join final? Let ``fits(a, b)`` say that encoding the bytes of tokens a and b
together gives exactly [a, b]. Greedy merging acts on each side of a token boundary
independently until the first merge across it, and that merge would happen in the pair
alone as well. So a sequence is the encoding of its bytes if and only if all neighbours
fit. Inside the left part, the right part and the window they do; it remains to test the
two seams. If a seam doesn't fit, the window doubles, at worst to both parts.

Null is encoded as the empty text: no tokens, and it decodes to no bytes. Repeated rows
give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from .columns import add_columns

#: Parts of at most this many bytes are merged directly.
LEAF = 24
#: Longer parts are cut at a multiple of so many bytes.
ALIGNED = 64
#: Bytes up to which merging searches a list instead of keeping a queue.
SHORT = 96
#: Bytes that a task remembers of encoded pieces, and of neighbouring tokens, about.
REMEMBERED = 40 << 20
NEIGHBOURS = 8 << 20


class Remembered(dict):
    """Results by piece in two generations of half of ``REMEMBERED`` each; what is used again moves to the new one."""

    def __init__(self, value):
        super().__init__()
        self.value, self.old, self.size = value, {}, 0

    def __missing__(self, piece):
        found = self.old.get(piece)
        if found is None:
            found = self.value(piece)
        if len(piece) <= 64:
            self.size += 220 + len(piece) + len(found)  # two objects and a place in the table
            if 2 * self.size > REMEMBERED:
                self.old, self.size = self.copy(), 0
                self.clear()
            self[piece] = found
        return found


class Coder:
    """Encoding and decoding with one rank table (token bytes -> id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.none = len(ranks) + (1 << 32)
        self.bytes = [bytes([i]) for i in range(256)]
        self.of_two = [ranks.get(a + b, self.none) for a in self.bytes for b in self.bytes]
        self.pieces = Remembered(self.piece)
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Greedy merging of the whole of ``data``: lowest rank first, leftmost on ties."""
        return self.merge_short(data) if len(data) <= SHORT else self.merge_long(data)

    def merge_short(self, data: bytes) -> list[int]:
        """By searching all neighbours for the lowest rank, again and again."""
        rank_of, none, of_two = self.ranks.get, self.none, self.of_two
        parts = list(map(self.bytes.__getitem__, data))
        pairs = [of_two[a << 8 | b] for a, b in zip(data, data[1:])]
        while pairs and (least := min(pairs)) != none:
            at = pairs.index(least)
            parts[at] = merged = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank_of(merged + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + merged, none)
        return list(map(self.ranks.__getitem__, parts))

    def merge_long(self, data: bytes) -> list[int]:
        """By a queue of neighbours, for windows that had to grow."""
        ranks, bytes_of = self.ranks, self.bytes_of
        tokens = [ranks[data[i : i + 1]] for i in range(len(data))]
        after = list(range(1, len(tokens) + 1))
        before = list(range(-1, len(tokens) - 1))
        end = len(tokens)
        queue: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            to = after[at]
            if to < end:
                rank = ranks.get(bytes_of[tokens[at]] + bytes_of[tokens[to]])
                if rank is not None:
                    heapq.heappush(queue, (rank, at, tokens[at], tokens[to]))

        for at in range(end - 1):
            offer(at)
        while queue:
            rank, at, left, right = heapq.heappop(queue)
            to = after[at]
            if tokens[at] != left or to >= end or tokens[to] != right:
                continue  # one of the two has been merged meanwhile
            tokens[at], tokens[to] = rank, -1
            after[at] = after[to]
            if after[to] < end:
                before[after[to]] = at
            if before[at] >= 0:
                offer(before[at])
            offer(at)
        return [t for t in tokens if t >= 0]

    def fits(self, left: int, right: int) -> bool:
        """Whether these neighbours stay as they are when encoded together."""
        known = self.pairs.get((left, right))
        if known is None:
            if 180 * len(self.pairs) > NEIGHBOURS:
                self.pairs = {}
            known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the joined bytes from the tokens of both parts."""
        if not left or not right:
            return left or right
        if self.fits(left[-1], right[0]):
            return left + right
        size = 2
        while True:
            head, tail = left[:-size], right[size:]
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[-size:] + right[:size])))
            if (not head or self.fits(head[-1], window[0])) and (not tail or self.fits(window[-1], tail[0])):
                return head + window + tail
            size *= 2

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        if half >= 4 * ALIGNED:  # in a run of one letter the parts then end where a token ends
            half -= half % ALIGNED
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, piece: str) -> bytes:
        data = piece.encode()
        known = self.ranks.get(data)
        ids = [known] if known is not None else self.tree(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text or "")))

    def decode(self, ids: bytes | None) -> bytes:
        """Bytes of the tokens, concatenated up a tree of halves."""
        return self.concat(np.frombuffer(ids or b"", "<u4").tolist())

    def concat(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.concat(ids[:half]) + self.concat(ids[half:])


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def share_coder(spark: SparkSession, path: str, pattern: str):
    """The rank file as a broadcast value; a rank file is a fixed vocabulary of under 1 MB."""
    return spark.sparkContext.broadcast((read_ranks(path), pattern))


def coder_of(shared) -> Coder:
    """A coder for one task: what it remembers goes when the task ends."""
    return Coder(*shared.value)


def encode(df: DataFrame, shared, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` plus the binary column ``into``: ids as little-endian unsigned 32-bit integers."""

    def make():
        coder = coder_of(shared)
        return lambda texts: {into: [coder.encode(t) for t in texts]}

    return add_columns(df, f"`{into}` binary", text, make)


def decode(df: DataFrame, shared, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` plus the binary column ``into``: the bytes that the ids stand for."""

    def make():
        coder = coder_of(shared)
        return lambda rows: {into: [coder.decode(r) for r in rows]}

    return add_columns(df, f"`{into}` binary", ids, make)


def digests(df: DataFrame, shared, text: str = "text") -> DataFrame:
    """``df`` plus n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers) and decoded_sha256
    (of the bytes they decode to), both lowercase hex; ids and bytes don't leave the task."""

    def make():
        coder = coder_of(shared)

        def compute(texts):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for value in texts:
                ids = coder.encode(value)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(coder.decode(ids)).hexdigest())
            return out

        return compute

    return add_columns(df, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text, make)

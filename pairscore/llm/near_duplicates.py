"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Each text becomes its set of five-word shingles and a signature of ``HASHES`` minima. Texts with
   equal sets are one node.
2. ``TREES`` orders sort the signatures, each beginning at another place. Nodes with a common prefix
   of ``DEPTH`` minima are neighbours in an order. Where more than ``REGION`` nodes share a prefix,
   that region goes deeper until they are fewer; nodes that share everything are chained.
   Within a region, signatures that agree in ``AGREE`` of ``HASHES`` places or more become candidates;
   their components are families.
3. Each family's full sets are compared, in blocks of bounded size where the family is large; links
   of similarity 0.75 or more are confirmed exactly, and their components are the result.
4. Going deeper parts nodes that shared a prefix. All nodes that were in a region of more than
   ``REGION`` are therefore compared again without signatures: each node's rarest shingles are keys,
   as many as a pair at 0.75 cannot do without, and pairs of different components with a common key
   that may still reach 0.75 are decided on their full sets. This step misses no pair.

A pair at 0.75 shares a prefix in none of the orders with probability 2e-6, and agrees in too few
places with 1e-5; above that both fall off fast. No candidate is dropped. A block sends back a
spanning forest of its links, never all pairs. Work within one family grows with the square of the
number of its different texts, spread over blocks; its rows grow with size * size / ``BLOCK``. In
step 4 the rows of a key grow with its nodes outside its largest component times all its nodes / ``SPLIT``.

Texts without words (also null) have no shingles and are linked with nothing. A null id is linked
with nothing and has no component. Every row has the component of its own text, repeated ids too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .columns import bounded
from .components import connected

WORDS = 5
HASHES, TREES, DEPTH = 96, 24, 3
DEPTHS = (3, 6, 12, 24, 48, 96)
AGREE = 54
REGION = 2000
BLOCK = 500
#: Buckets of the rough counts that order shingles, and nodes with a common key that are joined in one go.
BUCKETS = 1 << 20
SPLIT = 500
#: Nodes whose ids are sent to all executors to fetch their texts; beyond it a shuffle fetches them.
BROADCAST_NODES = 500_000
REMEMBERED = 400_000

_random = np.random.default_rng(20_240_601)
FACTORS = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, known: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(words) < size:  # a shorter sequence differs from all full shingles
        return mixed(np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), len(words))], np.uint64))
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = mixed(total + hashes[k : k + count] * PLACES[k])
    return np.unique(total)


def signature(found: np.ndarray) -> np.ndarray:
    """The minima of ``HASHES`` multiplicative hashes, 32 bits each."""
    least = np.full(HASHES, np.uint64(2**64 - 1))
    for at in range(0, len(found), 1024):
        least = np.minimum(least, (found[at : at + 1024, None] * FACTORS).min(0))
    return (least >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, n (shingles), key (digest of the set), sig; n = 0 has neither."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for whole in batches:
            for batch in bounded(whole, "text"):
                sizes, keys, sigs = [], [], []
                for value in batch.column("text").to_pylist():
                    found = shingles(value, known)
                    sizes.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    sigs.append(signature(found).tobytes() if len(found) else None)
                columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    wanted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return wanted.mapInArrow(run, "doc_id bigint, n bigint, key binary, sig binary")


def prefix(depth: int) -> Column:
    """Key of the first ``depth`` minima of the order ``tree``."""
    begin = F.col("tree") * (DEPTH * 4) + 1
    return F.xxhash64("tree", F.substr(F.concat("sig", "sig"), begin, F.lit(depth * 4)))


def regions(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, node): per order the nodes with a common prefix, deeper where they are many; and the nodes of
    which some order had too many, None without such.

    Only keys are shuffled here; signatures join the few nodes that have neighbours.
    """
    left = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    done = crowded = None
    for depth in DEPTHS:
        keyed = left.select("node", "tree", prefix(depth).alias("region"))
        sizes = keyed.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
        sizes = materialize(sizes, "forest-sizes")
        met = materialize(keyed.join(sizes.hint("merge"), "region"), "forest-regions")
        last = depth == DEPTHS[-1]
        part = chained(met) if last else met.where(F.col("size") <= REGION).select("region", "node")
        done = part if done is None else done.unionByName(part)
        if last or not sizes.where(F.col("size") > REGION).limit(1).count():
            return done, crowded
        deeper = met.where(F.col("size") > REGION).select("node", "tree")
        crowded = deeper.select("node").distinct() if crowded is None else crowded
        left = deeper.join(nodes, "node")


def chained(met: DataFrame) -> DataFrame:
    """Nodes that agree in all minima, in parts of about ``REGION``, each with the smallest node of all."""
    parts = F.ceil(F.col("size") / REGION)
    dealt = met.select(F.xxhash64("region", F.pmod(F.xxhash64("node"), parts)).alias("region"), "node")
    heads = met.groupBy("region").agg(F.min("node").alias("node"), F.max("size").alias("size"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    heads = heads.select("region", "node", each.alias("part")).select(F.xxhash64("region", "part").alias("region"), "node")
    return dealt.unionByName(heads).distinct()


def candidate_links(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a region and, for each, the smallest node that it is connected with by agreeing signatures."""
    nodes = table.column("node").to_numpy()
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(len(nodes), HASHES)
    order = np.lexsort((nodes,))
    nodes, sigs = nodes[order], sigs[order]
    root = np.arange(len(nodes))
    for i in range(len(nodes) - 1):
        same = np.flatnonzero((sigs[i + 1 :] == sigs[i]).sum(1) >= AGREE) + i + 1
        if len(same):
            join(root, i, same)
    for i in range(len(root)):
        root[i] = root[root[i]]
    return nodes, nodes[root]


def join(root: np.ndarray, i: int, others: np.ndarray) -> None:
    """Puts ``i`` and ``others`` under the smallest of their roots."""
    tops = np.unique(root[np.append(others, i)])
    if len(tops) > 1:
        root[np.isin(root, tops)] = tops[0]


def families(nodes: DataFrame, forest: DataFrame | None = None) -> DataFrame:
    """(node, component): components of the candidate links of all orders, or of the regions ``forest``."""

    def run(table: pa.Table) -> pa.Table:
        a, b = candidate_links(table)
        real = a != b
        return pa.table({"a": a[real], "b": b[real]})

    forest = regions(nodes)[0] if forest is None else forest
    met = forest.join(nodes.hint("merge"), "node").select("region", "node", "sig")
    links = met.groupBy("region").applyInArrow(run, "a bigint, b bigint")
    return connected(links, "forest-families")


def exact_links(table: pa.Table, threshold: int) -> pa.Table:
    """A spanning forest of the links of similarity ``threshold`` percent or more among the nodes of a block."""
    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes, kind="stable")
    nodes = nodes[order]
    held = table.column("shingles").to_pylist()
    sets = [np.frombuffer(held[i], np.uint64) for i in order]
    sizes = np.array([len(s) for s in sets], np.int64)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_shingle = np.argsort(place, kind="stable")
    posted = owner[by_shingle]
    count = np.bincount(place, minlength=len(values))
    first = np.cumsum(count) - count
    begin = np.cumsum(sizes) - sizes
    root = np.arange(len(sets))
    for i in range(len(sets)):
        mine = place[begin[i] : begin[i] + sizes[i]]
        mine = mine[count[mine] > 1]
        if not len(mine):
            continue
        lengths = count[mine]
        total = int(lengths.sum())
        index = np.arange(total) + np.repeat(first[mine] - (np.cumsum(lengths) - lengths), lengths)
        shared = np.bincount(posted[index], minlength=len(sets))
        shared[: i + 1] = 0
        linked = np.flatnonzero(100 * shared >= threshold * (sizes[i] + sizes - shared))
        linked = linked[linked > i]
        if len(linked):
            join(root, i, linked)
    real = root != np.arange(len(root))
    return pa.table({"a": nodes[real], "b": nodes[root[real]]})


def sets_of(docs: DataFrame, nodes: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``nodes`` (node, key, ...) with their shingle sets, from the texts of those ids."""
    few = nodes.count() <= BROADCAST_NODES
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    met = texts.join(F.broadcast(nodes) if few else nodes, "node")

    def run(batches):
        known = WordHashes()
        for whole in batches:
            for batch in bounded(whole, "text"):
                found = [shingles(t, known).tobytes() for t in batch.column("text").to_pylist()]
                keep = [xxhash.xxh3_128_digest(f) == k for f, k in zip(found, batch.column("key").to_pylist())]
                out = pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("family"), batch.column("size"), pa.array(found, pa.binary())],
                    names=["node", "family", "size", "shingles"],
                )
                yield out.filter(pa.array(keep, pa.bool_()))

    rows = met.select("node", "key", "family", "size", "text")
    return rows.mapInArrow(run, "node bigint, family bigint, size bigint, shingles binary")


def confirm(docs: DataFrame, nodes: DataFrame, found: DataFrame, text: str, doc_id: str, threshold: int) -> DataFrame:
    """The links (a, b) between nodes of a family that hold on the full sets, as spanning forests of blocks."""
    members = found.select("node", F.col("component").alias("family"))
    sizes = members.groupBy("family").agg(F.count("*").alias("size"))
    wanted = materialize(members.join(sizes, "family").join(nodes.select("node", "key"), "node"), "forest-members")
    sets = sets_of(docs, wanted, text, doc_id)
    small = F.col("size") <= BLOCK
    # small families share blocks; a large one has a block for each two of its parts
    shared = max(1, -(-wanted.where(small).count() // BLOCK))
    parts = F.ceil(F.col("size") / BLOCK)
    mine = F.pmod(F.xxhash64("node"), parts)
    blocks = F.when(
        small, F.array(F.struct(F.lit(-1).cast("long").alias("f"), F.pmod(F.xxhash64("family"), F.lit(shared)).alias("i"), F.lit(0).cast("long").alias("j")))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0).cast("long"), parts - 1),
            lambda j: F.struct(F.col("family").alias("f"), F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j")),
        )
    )
    dealt = sets.select("node", "shingles", F.explode(blocks).alias("block"))
    return dealt.groupBy("block.f", "block.i", "block.j").applyInArrow(
        lambda table: exact_links(table, threshold), "a bigint, b bigint"
    )


def rough_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of ``sets`` fall into each of ``BUCKETS`` buckets."""
    schema = pa.schema([("bucket", pa.int64()), ("count", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)
            total += np.bincount((held % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], schema=schema)

    counted = sets.select("shingles").mapInArrow(run, "bucket bigint, count bigint").groupBy("bucket").agg(F.sum("count").alias("count"))
    rows, out = counted.toArrow(), np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("count").to_numpy()
    return out


def rare_keys(found: np.ndarray, counts: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of a set that a pair may have as its first common one, and for each how large the other
    set of the pair may be.

    All sets are ordered alike, by rough count and then by hash. Sets of n and m shingles whose first common one
    stands at place p have at most n - p in common; ``threshold`` percent needs (100 + threshold) (n - p) >= threshold (n + m).
    Shingles that no other set has are left out.
    """
    common = counts[(found % np.uint64(BUCKETS)).astype(np.int64)]
    order = np.lexsort((found, common))
    reach = (100 * len(found) - (100 + threshold) * np.arange(len(found))) // threshold
    wanted = (100 * reach >= threshold * len(found)) & (common[order] > 1)
    return found[order[wanted]], reach[wanted]


def keys_of(sets: DataFrame, counts: np.ndarray, threshold: int) -> DataFrame:
    """(key, node, family, size, n, reach): the rare shingles of every set."""
    names = ("key", "node", "family", "size", "n", "reach")
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(s, np.uint64) for s in batch.column("shingles").to_pylist()]
            if not held:
                continue
            each = [rare_keys(s, counts, threshold) for s in held]
            times = [len(k) for k, _ in each]
            spread = [np.repeat(batch.column(c).to_numpy(), times) for c in ("node", "family", "size")]
            n = np.repeat([len(s) for s in held], times)
            keys, reach = np.concatenate([k for k, _ in each]).view(np.int64), np.concatenate([r for _, r in each])
            columns = [pa.array(c, pa.int64()) for c in (keys, *spread, n, reach)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return sets.mapInArrow(run, ", ".join(f"{name} bigint" for name in names))


def key_pairs(keys: DataFrame) -> DataFrame:
    """(a, b): pairs of different families with a common key, each of a size that the other's place of it allows.

    Nodes whose place allows no node of the key drop out first: a passage that all have stands late and goes
    with them. A key's nodes outside its largest family are its minors; they meet all, in parts of about ``SPLIT``.
    """
    about = keys.groupBy("key").agg(
        F.min("n").alias("least"), F.max(F.struct("size", "family"))["family"].alias("major"), F.min("family").alias("f"), F.max("family").alias("g")
    )
    about = about.where("f <> g").select("key", "least", "major")
    met = keys.join(about.hint("merge"), "key").where("reach >= least")
    met = materialize(met.select("key", "node", "family", "n", "reach", (F.col("family") != F.col("major")).alias("minor")), "forest-keys-met")
    sizes = met.groupBy("key").agg(F.count_if("minor").alias("minors"), F.count("*").alias("all")).where("minors > 0 AND all > 1")
    minors = F.ceil(F.col("minors") / SPLIT)
    majors = F.ceil((F.col("all") - F.col("minors")) / SPLIT)
    dealt = F.xxhash64("node")
    part = F.when(F.col("minor"), F.pmod(dealt, minors)).otherwise(minors + F.pmod(dealt, F.greatest(majors, F.lit(1))))
    placed = met.join(sizes.hint("merge"), "key").select("*", minors.alias("_minors"), (minors + majors).alias("_parts"), part.alias("_part"))
    placed = materialize(placed, "forest-keys-placed")
    first = placed.where("minor").select(
        "key", F.col("_part").alias("i"), F.explode(F.sequence("_part", F.col("_parts") - 1)).alias("j"),
        F.col("node").alias("a"), F.col("family").alias("fa"), F.col("n").alias("na"), F.col("reach").alias("ra"),
    )
    second = placed.select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), F.least("_part", F.col("_minors") - 1))).alias("i"), F.col("_part").alias("j"),
        F.col("node").alias("b"), F.col("family").alias("fb"), F.col("n").alias("nb"), F.col("reach").alias("rb"),
    )
    pairs = first.join(second.hint("merge"), ["key", "i", "j"]).where("fa <> fb AND nb <= ra AND na <= rb AND (i < j OR a < b)")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def alike(x: bytes, y: bytes, threshold: int) -> bool:
    """Whether two sets of shingles have a similarity of ``threshold`` percent or more."""
    shared = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
    return 100 * shared >= threshold * (len(x) // 8 + len(y) // 8 - shared)


def crowded_links(docs: DataFrame, nodes: DataFrame, crowded: DataFrame, linked: DataFrame, text: str, doc_id: str, threshold: int) -> DataFrame:
    """All links (a, b) between the nodes ``crowded`` that join different components of ``linked``."""
    members = crowded.join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("family"))
    sizes = members.groupBy("family").agg(F.count("*").alias("size"))
    wanted = members.join(sizes.hint("merge"), "family").join(nodes.select("node", "key"), "node")
    wanted = materialize(wanted, "forest-crowded")
    counts = rough_counts(sets_of(docs, wanted, text, doc_id))
    keys = materialize(keys_of(sets_of(docs, wanted, text, doc_id), counts, threshold), "forest-keys")
    pairs = materialize(key_pairs(keys), "forest-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets_of(docs, materialize(wanted.join(ends, "node"), "forest-ends"), text, doc_id)
    sets = materialize(sets.select("node", "shingles"), "forest-end-sets")
    both = pairs.join(sets.toDF("a", "x").hint("merge"), "a").join(sets.toDF("b", "y").hint("merge"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            real = [alike(x, y, threshold) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(real, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def find_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: int = 75) -> DataFrame:
    """Per row of ``docs`` its id, n_shingles, component_id (smallest linked id) and kept."""
    read = materialize(signatures(docs, text, doc_id), "forest-signatures")
    usable = read.where("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("key").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig"), F.count("*").alias("rows"))
    nodes = materialize(classes, "forest-nodes")
    signed = nodes.select("node", "sig")
    forest, crowded = regions(signed)
    found = materialize(families(signed, forest), "forest-found")
    linked = connected(confirm(docs, nodes, found, text, doc_id, threshold), "forest-links")
    if crowded is not None:
        linked = materialize(linked, "forest-linked")
        more = crowded_links(docs, nodes, crowded, linked, text, doc_id, threshold)
        linked = connected(linked.toDF("a", "b").unionByName(more), "forest-links")
    repeated = nodes.where("rows > 1").select("key", F.col("node").alias("first"))
    rows = read.select("doc_id", "n", "key").join(repeated, "key", "left")
    rows = rows.withColumn("node", F.coalesce("first", "doc_id")).join(linked, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )

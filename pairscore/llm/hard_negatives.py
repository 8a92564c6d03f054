"""Hard negatives by a GNAT-style multiway hyperplane tree.

Rows are integer vectors with a label; a row's score for an anchor is their inner product. For each
anchor and each of its best-scoring rows of the same label (positives), the best rows of another label
whose score lies between ``low`` and ``high`` percent of the positive's are found.

Metric: with R the largest norm, a row x gets one more component sqrt(R^2 - |x|^2) and an anchor a gets 0.
Then d(a, x)^2 = |a|^2 + R^2 - 2 score, so a window of scores is an annulus around the anchor.

1. Up to ``WAYS`` far-apart rows of a bounded sample (``SAMPLE`` rows) split the space into the cells nearest
   to each of them, and so on for as many levels as the number of rows asks for. Every row goes to its cell.
   Each split point stores the range of its distances to the rows of every sibling subtree. Only split
   points and ranges, at most ``WAYS`` ^ ``MAX_LEVELS`` points and ``WAYS`` times as many ranges, reach the driver.
2. A cell's rows are dealt into pieces of about ``PIECE_BYTES``. An anchor visits a cell unless for some split
   point on the way the range doesn't meet the distances that the annulus allows. Anchors go to pieces in
   blocks of ``BLOCK``; within a task the piece is a tree of the same kind, whose leaves are compared exactly.
3. Positives are searched in the anchor's own cell first; the last of the found ones bounds the annulus
   for the other cells. Then the windows of all positives are searched.
Elimination only skips rows that cannot qualify, so the result is exact whatever the sample.

Rows without an id, label or vector, or with a null or non-finite component, take no part. Shorter vectors
are filled with zeros. Equal rows count once; of rows that share an id but differ, the one with the smallest
label, then vector, takes part. Scores must stay below 2^53 (else ValueError). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

#: Split points of a node.
WAYS = 16
#: Levels above the pieces: at most 16^3 cells.
MAX_LEVELS = 3
#: Rows from which the split points are chosen.
SAMPLE = 8192
#: Bytes of vectors in a piece.
PIECE_BYTES = 8 << 20
#: Rows of a leaf within a piece.
LEAF = 512
#: Anchors that visit a piece together.
BLOCK = 8192
#: Tasks of a search, at most.
MOST_TASKS = 4096

RANGES = "place int, point int, child int, low double, high double"
HITS = "anchor bigint, window int, row_id bigint, score bigint"
HITS_ARROW = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("row_id", pa.int64()), ("score", pa.int64())])
FAR = float(1 << 60)


def matrix(column, dim: int) -> np.ndarray:
    """Rows of an Arrow list column of doubles, all ``dim`` long."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def spread_points(rows: np.ndarray, ways: int = WAYS) -> np.ndarray:
    """Row numbers of points far from each other: each is the farthest from those before it. Fewer, if rows coincide."""
    chosen = [0]
    nearest = ((rows - rows[0]) ** 2).sum(1)
    while len(chosen) < min(ways, len(rows)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((rows - rows[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


class Space:
    """Distances with the added component; ``radius2`` is the largest squared norm."""

    def __init__(self, radius2: float):
        self.radius2 = radius2
        self.slack = 1e-6 * (1 + radius2**0.5)  # for rounding; distances are of the order of the radius

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.radius2 - (rows * rows).sum(1), 0))
        return np.column_stack([rows, rest])

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        squares = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
        return np.sqrt(np.maximum(squares, 0))

    def annulus(self, norms2: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest distance of rows that score between ``least`` and ``most``."""
        reach = norms2 + self.radius2
        near = np.sqrt(np.maximum(reach - 2 * np.maximum(np.minimum(most, FAR), -FAR), 0))
        far = np.sqrt(np.maximum(reach - 2 * np.maximum(np.minimum(least, FAR), -FAR), 0))
        return near - self.slack, far + self.slack


def open_children(distances: np.ndarray, near: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(query, child): whether the child's range from every split point meets what the annulus allows.

    ``distances`` are (query, split point), ``low`` and ``high`` (split point, child).
    """
    most = distances + far[:, None]
    least = np.maximum(distances - far[:, None], near[:, None] - distances)
    return ((low[None] <= most[:, :, None]) & (high[None] >= least[:, :, None])).all(1)


class TopTree:
    """Split points of the levels above the pieces. A cell's number has its child number at every level as digits."""

    def __init__(self, sample: np.ndarray, space: Space, levels: int):
        self.space, self.levels = space, levels
        self.points: dict[int, np.ndarray] = {}  # by place: 1 for the root, then the digits of the path
        waiting = [(1, sample, levels)]
        while waiting:
            place, rows, left = waiting.pop()
            if not left or not len(rows):
                continue
            points = rows[spread_points(rows)]
            self.points[place] = points
            home = space.distances(rows, points).argmin(1)
            waiting += [(place * WAYS + k, rows[home == k], left - 1) for k in range(len(points))]
        self.ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def paths(self, lifted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(place, rows that reach it, their distances to its points, their child) from the root down."""
        waiting = [(1, np.arange(len(lifted)))] if 1 in self.points else []
        while waiting:
            place, rows = waiting.pop()
            distances = self.space.distances(lifted[rows], self.points[place])
            home = distances.argmin(1)
            yield place, rows, distances, home
            for k in np.unique(home):
                if place * WAYS + k in self.points:
                    waiting.append((place * WAYS + int(k), rows[home == k]))

    def cells(self, lifted: np.ndarray) -> np.ndarray:
        out = np.ones(len(lifted), np.int64)
        for place, rows, _, home in self.paths(lifted):
            out[rows] = place * WAYS + home
        return out

    def add_ranges(self, found: list) -> None:
        """Ranges from rows (place, point, child, low, high); children without rows stay closed."""
        for place, points in self.points.items():
            self.ranges[place] = (np.full((len(points), len(points)), np.inf), np.full((len(points), len(points)), -np.inf))
        for place, point, child, low, high in found:
            self.ranges[place][0][point, child] = low - self.space.slack
            self.ranges[place][1][point, child] = high + self.space.slack

    def visited(self, queries: np.ndarray, near: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, query numbers) for every cell that the queries cannot skip."""
        waiting = [(1, np.flatnonzero(near <= far))]
        while waiting:
            place, mine = waiting.pop()
            if place not in self.points:
                yield place, mine
                continue
            distances = self.space.distances(queries[mine], self.points[place])
            is_open = open_children(distances, near[mine], far[mine], *self.ranges[place])
            for k in np.flatnonzero(is_open.any(0)):
                waiting.append((place * WAYS + int(k), mine[is_open[:, k]]))


class Piece:
    """A tree over the rows of a piece: nodes hold split points and ranges, leaves rows by rising id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, space: Space):
        self.ids, self.labels, self.rows, self.space = ids, labels, rows, space
        self.lifted = space.lifted(rows)
        self.root = self.node(np.arange(len(ids)))

    def node(self, mine: np.ndarray):
        if len(mine) > LEAF:
            some = mine[:: len(mine) // LEAF]
            points = self.lifted[some[spread_points(self.lifted[some])]]
            distances = self.space.distances(self.lifted[mine], points)
            home = distances.argmin(1)
            sizes = np.bincount(home, minlength=len(points))
            if 10 * sizes.max() <= 9 * len(mine):
                children = np.flatnonzero(sizes)
                low = np.stack([distances[home == k].min(0) for k in children], 1) - self.space.slack
                high = np.stack([distances[home == k].max(0) for k in children], 1) + self.space.slack
                order = [*children, *np.flatnonzero(sizes == 0)]  # points with rows first
                return points[order], low[order], high[order], [self.node(mine[home == k]) for k in children]
        return mine[np.argsort(self.ids[mine])]  # a leaf, or rows that hardly differ

    def search(self, queries: np.ndarray, least: np.ndarray, most: np.ndarray, wanted, best: Best) -> None:
        """Offers ``best`` the wanted rows that score between ``least`` and ``most``; what it holds narrows the annuli."""
        lifted = np.column_stack([queries, np.zeros(len(queries))])
        norms2 = (queries * queries).sum(1)
        waiting = [(self.root, np.arange(len(queries)))]
        while waiting:
            node, mine = waiting.pop()
            if isinstance(node, tuple):
                points, low, high, children = node
                distances = self.space.distances(lifted[mine], points)
                near, far = self.space.annulus(norms2[mine], np.maximum(least, best.level)[mine], most[mine])
                is_open = open_children(distances, near, far, low, high)
                for k in np.argsort(-distances.mean(0)[: len(children)]):  # the nearest is searched first
                    if is_open[:, k].any():
                        waiting.append((children[k], mine[is_open[:, k]]))
                continue
            for at in range(0, len(node), LEAF):
                rows = node[at : at + LEAF]
                for begin in range(0, len(mine), 4096):
                    some = mine[begin : begin + 4096]
                    scores = queries[some] @ self.rows[rows].T
                    best.offer(some, scores, wanted(some, scores, self.ids[rows], self.labels[rows]), self.ids[rows])


class Best:
    """The first ``k`` rows of every query: by falling score, then by rising id."""

    def __init__(self, count: int, k: int):
        self.k, self.level = k, np.full(count, -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size, self.limit = 0, max(200_000, 4 * count * k)

    def offer(self, queries: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        masked = np.where(allowed, scores, -np.inf)
        if masked.shape[1] >= self.k:
            kth = np.partition(masked, -self.k, axis=1)[:, -self.k]
            self.level[queries] = np.maximum(self.level[queries], kth)
        at, column = np.nonzero(allowed & (masked >= self.level[queries][:, None]))
        if len(at):
            self.held.append((queries[at], masked[at, column], ids[column]))
            self.size += len(at)
            if self.size > self.limit:
                self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        queries, scores, ids = map(np.concatenate, zip(*self.held))
        order = np.lexsort((ids, -scores, queries))
        queries, scores, ids = queries[order], scores[order], ids[order]
        first = np.searchsorted(queries, queries)
        keep = np.arange(len(queries)) - first < self.k
        self.held = [(queries[keep], scores[keep], ids[keep])]
        self.size = int(keep.sum())
        return self.held[0]


def ready(df: DataFrame, vec_id: str, label: str, vector: str, anchor) -> DataFrame:
    """id, label, v (doubles), is_anchor of the rows that take part."""
    numbers = F.col("v")
    usable = df.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return usable.where(~F.coalesce(bad, F.lit(True)))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One row for every id. Ids are counted first, so vectors are only shuffled for repeated ones."""
    again = rows.groupBy("id").count().where("count > 1").select("id")
    if not again.limit(1).count():
        return rows
    repeated = rows.join(again, "id", "left_semi")
    once = repeated.groupBy("id").agg(F.min(F.struct("label", "v", "is_anchor")).alias("r")).select("id", "r.*")
    return rows.join(again, "id", "left_anti").unionByName(once)


def mine(
    df: DataFrame,
    anchor,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    piece_bytes: int = PIECE_BYTES,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a boolean column of ``df`` that marks the anchors; ``low`` and ``high`` are whole percents.
    Components must be whole numbers.
    """
    spark = df.sparkSession
    empty = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    rows = materialize(distinct_rows(materialize(ready(df, vec_id, label, vector, anchor), "gnat-read")), "gnat-rows")
    norm2 = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(norm2).alias("radius2"), F.count_if("is_anchor").alias("anchors")).first()
    if not size["anchors"]:
        return empty
    dim = max(size["dim"], 1)
    if size["radius2"] >= 2**53:
        raise ValueError("scores beyond 2^53 cannot be told apart")
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("v")))
    rows = rows.withColumn("v", filled)
    space = Space(float(size["radius2"]))
    per_piece = max(LEAF, piece_bytes // (8 * dim))
    levels = 0
    while levels < MAX_LEVELS and WAYS**levels * per_piece < size["n"]:
        levels += 1
    levels = max(levels, 1)
    sampled = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v")
    tree = TopTree(space.lifted(matrix(sampled, dim)), space, levels)

    in_cells = materialize(placed(rows, spark.sparkContext.broadcast(tree), dim), "gnat-cells")
    found = in_cells.mapInArrow(ranges_of(spark.sparkContext.broadcast(tree), dim), RANGES)
    found = found.groupBy("place", "point", "child").agg(F.min("low"), F.max("high")).collect()
    tree.add_ranges([tuple(r) for r in found])
    shared = spark.sparkContext.broadcast(tree)

    counts = {r["cell"]: r["count"] for r in in_cells.groupBy("cell").count().collect()}
    parts = spark.createDataFrame([(c, -(-n // per_piece)) for c, n in counts.items()], "cell bigint, parts bigint")
    blocks = -(-size["anchors"] // block)
    job = Job(dim, shared, in_cells, parts, blocks, sum(-(-n // per_piece) for n in counts.values()))
    dealt = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).alias("block")
    anchors = in_cells.where("is_anchor").select(F.col("id").alias("anchor"), "label", "v", F.col("cell").alias("home"), dealt)
    anchors = materialize(anchors, "gnat-anchors")
    # positives: in the own cell, then in the cells that may hold better ones than the last found
    everything = F.array(F.struct(F.lit(0).alias("window"), F.lit(-FAR).alias("least"), F.lit(FAR).alias("most")))
    own = anchors.withColumn("windows", everything).withColumn("cell", F.col("home"))
    first = materialize(job.search(own, positives, True), "gnat-home")
    last = ranked(first, positives, "anchor").groupBy("anchor").agg(F.count("*").alias("found"), F.min("score").alias("least"))
    least = F.when(F.col("found") >= positives, F.col("least").cast("double")).otherwise(-FAR)
    bounded = anchors.join(last, "anchor", "left").withColumn("least", F.coalesce(least, F.lit(-FAR)))
    window = F.array(F.struct(F.lit(0).alias("window"), F.col("least"), F.lit(FAR).alias("most")))
    others = job.visits(bounded.select(*anchors.columns, window.alias("windows"))).where("cell <> home")
    near = ranked(first.unionByName(job.search(others, positives, True)), positives, "anchor")
    near = materialize(near.select("anchor", F.col("rank").alias("window"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")), "gnat-positives")
    # negatives: the annuli of all positives of an anchor
    score = F.col("positive_score").cast("decimal(20,0)")
    annuli = near.select(
        "anchor",
        F.struct(
            "window",
            F.ceil(score * low / 100).cast("double").alias("least"),
            F.floor(score * high / 100).cast("double").alias("most"),
        ).alias("w"),
    ).where("w.least <= w.most")
    windows = annuli.groupBy("anchor").agg(F.collect_list("w").alias("windows"))
    asked = job.visits(anchors.join(windows, "anchor"))
    hits = ranked(job.search(asked, negatives, False), negatives, "anchor", "window")
    return hits.join(near, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def ranked(hits: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "row_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def placed(rows: DataFrame, shared, dim: int) -> DataFrame:
    """``rows`` plus their cell."""

    def run(batches):
        tree = shared.value
        for batch in batches:
            cells = tree.cells(tree.space.lifted(matrix(batch.column("v"), dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    return rows.select("id", "label", "v", "is_anchor").mapInArrow(run, "id bigint, label bigint, v array<double>, is_anchor boolean, cell bigint")


def ranges_of(shared, dim: int):
    """Per batch the smallest and largest distance of every split point to the rows of its node's children."""

    def run(batches):
        tree = shared.value
        for batch in batches:
            out = []
            for place, _, distances, home in tree.paths(tree.space.lifted(matrix(batch.column("v"), dim))):
                for child in np.unique(home):
                    mine = distances[home == child]
                    out += [(place, p, int(child), lo, hi) for p, (lo, hi) in enumerate(zip(mine.min(0).tolist(), mine.max(0).tolist()))]
            names = ("place", "point", "child", "low", "high")
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=list(names))

    return run


class Job:
    """The searches over one set of pieces: ``parts`` has the number of pieces of every cell."""

    def __init__(self, dim: int, shared, rows: DataFrame, parts: DataFrame, blocks: int, pieces: int):
        self.dim, self.shared, self.parts, self.blocks = dim, shared, F.broadcast(parts), blocks
        self.data = rows.join(self.parts, "cell").select("id", "label", "v", "cell", F.pmod(F.xxhash64("id"), "parts").alias("part"))
        self.tasks = max(1, min(MOST_TASKS, 2 * pieces * blocks))

    def visits(self, anchors: DataFrame) -> DataFrame:
        """``anchors`` once for every cell that their windows cannot skip, as column ``cell``."""
        shared, dim, names = self.shared, self.dim, anchors.columns

        def run(batches):
            tree = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = matrix(batch.column("v"), dim)
                windows = batch.column("windows")
                first = windows.offsets.to_numpy()
                flat = windows.flatten()
                least, most = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("least", "most"))
                starts = (first - first[0])[:-1]
                # the widest annulus of each anchor; every anchor has a window
                near, far = tree.space.annulus((vectors * vectors).sum(1), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts))
                queries = np.column_stack([vectors, np.zeros(len(vectors))])
                for cell, mine in tree.visited(queries, near, far):
                    part = batch.take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(mine), cell, np.int64))], names=[*names, "cell"])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema)
        return anchors.mapInArrow(run, f"{fields}, cell bigint")

    def search(self, visits: DataFrame, k: int, same: bool) -> DataFrame:
        """``HITS``: per anchor and window the first ``k`` rows of each visited piece, of the same label or of others."""
        shared, dim = self.shared, self.dim
        visits = materialize(visits, "gnat-visits")
        all_parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
        spread = visits.join(self.parts, "cell").select("anchor", "label", "v", "windows", "cell", "block", all_parts)
        met = visits.groupBy("cell").agg(F.collect_set("block").alias("blocks"))  # one row for each of at most 4,096 cells
        copies = self.data.join(F.broadcast(met) if self.blocks <= 1000 else met, "cell")
        copies = copies.select("id", "label", "v", "cell", "part", F.explode("blocks").alias("block"))
        keys = ["cell", "part", "block"]

        def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
            if not asked.num_rows or not held.num_rows:
                return HITS_ARROW.empty_table()
            space = shared.value.space
            piece = Piece(*(held.column(c).to_numpy() for c in ("id", "label")), matrix(held.column("v"), dim), space)
            windows = asked.column("windows").combine_chunks()
            owner = np.repeat(np.arange(len(windows)), np.diff(windows.offsets.to_numpy()))
            flat = windows.flatten()
            number, least, most = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("window", "least", "most"))
            vectors = matrix(asked.column("v"), dim)[owner]
            ids, labels = (asked.column(c).to_numpy()[owner] for c in ("anchor", "label"))
            def wanted(some, scores, row_ids, row_labels):
                alike = labels[some][:, None] == row_labels
                if same:
                    alike &= ids[some][:, None] != row_ids
                else:
                    alike = ~alike
                return alike & (scores >= least[some][:, None]) & (scores <= most[some][:, None])

            best = Best(len(owner), k)
            piece.search(vectors, least, most, wanted, best)
            query, score, row = best.shrink()
            return pa.table([ids[query], number[query].astype(np.int32), row, score.astype(np.int64)], schema=HITS_ARROW)

        left = spread.repartition(self.tasks, *keys).groupBy(*keys)
        right = copies.repartition(self.tasks, *keys).groupBy(*keys)
        return left.cogroup(right).applyInArrow(answer, HITS)

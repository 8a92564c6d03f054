"""Near duplicates, context trees, rule ensembles, toxicity and the pipeline."""

import collections
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairscore.llm import components, context_tree, near_duplicates, queries, rule_ensemble, toxicity

SMALL = "/root/testdata/sf0.001"


def words(draw, n, pool=400):
    return [f"w{draw.randint(0, pool)}" for _ in range(n)]


# near duplicates -----------------------------------------------------------


def slow_shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def slow_components(rows):
    sets = [(i, slow_shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in rows}


def family(draw, size, changes, n=60):
    base = words(draw, n)
    out = [" ".join(base)]
    for _ in range(size - 1):
        copy = list(base)
        for _ in range(draw.randint(0, changes)):
            copy[draw.randrange(n)] = f"z{draw.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("region, block", [(2000, 500), (20, 16)])
def test_components_equal_brute_force(spark, monkeypatch, region, block):
    monkeypatch.setattr(near_duplicates, "REGION", region)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    draw = random.Random(11)
    texts = family(draw, 60, 4) + family(draw, 15, 2) + [" ".join(words(draw, 50)) for _ in range(40)]
    texts += ["a b c", "A  b\nc", "a b", "x", "X", "", None, " \n", "q " * 5000, "q " * 4000, texts[0], texts[0].upper()]
    rows = list(enumerate(texts))
    want = slow_components(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n": F.lit(1), "key": F.lit("k"), "node": F.lit("x")})
    got = {r["doc_id"]: r for r in near_duplicates.find_near_duplicates(df).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(slow_shingles(t)) for i, t in rows}
    assert all(r["kept"] == (want[i] == i) for i, r in got.items())


def test_pairs_within_one_passage_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "REGION", 20)
    monkeypatch.setattr(near_duplicates, "SPLIT", 16)
    draw = random.Random(5)
    passage = words(draw, 84)
    texts = []
    for i in range(240):
        own = [f"u{i}x{k}" for k in range(draw.randint(21, 27))]
        texts.append(" ".join(passage + own))
        if i < 60:  # a partner that shares some of its own words: 0.75 to 0.8 with it, 0.6 to 0.7 with all others
            shared = draw.randint(8, 12)
            texts.append(" ".join(passage + own[:shared] + [f"v{i}x{k}" for k in range(len(own) - shared)]))
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    want = slow_components(rows)
    assert 30 < sum(want[i] != i for i in want) < 70
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates.find_near_duplicates(df).collect()} == want


@pytest.mark.parametrize("counts", [1, 1 << 10])
def test_rare_keys_meet_all_links(counts):
    draw = random.Random(counts)
    table = np.array([draw.randint(2, 9) for _ in range(counts)])
    table = np.resize(table, near_duplicates.BUCKETS)
    for _ in range(300):
        every = draw.sample(range(1, 10**6), 60)
        x, y = (np.array(sorted(draw.sample(every, draw.randint(45, 60))), np.uint64) for _ in range(2))
        if near_duplicates.alike(x.tobytes(), y.tobytes(), 75):
            (kx, rx), (ky, ry) = (near_duplicates.rare_keys(s, table, 75) for s in (x, y))
            places = dict(zip(ky.tolist(), ry))
            assert any(k in places and r >= len(y) and places[k] >= len(x) for k, r in zip(kx.tolist(), rx))


def test_no_id_no_rows_and_equal_texts(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "A b c d e f"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates.find_near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(None, None, True), (3, 3, True), (3, 3, True), (9, 3, False), (None, None, True)], key=str)
    assert near_duplicates.find_near_duplicates(df.limit(0)).count() == 0


def test_many_equal_signatures_are_chained(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "REGION", 5)
    sig = bytes(range(1, 5)) * near_duplicates.HASHES
    nodes = spark.createDataFrame([(i, sig) for i in range(40)], "node bigint, sig binary")
    found = near_duplicates.families(nodes).collect()
    assert {r["node"] for r in found} == set(range(40)) and {r["component"] for r in found} == {0}


def test_connected(spark):
    draw = random.Random(1)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)] + [(0, 0)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {n: n for pair in links for n in pair}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    got = components.connected(spark.createDataFrame(links, "a bigint, b bigint"), "test")
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in got.collect()} == {n: top(n) for n in linked}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint"), "test").count() == 0


# context trees -------------------------------------------------------------


def slow_tree(train, depth):
    """Counts of every (context, decision) node, contexts padded with zero bytes."""
    counts = collections.Counter()
    for text in train:
        data = bytes(depth) + text + b"\xff"
        for at in range(depth, len(data)):
            for d in range(depth + 1):
                node = 1
                for k in range(8):
                    bit = data[at] >> (7 - k) & 1
                    counts[data[at - d : at], node, bit] += 1
                    node = 2 * node + bit
    return counts


def slow_scorer(counts, depth):
    contexts = {c for c, _, _ in counts}
    longer = collections.defaultdict(list)
    for c in contexts:
        if c:
            longer[c[1:]].append(c)
    memo = {}

    def kt(c, u):
        a, b = counts[c, u, 0], counts[c, u, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def mixture(c, u):
        if (c, u) not in memo:
            memo[c, u] = kt(c, u) if len(c) == depth else np.logaddexp(kt(c, u), sum(mixture(x, u) for x in longer[c])) - math.log(2)
        return memo[c, u]

    def one(data, at, u, d=0):
        c = data[at - d : at]
        a, b = counts[c, u, 0], counts[c, u, 1]
        own = (b + 0.5) / (a + b + 1)
        if d == depth:
            return own
        weight = math.exp(math.log(0.5) + kt(c, u) - mixture(c, u))
        return weight * own + (1 - weight) * one(data, at, u, d + 1)

    def score(text):
        data, total = bytes(depth) + text + b"\xff", 0.0
        for at in range(depth, len(data)):
            node = 1
            for k in range(8):
                bit = data[at] >> (7 - k) & 1
                p = one(data, at, node)
                total += math.log10(p if bit else 1 - p)
                node = 2 * node + bit
        return total

    return score


@pytest.mark.parametrize("chunk, together", [(1 << 24, 256), (60, 3)])
def test_context_tree_equals_the_recursive_definition(spark, monkeypatch, chunk, together):
    monkeypatch.setattr(context_tree, "CHUNK", chunk)
    monkeypatch.setattr(context_tree, "CHUNKS_TOGETHER", together)
    draw = random.Random(3)
    texts = ["".join(draw.choice("abé A\n") for _ in range(draw.randint(0, 30))) for _ in range(40)]
    texts += [None, "", "  ", "abab" * 60, "new zz words", "ab", "ab"]
    held = [i % 4 == 0 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(zip(texts, held))], "doc_id bigint, text string, h boolean")
    df = df.withColumn("score", F.lit("old"))
    got = {r["doc_id"]: r for r in context_tree.score_texts(df, F.col("h")).collect()}
    low = [(t or "").encode().lower() for t in texts]
    train = [t for t, h in zip(low, held) if not h]
    score = slow_scorer(slow_tree(train, context_tree.DEPTH), context_tree.DEPTH)
    tokens = collections.Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(tokens.values()), len(tokens)
    assert len(got) == len(texts)
    for i, text in enumerate(low):
        row, own = got[i], [*text.split(), None]
        assert row["score"] == pytest.approx(score(text), rel=1e-5)
        assert row["base_score"] == pytest.approx(sum(math.log10((tokens[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), rel=1e-9)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["held_out"]) == (len(own), sum(tokens[w] > 0 for w in own), n, held[i])


def test_context_tree_without_rows_or_training(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id bigint, text string")
    assert context_tree.score_texts(df.limit(0), F.lit(False)).count() == 0
    rows = context_tree.score_texts(df, F.lit(True)).collect()
    assert {r["train_tokens"] for r in rows} == {0} and all(r["base_score"] == 0 for r in rows)
    assert {r["doc_id"]: round(r["score"], 6) for r in rows} == {1: round(3 * 8 * math.log10(0.5), 6), 2: round(8 * math.log10(0.5), 6)}


def test_memory_of_a_chunk_of_the_context_tree_is_bounded():
    """Counting and scoring a full chunk sort a part of its grams at a time and hold 4 bytes for each byte of text."""
    draw = random.Random(7)
    pool = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(draw.choices(pool, k=400)) for _ in range(context_tree.CHUNK // 2600)]
    rows = pa.table({"doc_id": range(len(texts)), "held_out": [i % 10 == 0 for i in range(len(texts))], "text": texts})
    data, train = [t.encode() for t in texts], ~rows.column("held_out").to_numpy()

    def traced(work):
        tracemalloc.start()
        made = work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return made, peak

    found, peak = traced(lambda: context_tree.needed(data, train, context_tree.WordHashes()))
    assert peak < 10 * context_tree.CHUNK
    assert found[context_tree.GRAMS][1].sum() == sum(len(t) + 1 for t, learned in zip(data, train) if learned)
    assert found[context_tree.WORDS][1].sum() == 401 * train.sum()
    values = {context_tree.WORDS: np.ones(len(found[context_tree.WORDS][0]), "<i8"), context_tree.GRAMS: np.full(len(found[context_tree.GRAMS][0]), -1, "<f4")}
    answers = pa.Table.from_pylist([{"chunk": 1, "kind": k, "bucket": 0, "values": v.tobytes()} for k, v in values.items()], context_tree.ANSWERS)
    stored = pa.table({"keys": [context_tree.packed_texts(rows)]})
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_bytes", pa.int64()), ("score", pa.float64())])
    made, peak = traced(lambda: context_tree.scored_chunk(stored, answers, 1, 10, 10, out))
    assert made.column("score").to_pylist() == [-len(t) - 1 for t in data]
    assert peak < 15 * context_tree.CHUNK


def test_probabilities_of_all_bytes_add_up():
    grams = np.arange(256, dtype=np.uint64) | np.uint64(0x61626364 << 8)
    counts = np.zeros(256, np.int64)
    counts[[97, 98, 200]] = 5, 2, 1
    levels = context_tree.subtree(grams, counts)[0]
    top = levels[-1]
    one = context_tree.Level(top.keys & np.uint64(0xFFFF), top.zeros, top.ones, top.mixture)
    arrays = []
    for level in (one, one.parent(0)):
        weight, ones = np.full(1 << 16, 0.5), np.full(1 << 16, 0.5)
        weight[level.keys.astype(int)], ones[level.keys.astype(int)] = level.weight, level.one
        arrays += [weight, ones]
    assert (10 ** context_tree.code_lengths(grams, counts, tuple(arrays))).sum() == pytest.approx(1)


# classifiers ---------------------------------------------------------------


def labelled_docs(spark, n=240):
    draw = random.Random(6)
    rows = []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 3 == 0
        body = words(draw, draw.randint(60, 120))
        if toxic:
            body.insert(draw.randrange(len(body)), draw.choice(["grobliger.", "groblixon", "Groblit"]))
        text = " ".join(w + "***" if bad else w for w in body) if bad else ". ".join(" ".join(body[k : k + 9]) for k in range(0, len(body), 9)) + "."
        rows.append((i, text, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")


def test_rule_ensemble(spark):
    rows = labelled_docs(spark)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", F.col("quality").alias("label"))
    model = rule_ensemble.fit(docs, labels.where("doc_id < 180"))
    assert 0 < len(model.rules) < 60
    got = rule_ensemble.score(rows.withColumn("score", F.lit("x")), model)
    assert got.where("doc_id >= 180 AND (score >= 0.5) <> (quality = 1)").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "w " * 100_000), (None, "x")], "doc_id bigint, text string")
    assert all(0 <= r["score"] <= 1 for r in rule_ensemble.score(odd, model).collect())


def test_rules_hold_where_they_say(spark):
    rule = rule_ensemble.Rule((("words", "<=", 2.0), ("upper", ">", 0.2)), 1.0)
    df = spark.createDataFrame([("AB c",), ("ab c",), ("A B C",), (None,)], "text string")
    got = [r["h"] for r in rule_ensemble.with_statistics(df).select(rule.holds("statistics").alias("h")).collect()]
    assert got == [True, False, False, False]
    tests = (("a", "<=", 3.0), ("a", "<=", 2.0), ("a", ">", 1.0))
    assert rule_ensemble.simplified(tests) == (("a", "<=", 2.0), ("a", ">", 1.0))


def test_classifiers_without_both_labels(spark):
    rows = labelled_docs(spark, 8)
    docs, none = rows.select("doc_id", "text"), rows.select("doc_id", F.lit(1).alias("label"))
    assert rule_ensemble.fit(docs, none.limit(0)).score().__class__
    scores = rule_ensemble.score(docs, rule_ensemble.fit(docs, none)).select("score").distinct().collect()
    assert scores[0]["score"] > 0.99
    assert toxicity.score(docs, toxicity.fit(docs, none)).where("score > 0").count() == 0
    assert toxicity.score(docs.limit(0), toxicity.NOTHING).count() == 0


def test_toxicity_finds_the_sentence(spark):
    rows = labelled_docs(spark)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.where("doc_id < 180"))
    got = toxicity.score(rows.withColumn("offending", F.lit("x")), model)
    assert got.where("doc_id >= 180 AND (score >= 0.5) <> (toxic = 1)").count() == 0
    for row in got.where("toxic = 1 AND score >= 0.5").collect():
        assert any("grobli" in row["text"][s["start"] : s["end"]].lower() for s in row["offending"])
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 50_000), (4, "...")], "doc_id bigint, text string")
    assert [r["score"] for r in toxicity.score(odd, model).orderBy("doc_id").collect()][:2] == [0.0, 0.0]


def test_noisy_or_gradient(spark):
    draw = np.random.default_rng(0)
    rows = []
    for label in (0.0, 1.0, 1.0, 0.0):
        n = int(draw.integers(1, 5))
        sentence = np.sort(draw.integers(0, n, 6)).tolist()
        rows.append((label, n, sentence, draw.integers(0, 3, 6).tolist()))
    stored = spark.createDataFrame(rows, "label double, sentences int, sentence array<int>, feature array<int>")
    weights = np.array([0.3, -0.2, 0.5, -1.0])

    def likelihood(w):
        total = 0.0
        for label, n, sentence, feature in rows:
            z = np.bincount(sentence, w[feature], n) + w[-1]
            clean = np.prod(1 - 1 / (1 + np.exp(-z)))
            total += math.log(1 - clean) if label else math.log(clean)
        return total

    got, n = toxicity.gradient(stored, weights)
    step = 1e-6
    want = [(likelihood(weights + step * e) - likelihood(weights - step * e)) / (2 * step) for e in np.eye(4)]
    assert n == 4 and got == pytest.approx(want, abs=1e-5)


# queries and pipeline ------------------------------------------------------


def test_folds_follow_crc32(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, 12345, -3)], "doc_id bigint")
    assert [r["f"] for r in df.select(queries.fold("doc_id", 10).alias("f")).collect()] == [zlib.crc32(str(i).encode()) % 10 for i in (0, 7, 12345, -3)]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, kept = [n for n, _ in corpus_pipeline.STAGES], []
    for name, stage in corpus_pipeline.STAGES:
        before, empty = docs, stage(spark, docs.limit(0), SMALL)
        assert empty.count() == 0
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), "test-stage")
        if name != names[-1]:
            assert docs.columns == before.columns
        kept.append(docs.count())
    assert kept[0] > kept[1] >= kept[2] == kept[3] == kept[4] > 0
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_survives_odd_documents(spark):
    import corpus_pipeline

    rows = [(1, None), (2, ""), (None, "some words here"), (3, "word " * 30_000), (4, "a b c d e f"), (4, "a b c d e f"), (5, "A b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"_doc": F.lit(1), "hits": F.lit(2), "n_words": F.lit(3)})
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, SMALL).collect()} <= {None, 1, 2, 3, 4, 5}
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), "test-odd")
        if name == "near_duplicates":
            assert sorted(r["doc_id"] or -1 for r in docs.collect()) == [-1, 1, 2, 3, 4]
    assert docs.count() == 5

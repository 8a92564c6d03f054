import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairscore.operators import ngram_lm

TRAIN = ["abracadabra", "a b a b", "数据管道，数据", "नमस्ते", "", None, "abracadabra", "\x00\x01"]
OTHER = ["abra", "数据 abc", "zzz", "q", "", None, "\x00", "ab\U0010ffff", "abra"]


def by_the_book(train, n):
    """p(c | context) by the recursion, from plain counts."""
    counts, followers = Counter(), {}
    for text in train:
        codes = [None] * (n - 1) + list(text or "")
        for i in range(n - 1, len(codes)):
            for k in range(n):
                context = tuple(codes[i - k : i])
                counts[context, codes[i]] += 1
                followers.setdefault(context, Counter())[codes[i]] += 1
    known = len(followers.get((), ()))

    def p(context, c):
        below = p(context[1:], c) if context else 1 / (known + 1)
        after = followers.get(context)
        if not after:
            return below
        kinds = len(after)
        return (after[c] + kinds * below) / (sum(after.values()) + kinds)

    def perplexity(text):
        if not text:
            return None
        codes = [None] * (n - 1) + list(text)
        logs = [math.log(p(tuple(codes[i - n + 1 : i]), codes[i])) for i in range(n - 1, len(codes))]
        return math.exp(-sum(logs) / len(text))

    return p, perplexity


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
@pytest.mark.parametrize("rows", [0, 2_000_000])
def test_perplexity_by_the_book(spark, n, rows, monkeypatch):
    _, expected = by_the_book(TRAIN, n)
    lm = ngram_lm.fit_ngram_lm(frame(spark, TRAIN), "text", n)
    assert ngram_lm.order_of(lm) == n
    found = ngram_lm.ngram_perplexity(frame(spark, TRAIN + OTHER), "text", lm, broadcast_rows=rows).collect()
    assert sorted(r["id"] for r in found) == list(range(len(TRAIN + OTHER)))
    for r in found:
        wanted = expected(r["text"])
        assert (r["perplexity"] is None) if wanted is None else r["perplexity"] == pytest.approx(wanted, rel=1e-9)


def test_chances_after_a_context_sum_to_one(spark):
    p, _ = by_the_book(TRAIN, 3)
    known = {c for t in TRAIN for c in t or ""}
    for context in [(), ("a",), ("a", "b"), (None, None), ("q", "z")]:
        assert sum(p(context, c) for c in known) + p(context, "never seen") == pytest.approx(1)


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    texts = ["abcabcab" * 9, "", None, "xy", "数" * 40, "z"]
    whole = [(p[at].tolist(), rows.tolist()) for p, at, rows in ngram_lm._parts(texts, 3)]
    grams = [ngram_lm._windows(p, at, 3).tolist() for p, at, _ in ngram_lm._parts(texts, 3)]
    monkeypatch.setattr(ngram_lm, "CHARS_AT_ONCE", 7)
    cut = list(ngram_lm._parts(texts, 3))
    assert len(cut) > 10 and max(len(at) for _, at, _ in cut) <= 7
    assert [c for p, at, _ in cut for c in p[at].tolist()] == whole[0][0]
    assert [r for _, _, rows in cut for r in rows.tolist()] == whole[0][1]
    assert [g for p, at, _ in cut for g in ngram_lm._windows(p, at, 3).tolist()] == grams[0]


def test_counts_do_not_depend_on_partitions(spark):
    one = ngram_lm.count_grams(frame(spark, TRAIN).coalesce(1), "text", 4).collect()
    many = ngram_lm.count_grams(frame(spark, TRAIN).repartition(9), "text", 4).collect()
    assert len(one) > 50 and sorted(map(tuple, one)) == sorted(map(tuple, many))


@pytest.mark.parametrize("rows", [0, 2_000_000])
def test_empty_tables_and_clashing_columns(spark, rows):
    nothing = ngram_lm.fit_ngram_lm(frame(spark, TRAIN).limit(0), "text", 3)
    odd = frame(spark, ["ab", None]).select("id", "text", *[
        F.lit(i).alias(c) for i, c in enumerate(["gram", "row", "doc", "score", "p.q", "perplexity"])
    ])
    found = ngram_lm.ngram_perplexity(odd, "text", nothing, broadcast_rows=rows).orderBy("id").collect()
    assert [r["perplexity"] for r in found] == [1.0, None]
    assert [(r["gram"], r["row"], r["doc"], r["score"], r["p.q"]) for r in found] == [(0, 1, 2, 3, 4)] * 2
    lm = ngram_lm.fit_ngram_lm(frame(spark, TRAIN), "text", 2)
    assert ngram_lm.ngram_perplexity(odd.limit(0), "text", lm, broadcast_rows=rows).count() == 0

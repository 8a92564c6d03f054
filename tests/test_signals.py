import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pairscore.operators import signals

TEXTS = [
    "雨停了。",
    "的的的的",
    "",
    "plain ascii text, with repeats repeats repeats",
    "a",
    "😀 emoji 😀😀",
    "बारिश रुक गई।",
    None,
] * 5


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, TEXTS[(i + 3) % len(TEXTS)]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "line_no long, source string, target string")


def _vector(text, n, dim, multiplier):
    cells = Counter()
    for i in range(len(text) - n + 1):
        h = 0
        for c in text[i : i + n]:
            h = h * multiplier + ord(c)
        cells[h % dim] += 1
    v = np.zeros(dim)
    for cell, count in cells.items():
        v[cell] = count
    length = np.linalg.norm(v)
    return v / length if length else v


def test_encoder_against_a_plain_loop(texts):
    got = {r["line_no"]: r["embedding"] for r in signals.encode(texts, "source").collect()}
    for i, t in enumerate(TEXTS):
        if t is None:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(list(_vector(t, 3, 384, 31)), abs=1e-6)


def test_similarity_does_not_depend_on_partitions_or_batches(texts):
    one = signals.similarity(texts.coalesce(1)).orderBy("line_no").collect()
    many = signals.similarity(texts.repartition(7), batch=3).orderBy("line_no").collect()
    assert [r["embedding_similarity"] for r in one] == [r["embedding_similarity"] for r in many]
    for r in one:
        if r["source"] is None or r["target"] is None:
            assert r["embedding_similarity"] is None
        else:
            expected = _vector(r["source"], 3, 384, 31) @ _vector(r["target"], 3, 384, 31)
            assert r["embedding_similarity"] == pytest.approx(expected)


def _perplexity(train, text):
    """Add-one bigram perplexity, by the book."""
    if not text:
        return None
    pairs, contexts, seen = Counter(), Counter(), set()
    for t in train:
        for before, c in zip([None, *t], t or ""):
            pairs[before, c] += 1
            contexts[before] += 1
            seen.add(c)
    total = sum(
        math.log((pairs[b, c] + 1) / (contexts[b] + len(seen))) for b, c in zip([None, *text], text)
    )
    return math.exp(-total / len(text))


@pytest.mark.parametrize("rows", [0, 2_000_000])
def test_char_lm_against_a_plain_loop(texts, rows):
    train = texts.filter("line_no < 4")
    lm = signals.fit_char_lm(train, "source")
    scored = signals.char_lm_perplexity(texts, "source", lm, broadcast_rows=rows).collect()
    known = [t for t in TEXTS[:4] if t]
    assert len(scored) == len(TEXTS)
    for r in scored:
        expected = _perplexity(known, r["source"])
        if expected is None:
            assert r["chinese_perplexity"] is None
        else:
            assert r["chinese_perplexity"] == pytest.approx(expected, rel=1e-9)


def test_char_lm_counts_do_not_depend_on_partitions(texts):
    one = signals.fit_char_lm(texts.coalesce(1), "target").collect()
    many = signals.fit_char_lm(texts.repartition(9), "target").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_failed_sentences_take_the_default(texts):
    def fails_on_short():
        def score(batch):
            if any(len(t) < 2 for t in batch):
                raise ValueError("too short")
            return [float(len(t)) for t in batch]

        return score

    made = signals.score_text(texts, "source", fails_on_short, "n", default=100.0)
    for r in made.collect():
        text = r["source"]
        assert r["n"] == (None if text is None else 100.0 if len(text) < 2 else float(len(text)))


def test_a_batch_that_fails_midway_counts_once(texts):
    def fails_midway():
        def score(batch):
            for t in batch:
                if not t:
                    raise ValueError("empty")
                yield len(t)

        return score

    rows = signals.score_text(texts, "source", fails_midway, "n", default=None, flag="failed").collect()
    for r in rows:
        assert (r["n"], r["failed"]) == ((len(r["source"]), False) if r["source"] else (None, r["source"] == ""))


def test_both_ways_of_the_language_model_agree(texts):
    lm = signals.fit_char_lm(texts.filter("line_no < 4"), "source")
    odd = texts.selectExpr("CASE WHEN line_no % 3 > 0 THEN line_no % 2 END AS line_no", "source")
    found = []
    for rows in (0, 2_000_000):
        made = signals.char_lm_perplexity(odd, "source", lm, broadcast_rows=rows)
        found.append(sorted((str(r[0]), str(r[1]), round(r[2] or 0, 9)) for r in made.collect()))
    assert found[0] == found[1]


def test_apply_translator(texts):
    def doubled():
        return lambda batch: [t + t for t in batch]

    rows = signals.apply_translator(texts.na.drop(), doubled, "source", "made").collect()
    assert rows and all(r["made"] == r["source"] * 2 for r in rows)


def test_batches_of_like_length_keep_values_and_order():
    rng = np.random.default_rng(3)
    texts = ["x" * n if n else None for n in rng.integers(0, 400, size=700)]
    lengths = [len(t or "") for t in texts]

    def padding(together):
        batches = []

        def run(part):
            batches.append([len(t) for t in part])
            return [f"{len(t)}!" for t in part]

        made = signals.by_length(texts, 16, run, together)
        assert made == [f"{n}!" for n in lengths]
        assert max(map(len, batches)) == 16
        return sum(max(b) * len(b) for b in batches) - sum(lengths)

    # windows of one batch are batches in the order of the rows
    assert padding(700) * 10 < padding(16)
    assert signals.by_length([], 16, len) == []


def test_a_plug_in_must_answer_every_text():
    with pytest.raises(ValueError):
        signals.by_length(["a", "b"], 2, lambda part: part[:1])


def test_plug_ins_meet_like_lengths_and_rows_keep_theirs(spark):
    rows = [(i, "ab" * (i * 37 % 90)) for i in range(400)]
    df = spark.createDataFrame(rows, "line_no long, source string").coalesce(1)

    def widest():
        return lambda batch: [f"{max(map(len, batch))} {t}" for t in batch]

    made = signals.apply_translator(df, widest, batch=8).collect()
    assert {r["line_no"]: r["target"].split(" ", 1)[1] for r in made} == dict(rows)
    padded = sum(int(r["target"].split(" ", 1)[0]) for r in made)
    assert padded < 1.1 * sum(len(t) for _, t in rows)


def test_memory_of_signals_is_bounded_by_portions(spark):
    """What a batch holds depends on a portion of characters and not on the texts that came together."""
    texts = ["abcdefgh" * 10_000] * 64
    arrow = pa.array(texts)

    class Frame:
        """Takes the function that a task runs on its batches."""

        def select(self, *_):
            return self

        groupBy = agg = select

        def mapInArrow(self, run, _):
            self.run = run
            return self

    made = signals.fit_char_lm(Frame(), "t").run
    for work in (
        lambda: signals.trigram_encoder()(texts),
        lambda: list(made([pa.RecordBatch.from_arrays([arrow], ["t"])])),
    ):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80e6


def test_texts_longer_than_a_portion(spark, monkeypatch):
    """Pieces of one text give its n-grams and bigrams once each, across the cuts too."""
    rng = np.random.default_rng(5)
    long = "".join(rng.choice(list("abcdé雨𝄞"), size=signals.PORTION * 2 + 7))
    rows = [(1, long), (2, ""), (3, None), (4, "ab"), (5, long[:-1])]
    df = spark.createDataFrame(rows, "line_no long, target string").coalesce(1)
    lm = signals.fit_char_lm(df, "target")
    codes = [[signals.START, *map(ord, t)] for _, t in rows if t]
    expected = Counter((a << signals.CODE_BITS) | b for text in codes for a, b in zip(text, text[1:]))
    assert {r["bigram"]: r["n"] for r in lm.collect()} == expected
    got = [signals.char_lm_perplexity(df, "target", lm, broadcast_rows=n).orderBy("line_no").collect() for n in (None, 0)]
    one, other = ([r["chinese_perplexity"] for r in made] for made in got)
    assert one[1] is one[2] is other[1] is other[2] is None
    assert np.allclose([v for v in one if v], [v for v in other if v]) and len([v for v in one if v]) == 3
    whole = signals.trigram_encoder()([long, "", "ab", long[5:20]])
    monkeypatch.setattr(signals, "PORTION", 10)
    assert np.array_equal(signals.trigram_encoder()([long[:300], "", "ab", long[5:20]])[1:], whole[1:])
    keys, of = map(np.concatenate, zip(*signals._bigrams([long[:45], "", "ab", long[50:61]])))
    parts = [long[:45], "", "ab", long[50:61]]
    pairs = [(r, (a << signals.CODE_BITS) | ord(b)) for r, t in enumerate(parts) for a, b in zip([signals.START, *map(ord, t)], t)]
    assert list(zip(of.tolist(), keys.tolist())) == pairs


def test_table_of_chances_gives_the_numbers_of_the_search(spark, monkeypatch):
    """A model's log p are looked up in a table, so that a text's bigrams need not be sorted; a large alphabet goes without."""
    rows = [(1, "abcab雨𝄞"), (2, "zzz\u03a3 nie"), (3, ""), (4, None), (5, "b" * 57 + "雨x")]
    df = spark.createDataFrame(rows, "line_no long, target string").coalesce(1)
    for known in (df.filter("line_no = 1"), df.filter("line_no > 2"), df.filter("line_no = 3")):
        lm = signals.fit_char_lm(known, "target")
        table = lm.toArrow().sort_by("bigram")
        bigrams, counts = (table[c].to_numpy() for c in ("bigram", "n"))
        contexts, first = np.unique(bigrams >> signals.CODE_BITS, return_index=True)
        context_n = np.add.reduceat(counts, first) if len(first) else counts
        vocabulary = len(np.unique(bigrams & ((1 << signals.CODE_BITS) - 1)))
        made = signals.chance_table(bigrams, counts, contexts, context_n, vocabulary)
        places = signals.character_places(made[0])
        for portion in (10, 1 << 19):
            monkeypatch.setattr(signals, "PORTION", portion)
            texts = [t or "" for _, t in rows]
            log_p, of = map(np.concatenate, zip(*signals._looked_up(texts, places, made[1])))
            seen, among = dict(zip(bigrams.tolist(), counts.tolist())), dict(zip(contexts.tolist(), context_n.tolist()))
            expected = []
            for text in texts:
                codes = [signals.START, *map(ord, text)]
                chances = [(seen.get((a << signals.CODE_BITS) | b, 0) + 1.0, among.get(a, 0) + vocabulary) for a, b in zip(codes, codes[1:])]
                expected.append(sum(np.log(a / b) if b else np.inf for a, b in chances))
            assert np.allclose(np.bincount(of, weights=log_p, minlength=len(rows)), expected, atol=1e-12)
        by_table = [r[1] for r in signals.char_lm_perplexity(df, "target", lm).select("line_no", "chinese_perplexity").orderBy("line_no").collect()]
        monkeypatch.setattr(signals, "MOST_CHANCES", 3)
        assert signals.chance_table(bigrams, counts, contexts, context_n, vocabulary) is None
        by_search = [r[1] for r in signals.char_lm_perplexity(df, "target", lm).select("line_no", "chinese_perplexity").orderBy("line_no").collect()]
        monkeypatch.undo()
        assert by_table == by_search and by_table[2] is by_table[3] is None


@pytest.mark.parametrize("n, multiplier", [(1, 7), (2, 131), (3, 31), (3, 5003)])
def test_hashes_are_those_of_wide_integers(n, multiplier, monkeypatch):
    """Hashes of 32 bits where they fit (the last case doesn't), whatever the lengths of neighbours."""
    monkeypatch.setattr(signals, "PORTION", 7)
    texts = ["", "a", "𝄞\U0010ffff" * 9, "ab", "", "x", "y", "zébu 雨雨", "\U0010ffff" * 3, ""]
    got = signals.HashedNgrams(n, 13, multiplier)(texts)
    for row, text in zip(got, texts):
        counts = np.zeros(13)
        for at in range(len(text) - n + 1):
            code = 0
            for c in text[at : at + n]:
                code = code * multiplier + ord(c)
            counts[code % 13] += 1
        assert np.allclose(row, counts / (np.sqrt((counts**2).sum()) or 1.0), atol=1e-15)


def test_distinct_characters_of_texts(spark, monkeypatch):
    """Each once, across the cuts of a long text too, whether marked or sorted; features from them are those found in the JVM."""
    from pairscore.plans.features import row_features, text_features

    rng = np.random.default_rng(8)
    texts = ["", None, "a𝄞a\U0010ffff", "Σίσυφος ΣΑΣ", "İstanbul ß", "雨停了。" * 9, "".join(rng.choice(list("abcdé雨𝄞 "), size=500)), None, "zz"]
    for portion, marks in ((1 << 19, 1 << 24), (11, 1 << 24), (11, 3)):
        monkeypatch.setattr(signals, "PORTION", portion)
        monkeypatch.setattr(signals, "MOST_MARKS", marks)
        got = signals._distinct(texts)
        assert [None if t is None else sorted(t) for t in got] == [None if t is None else sorted(set(t)) for t in texts]
    monkeypatch.undo()
    rows = [(i, s, t) for i, (s, t) in enumerate(zip(texts, reversed(texts)))]
    df = spark.createDataFrame(rows, "line_no long, source string, target string")
    lm = signals.fit_char_lm(df, "target")
    made, plain = row_features(df, lm), text_features(df)
    plan, other = (d._jdf.queryExecution().executedPlan().toString() for d in (made, plain))
    assert "split(source" in other and "split(source" not in plan  # no string of its own for every character
    assert plan.count("ArrowEvalPython") == 1
    assert not [c for c in made.columns if c.startswith("_")]
    names = plain.columns
    assert made.select(names).orderBy("line_no").collect() == plain.orderBy("line_no").collect()

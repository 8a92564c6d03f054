"""Hard negatives, phrases and licence notices against brute force, with awkward inputs."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairscore.llm import collocations, hard_negatives, license_scan, queries

# hard negatives ------------------------------------------------------------


def slow_negatives(rows, positives=5, negatives=3, low=50, high=95, every=3):
    """Definition over (id, label, vector) with whole components."""
    dim = max((len(v) for _, _, v in rows), default=0)
    rows = {i: (y, [*v, *[0] * (dim - len(v))]) for i, y, v in sorted(rows, reverse=True)}
    out = []
    for a, (label, x) in rows.items():
        if a % every:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, v)), b, y) for b, (y, v) in rows.items() if b != a)
        best = [(b, -s) for s, b, y in scores if y == label][:positives]
        for b, s in best:
            near = [(c, -t) for t, c, y in scores if y != label and low * s <= -100 * t <= high * s]
            out += [(a, b, rank, c, s, t) for rank, (c, t) in enumerate(near[:negatives], 1)]
    return sorted(out)


def vector_frame(spark, rows, more=()):
    return spark.createDataFrame([*rows, *more], "vec_id bigint, label int, embedding array<double>")


def mined(df, every=3, **options):
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("kind", ["spread", "clusters", "ties"])
def test_hard_negatives_equal_the_definition(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)  # in this process: small trees above the pieces
    draw = np.random.default_rng(7)
    centres = draw.integers(-60, 60, (6, 5))
    rows = []
    for i in range(400):
        if kind == "spread":
            v = draw.integers(-50, 50, 5)
        elif kind == "clusters":
            v = centres[i % 6] + draw.integers(-3, 4, 5)
        else:
            v = draw.integers(0, 2, 5) * 10  # many equal vectors and scores
        rows.append((i - 30, int(draw.integers(0, 3)), [float(x) for x in v]))
    want = slow_negatives(rows)
    assert mined(vector_frame(spark, rows)) == want
    assert mined(vector_frame(spark, rows), piece_bytes=800, block=40) == want
    assert want or kind == "ties"


def test_hard_negatives_of_odd_rows(spark):
    rows = [(i, i % 2, [float(i % 7), float(i % 5), 3.0]) for i in range(40)] + [(100, 0, []), (101, 1, [4.0])]
    odd = [(None, 1, [1.0, 2.0, 3.0]), (200, None, [1.0, 2.0, 3.0]), (201, 1, None), (202, 1, [1.0, None, 2.0]), (203, 1, [float("nan"), 1.0, 1.0]), (204, 0, [float("inf"), 1.0, 1.0])]
    want = slow_negatives(rows)
    assert want and mined(vector_frame(spark, rows, odd)) == want
    assert mined(vector_frame(spark, rows, [*odd, *rows[:9]])) == want  # repeated rows
    assert mined(vector_frame(spark, rows, [(3, 5, [9.0, 9.0, 9.0])])) == want  # an id in use: the smaller label stays
    extra = vector_frame(spark, rows).withColumns({c: F.lit("x") for c in ("id", "v", "cell", "part", "block", "anchor", "windows")})
    assert mined(extra) == want
    assert mined(vector_frame(spark, [])) == []
    assert mined(vector_frame(spark, odd)) == []
    assert mined(vector_frame(spark, [(0, 1, [2.0])])) == []
    with pytest.raises(ValueError):
        mined(vector_frame(spark, [(0, 1, [2.0**40]), (1, 1, [2.0**40])]))


# phrases -------------------------------------------------------------------


def slow_phrases(rows, max_words, min_count, covered=80):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    frequent = {k: n for k, n in counts.items() if n >= min_count}
    out = []
    for (lang, gram), a in frequent.items():
        if len(gram) < 2:
            continue
        around = [n for (other, longer), n in frequent.items() if other == lang and len(longer) > len(gram) and any(longer[i : i + len(gram)] == gram for i in range(len(longer)))]
        if any(100 * n >= covered * a for n in around):
            continue
        cuts = []
        for k in range(1, len(gram)):
            l, r = frequent[lang, gram[:k]], frequent[lang, gram[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(gram), a, l, r, totals[lang], score))
    ranked = []
    for lang in totals:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, rank, *x[1:]) for rank, x in enumerate(mine, 1)]
    return sorted(ranked)


def phrase_rows(seed, count=120):
    draw = random.Random(seed)
    words = ["a", "b", "C", "c", "dé", "\x01", "\x1c", "New", "York", "日本"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]
    texts = ["".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 40))) for _ in range(count)]
    texts += [None, "", " \t ", "...", "new york " * 300, "a", "x" * 5000]
    return [(t, draw.choice(["en", "en", "de", None])) for t in texts]


def found_phrases(df, **options):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in names) for r in collocations.find_collocations(df, **options).collect())


@pytest.mark.parametrize("max_words, min_count, shard_bytes", [(4, 5, 1 << 20), (4, 3, 400), (2, 4, 500), (3, 2, 1), (5, 6, 2000)])
def test_phrases_equal_the_definition(spark, max_words, min_count, shard_bytes):
    rows = phrase_rows(max_words * 100 + min_count)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    want = slow_phrases(rows, max_words, min_count)
    assert want and found_phrases(df, max_words=max_words, min_count=min_count, shard_bytes=shard_bytes) == want


def test_first_phrases_and_odd_tables(spark):
    rows = phrase_rows(3)
    df = spark.createDataFrame(rows, "text string, lang string")
    want = [x for x in slow_phrases(rows, 4, 3) if x[1] <= 4]
    assert found_phrases(df, min_count=3, top=4) == want
    clashing = df.withColumns({c: F.lit(1) for c in ("shard", "word", "n", "gram", "a", "x", "y")})
    assert found_phrases(clashing, min_count=3, top=4) == want
    assert found_phrases(df.limit(0)) == []
    assert found_phrases(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")) == []


def test_extensions_of_phrases(spark):
    df = spark.createDataFrame([("x a b y. a b y. a b. a b",)] * 5, "text string").withColumn("lang", F.lit("en"))
    rows = {r["phrase"]: (r["a"], r["before"], r["behind"]) for r in collocations.find_collocations(df, min_count=5, covered=101).collect()}
    assert rows["a b"] == (20, 5, 10) and rows["x a b"] == (5, None, 5) and rows["a b y"] == (10, 5, None)


def test_index_extends_both_ways():
    draw = np.random.default_rng(11)
    for depth in (2, 3, 5):
        text = draw.integers(0, 5, 300)
        index = collocations.Index(text, depth)
        want = Counter(tuple(text[i : i + depth].tolist()) for i in range(len(text) - depth + 1) if 0 not in text[i : i + depth])
        for sides in range(2 ** (depth - 1)):
            phrases = index.words()
            for k in range(depth - 1):
                phrases = index.extend(phrases, bool(sides >> k & 1))
            assert dict(zip(map(tuple, phrases[0].tolist()), phrases[3].tolist())) == want


# licences ------------------------------------------------------------------


def test_automaton_gives_matching_statistics():
    draw = random.Random(1)
    for _ in range(100):
        sequences = [[draw.choice("abc") for _ in range(draw.randint(1, 12))] for _ in range(draw.randint(1, 4))]
        automaton = license_scan.Automaton(sequences)
        text = [draw.choice("abcd") for _ in range(30)]
        state = length = 0
        for i, symbol in enumerate(text):
            while state and symbol not in automaton.next[state]:
                state = automaton.link[state]
                length = automaton.length[state]
            state, length = (automaton.next[state][symbol], length + 1) if symbol in automaton.next[state] else (0, 0)
            run = lambda k: tuple(text[i - k + 1 : i + 1])  # noqa: B023, E731
            places = lambda k: [(n, j + k - 1) for n, s in enumerate(sequences) for j in range(len(s) - k + 1) if tuple(s[j : j + k]) == run(k)]  # noqa: B023, E731
            assert length == max(k for k in range(i + 2) if k == 0 or places(k))
            if length:
                assert list(automaton.occurrences(state)) == sorted(places(length))


def slow_places(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = [(i, label) for label, phrase in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


def test_places_equal_the_definition():
    draw, scanner = random.Random(4), license_scan.Scanner()
    words = "GNU General Public License Apache cc BY by MIT mit license. version 2.0 under the é".split()
    for _ in range(500):
        text = draw.choice([" ", "-", "\n"]).join(draw.choice(words) for _ in range(draw.randint(0, 40)))
        count, places, _ = scanner.scan(text)
        assert (count, sorted((p["word"], p["label"]) for p in places)) == slow_places(text)


@pytest.mark.parametrize("number", range(len(license_scan.TEMPLATES)))
def test_templates_are_found_with_changes(number):
    label, text = license_scan.TEMPLATES[number]
    scanner = license_scan.Scanner()
    body = "Some words before.\n" + text + "\nand after"
    _, _, spans = scanner.scan(body)
    whole = [s for s in spans if s["template"] == number]
    assert [(s["label"], s["covered"], s["size"]) for s in whole] == [(label, scanner.sizes[number], scanner.sizes[number])]
    assert text.startswith(body[whole[0]["start"] : whole[0]["end"]][:10]) and body[whole[0]["end"] - 3 : whole[0]["end"]] in text
    words = text.split()
    if len(words) > 30:
        changed = " ".join([*words[:10], "<owner>", "2020", *words[12:]])
        assert any(s["template"] == number and s["covered"] > 0.8 * s["size"] for s in scanner.scan(changed)[2])


def test_harmless_and_hostile_texts():
    scanner = license_scan.Scanner()
    assert scanner.scan("the software and the rights to use of this work is under the public domain at your option")[2] == []
    for unit in ("gnu general public license ", "to use copy modify ", "the software and the license ", "cc by "):
        begin = time.time()
        scanner.scan(unit * (500_000 // len(unit)))
        assert time.time() - begin < 10


def test_license_frames(spark):
    texts = [None, "", " . ", "Released under the MIT License.", "Released under the MIT License.", "CC-BY", "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"places": F.lit(1), "spans": F.lit("s"), "label": F.lit("mine")})
    found = license_scan.scan(df)
    assert found.columns == ["doc_id", "text", "label", "n_words", "places", "spans"]
    rows = found.orderBy("doc_id").collect()
    assert [r["n_words"] for r in rows] == [0, 0, 0, 5, 5, 2, 1] and {r["label"] for r in rows} == {"mine"}
    assert rows[3]["spans"] == rows[4]["spans"] and rows[3]["spans"][0]["covered"] == 5
    scores = [r["score"] for r in found.select("doc_id", license_scan.score().alias("score")).orderBy("doc_id").collect()]
    assert scores == [0.0, 0.0, 0.0, 1.0, 1.0, 0.5, 0.0]
    assert license_scan.scan(df.limit(0)).count() == 0


def test_license_query(spark):
    rows = queries.licenses(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for row, doc in zip(sorted(rows, key=lambda r: r["doc_id"]), sorted(docs, key=lambda r: r["doc_id"])):
        count, places = slow_places(doc["text"])
        base = sorted({label for _, label in places})
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (count, len(places), ",".join(base))
        assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(base) <= set(row["labels"].split(",")) or not base
        assert 0 <= row["score"] <= 1

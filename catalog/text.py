"""Text features, n-gram overlaps, vectors and signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import (
    CHAR_LM,
    CHARS,
    CONV_PAIRS,
    DOC_PAIRS,
    EMBEDDING,
    FEATURE_CTES,
    LABSE,
    SCRIPT_PAIRS,
    VEC_PAIRS,
    conv_pairs,
    doc_pairs,
    rounded,
    rounded_features,
    rounded_sql,
    script_pairs,
    table,
    text_features_sql,
    vec_pairs,
    with_sql,
)
from pairscore.functions import text, vectors
from pairscore.operators import ngram_lm, signals
from pairscore.operators.joins import translate
from pairscore.operators.profile import embedding_shape
from pairscore.plans.features import text_features, training_table
from pairscore.schema import FEATURES, TARGET
from pairscore.session import materialize

# white space around a text, as the strip operator must remove it
PADDING = "　\t\x1f "


def strip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit(PADDING), "text", F.lit(PADDING + "\n"))
    stripped = text.strip(padded)
    return docs.select(
        "doc_id", F.md5(stripped).alias("digest"), F.length(stripped).alias("length")
    )


def text_features_conversations(spark, sf_dir):
    return text_features(conv_pairs(spark, sf_dir)).drop("source", "target")


def text_features_documents(spark, sf_dir):
    return text_features(doc_pairs(spark, sf_dir)).drop("source", "target", "score")


def text_features_scripts(spark, sf_dir):
    """Features of texts in two other scripts, some of them empty."""
    return text_features(script_pairs(spark, sf_dir)).drop("source", "target")


def char_ngram_overlap(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return text.char_ngram_overlap(pairs, "source", "target", 3, "overlap").select(
        "line_no", "overlap"
    )


def word_ngram_overlap(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return text.word_ngram_overlap(pairs, "source", "target", 2, "overlap").select(
        "line_no", "overlap"
    )


def cosine(spark, sf_dir):
    similarity = vectors.cosine(F.col("a"), F.col("b"))
    return rounded(vec_pairs(spark, sf_dir).select("vec_id", similarity.alias("similarity")))


def vector_shape(spark, sf_dir):
    return embedding_shape(table(spark, sf_dir, "embeddings"), "embedding")


def encode(spark, sf_dir):
    """Sentence vectors of all documents, listed by their non-zero cells."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = signals.encode(docs, "text", signals.trigram_encoder, "v")
    cells = made.select("doc_id", F.posexplode("v").alias("cell", "value"))
    return cells.filter(F.col("value") > 0).withColumn("cell", F.col("cell").cast("long"))


def pair_similarity(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    pairs = signals.similarity(pairs, signals.trigram_encoder, output="embedding_similarity")
    pairs = signals.similarity(pairs, signals.bigram_encoder, output="labse_similarity")
    return rounded(pairs.select("line_no", "embedding_similarity", "labse_similarity"))


def char_lm(spark, sf_dir):
    counts = signals.fit_char_lm(doc_pairs(spark, sf_dir), "target")
    return counts.select(
        F.shiftright("bigram", signals.CODE_BITS).alias("previous"),
        F.col("bigram").bitwiseAND(F.lit((1 << signals.CODE_BITS) - 1)).alias("following"),
        "n",
    )


def _perplexity(spark, sf_dir, **options):
    pairs = doc_pairs(spark, sf_dir)
    counts = materialize(signals.fit_char_lm(pairs, "target"), "char-lm")
    scored = signals.char_lm_perplexity(pairs, "target", counts, **options)
    return rounded(scored.select("line_no", "chinese_perplexity"))


def char_lm_perplexity(spark, sf_dir):
    return _perplexity(spark, sf_dir)


def char_lm_perplexity_large_model(spark, sf_dir):
    """The path for a model too large to send to every worker."""
    return _perplexity(spark, sf_dir, broadcast_rows=0)


def _order3(spark, sf_dir, **options):
    """Turns of conversations under a model of three characters learned from all documents."""
    lm = ngram_lm.fit_ngram_lm(table(spark, sf_dir, "documents"), "text", 3)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    scored = ngram_lm.ngram_perplexity(turns, "text", lm, "perplexity", **options)
    return rounded(scored.select("conv_id", "turn", "perplexity"))


def char_lm_order3(spark, sf_dir):
    return _order3(spark, sf_dir)


def char_lm_order3_large_model(spark, sf_dir):
    """The path for a model too large to send to every worker."""
    return _order3(spark, sf_dir, broadcast_rows=0)


# A context passes d / (t + d) on to the next shorter one; the empty one passes it to 1 / (d + 1).
ORDER3_SQL = """WITH chars AS (
  SELECT row_no, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS pos
  FROM (SELECT text, row_number() OVER () AS row_no FROM documents WHERE text <> '')),
learned AS (
  SELECT unicode(ch) AS c, coalesce(lag(unicode(ch)) OVER w, 1114112) AS b, coalesce(lag(unicode(ch), 2) OVER w, 1114112) AS a
  FROM chars WINDOW w AS (PARTITION BY row_no ORDER BY pos)),
n3 AS (SELECT a, b, c, count(*) AS n FROM learned GROUP BY ALL),
n2 AS (SELECT b, c, sum(n) AS n FROM n3 GROUP BY ALL),
n1 AS (SELECT c, sum(n) AS n FROM n2 GROUP BY ALL),
s2 AS (SELECT a, b, sum(n) AS t, count(*) AS d FROM n3 GROUP BY ALL),
s1 AS (SELECT b, sum(n) AS t, count(*) AS d FROM n2 GROUP BY ALL),
s0 AS (SELECT sum(n) AS t, count(*) AS d FROM n1),
turns AS (SELECT conv_id, turn, text, row_number() OVER () AS turn_no FROM conversations),
turn_chars AS (
  SELECT turn_no, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS pos
  FROM turns WHERE text <> ''),
met AS (
  SELECT turn_no, unicode(ch) AS c, coalesce(lag(unicode(ch)) OVER w, 1114112) AS b, coalesce(lag(unicode(ch), 2) OVER w, 1114112) AS a
  FROM turn_chars WINDOW w AS (PARTITION BY turn_no ORDER BY pos)),
cases AS (SELECT a, b, c, turn_no, count(*) AS times FROM met GROUP BY ALL),
p1 AS (
  SELECT m.*, (coalesce(n1.n, 0) + s0.d / (s0.d + 1)::DOUBLE) / (s0.t + s0.d)::DOUBLE AS p
  FROM cases m CROSS JOIN s0 LEFT JOIN n1 USING (c)),
p2 AS (
  SELECT m.* REPLACE (CASE WHEN s1.t IS NULL THEN m.p ELSE (coalesce(n2.n, 0) + s1.d * m.p) / (s1.t + s1.d) END AS p)
  FROM p1 m LEFT JOIN s1 USING (b) LEFT JOIN n2 USING (b, c)),
p3 AS (
  SELECT m.* REPLACE (CASE WHEN s2.t IS NULL THEN m.p ELSE (coalesce(n3.n, 0) + s2.d * m.p) / (s2.t + s2.d) END AS p)
  FROM p2 m LEFT JOIN s2 USING (a, b) LEFT JOIN n3 USING (a, b, c)),
per_turn AS (SELECT turn_no, exp(-sum(times * ln(p)) / sum(times)) AS ppl FROM p3 GROUP BY turn_no)
SELECT conv_id, turn, round(ppl, 6) AS perplexity FROM turns LEFT JOIN per_turn USING (turn_no)"""


def spread_of_letters():
    """A scorer: the share of a text's characters that are letters."""
    import numpy as np

    return lambda texts: np.array([sum(c.isascii() and c.isalpha() for c in t) / (len(t) + 1) for t in texts])


def score_text(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return signals.score_text(pairs, "target", spread_of_letters, "letters").select(
        "line_no", "letters"
    )


def feature_table(spark, sf_dir):
    """All 31 features and the target of every pair."""
    pairs = doc_pairs(spark, sf_dir)
    lm = materialize(signals.fit_char_lm(pairs, "target"), "char-lm")
    return rounded_features(training_table(pairs, lm)[0])


def translate_lookup(spark, sf_dir):
    """Labels as a dictionary of documents, with a default for those without."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    known = table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("quality "), "quality").alias("translation")
    )
    return translate(docs, known, "翻译", "doc_id", "translation")


def translate_lookup_shuffled(spark, sf_dir):
    """The same with a dictionary too large to broadcast, on a key with few values."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source"))
    known = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("src"), "n_nationkey").alias("source"), F.col("n_name").alias("translation")
    )
    return translate(docs, known, "翻译", "source", "translation", broadcast_rows=0)


def lower_case_translator():
    return lambda texts: ["» " + t.lower() for t in texts]


def apply_translator(spark, sf_dir):
    turns = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("source"))
    return signals.apply_translator(turns, lower_case_translator)


_STRIP_CLASS = r"\s\x0b\x1c-\x1f\x{00a0}\x{3000}"
_TRIGRAM_LISTS = """parts AS (
  SELECT line_no, list_filter(string_split(source, ''), lambda c: c <> '') AS s,
         list_filter(string_split(target, ''), lambda c: c <> '') AS t FROM doc_pairs),
gram_sets AS (
  SELECT line_no, len(s) AS ns, len(t) AS nt,
         list_distinct(list_transform(range(1, len(s) - 1), lambda i: s[i] || s[i + 1] || s[i + 2])) AS a,
         list_distinct(list_transform(range(1, len(t) - 1), lambda i: t[i] || t[i + 1] || t[i + 2])) AS b
  FROM parts)"""
_WORD_LISTS = r"""parts AS (
  SELECT line_no, list_filter(regexp_split_to_array(source, '[\s\x1c-\x1f\x0b]+'), lambda w: w <> '') AS s,
         list_filter(regexp_split_to_array(target, '[\s\x1c-\x1f\x0b]+'), lambda w: w <> '') AS t FROM doc_pairs),
gram_sets AS (
  SELECT line_no, len(s) AS ns, len(t) AS nt,
         list_distinct(list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1])) AS a,
         list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS b
  FROM parts)"""


def _overlap(n: int) -> str:
    return f"""SELECT line_no, CASE WHEN ns < {n} OR nt < {n} THEN 0.0::DOUBLE
  ELSE len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) END AS overlap FROM gram_sets"""


ENTRIES = {
    "strip": (
        strip,
        rf"""SELECT doc_id, md5(t) AS digest, length(t)::INTEGER AS length FROM (
  SELECT doc_id, regexp_replace(chr(12288) || chr(9) || chr(31) || chr(160) || text || chr(12288) || chr(9) || chr(31)
    || chr(160) || chr(10), '^[{_STRIP_CLASS}]+|[{_STRIP_CLASS}]+$', '', 'g') AS t FROM documents)""",
    ),
    "text_features_conversations": (
        text_features_conversations,
        with_sql(
            CONV_PAIRS,
            text_features_sql("conv_pairs"),
            select="SELECT * EXCLUDE (source, target) FROM text_features",
        ),
    ),
    "text_features_documents": (
        text_features_documents,
        with_sql(
            DOC_PAIRS,
            text_features_sql("doc_pairs"),
            select="SELECT * EXCLUDE (source, target, score) FROM text_features",
        ),
    ),
    "text_features_scripts": (
        text_features_scripts,
        with_sql(
            DOC_PAIRS,
            SCRIPT_PAIRS,
            text_features_sql("script_pairs"),
            select="SELECT * EXCLUDE (source, target) FROM text_features",
        ),
    ),
    "char_ngram_overlap": (
        char_ngram_overlap,
        with_sql(DOC_PAIRS, _TRIGRAM_LISTS, select=_overlap(3)),
    ),
    "word_ngram_overlap": (
        word_ngram_overlap,
        with_sql(DOC_PAIRS, _WORD_LISTS, select=_overlap(2)),
    ),
    "cosine": (
        cosine,
        with_sql(
            VEC_PAIRS,
            select="SELECT vec_id, round(list_cosine_similarity(a::DOUBLE[], b::DOUBLE[]), 6) AS similarity FROM vec_pairs",
        ),
    ),
    "vector_shape": (
        vector_shape,
        'SELECT min(len(embedding))::INTEGER AS min_dim, max(len(embedding))::INTEGER AS max_dim, count(embedding) AS "rows" FROM embeddings',
    ),
    "encode": (
        encode,
        with_sql(
            CHARS,
            EMBEDDING,
            select="SELECT doc_id, cell, (n / norm)::FLOAT AS value FROM embedding_sim_cells JOIN embedding_sim_norms USING (doc_id)",
        ),
    ),
    "pair_similarity": (
        pair_similarity,
        with_sql(
            CHARS,
            EMBEDDING,
            LABSE,
            select="SELECT line_no, round(e.sim, 6) AS embedding_similarity, round(l.sim, 6) AS labse_similarity "
            "FROM embedding_sim e JOIN labse_sim l USING (line_no)",
        ),
    ),
    "char_lm": (
        char_lm,
        with_sql(CHARS, CHAR_LM, select="SELECT prev AS previous, c0 AS following, n FROM lm"),
    ),
    "char_lm_perplexity": (
        char_lm_perplexity,
        with_sql(
            CHARS,
            CHAR_LM,
            select="SELECT line_no, round(ppl, 6) AS chinese_perplexity FROM perplexity",
        ),
    ),
    "char_lm_perplexity_large_model": (
        char_lm_perplexity_large_model,
        with_sql(
            CHARS,
            CHAR_LM,
            select="SELECT line_no, round(ppl, 6) AS chinese_perplexity FROM perplexity",
        ),
    ),
    "char_lm_order3": (char_lm_order3, ORDER3_SQL),
    "char_lm_order3_large_model": (char_lm_order3_large_model, ORDER3_SQL),
    "score_text": (
        score_text,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, length(regexp_replace(target, '[^A-Za-z]+', '', 'g')) / (length(target) + 1) AS letters FROM doc_pairs",
        ),
    ),
    "feature_table": (
        feature_table,
        with_sql(*FEATURE_CTES, select=f"SELECT line_no, {rounded_sql([*FEATURES, TARGET])} FROM wide"),
    ),
    "translate_lookup": (
        translate_lookup,
        "SELECT doc_id, coalesce('quality ' || quality, '翻译') AS translation FROM documents LEFT JOIN labels USING (doc_id)",
    ),
    "translate_lookup_shuffled": (
        translate_lookup_shuffled,
        "SELECT doc_id, d.source, coalesce(n_name, '翻译') AS translation FROM documents d "
        "LEFT JOIN nation n ON d.source = 'src' || n.n_nationkey",
    ),
    "apply_translator": (
        apply_translator,
        "SELECT item_id, text AS source, '» ' || lower(text) AS target FROM benchmark",
    ),
}

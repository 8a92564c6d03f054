"""Pair views over the given tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.operators.joins import zip_by_line
from pairscore.schema import INT_FEATURES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document next to the one that follows it."""
    docs = table(spark, sf_dir, "documents")
    a = docs.select(
        F.col("doc_id").alias("line_no"), F.col("text").alias("source"), F.col("n_chars").alias("na")
    )
    b = docs.select(
        (F.col("doc_id") - 1).alias("line_no"),
        F.col("text").alias("target"),
        F.col("n_chars").alias("nb"),
    )
    ratio = F.least("na", "nb") / F.greatest("na", "nb")
    return zip_by_line([a, b]).select(
        "line_no", "source", "target", (F.lit(1.06) + F.lit(0.18) * ratio).alias("score")
    )


# Each of these letters becomes the letter or digit at its place in the list of a side.
LATIN = "etaoinshrdlubfgm"
DEVANAGARI = "कखगघचछजझटठडढ०३५७"
HAN = "雨停商店九点开门的书看人１２４８"


def script_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pairs in Devanagari and Han letters and digits; one side of some is empty, of some both."""
    pairs = doc_pairs(spark, sf_dir)
    source = F.when(F.col("line_no") % 11 == 0, "").otherwise(F.translate("source", LATIN, DEVANAGARI))
    target = F.when(F.col("line_no") % 13 == 0, "").otherwise(F.translate("target", LATIN, HAN))
    return pairs.select("line_no", source.alias("source"), target.alias("target"))


def conv_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns next to the assistant turns that answer them."""
    turns = table(spark, sf_dir, "conversations")
    a = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("source")
    )
    b = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target")
    )
    return a.join(b.hint("merge"), ["conv_id", "turn"]).select(
        F.concat_ws("/", "conv_id", "turn").alias("pair_id"), "source", "target"
    )


def vec_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector next to the one that follows it."""
    vectors = table(spark, sf_dir, "embeddings")
    a = vectors.select("vec_id", F.col("embedding").alias("a"), "label")
    b = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return zip_by_line([a, b], "vec_id")


def system_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read as outputs of the site that published them, 50 source keys."""
    systems = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("line_no"), F.col("source").alias("system")
    )
    pairs = doc_pairs(spark, sf_dir).withColumnRenamed("source", "source_text")
    return pairs.join(systems, "line_no").withColumn("source", F.col("line_no") % 50)


DOC_PAIRS = """doc_pairs AS (
  SELECT a.doc_id AS line_no, a.text AS source, b.text AS target,
         1.06::DOUBLE + 0.18::DOUBLE * (least(a.n_chars, b.n_chars) / greatest(a.n_chars, b.n_chars)) AS score
  FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"""

SCRIPT_PAIRS = f"""script_pairs AS (
  SELECT line_no, CASE WHEN line_no % 11 = 0 THEN '' ELSE translate(source, '{LATIN}', '{DEVANAGARI}') END AS source,
         CASE WHEN line_no % 13 = 0 THEN '' ELSE translate(target, '{LATIN}', '{HAN}') END AS target FROM doc_pairs)"""

CONV_PAIRS = """conv_pairs AS (
  SELECT a.conv_id || '/' || a.turn AS pair_id, a.text AS source, b.text AS target
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""

VEC_PAIRS = """vec_pairs AS (
  SELECT a.vec_id, a.embedding AS a, b.embedding AS b, a.label
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""

SYSTEM_OUTPUTS = """system_outputs AS (
  SELECT p.line_no, p.line_no % 50 AS source, d.source AS system, p.source AS source_text, p.target, p.score
  FROM doc_pairs p JOIN documents d ON d.doc_id = p.line_no)"""

# the text features of a pair relation {0}
TEXT_FEATURES = r"""text_parts AS (
  SELECT *, length(source) AS sl, length(target) AS tl,
         list_filter(regexp_split_to_array(source, '[\s\x1c-\x1f\x0b]+'), lambda w: w <> '') AS words,
         list_distinct(list_filter(string_split(target, ''), lambda c: c <> '')) AS tchars,
         list_distinct(list_filter(string_split(lower(source), ''), lambda c: c <> '')) AS ls,
         list_distinct(list_filter(string_split(lower(target), ''), lambda c: c <> '')) AS lt
  FROM {0}),
text_features AS (
  SELECT * EXCLUDE (sl, tl, words, tchars, ls, lt),
         sl::INTEGER AS hindi_length, tl::INTEGER AS chinese_length,
         len(words)::INTEGER AS hindi_word_count,
         length(regexp_replace(target, '[^\x{{4e00}}-\x{{9fff}}]+', '', 'g'))::INTEGER AS chinese_char_count,
         sl / (tl + 1) AS length_ratio, abs(sl - tl)::INTEGER AS length_diff,
         sl / (len(words) + 1) AS hindi_avg_word_length,
         tl / (length(regexp_replace(target, '[^\x{{4e00}}-\x{{9fff}}]+', '', 'g')) + 1) AS chinese_avg_char_length,
         length(regexp_replace(source, '[^.,!?;:()\[\]{{}}"'']+', '', 'g'))::INTEGER AS punctuation_count_hi,
         length(regexp_replace(target, '[^.,!?;:()\[\]{{}}"'']+', '', 'g'))::INTEGER AS punctuation_count_zh,
         length(regexp_replace(source, '[^\p{{Nd}}]+', '', 'g'))::INTEGER AS digit_count_hi,
         length(regexp_replace(target, '[^\p{{Nd}}]+', '', 'g'))::INTEGER AS digit_count_zh,
         length(regexp_replace(source, '[^.,!?;:()\[\]{{}}"'']+', '', 'g')) / (sl + 1) AS punctuation_ratio_hi,
         length(regexp_replace(target, '[^.,!?;:()\[\]{{}}"'']+', '', 'g')) / (tl + 1) AS punctuation_ratio_zh,
         len(list_distinct(words)) / (len(words) + 1) AS vocab_diversity_hi,
         len(tchars) / (tl + 1) AS vocab_diversity_zh,
         CASE WHEN len(ls) + len(lt) = 0 THEN 0.0::DOUBLE
              ELSE len(list_intersect(ls, lt)) / (len(ls) + len(lt) - len(list_intersect(ls, lt))) END AS char_alignment
  FROM text_parts)"""


def with_sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def text_features_sql(relation: str) -> str:
    return TEXT_FEATURES.format(relation)


# characters of every document with their neighbours, and hashed n-gram cells
CHARS = """chars AS (
  SELECT doc_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS pos
  FROM documents WHERE text <> ''),
grams AS (
  SELECT doc_id, unicode(ch)::BIGINT AS c0, lead(unicode(ch)) OVER w AS c1,
         lead(unicode(ch), 2) OVER w AS c2, coalesce(lag(unicode(ch)) OVER w, 1114112)::BIGINT AS prev
  FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY pos))"""


def _similarity(name: str, cell: str, last: str) -> str:
    return f"""{name}_cells AS (
  SELECT doc_id, {cell} AS cell, count(*) AS n FROM grams WHERE {last} IS NOT NULL GROUP BY ALL),
{name}_norms AS (SELECT doc_id, sqrt(sum(n * n)::DOUBLE) AS norm FROM {name}_cells GROUP BY doc_id),
{name}_dots AS (
  SELECT a.doc_id AS line_no, sum(a.n * b.n)::DOUBLE AS dot
  FROM {name}_cells a JOIN {name}_cells b ON b.doc_id = a.doc_id + 1 AND b.cell = a.cell GROUP BY a.doc_id),
{name} AS (
  SELECT p.line_no, coalesce(d.dot / (x.norm * y.norm), 0.0::DOUBLE) AS sim
  FROM (SELECT a.doc_id AS line_no FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1) p
  LEFT JOIN {name}_dots d ON d.line_no = p.line_no
  LEFT JOIN {name}_norms x ON x.doc_id = p.line_no
  LEFT JOIN {name}_norms y ON y.doc_id = p.line_no + 1)"""


EMBEDDING = _similarity("embedding_sim", "((c0 * 31 + c1) * 31 + c2) % 384", "c2")
LABSE = _similarity("labse_sim", "(c0 * 131 + c1) % 768", "c1")

# bigram counts of the target side, and the perplexity of every target
CHAR_LM = """target_grams AS (
  SELECT doc_id - 1 AS line_no, prev, c0 FROM grams
  WHERE doc_id - 1 IN (SELECT doc_id FROM documents)),
lm AS (SELECT prev, c0, count(*) AS n FROM target_grams GROUP BY ALL),
contexts AS (SELECT prev, sum(n) AS context_n FROM lm GROUP BY prev),
perplexity AS (
  SELECT line_no, exp(-avg(ln((n + 1) / (context_n + (SELECT count(DISTINCT c0) FROM lm))))) AS ppl
  FROM target_grams JOIN lm USING (prev, c0) JOIN contexts USING (prev) GROUP BY line_no)"""

ALL_FEATURES = """signals AS (
  SELECT t.*, e.sim AS embedding_similarity, l.sim AS labse_similarity, p.ppl AS chinese_perplexity,
         min(length_ratio) OVER () AS low, max(length_ratio) OVER () AS high
  FROM text_features t JOIN embedding_sim e USING (line_no) JOIN labse_sim l USING (line_no)
  LEFT JOIN perplexity p USING (line_no)),
wide AS (
  SELECT line_no, hindi_length, chinese_length, hindi_word_count, chinese_char_count, length_ratio, length_diff,
         hindi_avg_word_length, chinese_avg_char_length,
         (length_ratio - low) / (high - low + 1e-8::DOUBLE) AS length_ratio_normalized,
         embedding_similarity, labse_similarity, chinese_perplexity,
         1 / (chinese_perplexity + 1) AS chinese_fluency,
         embedding_similarity * labse_similarity AS embedding_labse_interaction,
         (embedding_similarity + labse_similarity) / 2 AS similarity_avg,
         abs(embedding_similarity - labse_similarity) AS similarity_diff,
         embedding_similarity * embedding_similarity AS embedding_similarity_squared,
         labse_similarity * labse_similarity AS labse_similarity_squared,
         embedding_similarity / (labse_similarity + 1e-8::DOUBLE) AS similarity_ratio,
         char_alignment,
         length_ratio * embedding_similarity AS length_similarity_interaction,
         chinese_length * chinese_perplexity AS length_perplexity_interaction,
         chinese_length / (chinese_perplexity + 1e-8::DOUBLE) AS length_perplexity_ratio,
         punctuation_count_hi, punctuation_count_zh, digit_count_hi, digit_count_zh,
         punctuation_ratio_hi, punctuation_ratio_zh, vocab_diversity_hi, vocab_diversity_zh,
         score AS ccmatrix_score
  FROM signals WHERE chinese_perplexity IS NOT NULL)"""

FEATURE_CTES = (
    DOC_PAIRS,
    text_features_sql("doc_pairs"),
    CHARS,
    EMBEDDING,
    LABSE,
    CHAR_LM,
    ALL_FEATURES,
)
SIMILARITY_CTES = (DOC_PAIRS, CHARS, EMBEDDING)


def rounded(df: DataFrame, places: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, so that another order of summation gives the same table."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "double" and f.name not in skip]
    return df.withColumns({c: F.round(c, places) for c in names}) if names else df


def rounded_features(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, those of 100 and more to 2: about as many digits for both."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns(
        {c: F.when(F.abs(c) >= 100, F.round(c, 2)).otherwise(F.round(c, 6)) for c in names}
    )


def rounded_feature_sql(c: str) -> str:
    return f"CASE WHEN abs({c}) >= 100 THEN round({c}, 2) ELSE round({c}, 6) END AS {c}"


def rounded_sql(columns: list[str]) -> str:
    return ", ".join(c if c in INT_FEATURES else rounded_feature_sql(c) for c in columns)

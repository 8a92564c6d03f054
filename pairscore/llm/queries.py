"""The registered queries of these operators, with SQL where SQL can state them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    collocations,
    context_tree,
    decontaminate,
    hard_negatives,
    license_scan,
    line_rules,
    near_duplicates,
    pii,
    rule_ensemble,
    secrets,
    toxicity,
    warc_zip,
)
from .columns import digest, span_text


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns or ("doc_id", "text"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records in packages, then read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = pages.select(
        F.col("page_id").alias("record_id"), F.col("url").alias("uri"), warc_zip.as_payload(F.col("html")).alias("payload")
    )
    read = warc_zip.read_packages(warc_zip.store(records))
    return read.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every text."""
    found = pii.detect(documents(spark, sf_dir)).drop("text")
    spans = F.col("pii")
    return found.select(
        "doc_id",
        *[pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        digest(span_text(F.filter(spans, lambda s: s["base"]))).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.find_contamination(documents(spark, sf_dir), items)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        digest(ids).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets and linked credential parts of every text."""
    spans = F.col("secrets")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        digest(span_text(F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE)))).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first verdict on every text."""
    judged = line_rules.clean(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_failed_lines", "kept_chars", "kept",
    )


def fold(doc_id, parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def train_labels(spark: SparkSession, sf_dir: str, name: str, parts: int, held_out: int) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(name).alias("label"))
    return labels.where(fold("doc_id", parts) != held_out)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    docs = documents(spark, sf_dir)
    model = rule_ensemble.fit(docs, train_labels(spark, sf_dir, "quality", 4, 2))
    return scored(rule_ensemble.score(docs, model), 4, 2, 0.7)


def code_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every text under the context tree and under word frequencies."""
    scores = context_tree.score_texts(documents(spark, sf_dir), fold("doc_id", 10) == 0)
    return scores.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every text among its near duplicates."""
    return near_duplicates.find_near_duplicates(documents(spark, sf_dir))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, with the number of offending sentences."""
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, train_labels(spark, sf_dir, "toxic", 5, 0))
    return scored(toxicity.score(docs, model), 5, 0, 0.5, F.size("offending").cast("long").alias("n_offending"))


def scored(df: DataFrame, parts: int, held_out: int, threshold: float, *more: Column) -> DataFrame:
    return df.select(
        "doc_id",
        F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *more,
    )


def vocabulary() -> tuple[str, str]:
    """The rank file and the split pattern that the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def token_digests(docs: DataFrame) -> DataFrame:
    """doc_id with the count and digest of a text's tokens, and the digest of the bytes they decode to."""
    coder = bpe.share_coder(docs.sparkSession, *vocabulary())
    return bpe.digests(docs.select("doc_id", "text"), coder).drop("text")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded."""
    return token_digests(documents(spark, sf_dir))


def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))

    def whole(x: Column) -> Column:  # null and non-finite components stay null
        value = x.cast("double")
        return F.when(F.abs(value) < float("inf"), F.floor(256 * value))

    numbers = rows.select("vec_id", flipped.alias("label"), F.transform("embedding", whole).alias("embedding"))
    return hard_negatives.mine(numbers, F.col("vec_id") % 50 == 0)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    found = collocations.find_collocations(documents(spark, sf_dir, "text", "lang"), top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "before", "behind")


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every text."""
    found = license_scan.scan(documents(spark, sf_dir))
    words = F.transform("places", lambda p: p["word"])
    base, own = (F.transform(c, lambda s: s["label"]) for c in ("places", "spans"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        license_scan.label_list(base).alias("base_labels"),
        license_scan.label_list(base, own).alias("labels"),
        license_scan.score().alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )


ARCHIVES_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex,
         max(page_id) OVER (PARTITION BY body) AS first
  FROM p
), bits AS (
  SELECT *, array_to_string(list_transform(range(40), lambda i:
    lpad(bin(CAST('0x' || substr(hex, CAST(i + 1 AS INT), 1) AS INT)), 4, '0')), '') AS b FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(b, CAST(5 * i + j + 1 AS INT), 1) AS INT) * CAST(power(2, 4 - j) AS INT))) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN first END AS refers_to
FROM bits
"""

CONTAMINATION_SQL = r"""
WITH fold AS (
  SELECT 0 AS kind, doc_id AS id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents
  UNION ALL SELECT 1, item_id, text, row_number() OVER () FROM benchmark
), w AS (
  SELECT kind, id, row, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM fold
), items AS (
  SELECT DISTINCT id AS item_id, len(ws) AS size, array_to_string(ws[i : i + 9], ' ') AS win
  FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM w WHERE kind = 1 AND len(ws) > 0)
), sizes AS (SELECT DISTINCT least(size, 10) AS size FROM items),
places AS (
  SELECT row, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, sizes WHERE kind = 0 AND len(ws) >= size
), hits AS (
  SELECT a.row, a.i, a.size, t.item_id FROM (SELECT row, i, size, array_to_string(ws[i : i + size - 1], ' ') AS win FROM places) a
  JOIN items t ON t.win = a.win AND least(t.size, 10) = a.size
), covered AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS p FROM hits) GROUP BY row
), ids AS (
  SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
  FROM hits GROUP BY row
)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN covered USING (row) LEFT JOIN ids USING (row) WHERE kind = 0
"""



def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def contains(name: str, values) -> str:
    return " OR ".join(f"contains({name}, '{v}')" for v in values)


def counted(name: str, pattern: str) -> str:
    return f"len(regexp_extract_all({name}, '{pattern}'))"


CLEANED_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT row, doc_id, text, regexp_extract_all(text, '[^ 	-
]+') AS ws, string_split(text, chr(10)) AS ls FROM d
), win AS (
  SELECT row, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS win
  FROM (SELECT row, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM win) WHERE n > 1
), again AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY row
), lines AS (
  SELECT row, l, lower(l) AS low, len(translate(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS c,
    {counted("l", line_rules.WORD)} AS n, {counted("l", line_rules.SYMBOL)} AS sym, {counted("l", line_rules.MARK)} AS marks,
    {counted("l", line_rules.CALL)} AS calls, {counted("l", line_rules.UPPER_CASE)} AS ups,
    {counted("l", line_rules.LETTER)} AS letters, {counted("l", line_rules.SEPARATOR)} AS seps
  FROM (SELECT row, unnest(ls) AS l FROM w)
), judged AS (
  SELECT *, (10 * sym > c OR (n >= 8 AND marks = 0) OR (calls >= 5 AND 3 * calls > n) OR (ups >= 20 AND 10 * ups > 7 * letters)
    OR (seps >= 3 AND 4 * seps >= n) OR trim(low) IN ({quoted(line_rules.MENU)})
    OR (n <= {line_rules.BOILERPLATE_WORDS} AND ({contains("low", line_rules.BOILERPLATE)}))) AS bad
  FROM lines WHERE n > 0
), perdoc AS (
  SELECT row, count(*) - count(DISTINCT l) AS dups, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS failed,
    sum(CASE WHEN bad THEN 0 ELSE c END) AS kept_chars
  FROM judged GROUP BY row
), t AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(len(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST({counted("text", line_rules.SYMBOL)} AS BIGINT) AS n_symbols, CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(failed, 0) AS BIGINT) AS n_failed_lines,
    CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM w LEFT JOIN again USING (row) LEFT JOIN perdoc USING (row)
)
SELECT *, n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED} * n_words)
    AND 100 * kept_chars >= {line_rules.MIN_KEPT} * word_chars AS kept
FROM t
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, row, piece, regexp_extract_all(text, '[^ \t]+') AS ws
  FROM (
    SELECT lang, row, unnest(ps) AS text, unnest(range(len(ps))) AS piece
    FROM (
      SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row,
        regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
      FROM documents WHERE text IS NOT NULL
    )
  )
), places AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, k, ws[i : i + k - 1] AS gram, count(*) AS f
  FROM places, (SELECT unnest(range(1, 5)) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, count(*) AS n FROM places GROUP BY lang
), cuts AS (
  SELECT g.lang, g.gram, g.f AS a, c, CAST(x.f AS BIGINT) AS l, CAST(y.f AS BIGINT) AS r,
    CAST(2000000 * CAST(g.f AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM grams WHERE k > 1) g
  JOIN grams x ON x.lang = g.lang AND x.gram = g.gram[1 : c]
  JOIN grams y ON y.lang = g.lang AND y.gram = g.gram[c + 1 : g.k]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, c) = 1
), parts AS (
  SELECT lang, f, k, gram, unnest(range(1, k)) AS i FROM grams WHERE k > 2
), inside AS (
  SELECT lang, f, k, gram[i : i + size - 1] AS gram, i, size
  FROM (SELECT *, unnest(range(2, k)) AS size FROM parts) WHERE i + size - 1 <= k
), around AS (
  SELECT lang, gram, max(f) AS f, max(CASE WHEN k = size + 1 AND i = 2 THEN f END) AS before,
    max(CASE WHEN k = size + 1 AND i = 1 THEN f END) AS behind
  FROM inside GROUP BY lang, gram
)
SELECT lang, row_number() OVER best AS rank, array_to_string(gram, ' ') AS phrase, a, l, r, n, score, before, behind
FROM lowest LEFT JOIN around USING (lang, gram) JOIN totals USING (lang)
WHERE around.f IS NULL OR 100 * around.f < 80 * a
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' '))
QUALIFY rank <= 2000
"""

ENTRIES = {
    "op1_warc_zip": (archives, ARCHIVES_SQL),
    "op2_pii": (personal_data, None),
    "op8_decontaminate": (contamination, CONTAMINATION_SQL),
    "op3_context_tree": (code_lengths, None),
    "op4_rule_ensemble": (quality, None),
    "op5_lsh_forest": (near_copies, None),
    "op6_toxicity": (toxic, None),
    "op7_secrets": (credentials, None),
    "op9_line_rules": (cleaned_lines, CLEANED_SQL),
    "op10_bpe": (tokens, None),
    "op11_hyperplane_tree": (hard_negative_rows, HARD_NEGATIVES_SQL),
    "op12_fm_phrases": (phrases, PHRASES_SQL),
    "op13_license_automaton": (licenses, None),
}

"""Secrets in texts, and credentials in several parts, with built-in functions only.

Strong patterns (assign, access, hex) are always reported. Weak candidates (identifier, secret,
endpoint) are common in harmless text; they are reported where complementary parts stand within
``REACH`` characters of each other: an identifier with a secret, and an endpoint beside such a
pair. Parts are interval-joined on (row, stretch of text): a stretch is as long as the reach,
so the pairs per part are bounded by what fits into its own stretches and one on either side.
Values of any length match whole; a value may follow its sign directly (key=value).

A pattern's matches and the gaps between them come from the same expression; the running sum of
their lengths gives the offsets, in code points, ends exclusive. Null is searched as the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

BASE = ("assign", "access", "hex")
WEAK = ("identifier", "secret", "endpoint")
KINDS = BASE + WEAK
#: Characters between parts of one credential.
REACH = 300

# The patterns.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "identifier": r"""(?<![A-Za-z0-9])(?i:access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|app[_-]?id|user(?:name)?|login)["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9_.@-]{4,}+""",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])",
    "endpoint": r"""(?<![A-Za-z0-9])(?:(?i:https?|jdbc:[a-z]{2,12}|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9][^\x00-\x20"'<>]{3,}+|(?i:host(?:name)?|endpoint|server)["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9][A-Za-z0-9.:-]{3,}+)""",
}
#: A cheap test that every match of a kind passes.
HINTS = {
    "assign": r"(?i)password|passwd|secret|token|api_?key",
    "access": "AKIA",
    "hex": r"[0-9a-f]{24}",
    "identifier": r"(?i)(?:key|id|user|username|login)[_a-z\"' -]{0,24}[:=]",
    "secret": r"[A-Za-z0-9+/_-]{32}",
    "endpoint": r"(?i)://|host|endpoint|server",
}
FOUND = "array<struct<gap:int,size:int,good:boolean>>"


def good(kind: str, match: Column) -> Column:
    """Whether a match of the pattern counts."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, PATTERNS["assign"], 1)) >= 6
    if kind == "access":
        return F.length(match) >= 20
    if kind == "secret":
        return F.regexp_like(match, F.lit("[0-9]")) & F.regexp_like(match, F.lit("[a-z]")) & F.regexp_like(match, F.lit("[A-Z]"))
    return F.lit(True)


def found(text: Column, kind: str) -> Column:
    """Lengths of the gap before each match and of the match, and whether it counts."""
    pattern = PATTERNS[kind]
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.split(text, pattern, -1),
        lambda match, gap: F.struct(
            F.length(gap).alias("gap"), F.length(match).alias("size"), good(kind, match).alias("good")
        ),
    )  # the piece after the last match has no match
    real = F.filter(pairs, lambda p: p["size"].isNotNull())
    hint = F.contains(text, F.lit(HINTS[kind])) if kind == "access" else F.regexp_like(text, F.lit(HINTS[kind]))
    return F.when(hint, real).otherwise(F.array().cast(FOUND)).cast(FOUND)


def find_parts(rows: DataFrame) -> DataFrame:
    """(_row, kind, start, end) of all matches that count, from the stored matches of every row."""
    each = None
    for kind in KINDS:
        part = rows.where(F.size(kind) > 0).select(
            "_row", F.lit(kind).alias("kind"), F.posexplode(kind).alias("place", "m")
        )
        each = part if each is None else each.unionByName(part)
    so_far = Window.partitionBy("_row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap").cast("long") + F.col("m.size")).over(so_far)
    placed = each.select("_row", "kind", "m.size", "m.good", end.alias("end"))
    return placed.where("good").select("_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def near(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """Rows of ``left`` with a row of ``right`` within ``reach`` characters: an interval join on stretches of text."""
    stretch = lambda a, b: F.explode(F.sequence(F.floor(a / reach), F.floor(b / reach)))
    start, end = F.col("start"), F.col("end")
    wide = left.select("*", stretch(F.greatest(start - reach, F.lit(0)), end + reach).alias("_at"))
    other = right.select(
        F.col("_row").alias("_o"), start.alias("_s"), end.alias("_e"), stretch(start, end).alias("_oat")
    )
    close = (
        (F.col("_row") == F.col("_o"))
        & (F.col("_at") == F.col("_oat"))
        & (F.col("_s") <= end + reach)
        & (F.col("_e") >= start - reach)
    )
    return wide.join(other, close, "left_semi").drop("_at").distinct()


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts that stand beside their complements."""
    identifiers = parts.where(F.col("kind").isin("identifier", "access"))
    secrets = parts.where(F.col("kind").isin("secret", "assign", "hex"))
    paired_ids = near(identifiers, secrets, reach)
    paired_secrets = near(secrets, identifiers, reach)
    endpoints = near(near(parts.where("kind = 'endpoint'"), identifiers, reach), secrets, reach)
    return paired_ids.unionByName(paired_secrets).unionByName(endpoints).where(F.col("kind").isin(*WEAK))


def scan(df: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """``df`` without ``text``, plus ``secrets``: the spans (kind, start, end) by start, then by kind.

    The texts are read once; the lengths of their matches are stored and everything else works on those.
    A column of ``df`` named ``secrets`` is replaced.
    """
    kept = [c for c in df.columns if c not in (text, "secrets")]
    body = F.coalesce(F.col(text), F.lit(""))
    marks = [found(body, kind).alias(f"_{kind}") for kind in KINDS]
    read = df.select(F.struct(*kept).alias("_kept"), F.monotonically_increasing_id().alias("_row"), *marks)
    rows = materialize(read.toDF("_kept", "_row", *KINDS), "secrets-matches")
    parts = materialize(find_parts(rows), "secrets-parts")
    spans = parts.where(F.col("kind").isin(*BASE)).unionByName(link_parts(parts, reach))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    gathered = spans.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "end", "kind"))).alias("_spans")
    )
    shaped = F.transform(
        F.coalesce("_spans", F.array().cast("array<struct<start:bigint,order:bigint,end:bigint,kind:string>>")),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    joined = rows.select("_kept", "_row").join(gathered, "_row", "left")
    return joined.select("_kept.*", shaped.alias("secrets"))

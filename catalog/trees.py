"""Forests and boosted trees of depth one, whose splits SQL can search too."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import rounded, table, with_sql
from pairscore.operators import regress
from pairscore.session import materialize

KEYS = ["l_orderkey", "l_linenumber"]
FEATURES = ["quantity", "discount", "tax", "line"]
ROUNDS, STEP = 4, 0.1
# more than the values of any feature: every place between two values is a candidate
BINS = 64


def priced_lines(spark, sf_dir):
    """Quantity times discount of every order line, beside four numbers of the line."""
    lines = table(spark, sf_dir, "lineitem").select(
        *KEYS,
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_discount").cast("double").alias("discount"),
        F.col("l_tax").cast("double").alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_quantity").cast("double") * F.col("l_discount").cast("double")).alias("given"),
    )
    return materialize(lines, "priced-lines")


def _fit(lines, kind):
    params = {"maxDepth": 1, "maxBins": BINS, "seed": 42}
    if kind == "gbt":
        params |= {"maxIter": ROUNDS, "stepSize": STEP}
    else:
        params |= {"numTrees": 1, "bootstrap": False}
    return regress.fit_regressor(lines, kind, FEATURES, target="given", params=params)


def _predicted(spark, sf_dir, kind):
    lines = priced_lines(spark, sf_dir)
    return rounded(_fit(lines, kind).predict(lines, "predicted").select(*KEYS, "predicted"), 4)


def forest_stump(spark, sf_dir):
    """One tree with one split, on all rows."""
    return _predicted(spark, sf_dir, "random_forest")


def boosted_stumps(spark, sf_dir):
    """Boosting with trees of one split."""
    return _predicted(spark, sf_dir, "gbt")


def stump_importance(spark, sf_dir):
    """Importance of the features of boosted stumps: their share of the squared error that splits remove."""
    lines = priced_lines(spark, sf_dir)
    return rounded(regress.tree_importance(_fit(lines, "gbt"), lines, k=None))


def boosting_sql(rounds: int) -> list[str]:
    """Rounds of boosting: ``r<k>`` has the prediction before round k, ``b<k>`` its best split.

    Every round but the first is fitted to twice the error, as the derivative of the squared error has it.
    """
    ctes = [
        """r1 AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS quantity, l_discount::DOUBLE AS discount,
  l_tax::DOUBLE AS tax, l_linenumber::DOUBLE AS line, l_quantity::DOUBLE * l_discount::DOUBLE AS given,
  0::DOUBLE AS predicted FROM lineitem)"""
    ]
    chosen = " ".join(f"WHEN '{f}' THEN {f}" for f in FEATURES)
    for k in range(1, rounds + 1):
        aim = "given" if k == 1 else "2 * (given - predicted)"
        values = " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {f} AS v, count(*) AS n, sum({aim}) AS s FROM r{k} GROUP BY {f}" for f in FEATURES
        )
        ctes += [
            f"g{k} AS ({values})",
            f"""c{k} AS (SELECT feature, v, sum(n) OVER w AS n, sum(s) OVER w AS s,
  sum(n) OVER (PARTITION BY feature) AS all_n, sum(s) OVER (PARTITION BY feature) AS all_s
  FROM g{k} WINDOW w AS (PARTITION BY feature ORDER BY v))""",
            f"""b{k} AS (SELECT feature, v, s / n AS low, (all_s - s) / (all_n - n) AS high,
  s * s / n + (all_s - s) * (all_s - s) / (all_n - n) - all_s * all_s / all_n AS gain
  FROM c{k} WHERE n < all_n ORDER BY gain DESC LIMIT 1)""",
            f"""r{k + 1} AS (SELECT r{k}.* REPLACE (
  predicted + {1 if k == 1 else STEP} * CASE WHEN CASE feature {chosen} END <= v THEN low ELSE high END AS predicted)
  FROM r{k}, b{k})""",
        ]
    return ctes


def _predicted_sql(rounds: int) -> str:
    return with_sql(
        *boosting_sql(rounds), select=f"SELECT l_orderkey, l_linenumber, round(predicted, 4) AS predicted FROM r{rounds + 1}"
    )


ENTRIES = {
    "forest_stump": (forest_stump, _predicted_sql(1)),
    "boosted_stumps": (boosted_stumps, _predicted_sql(ROUNDS)),
    "stump_importance": (
        stump_importance,
        with_sql(
            *boosting_sql(ROUNDS),
            "b AS (" + " UNION ALL ".join(f"SELECT feature, gain FROM b{k}" for k in range(1, ROUNDS + 1)) + ")",
            f"names AS (SELECT unnest({FEATURES}) AS feature)",
            select="SELECT feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM b), 6) AS importance "
            "FROM names LEFT JOIN b USING (feature) GROUP BY feature",
        ),
    ),
}

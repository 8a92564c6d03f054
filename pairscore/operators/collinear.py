"""Removal of features that repeat an earlier one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pairscore.operators.profile import corr_values

COLLINEAR_LIMIT = 0.95


@dataclass(frozen=True)
class Pruned:
    """Features that stay, in order, and the ``(earlier, later, |r|)`` pairs behind the rest."""

    kept: list[str]
    pairs: list[tuple[str, str, float]]

    @property
    def dropped(self) -> list[str]:
        return sorted({later for _, later, _ in self.pairs})


def prune_from_matrix(features: list[str], matrix, limit: float = COLLINEAR_LIMIT) -> Pruned:
    """Of each pair with |r| strictly above the limit the later feature goes.

    A feature that goes still counts against later ones, and an undefined r
    (a constant column) removes nothing.
    """
    pairs = [
        (features[i], later, abs(float(matrix[i][j])))
        for j, later in enumerate(features)
        for i in range(j)
        if abs(matrix[i][j]) > limit
    ]
    gone = {later for _, later, _ in pairs}
    return Pruned([f for f in features if f not in gone], pairs)


def prune_collinear(
    df: DataFrame, features: list[str], limit: float = COLLINEAR_LIMIT
) -> Pruned:
    """One pass over the data for the matrix; the rule then needs only its k x k numbers."""
    return prune_from_matrix(features, corr_values(df, features), limit)


def pruned_pairs(df: DataFrame, pruned: Pruned) -> DataFrame:
    """The high-correlation pairs as a table."""
    return df.sparkSession.createDataFrame(pruned.pairs, "earlier string, later string, r double")


def kept_features(df: DataFrame, pruned: Pruned) -> DataFrame:
    """The surviving features as a table with their order."""
    return df.sparkSession.createDataFrame(
        list(enumerate(pruned.kept)), "ordinal long, feature string"
    )

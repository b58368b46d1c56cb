"""Annotating rows from rule tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.functions.scalar import lookup


@dataclass(frozen=True)
class TextRule:
    """Text for rows whose ``column`` equals ``value`` or, with ``above``, exceeds it."""

    column: str
    text: str
    value: float
    above: bool = False

    def holds(self) -> Column:
        c = F.col(f"`{self.column}`")
        return c > self.value if self.above else c == self.value


def threshold_colour(score: Column, threshold: float, below: str, otherwise: str) -> Column:
    return F.when(score.isNull(), None).when(score < threshold, below).otherwise(otherwise)


def annotate(
    df: DataFrame,
    colours: Mapping[str, str],
    group_text: Mapping[int, str],
    rules: Sequence[TextRule],
    threshold: float = 0.7,
    below: str = "#FF0000",
    otherwise: str = "#000000",
    group: str = "cluster",
    group_column: str = "cluster_advice",
    suffix: str = "_advice",
) -> DataFrame:
    """Colour columns by threshold, text by group and text per feature rule; rules for absent columns are skipped.

    ``colours`` maps a new colour column to the score column it judges.
    """
    added = {name: threshold_colour(F.col(f"`{score}`"), threshold, below, otherwise) for name, score in colours.items()}
    added[group_column] = lookup(F.col(group), group_text)
    for rule in rules:
        if rule.column in df.columns:
            added[rule.column + suffix] = F.when(rule.holds(), F.lit(rule.text))
    return df.select("*", *[c.alias(n) for n, c in added.items()])

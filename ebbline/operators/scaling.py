"""Robust scaling: centre by the median, divide by the interquartile range."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbline.functions.cells import double_literal, filled
from ebbline.operators.quantiles import exact_quantiles

STATS_SCHEMA = "feature string, median double, iqr double"


@dataclass(frozen=True)
class RobustScale:
    """Fitted medians and ranges, one entry per feature."""

    stats: tuple[tuple[str, float, float], ...]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str]) -> RobustScale:
        found = exact_quantiles(df, features, (0.25, 0.5, 0.75))
        stats = []
        for name in features:
            low, median, high = (found[name, p] for p in (0.25, 0.5, 0.75))
            # A column without any value is left as it is.
            stats.append((name, 0.0, 1.0) if median is None else (name, median, high - low))
        return RobustScale(tuple(stats))

    @staticmethod
    def from_table(table: DataFrame, features: Sequence[str]) -> RobustScale:
        rows = {row["feature"]: (row["median"], row["iqr"]) for row in table.limit(len(features) + 1).collect()}
        return RobustScale(tuple((name, *rows[name]) for name in features))

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.stats), STATS_SCHEMA)

    def divisors(self) -> dict[str, float]:
        """Ranges to divide by; a constant feature is only centred."""
        tiny = 10 * sys.float_info.epsilon
        return {name: 1.0 if iqr < tiny else iqr for name, _, iqr in self.stats}

    def expressions(self, sentinel: float | None = -1.0) -> dict[str, str]:
        """SQL for each scaled feature; missing and infinite results become ``sentinel``.

        The fitted numbers are written out in full, so a text stored with them scales the same way.
        """
        divisors = self.divisors()
        cells = {}
        for name, median, _ in self.stats:
            value = f"((CAST({name} AS DOUBLE) - {double_literal(median)}) / {double_literal(divisors[name])})"
            cells[name] = value if sentinel is None else filled(value, sentinel)
        return cells

    def transform(self, df: DataFrame, sentinel: float | None = -1.0) -> DataFrame:
        """Scale in place, keeping the other columns of each row."""
        scaled = self.expressions(sentinel)
        return df.selectExpr(*[f"{scaled[c]} AS {c}" if c in scaled else f"`{c}`" for c in df.columns])

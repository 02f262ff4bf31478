"""Aggregations (D1-D14): counts, distinct lists, global extremes, KPIs.

All are single ``agg``/``groupBy`` calls: partial aggregation runs before the
shuffle, so hot keys are combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per value, null value dropped, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.col(count_col).desc(), F.col(col).asc()))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, ascending."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def distinct_fallback(df: DataFrame, cols: Sequence[str], out: str = "name") -> DataFrame:
    """Distinct first-non-null of ``cols``; blanks dropped."""
    v = F.coalesce(*[F.col(c) for c in cols])
    return (df.select(v.alias(out)).filter(F.col(out).isNotNull() & (F.trim(F.col(out)) != ""))
              .distinct())


def axis_stats(df: DataFrame, x: str, y: str) -> DataFrame:
    """mean/min/max of two axes in one aggregate."""
    return df.agg(F.avg(x).alias("x_mean"), F.min(x).alias("x_min"), F.max(x).alias("x_max"),
                  F.avg(y).alias("y_mean"), F.min(y).alias("y_min"), F.max(y).alias("y_max"))


def matched_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Matched / unmatched count per lookup column."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}_matched"),
                 F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}_unmatched")]
    return df.agg(*aggs)


__all__ = ["value_counts", "distinct_sorted",
           "distinct_fallback", "axis_stats", "matched_counts"]

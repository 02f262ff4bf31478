"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_domains(a: DataFrame, a_col: str, b: DataFrame, b_col: str,
                  out: str = "name") -> DataFrame:
    """G1: distinct values of two columns' domains (UNION, nulls kept once)."""
    return (a.select(F.col(a_col).alias(out))
             .union(b.select(F.col(b_col).alias(out))).distinct())


def concat_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row concatenation by name; columns missing on one side are null."""
    return a.unionByName(b, allowMissingColumns=True)


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``a`` absent from ``b``."""
    return a.select(*keys).distinct().join(b.select(*keys), list(keys), "left_anti")


def key_intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present in both."""
    return a.select(*keys).distinct().join(b.select(*keys), list(keys), "left_semi")


__all__ = ["union_domains", "concat_union", "key_difference", "key_intersection"]

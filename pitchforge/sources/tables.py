"""Parquet table access (A9) and plan-time source resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pitchforge.session import path_exists

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; filters and projections push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def resolve_source(spark: SparkSession, candidates: Sequence[str]) -> str | None:
    """First candidate path that exists (plan-time check)."""
    for c in candidates:
        if path_exists(spark, c):
            return c
    return None


def has_columns(df: DataFrame, names: Sequence[str]) -> dict[str, bool]:
    """Catalog probe."""
    return {n: n in df.columns for n in names}


__all__ = ["table", "resolve_source", "has_columns", "DRIVER_TABLES"]

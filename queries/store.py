"""Tables that several queries read, built once for each data folder.

Silver history, rating and star are tables of the warehouse in the pipeline this
library serves, so queries read them; the first query of a session that needs
one writes it to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchforge.operators.scd2_store import HistoryStore
from pitchforge.session import path_exists, scratch_path

_PATHS: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` of data folder ``d``, written on first use in this application."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"), name)
    path = _PATHS.get(key)
    if path is None or not path_exists(spark, path):
        path = scratch_path(spark, f"store-{name}")
        build().write.mode("overwrite").parquet(path)
        _PATHS[key] = path
    return spark.read.parquet(path)


def forget() -> None:
    """Let the next query of each stored table build it anew."""
    _PATHS.clear()


def history_store(spark: SparkSession, d: str, name: str, key: str, buckets: int = 8) -> HistoryStore:
    """The stored history ``name`` of data folder ``d``, one in each application; buckets suit small tables."""
    at = (spark.sparkContext.applicationId, d.rstrip("/"), f"history-{name}")
    if at not in _PATHS:
        _PATHS[at] = scratch_path(spark, at[2])
    return HistoryStore(spark, _PATHS[at], key, buckets)

"""Group min-max scaling to 0..100.

One ``groupBy(group).agg(min, max for every metric)`` (partial aggregation on
the map side, so a group holding a third of the rows costs nothing extra),
then the per-group statistics are joined back.  The statistics table has one
row per group; its size is checked before it is broadcast
(``bounded_broadcast_join``), so the big side is never shuffled or skewed.
Window functions partitioned by the group would put each group's rows in one
task instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchforge.functions.scalars import min_max_scaled
from pitchforge.operators.joins import bounded_broadcast_join
from pitchforge.session import cut_lineage


def group_min_max(df: DataFrame, group: str, metrics: Sequence[str],
                  where: Column | None = None) -> DataFrame:
    """Per-group min and max of every metric (rows matching ``where`` only)."""
    src = df if where is None else df.filter(where)
    aggs = []
    for m in metrics:
        aggs += [F.min(m).alias(f"__min_{m}"), F.max(m).alias(f"__max_{m}")]
    return src.groupBy(group).agg(*aggs)


def scale_by_group(df: DataFrame, group: str, metrics: Sequence[str],
                   where: Column | None = None, suffix: str = "_scaled",
                   max_groups: int = 1_000_000, materialize: bool = True) -> DataFrame:
    """``<m><suffix>`` = min-max of ``m`` within ``group`` scaled to 0..100.

    Statistics come from rows matching ``where``; max == min -> 0; the result
    is clipped to [0, 100]; a null value (or an all-null group) -> 0.  The rows
    are read twice, so they are written once first; ``materialize=False`` for
    rows that come from a stored table.
    """
    if not metrics:
        return df
    if materialize:
        df = cut_lineage(df, "scaling-input")
    stats = group_min_max(df, group, metrics, where)
    joined = bounded_broadcast_join(df, stats, group, "left", max_rows=max_groups,
                                    name="group-stats")
    scaled = {f"{m}{suffix}": min_max_scaled(m, f"__min_{m}", f"__max_{m}") for m in metrics}
    helper = [c for m in metrics for c in (f"__min_{m}", f"__max_{m}")]
    return joined.withColumns(scaled).drop(*helper)


__all__ = ["group_min_max", "scale_by_group"]

"""Lookup, bridge, membership and comparison joins.

No explicit broadcast hints on data whose size is not bounded by
construction: with AQE on, a lookup side that turns out small at run time is
converted to a broadcast join from its real shuffle statistics, and a hot key
on the probe side is split by the skew-join rule.  Only literal configuration
tables (size fixed by code) are broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchforge.operators.dedupe import keep_first, keep_last, latest_per_key


def shuffled(df: DataFrame) -> DataFrame:
    """A side with a row per entity, marked for a shuffle join.

    The rows of such a side compress so well that a shuffle of a few MB may hold
    hundreds of MB of rows, and AQE would send them all through the driver.
    """
    return df.hint("merge")


def left_lookup(df: DataFrame, lookup: DataFrame, left_on: str | Sequence[str],
                right_on: str | Sequence[str], take: Mapping[str, str],
                defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left join on (possibly differently named) keys, bringing
    only ``take`` (right name -> output name); missing keys get ``defaults``."""
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = [right_on] if isinstance(right_on, str) else list(right_on)
    tmp = [f"__lk{i}" for i in range(len(rk))]
    right = lookup.select(*[F.col(r).alias(t) for r, t in zip(rk, tmp)],
                          *[F.col(s).alias(d) for s, d in take.items()])
    cond = [F.col(lc) == F.col(t) for lc, t in zip(lk, tmp)]
    cond_expr = cond[0]
    for c in cond[1:]:
        cond_expr = cond_expr & c
    out = df.join(right, cond_expr, "left").drop(*tmp)
    for col, dflt in (defaults or {}).items():
        out = out.withColumn(col, F.coalesce(F.col(col), F.lit(dflt)))
    return out


def latest_join(left: DataFrame, history: DataFrame, key: str, date_col: str,
                take: Mapping[str, str], tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Left join to the latest history row per key (aggregate before join)."""
    latest = latest_per_key(history, [key], date_col, tiebreak)
    return left_lookup(left, latest, key, key, take)


def registry_lookup(df: DataFrame, registry: DataFrame, source_key: str,
                    registry_key: str, id_col: str, order_col: str) -> DataFrame:
    """Known source id -> internal id; duplicate registry entries keep the
    last one in ``order_col`` order."""
    reg = keep_last(registry.filter(F.col(registry_key).isNotNull()), [registry_key],
                    [order_col])
    return left_lookup(df, reg, source_key, registry_key, {id_col: id_col})


def bridge_join(df: DataFrame, bridge: DataFrame, target: DataFrame, id_col: str,
                bridge_key: str, target_key: str) -> DataFrame:
    """Internal id -> bridge key -> target row; columns of ``target`` that
    collide with ``df`` are dropped (the left copy wins)."""
    step = df.join(bridge.select(id_col, bridge_key), id_col, "left")
    keep = [c for c in target.columns if c not in step.columns or c == target_key]
    right = target.select(*keep).withColumnRenamed(target_key, "__tk")
    return step.join(right, F.col(bridge_key) == F.col("__tk"), "left").drop("__tk")


def attach_first(df: DataFrame, attrs: DataFrame, key: str, order: Sequence[str | Column],
                 take: Mapping[str, str]) -> DataFrame:
    """Attach attributes from the first row per key."""
    return left_lookup(df, keep_first(attrs, [key], order), key, key, take)


def membership_flag(df: DataFrame, members: DataFrame, left_on: str, right_on: str,
                    flag: str) -> DataFrame:
    """Is the row's key present in ``members``?  A left-semi style test
    expressed as an EXISTS subquery so duplicates on the right never fan out."""
    keys = members.select(F.col(right_on).alias("__m")).distinct()
    return (df.join(keys.withColumn("__hit", F.lit(True)), F.col(left_on) == F.col("__m"),
                    "left")
              .withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False)))
              .drop("__m", "__hit"))


def work_list(candidates: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Candidate keys absent from ``mapping`` or mapped to ''."""
    done = mapping.filter(F.col(value).isNotNull() & (F.col(value) != "")).select(key)
    return candidates.join(done, key, "left_anti")


def upsert_mapping(mapping: DataFrame, updates: DataFrame, key: str,
                   order_col: str) -> DataFrame:
    """Union then keep the last entry per key (``order_col`` ascending)."""
    return keep_last(mapping.unionByName(updates, allowMissingColumns=True), [key], [order_col])


def compare_entities(long_df: DataFrame, entity_col: str, metric_col: str, value_col: str,
                     entity_a: str, entity_b: str, inverted: Sequence[str] = ()) -> DataFrame:
    """One row per metric with A, B (null -> 0) and A - B; ``better``
    names the side with the better value (lower wins for ``inverted``)."""
    pair = long_df.filter(F.col(entity_col).isin(entity_a, entity_b))
    wide = pair.groupBy(metric_col).agg(
        F.max(F.when(F.col(entity_col) == entity_a, F.col(value_col))).alias("value_a"),
        F.max(F.when(F.col(entity_col) == entity_b, F.col(value_col))).alias("value_b"))
    a = F.coalesce(F.col("value_a"), F.lit(0.0))
    b = F.coalesce(F.col("value_b"), F.lit(0.0))
    inv = F.col(metric_col).isin(list(inverted)) if inverted else F.lit(False)
    better = (F.when(a == b, F.lit("tie"))
               .when((a > b) != inv, F.lit("a")).otherwise(F.lit("b")))
    return wide.select(metric_col, a.alias("value_a"), b.alias("value_b"),
                       (a - b).alias("diff"), better.alias("better"))


def rank_lookup(df: DataFrame, ranks: DataFrame, left_on: str, right_on: str,
                rank_col: str, out_col: str, default: int = 20) -> DataFrame:
    """Team -> table position, default 20 when unknown."""
    return left_lookup(df, ranks, left_on, right_on, {rank_col: out_col},
                       defaults={out_col: default})


def bounded_broadcast_join(big: DataFrame, small: DataFrame, on: str | Sequence[str],
                           how: str = "left", max_rows: int = 1_000_000,
                           name: str = "small-side", materialized: bool = False) -> DataFrame:
    """Join ``big`` to a side whose size is checked before it is broadcast.

    ``small`` (an aggregate or dimension) is first written to the shared
    checkpoint folder, so counting it costs one read of that small output
    rather than recomputing it.  Under ``max_rows`` it is broadcast (the
    count is the proven bound); beyond it the join is a shuffle join that
    AQE can split when a key is hot, but not turn into a broadcast.  ``materialized=True`` skips the write
    for a side that is already stored (e.g. a checkpointed dimension).
    """
    from pitchforge.session import cut_lineage

    materialised = small if materialized else cut_lineage(small, name)
    materialised = F.broadcast(materialised) if materialised.count() <= max_rows else shuffled(materialised)
    return big.join(materialised, on, how)


__all__ = ["left_lookup", "latest_join", "registry_lookup", "bridge_join", "attach_first",
           "membership_flag", "work_list", "upsert_mapping", "compare_entities",
           "rank_lookup", "bounded_broadcast_join", "shuffled"]

"""One nested profile per entity from several parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_items(items: DataFrame, key: str, order: Sequence, take: Sequence[str], n: int, out: str) -> DataFrame:
    """up to ``n`` items of each key in ``order``, as an array of structs.

    The rank is limited before the shuffle, so no key sends more than ``n`` rows a task.
    """
    ranked = items.withColumn("__i", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("__i") <= n)
    packed = ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__i", *take))).alias("__items"))
    return packed.select(key, F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in take])).alias(out))


def assemble_profiles(entities: DataFrame, key: str, core: Sequence[str], parts: Mapping[str, DataFrame],
                      rank: DataFrame | None = None, rank_on: str | None = None, default_rank: int = 20) -> DataFrame:
    """(key, profile) with the core fields, each named part (null if it is missing) and the rank.

    ``parts``: name -> (key, one column); ``rank``: (``rank_on``, team_rank).
    """
    out = entities
    for name, part in parts.items():
        value = next(c for c in part.columns if c != key)
        out = out.join(part.select(key, F.col(value).alias(f"__{name}")), key, "left")
    if rank is not None:
        out = out.join(rank.select(F.col(rank_on), F.col("team_rank").alias("__rank")), rank_on, "left")
    else:
        out = out.withColumn("__rank", F.lit(None).cast("bigint"))
    return out.select(key, F.struct(
        F.struct(*core).alias("core_info"), *[F.col(f"__{n}").alias(n) for n in parts],
        F.coalesce("__rank", F.lit(default_rank)).cast("bigint").alias("team_rank")).alias("profile"))


__all__ = ["first_items", "assemble_profiles"]

"""Windows and scans along a key whose rows may be most of a table.

Rows are dealt by range of (key, order), so a key with half of all rows is split
over many tasks.  What a range needs from the rows before it is small:

* ``look_back``: a frame of n rows before the current one needs the last n rows of
  the key ahead of the range (a halo), which are copied into it;
* ``scan``: a fold needs the state at the end of each earlier range; ranges give
  one summary row for each key, and a key's summaries are composed in order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pitchforge.operators.joins import bounded_broadcast_join
from pitchforge.session import cut_lineage

RANGE = "__range"


def by_range(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Written ``rows`` with the number of their range of (key, order); ``order`` has to tell a key's rows apart."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(rows.repartitionByRange(n, key, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def halos(ranged: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key ahead of each range that it continues in, with that range's number.

    Only keys in more than one range have any.  Of them at most ``n`` rows and a mark for each range come
    together.
    """
    cols = [c for c in ranged.columns if c != RANGE]
    # null is a key as others are; as text and flag it can be joined
    named = ranged.withColumns({"__k": F.coalesce(F.col(key).cast("string"), F.lit("")), "__no": F.col(key).isNull()})
    spans = named.groupBy("__k", "__no").agg(F.min(RANGE).alias("__first"), F.max(RANGE).alias("__last")).filter("__first < __last")
    # a range ends with one key and begins with one, so there are fewer such keys than ranges
    spans = cut_lineage(spans.select("__k", "__no"), "spans")
    split = bounded_broadcast_join(named, spans, ["__k", "__no"], how="left_semi", materialized=True)
    last = Window.partitionBy(RANGE, "__k", "__no").orderBy(*[F.desc(c) for c in order])
    tails = split.withColumn("__n", F.row_number().over(last)).filter(F.col("__n") <= n)
    tails = tails.select("__k", "__no", RANGE, F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), (-F.col("__n")).alias("__at"))
    marks = split.select("__k", "__no", RANGE).distinct().withColumns(
        {"__row": F.lit(None).cast(tails.schema["__row"].dataType), "__at": F.lit(-n - 1)})
    # the 2n rows before a mark hold n rows of the key, or all there are: each range has one for its mark
    w = Window.partitionBy("__k", "__no").orderBy(RANGE, "__at").rowsBetween(-2 * n, -1)
    found = tails.unionByName(marks).withColumn("__before", F.collect_list("__row").over(w)).filter(F.col("__at") == -n - 1)
    found = found.select(RANGE, F.explode(F.slice(F.reverse("__before"), 1, n)).alias("__row"))
    return found.select(*[F.col(f"__row.`{c}`").alias(c) for c in cols], RANGE)


def look_back(rows: DataFrame, key: str, order: Sequence[str], n: int, add: Callable[[DataFrame, WindowSpec], DataFrame]) -> DataFrame:
    """``add(rows, window)`` where the window runs along ``key`` in ``order`` and functions over it look at most
    ``n`` rows back; equal to the plain window over the whole key."""
    ranged = by_range(rows, key, order)
    both = ranged.withColumn("__halo", F.lit(False)).unionByName(halos(ranged, key, order, n).withColumn("__halo", F.lit(True)))
    out = add(both, Window.partitionBy(RANGE, key).orderBy(*order))
    return out.filter(~F.col("__halo")).drop("__halo", RANGE)


def longest_streak(rows: DataFrame, key: str, order: Sequence[str], condition: Column) -> DataFrame:
    """(key, longest_streak): the longest run of rows in ``order`` that meet a condition; 0 if none does.

    A range tells for each key its first streak, its last one, its longest and
    whether it has no break; a fold over a key's ranges joins streaks across borders.
    """
    ranged = by_range(rows.select(key, *order, F.coalesce(condition, F.lit(False)).alias("__ok")), key, order)
    w = Window.partitionBy(RANGE, key).orderBy(*order)
    islands = ranged.withColumn("__island", F.sum(F.when(F.col("__ok"), 0).otherwise(1)).over(w))
    streaks = islands.groupBy(RANGE, key, "__island").agg(F.count_if("__ok").alias("n"))
    parts = streaks.groupBy(RANGE, key).agg(
        F.max("n").alias("best"), F.coalesce(F.max(F.when(F.col("__island") == 0, F.col("n"))), F.lit(0)).alias("first"),
        F.max_by("n", "__island").alias("last"), (F.max("__island") == 0).alias("whole"))
    # a key has a struct for each range at most
    ordered = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(RANGE, "best", "first", "last", "whole"))).alias("p"))
    zero = F.struct(F.lit(0).cast("bigint").alias("best"), F.lit(0).cast("bigint").alias("open"))
    joined = F.aggregate("p", zero, lambda s, p: F.struct(
        F.greatest(s["best"], p["best"], s["open"] + p["first"]).alias("best"),
        F.when(p["whole"], s["open"] + p["last"]).otherwise(p["last"]).alias("open")))
    return ordered.select(key, joined["best"].alias("longest_streak"))


__all__ = ["by_range", "halos", "look_back", "longest_streak"]

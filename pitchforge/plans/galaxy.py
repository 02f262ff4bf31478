"""Match-grain and time-series analytics.

Neither a player's rows (X2-X6, in ranges with the few rows or the state that
comes before each) nor those of a position group (X7) come together in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from pitchforge.operators import segments
from pitchforge.operators.joins import bounded_broadcast_join
from pitchforge.session import cut_lineage

#: Rows of one key on one side of a join from which the key is salted.
HOT_ROWS = 10_000
#: Matches in one array of a player.
CHUNK_MATCHES = 1_000


def dim_date(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """One row per day from ``first`` to ``last`` (column expressions of one-row facts)."""
    days = spark.range(1).select(F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias("full_date"))
    return days.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"), "full_date", F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"), F.quarter("full_date").alias("quarter"), F.year("full_date").alias("year"),
        (F.weekday("full_date") + 1).alias("day_of_week"), (F.weekday("full_date") >= 5).alias("is_weekend"))


def match_chunks(matches: DataFrame, key: str, order: Sequence, take: Sequence[str], out: str, size: int = CHUNK_MATCHES) -> DataFrame:
    """All matches of each player in ``order`` (which tells them apart), as arrays of at most ``size`` structs: (key, chunk from 0, out).

    Matches are dealt by range of player and order and numbered over the ranges, so
    neither a player's matches nor an array of them need to come together in one task.
    """
    n = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(matches.repartitionByRange(n, F.col(key), *order).withColumn("__range", F.spark_partition_id()), "matches")
    before = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range and player in it
    offsets = ranged.groupBy("__range", key).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("__range").alias("__r"), F.col(key).alias("__k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    local = ranged.withColumn("__i", F.row_number().over(Window.partitionBy("__range", key).orderBy(*order)))
    numbered = local.join(offsets, (F.col("__range") == F.col("__r")) & F.col(key).eqNullSafe(F.col("__k")))
    numbered = numbered.withColumn("__i", F.col("__i") + F.col("__before") - 1)
    packed = numbered.groupBy(key, F.floor(F.col("__i") / size).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("__i", *take))).alias("__items"))
    return packed.select(key, "chunk", F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in take])).alias(out))


def match_fact(profiles: DataFrame, key: str, matches: Column, before: Column | None = None) -> DataFrame:
    """One row per player and match of the profile's match array, numbered from 1.

    ``before``: number of the player's matches in the arrays ahead of this one (``match_chunks``).
    """
    ahead = F.lit(0) if before is None else before
    rows = profiles.select(key, ahead.alias("__ahead"), F.posexplode(matches).alias("__i", "m"))
    return rows.select(key, (F.col("__ahead") + F.col("__i") + 1).cast("bigint").alias("match_no"), "m.*")


def value_history(history: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Each value with its difference from the one before (null for the first)."""
    return segments.look_back(history, key, order, 1, lambda df, w: df.withColumn(
        "delta_from_previous", F.col(value) - F.lag(value).over(w)))


def last_n(rows: DataFrame, key: str, order: Sequence[str], value: str, n: int = 5) -> DataFrame:
    """The last ``n`` values up to each row, oldest first, and their mean."""
    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        w = w.rowsBetween(-(n - 1), 0)
        return df.withColumns({f"last_{n}": F.collect_list(value).over(w), f"mean_{n}": F.avg(value).over(w)})

    return segments.look_back(rows, key, order, max(1, n - 1), add)


def year_over_year(monthly: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """A month's value against the same month a year before (null without one)."""
    before = monthly.select(key, F.add_months(month, 12).alias(month), F.col(value).alias("year_before"))
    out = monthly.join(before, [key, month], "left")
    return out.withColumn("change", F.col(value) - F.col("year_before"))


def consistency(rows: DataFrame, key: str, value: str) -> DataFrame:
    """100 less the coefficient of variation in percent, at least 0; null for fewer than two values."""
    out = rows.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("spread"))
    score = F.greatest(F.lit(0.0), F.lit(100.0) - F.lit(100.0) * F.col("spread") / F.col("mean"))
    return out.select(key, "n", F.when((F.col("n") > 1) & (F.col("mean") != 0), score).alias("consistency"))


def longest_streak(rows: DataFrame, key: str, order: Sequence[str], condition: Column) -> DataFrame:
    """The longest run of rows in a row that meet a condition; 0 if none does."""
    return segments.longest_streak(rows, key, order, condition)


def percentile_score(rows: DataFrame, group: str, value: str, out: str = "percentile") -> DataFrame:
    """100 * percent rank of each value within its group (0 in a group of one, null for null).

    Values are counted first and dealt by range, so neither a large group nor a
    frequent value comes together in one task: a value's rank is the count below
    it in its range plus the group's counts of the ranges before.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(counted.repartitionByRange(n, group, value).withColumn("__range", F.spark_partition_id()), "ranges")
    below = Window.partitionBy("__range", group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    # one row for each range and group in it
    offsets = ranged.groupBy("__range", group).agg(F.sum("n").alias("t")).select(
        "__range", F.col(group).alias("__g"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("before"),
        F.sum("t").over(whole).alias("total"))
    ranked = ranged.withColumn("below", F.coalesce(F.sum("n").over(below), F.lit(0)))
    ranked = ranked.join(offsets, (ranked["__range"] == offsets["__range"]) & ranked[group].eqNullSafe(offsets["__g"]))
    score = F.when(F.col("total") > 1, F.lit(100.0) * (F.col("below") + F.col("before")) / (F.col("total") - 1)).otherwise(F.lit(0.0))
    ranked = ranked.select(F.col(group).alias("__rg"), F.col(value).alias("__rv"), score.alias(out))
    return rows.join(ranked, rows[group].eqNullSafe(ranked["__rg"]) & (rows[value] == ranked["__rv"]), "left").drop("__rg", "__rv")


def role_weights(config: Mapping[str, Mapping], group: Column) -> Column:
    """A scoring group's weights as JSON text; '{}' for an unknown one."""
    out = F.lit("{}")
    for name, cfg in reversed(list(config.items())):
        weights = F.to_json(F.struct(*[F.lit(float(w)).alias(m) for m, w in cfg["weights"].items()]))
        out = F.when(group == name, weights).otherwise(out)
    return out


def secondary_candidates(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                         on: Mapping[str, str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every candidate pair by a second key (day of birth and team), nulls matching nothing.

    A key with over ``hot_rows`` rows on a side is dealt over a grid of salts, one axis for each
    side, so no task joins more than about ``hot_rows`` rows of a key with as many of the other side.
    """
    keys = [f"__{r}" for r in on.values()]
    sides = [side.select(F.col(i).alias(out), *[F.col(c).alias(k) for c, k in zip(cols, keys, strict=True)]).dropna(subset=keys)
             for side, i, cols, out in ((left, left_id, list(on), "__left"), (right, right_id, list(on.values()), "__right"))]
    # at most one row for each hot_rows rows of a side
    hot = [cut_lineage(s.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows).select(
        *keys, F.ceil(F.col("n") / hot_rows).cast("int").alias(f"__n{i}")), f"hot{i}") for i, s in enumerate(sides)]
    dealt = []
    for i, s in enumerate(sides):
        for j, h in enumerate(hot):
            s = bounded_broadcast_join(s, h, keys, materialized=True).fillna(1, [f"__n{j}"])
        s = s.withColumn(f"__salt{i}", F.pmod(F.xxhash64(s.columns[len(keys)]), F.col(f"__n{i}")).cast("int"))
        dealt.append(s.withColumn(f"__salt{1 - i}", F.explode(F.sequence(F.lit(0), F.col(f"__n{1 - i}") - 1))).drop("__n0", "__n1"))
    pairs = dealt[0].join(dealt[1], [*keys, "__salt0", "__salt1"])
    return pairs.select(F.col("__left").alias(left_id), F.col("__right").alias(right_id))


__all__ = ["dim_date", "match_chunks", "match_fact", "value_history", "last_n", "year_over_year", "consistency", "longest_streak",
           "percentile_score", "role_weights", "secondary_candidates"]

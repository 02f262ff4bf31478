"""Latest-row, keep-first/last dedupe, dense keys and sequential ids.

All "first/last" operators take an explicit total order; ties are broken by
the caller's tiebreak columns, never by physical row order.

Dense keys never funnel rows through one task: rows are range-partitioned on
the order, each partition is numbered locally, and the per-partition row
counts (one row per partition, a bound fixed by the partition count) become
offsets added back as a literal map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchforge.session import cut_lineage, ensure_checkpoint_dir

OrderSpec = Sequence[Column | str]


def _cols(order: OrderSpec) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def first_per_key(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """Keep the first row of each key under ``order`` (row_number == 1).

    The window sorts within the hash partition of ``keys``; a hot key only
    costs a sort of its own rows, and Spark's window group limit pushes the
    rank filter below the shuffle (partial top-1 per map task).
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


def latest_per_key(df: DataFrame, keys: Sequence[str], date_col: str,
                   tiebreak: OrderSpec = ()) -> DataFrame:
    """Row with the greatest date per key; unparseable (null) dates win,
    as a stable sort putting nulls last followed by ``tail(1)`` would pick them."""
    order = [F.col(date_col).desc_nulls_first(), *_cols(tiebreak)]
    return first_per_key(df, keys, order)


def keep_last(df: DataFrame, keys: Sequence[str], position: OrderSpec) -> DataFrame:
    """The last row per key in ``position`` order (e.g. file name, index)."""
    order = [c.desc() for c in _cols(position)]
    return first_per_key(df, keys, order)


def keep_first(df: DataFrame, keys: Sequence[str], position: OrderSpec) -> DataFrame:
    """The first row per key in ``position`` order."""
    return first_per_key(df, keys, _cols(position))


def dense_key(df: DataFrame, order: OrderSpec, key_col: str = "key",
              start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """E5: consecutive keys start..start+n-1 in ``order`` (must be a total order).

    Range-partition + per-partition numbering; the lineage is cut with a
    reliable checkpoint so partition contents are identical in the counting
    pass and the numbering pass.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _cols(order)
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = sorted((r["__pid"], r["cnt"]) for r in
                    ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("cnt")).collect())
    offsets, running = [], start
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    # one row for each partition: a bounded side of a join, looked up by hash
    table = F.broadcast(spark.createDataFrame(offsets, "__pid int, __base bigint"))
    local_index = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return (ranged.join(table, "__pid")
                  .withColumn(key_col, (F.col("__base") + local_index).cast("bigint"))
                  .select(*df.columns, key_col))


def small_dense_key(df: DataFrame, order: OrderSpec, key_col: str, start: int = 1,
                    max_rows: int = 10_000) -> DataFrame:
    """E5 for an aggregate that is expected to be small, such as a list of names.

    It is written once and counted; up to ``max_rows`` rows one task numbers
    them, beyond that ``dense_key`` does.
    """
    rows = cut_lineage(df, "names")
    if rows.count() > max_rows:
        return dense_key(rows, order, key_col, start)
    numbered = F.row_number().over(Window.orderBy(*_cols(order))) + F.lit(start - 1)
    return rows.withColumn(key_col, numbered.cast("bigint"))


def mint_ids(df: DataFrame, order: OrderSpec, id_col: str, start_after: int = 0,
             prefix: str = "PLR_", width: int = 5) -> DataFrame:
    """``prefix`` + zero-padded sequence continuing after ``start_after``
    (the largest number already issued, a one-row plan-time fact)."""
    keyed = dense_key(df, order, "__seq", start=start_after + 1)
    return keyed.withColumn(id_col, F.format_string(f"{prefix}%0{width}d", F.col("__seq"))) \
                .drop("__seq")


def display_rank(df: DataFrame, order: OrderSpec, rank_col: str = "rank") -> DataFrame:
    """1..n display rank of all rows after a sort."""
    return dense_key(df, order, rank_col, start=1)


def best_per_key(df: DataFrame, keys: Sequence[str], score: str,
                 tiebreak: OrderSpec = ()) -> DataFrame:
    """Arg-max of ``score`` per key, ties to the smallest tiebreak."""
    return first_per_key(df, keys, [F.col(score).desc_nulls_last(), *_cols(tiebreak)])


def removed_duplicates(df: DataFrame, key: str) -> DataFrame:
    """count(*) - count(distinct key) as a one-row frame."""
    return df.agg((F.count(F.lit(1)) - F.countDistinct(key)).cast("bigint")
                  .alias("removed_duplicates"))


__all__ = ["first_per_key", "latest_per_key", "keep_last", "keep_first", "dense_key",
           "small_dense_key", "mint_ids", "display_rank", "best_per_key", "removed_duplicates"]

"""Helpers shared by the corpus operators: row identities, tables in the
shared folder, batch sizes, and state that a Python worker keeps between tasks.
"""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, scratch_path

# Executors need no copy of the package: functions of these modules travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

SPLITS = "spark.sql.files.minPartitionNum"
#: Rows of whole texts that one Arrow batch may hold; bounds a worker's memory.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Settings that the operators rely on: a shared folder, fixed splits and small Arrow batches."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(SPLITS, None) is None:
        # otherwise the splits of a small table follow the number of executors, which may change
        spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, **cols: str) -> DataFrame:
    """Only the columns that an operator uses, under its own names; others can't clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in cols.items()])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has in no spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """Number rows by (partition, place in it).

    Ids tell rows with equal or null keys apart.  ``df`` has to be a table scan
    (or a narrow projection of one): its splits are the same in every plan
    (``prepare`` fixes what they depend on), so two branches of a query, or a
    task that runs again, number rows alike.
    """
    prepare(df.sparkSession)
    return df.withColumn(name, F.monotonically_increasing_id())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    return cut_lineage(df, f"llm-{name}")


#: Rows of a few numbers each that may be broadcast (tens of MB).
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written narrow table, marked for broadcast only if it has at most ``rows`` rows.

    Beyond that it stays as it is, and the join shuffles.
    """
    return F.broadcast(df) if df.count() <= rows else df


def worker_state(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks and queries."""
    home = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    return home.__dict__.setdefault(name, {})


__all__ = ["prepare", "table", "narrow", "fresh", "with_row_id", "materialize", "small_side", "worker_state",
           "scratch_path", "BATCH_ROWS"]

"""Hive-partitioned raw landing zone.

Layout ``<root>/source=<s>/dt=YYYY-MM-DD/<file>``, append-only.  Reads use
partition discovery, so ``dt = <latest>`` prunes every other directory before
any file is opened; the latest value is a bounded plan-time fact taken from
the partition listing, not from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_landing(df: DataFrame, root: str, source_col: str = "source",
                  dt_col: str = "dt", fmt: str = "json", **options) -> None:
    """Append raw records partitioned by source and day.

    Rows are clustered by the partition columns first so each task writes a
    few large files per partition instead of one small file per task; the
    rebalance lets AQE split a day that holds most rows over several tasks.
    """
    (df.hint("rebalance", F.col(source_col), F.col(dt_col))
       .write.mode("append").partitionBy(source_col, dt_col).format(fmt).options(**options)
       .save(root))


def partition_values(spark: SparkSession, root: str, column: str = "dt") -> list[str]:
    """Distinct values of one partition column, from the directory listing only."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found: set[str] = set()
    stack = [base]
    prefix = f"{column}="
    while stack:
        for st in fs.listStatus(stack.pop()):
            if not st.isDirectory():
                continue
            name = st.getPath().getName()
            if name.startswith(prefix):
                found.add(name[len(prefix):])
            elif "=" in name:
                stack.append(st.getPath())
    return sorted(found)


def latest_per_source(spark: SparkSession, root: str, schema: T.StructType | None = None,
                      source: str = "source", column: str = "dt", fmt: str = "json",
                      **options) -> tuple[DataFrame | None, dict[str, str]]:
    """A1: each source's own latest day, so one that didn't land today keeps its last one.

    Only the folders ``source=<s>/dt=<latest>`` are listed and read.
    """
    latest = {s: days[-1] for s in partition_values(spark, root, source)
              if (days := partition_values(spark, f"{root.rstrip('/')}/{source}={s}", column))}
    if not latest:
        return None, {}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    folders = [f"{root.rstrip('/')}/{source}={s}/{column}={day}" for s, day in sorted(latest.items())]
    return reader.option("basePath", root).load(folders), latest


def latest_partition(spark: SparkSession, root: str, schema: T.StructType | None = None,
                     column: str = "dt", fmt: str = "json", **options) -> tuple[DataFrame | None, str | None]:
    """Read only the lexicographically greatest ``column=`` partition.

    Returns (frame, value); (None, None) when nothing has landed yet.
    """
    values = partition_values(spark, root, column)
    if not values:
        return None, None
    latest = values[-1]
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("basePath", root).load(root)
    return df.filter(F.col(column) == F.lit(latest)), latest


def read_all_partitions(spark: SparkSession, root: str, schema: T.StructType | None = None,
                        fmt: str = "json", name_glob: str | None = None,
                        **options) -> DataFrame:
    """A4: every partition, keeping only files whose name matches ``name_glob``;
    the file name is exposed as ``__file`` from the scan metadata."""
    reader = spark.read.format(fmt).options(**options)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(root)
    return df.withColumn("__file", F.col("_metadata.file_name"))


__all__ = ["write_landing", "partition_values", "latest_per_source", "latest_partition", "read_all_partitions"]

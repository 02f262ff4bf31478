"""Untyped CSV scans (A6) and Parquet / table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchforge.session import path_exists


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header row, every column a string (no inference).

    With ``multi_line`` quoted values may hold newlines, and a file is one task
    (``quoted_csv.read_csv_quoted`` splits such files); without it files are split.
    """
    return (spark.read.option("header", True).option("inferSchema", False)
                 .option("multiLine", multi_line).option("escape", '"').csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Header row, quotes doubled within quotes, spaces at the ends of values kept."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """A10: replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def versions(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    """Numbers of the ``v=<n>`` directories under ``base``, by one listing; only those whose write ended
    (with ``_SUCCESS``) if ``complete``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    found = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return [n for n in found if not complete or path_exists(spark, f"{base.rstrip('/')}/v={n}/_SUCCESS")]


def next_version_path(spark: SparkSession, base: str) -> str:
    """A10 for input == output: the next ``v=<n>`` directory under ``base``.

    Readers keep reading the old version while the new one is written; the
    caller switches by reading the returned path afterwards.  A number whose
    write was given up is not used again, so a late writer can't mix files into
    another's version.
    """
    taken = versions(spark, base, complete=False)
    return f"{base.rstrip('/')}/v={taken[-1] + 1 if taken else 0}"


def latest_version_path(spark: SparkSession, base: str) -> str | None:
    """The latest version whose write ended; half-written ones don't count."""
    done = versions(spark, base)
    return f"{base.rstrip('/')}/v={done[-1]}" if done else None


def with_load_stamp(df: DataFrame, stamp: Column | None = None,
                    col: str = "synced_at") -> DataFrame:
    """``SELECT *, CURRENT_DATE AS synced_at`` (stamp is a parameter)."""
    return df.withColumn(col, (stamp if stamp is not None else F.current_date()).cast("date"))


def load_tables(tables: dict[str, DataFrame | None], base: str, stamp: Column | None = None) -> list[str]:
    """Replace each named table; optional (None) tables are skipped."""
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        out = df if stamp is None else with_load_stamp(df, stamp)
        overwrite_parquet(out, f"{base.rstrip('/')}/{name}")
        written.append(name)
    return written


def verify_load(df: DataFrame, condition: Column) -> DataFrame:
    """Total and conditional row counts of a loaded table."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(condition).cast("bigint").alias("matched"))


__all__ = ["read_csv_strings", "write_csv", "overwrite_parquet", "versions", "next_version_path",
           "latest_version_path", "with_load_stamp", "load_tables", "verify_load"]

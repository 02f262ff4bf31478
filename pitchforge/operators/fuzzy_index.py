"""A stored inverted index of the right side's segments for the fuzzy match.

The segments of a name depend on the name alone, so a run adds only the names
that the index does not have yet, as a delta, and probes it with its unresolved left names.  Folders are
written once; a full version takes the place of the deltas it covers, and folders
whose write did not end don't count.  Names that are no longer on the right side
stay in the index and drop out where candidates meet the right rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchforge.operators import fuzzy
from pitchforge.session import cut_lineage
from pitchforge.sources.files import next_version_path, versions

SCHEMA = "rs string, a int, seg_i int, seg_text string, b int"
#: Deltas from which an update writes a full version.
MAX_DELTAS = 16


class SegmentIndex:
    """Segments of token-sorted names for matches from ``threshold`` on, below the folder ``base``."""

    def __init__(self, spark: SparkSession, base: str, threshold: int = 85):
        if threshold < fuzzy.LEAST_THRESHOLD:
            raise ValueError(f"the segment filter is lossless from a threshold of {fuzzy.LEAST_THRESHOLD} on")
        self.spark, self.threshold = spark, int(threshold)
        self.base = f"{base.rstrip('/')}/threshold-{self.threshold}"

    def paths(self) -> list[str]:
        """The latest full version and the deltas after it."""
        full = versions(self.spark, f"{self.base}/full")
        covered = full[-1] if full else -1
        after = [f"{self.base}/delta/v={n}" for n in versions(self.spark, f"{self.base}/delta") if n > covered]
        return [f"{self.base}/full/v={covered}"] * bool(full) + after

    def segments(self) -> DataFrame:
        """(rs, a, b, seg_i, seg_text); files lie by right length, so probes read the lengths they can match."""
        parts = [self.spark.read.schema(SCHEMA).parquet(p) for p in self.paths()]
        out = parts[0] if parts else self.spark.createDataFrame([], SCHEMA)
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def update(self, names: DataFrame) -> int:
        """Add the names of ``names`` (rs) that the index lacks; how many these are."""
        known = self.segments().select("rs").distinct()
        fresh = cut_lineage(names.select("rs").filter("rs <> ''").distinct().join(known, "rs", "left_anti"), "fresh-names")
        n = fresh.count()
        if n:
            self.write(fuzzy.right_segments(fresh, self.threshold), next_version_path(self.spark, f"{self.base}/delta"))
        deltas = versions(self.spark, f"{self.base}/delta")
        if len(self.paths()) > MAX_DELTAS:
            self.write(self.segments(), f"{self.base}/full/v={deltas[-1]}")
        return n

    def write(self, segments: DataFrame, path: str) -> None:
        segments.repartition("b", F.pmod(F.xxhash64("rs"), F.lit(16))).write.partitionBy("b").mode("overwrite").parquet(path)


__all__ = ["SegmentIndex"]

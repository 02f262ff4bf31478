"""A stored SCD2 history that a load changes only where keys changed.

The latest row of every key (its current one, or the last closed one of a key that
has none) lies in the bucket of its key; closed rows lie in append-only segments.  A version is a
manifest that names the folders of its buckets and segments, with their rows and the
columns that have a value in them.  A load

1. compares the snapshot with the buckets of its keys (key, flag and tracked
   columns only),
2. writes the buckets in which a key is new or changed anew, and the rows it
   closes as a new segment,
3. switches by writing the next manifest, which names the new folders and the
   untouched old ones.

Folders are never changed once written, so every earlier version stays readable, and a load that
ends before its manifest is complete leaves the version before it in place.  Two
loads that start from one version both write the same manifest number, and the
second fails instead of hiding the first.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchforge.operators.dedupe import first_per_key, keep_last
from pitchforge.operators.joins import bounded_broadcast_join, shuffled
from pitchforge.operators.scd2 import SCD_COLS, detect_changes
from pitchforge.session import cut_lineage
from pitchforge.sources.files import versions

BUCKET = "__bucket"
#: Columns whose bits one long holds.
WORD = 60
#: Closed segments that a version names before a load merges them into one.
MAX_SEGMENTS = 64
#: Changed keys of a load that may be broadcast.
DELTA_ROWS = 100_000


@dataclass
class Part:
    """A folder of Parquet files with its rows and the columns in which one of them has a value."""

    path: str
    rows: int
    filled: list[str]


@dataclass
class Manifest:
    buckets: int
    schema: str | None = None
    latest: dict[int, Part] = field(default_factory=dict)
    closed: list[Part] = field(default_factory=list)

    def to_json(self) -> str:
        part = lambda p: [p.path, p.rows, p.filled]
        return json.dumps({"buckets": self.buckets, "schema": self.schema, "closed": [part(p) for p in self.closed],
                           "latest": {str(b): part(p) for b, p in self.latest.items()}})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        d = json.loads(text)
        return cls(d["buckets"], d["schema"], {int(b): Part(*p) for b, p in d["latest"].items()}, [Part(*p) for p in d["closed"]])

    def filled(self) -> set[str]:
        """Columns in which some row has a value."""
        return {c for p in [*self.closed, *self.latest.values()] for c in p.filled}


class HistoryStore:
    """The history of ``key`` below the folder ``base``; ``buckets`` holds for a new store."""

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int = 32):
        self.spark, self.base, self.key, self.buckets = spark, base.rstrip("/"), key, buckets

    # --- versions ---

    def version(self) -> int | None:
        """The latest version whose manifest is complete."""
        done = versions(self.spark, f"{self.base}/manifest")
        return done[-1] if done else None

    def manifest(self, version: int | None = None) -> Manifest:
        at = self.version() if version is None else version
        if at is None:
            return Manifest(self.buckets)
        return Manifest.from_json(self.spark.read.text(f"{self.base}/manifest/v={at}", wholetext=True).first()[0])

    def switch(self, manifest: Manifest, before: int | None) -> int:
        """Write the manifest that follows version ``before``; fails if another load has taken its number.

        Numbers whose write was given up are skipped, unless a version after ``before`` is complete.
        """
        done = self.version()
        if done != before:
            raise RuntimeError(f"version {done} was stored since version {before} was read")
        taken = versions(self.spark, f"{self.base}/manifest", complete=False)
        n = taken[-1] + 1 if taken else 0
        self.spark.createDataFrame([(manifest.to_json(),)], "m string").coalesce(1).write.mode("error").text(f"{self.base}/manifest/v={n}")
        return n

    # --- reading ---

    def bucket_of(self, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(n)).cast("int")

    def read(self, manifest: Manifest, paths: Sequence[str]) -> DataFrame:
        """Rows of folders of any version, by the manifest's schema (columns a folder lacks are null)."""
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def latest(self, manifest: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        """The latest row of every key of these buckets (of all without them)."""
        return self.read(manifest, [p.path for b, p in sorted(manifest.latest.items()) if buckets is None or b in buckets])

    def history(self, version: int | None = None) -> DataFrame:
        """The whole table as of a version: closed segments and latest rows."""
        m = self.manifest(version)
        if m.schema is None:
            raise ValueError(f"no version is stored in {self.base}")
        return self.read(m, [*[p.path for p in m.closed], *[p.path for _, p in sorted(m.latest.items())]])

    # --- writing ---

    def write_buckets(self, df: DataFrame) -> dict[int, Part]:
        """Write rows with a column BUCKET, a folder for each of its values."""
        path = f"{self.base}/data/latest-{uuid.uuid4().hex[:12]}"
        df.repartition(F.col(BUCKET)).write.partitionBy(BUCKET).mode("error").parquet(path)
        back, cols = self.spark.read.schema(df.schema).parquet(path), [c for c in df.columns if c != BUCKET]
        rows = back.groupBy(BUCKET).agg(*self.summary(cols)).collect()  # a row for each bucket
        return {r[0]: Part(f"{path}/{BUCKET}={r[0]}", r[1], self.present(cols, r[2:])) for r in rows}

    def write_segment(self, df: DataFrame) -> list[Part]:
        """Write closed rows; no part without any."""
        path = f"{self.base}/data/closed-{uuid.uuid4().hex[:12]}"
        df.write.mode("error").parquet(path)
        r = self.spark.read.schema(df.schema).parquet(path).agg(*self.summary(df.columns)).first()
        return [Part(path, r[0], self.present(df.columns, r[1:]))] if r[0] else []

    @staticmethod
    def summary(cols: Sequence[str]) -> list[Column]:
        """Rows, and for every WORD columns a word with the bits of those that have a value."""
        words = []
        for at in range(0, len(cols), WORD):
            bits = [F.when(F.col(f"`{c}`").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(cols[at:at + WORD])]
            words.append(F.bit_or(functools.reduce(lambda a, b: a + b, bits)))
        return [F.count(F.lit(1)), *words]

    @staticmethod
    def present(cols: Sequence[str], words: Sequence[int | None]) -> list[str]:
        return [c for i, c in enumerate(cols) if (words[i // WORD] or 0) >> (i % WORD) & 1]

    def adopt(self, history: DataFrame) -> int:
        """Store an existing history (without changing a row) as the next version, whatever was stored before."""
        before = self.version()
        active = F.col("is_current").eqNullSafe(True)
        rows = cut_lineage(history.withColumn("__uid", F.monotonically_increasing_id()), "adopt")
        # of a key without a current row its last closed one stands for it
        last = rows.groupBy(self.key).agg(F.max(active).alias("__a"), F.max(F.struct("valid_from", "__uid")).alias("__l"))
        last = last.filter(~F.col("__a") & F.col(self.key).isNotNull()).select(F.col("__l.__uid").alias("__uid"))
        held = active & F.col(self.key).isNotNull()
        stays = rows.filter(held).unionByName(rows.filter(~held).join(last, "__uid", "left_semi")).drop("__uid")
        m = Manifest(self.buckets, history.schema.json())
        m.latest = self.write_buckets(stays.withColumn(BUCKET, self.bucket_of(self.buckets)))
        m.closed = self.write_segment(rows.filter(~held).join(last, "__uid", "left_anti").drop("__uid"))
        return self.switch(m, before)

    def load(self, new: DataFrame, tracked: Sequence[str], run_date: Column, order: Sequence[str | Column] | None = None,
             validate: Callable[[DataFrame], None] | None = None) -> int:
        """I7 on the stored history; the number of the new version.

        The same rules as ``scd2_load``: keep one row of each key, check the
        contract, close or (on the same day) replace changed rows, insert, and
        copy columns in which no row has a value onto current rows.  A column
        that changes its type is refused.
        """
        before = self.version()
        m = self.manifest(before)
        if order:
            snapshot = keep_last(new, [self.key], order)
        else:
            snapshot = first_per_key(new, [self.key], [F.xxhash64(*[F.col(f"`{c}`") for c in new.columns])])
        snapshot = cut_lineage(snapshot.withColumn(BUCKET, self.bucket_of(m.buckets)), "scd2-snapshot")
        if validate is not None:
            validate(snapshot.drop(BUCKET))
        day = run_date.cast("date")
        opened = {"is_current": F.lit(True), "valid_from": day, "valid_to": F.lit(None).cast("date")}
        if m.schema is None:
            inserts = snapshot.filter(F.col(self.key).isNotNull()).withColumns(opened)
            m.schema, m.latest = inserts.drop(BUCKET).schema.json(), self.write_buckets(inserts)
            return self.switch(m, before)

        types = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(m.schema))}
        other = [f.name for f in snapshot.schema if f.name in types and f.dataType != types[f.name]]
        if other:
            raise ValueError(f"columns have other types than the stored ones: {other}")
        status = self.statuses(m, snapshot, tracked)
        touched = {r[0] for r in status.select(BUCKET).distinct().collect()}  # at most the number of buckets
        if touched:
            state = self.latest(m, touched).withColumn(BUCKET, self.bucket_of(m.buckets))
            inserts = bounded_broadcast_join(snapshot, status.select(self.key), self.key, "left_semi", max_rows=DELTA_ROWS,
                                             materialized=True).withColumns(opened)
            changed = status.filter("__status = 'changed'").select(self.key, F.lit(True).alias("__chg"))
            hit = F.col("__chg").isNotNull() & F.col("is_current").eqNullSafe(True)
            marked = bounded_broadcast_join(state, changed, self.key, "left", max_rows=DELTA_ROWS, materialized=True).withColumn("__hit", hit)
            closes = marked.filter(F.col("__hit") & ~F.col("valid_from").eqNullSafe(day)).withColumns(
                {"valid_to": day, "is_current": F.lit(False)})
            stays = marked.filter(~F.col("__hit")).drop("__chg", "__hit").unionByName(inserts, allowMissingColumns=True)
            m.schema = stays.drop(BUCKET).schema.json()
            m.latest = {b: p for b, p in m.latest.items() if b not in touched} | self.write_buckets(stays)
            m.closed = m.closed + self.write_segment(closes.drop("__chg", "__hit", BUCKET))
        copied = self.without_values(m, snapshot)
        if copied:
            wide = T.StructType.fromJson(json.loads(m.schema))
            for c in copied:
                wide = wide if c in wide.names else wide.add(snapshot.schema[c])
            m.schema = wide.json()
            m.latest = self.write_buckets(self.enriched(m, snapshot, copied))
        if len(m.closed) > MAX_SEGMENTS:
            m.closed = self.write_segment(self.read(m, [p.path for p in m.closed]))
        return self.switch(m, before)

    def without_values(self, m: Manifest, snapshot: DataFrame) -> list[str]:
        """Columns in which the snapshot has values and the history none."""
        filled = m.filled()
        empty = [c for c in snapshot.columns if c not in (self.key, BUCKET, *SCD_COLS) and c not in filled]
        if not empty:
            return []
        return self.present(empty, snapshot.filter(F.col(self.key).isNotNull()).agg(*self.summary(empty)).first()[1:])

    def statuses(self, m: Manifest, snapshot: DataFrame, tracked: Sequence[str]) -> DataFrame:
        """(key, bucket, __status) of the snapshot's new and changed keys, written; reads the buckets of its keys only."""
        present = {r[0] for r in snapshot.filter(F.col(self.key).isNotNull()).select(BUCKET).distinct().collect()}
        kept = [c for c in tracked if c in T.StructType.fromJson(json.loads(m.schema)).names]
        state = self.latest(m, present).select(self.key, "is_current", *kept)
        tagged = detect_changes(snapshot.select(self.key, BUCKET, *[c for c in tracked if c in snapshot.columns]), state, self.key, tracked)
        return cut_lineage(tagged.filter("__status <> 'unchanged'").select(self.key, BUCKET, "__status"), "scd2-status")

    def enriched(self, m: Manifest, snapshot: DataFrame, copied: Sequence[str]) -> DataFrame:
        """All latest rows, with columns that no row has a value in copied from the snapshot onto current ones."""
        source = snapshot.filter(F.col(self.key).isNotNull()).select(self.key, *[F.col(c).alias(f"__new_{c}") for c in copied])
        rows = self.latest(m).withColumn(BUCKET, self.bucket_of(m.buckets)).join(shuffled(source), self.key, "left")
        active = F.col("is_current").eqNullSafe(True)
        return rows.withColumns({c: F.when(active, F.col(f"__new_{c}")) for c in copied}).drop(*[f"__new_{c}" for c in copied])


__all__ = ["HistoryStore", "Manifest", "Part"]

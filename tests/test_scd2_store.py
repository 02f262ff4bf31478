"""The stored history: same rows as plain loads, and only changed buckets are written."""

import pytest
from pyspark.sql import functions as F

from pitchforge.functions.scalars import run_date_col
from pitchforge.operators.scd2 import scd2_load
from pitchforge.operators.scd2_store import HistoryStore
from pitchforge.session import scratch_path

SCHEMA = "k string, goals long, name string, note string"


def rows(df):
    return sorted(map(str, (sorted(r.asDict().items()) for r in df.collect())))


def store(spark, buckets=16):
    return HistoryStore(spark, scratch_path(spark, "test-store"), "k", buckets)


def frame(spark, n, bump=lambda i: 0, start=0):
    return spark.createDataFrame([(f"p{i}", i + bump(i), f"n{i}" if i % 3 else None, None) for i in range(start, n)], SCHEMA)


def test_loads_equal_plain_loads(spark):
    day = ["2026-05-01", "2026-05-04", "2026-05-04", "2026-05-09"]
    doubled = frame(spark, 60, lambda i: 2 if i < 9 else 0).unionByName(spark.createDataFrame([(None, 1, "x", None), ("p3", 77, "z", None)], SCHEMA))
    noted = frame(spark, 60, lambda i: 2 if i < 9 else 0).withColumn("note", F.col("k")).withColumn("extra", F.lit(5))
    loads = list(zip(day, [frame(spark, 50), frame(spark, 60, lambda i: 1 if i < 9 else 0), doubled, noted], strict=True))
    s, plain = store(spark, buckets=4), [None]
    for n, (d, df) in enumerate(loads):
        assert s.load(df, ["goals", "name"], run_date_col(d), order=["name"]) == n
        plain.append(scd2_load(df, plain[-1], "k", ["goals", "name"], run_date_col(d), order=["name"]))
    for n in range(4):  # every earlier version is still there
        assert rows(s.history(n)) == rows(plain[n + 1].select(s.history(n).columns))


def test_only_touched_buckets_are_read_and_written(spark):
    s = store(spark)
    s.load(frame(spark, 800), ["goals", "name"], run_date_col("2026-05-01"))
    first = s.manifest()
    s.load(frame(spark, 8, lambda i: 1, start=7), ["goals", "name"], run_date_col("2026-05-02"))
    second = s.manifest()
    moved = [b for b, p in second.latest.items() if p.path != first.latest[b].path]
    assert len(moved) == 1 and len(second.closed) == 1 and second.closed[0].rows == 1
    assert second.latest[moved[0]].rows == first.latest[moved[0]].rows < 150
    # what the load read of the history lies in that bucket alone
    read = s.latest(first, set(moved)).inputFiles()
    assert read and all(first.latest[moved[0]].path.split(":")[-1] in f for f in read)
    # an unchanged snapshot writes nothing but a manifest
    s.load(frame(spark, 800).filter("k <> 'p7'"), ["goals", "name"], run_date_col("2026-05-03"))
    assert s.manifest().latest == second.latest and s.manifest().closed == second.closed


def test_a_load_that_fails_leaves_the_version_before(spark, monkeypatch):
    s = store(spark)
    s.load(frame(spark, 20), ["goals"], run_date_col("2026-05-01"))
    before = rows(s.history())
    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            s.load(frame(spark, 20, lambda i: 1), ["goals"], run_date_col("2026-05-02"))
    assert s.version() == 0 and rows(s.history()) == before
    # a manifest without its end mark doesn't count either
    spark.createDataFrame([("{",)], "m string").write.text(f"{s.base}/manifest/v=1")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{s.base}/manifest/v=1/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert s.version() == 0
    assert s.load(frame(spark, 20, lambda i: 1), ["goals"], run_date_col("2026-05-02")) == 2
    assert s.history().count() == 40


def test_loads_from_one_version_exclude_each_other(spark):
    s = store(spark)
    s.load(frame(spark, 5), ["goals"], run_date_col("2026-05-01"))
    stale = s.manifest()
    s.load(frame(spark, 6), ["goals"], run_date_col("2026-05-02"))
    with pytest.raises(RuntimeError):
        s.switch(stale, 0)


def test_adopted_history_keeps_every_row(spark):
    old = spark.createDataFrame(
        [("a", 1, False, "2026-01-01", "2026-02-01"), ("a", 2, True, "2026-02-01", None), ("b", 1, False, "2026-01-01", "2026-02-01"),
         ("b", 3, False, "2026-02-01", "2026-03-01"), (None, 9, True, None, None), ("c", 4, None, "2026-01-01", None), ("c", 4, None, "2026-01-01", None)],
        "k string, goals long, is_current boolean, valid_from string, valid_to string").withColumns(
            {c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    s = store(spark)
    s.adopt(old)
    assert rows(s.history()) == rows(old)
    new = spark.createDataFrame([("a", 5), ("b", 7), ("c", 8), ("d", 1)], "k string, goals long")
    s.load(new, ["goals"], run_date_col("2026-04-01"))
    want = scd2_load(new, old, "k", ["goals"], run_date_col("2026-04-01"))
    assert rows(s.history()) == rows(want.select(s.history().columns))


def test_segments_are_merged_and_types_kept(spark, monkeypatch):
    monkeypatch.setattr("pitchforge.operators.scd2_store.MAX_SEGMENTS", 2)
    s = store(spark, buckets=2)
    for n in range(4):
        s.load(frame(spark, 4, lambda i, n=n: n), ["goals"], run_date_col(f"2026-05-0{n + 1}"))
        assert len(s.manifest().closed) <= 2
    assert s.history().count() == 16 and s.history().filter("is_current").count() == 4
    with pytest.raises(ValueError):
        s.load(frame(spark, 4).withColumn("goals", F.col("goals").cast("double")), ["goals"], run_date_col("2026-06-01"))


def test_empty_snapshots(spark):
    s = store(spark)
    s.load(frame(spark, 0), ["goals"], run_date_col("2026-05-01"))
    assert s.history().count() == 0
    s.load(frame(spark, 3), ["goals"], run_date_col("2026-05-02"))
    s.load(frame(spark, 0), ["goals"], run_date_col("2026-05-03"))
    assert s.history().filter("is_current").count() == 3 == s.history().count()

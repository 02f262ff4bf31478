"""The stored name index: equal to a fresh match, and grown by new names alone."""

import random

import pytest
from pyspark.sql import functions as F

from pitchforge.functions.text import token_sort_key
from pitchforge.operators import fuzzy_index
from pitchforge.operators.fuzzy import fuzzy_best_match
from pitchforge.operators.fuzzy_index import SegmentIndex
from pitchforge.session import scratch_path


def names(rng, n):
    return ["".join(rng.choices("abcdeino", k=rng.randint(3, 8))) + " " + "".join(rng.choices("lmrstu", k=rng.randint(3, 7))) for _ in range(n)]


def altered(rng, name):
    at = rng.randrange(len(name))
    return name[:at] + rng.choice(["", "x", "ab"]) + name[at + 1:]


def match(spark, left, right, index=None):
    lf = spark.createDataFrame([(x,) for x in left], "l string")
    rf = spark.createDataFrame([(x, i) for i, x in enumerate(right)], "r string, o int")
    return sorted(tuple(x) for x in fuzzy_best_match(lf, "l", rf, "r", "o", ["o"], 85, index).collect())


def test_runs_equal_fresh_matches(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_index, "MAX_DELTAS", 2)
    rng = random.Random(1)
    right, index = names(rng, 60), SegmentIndex(spark, scratch_path(spark, "t-index"))
    for run in range(4):
        left = [altered(rng, rng.choice(right)) for _ in range(25)]
        assert match(spark, left, right, index) == match(spark, left, right)
        assert len(index.paths()) <= 2
        right = right[3:] + names(rng, 5)  # some names go, some come
    stored = index.segments().select("rs").distinct().count()
    assert stored >= 60 + 3 * 5 - 5  # names that went stay in the index without being matched


def test_only_new_names_are_added(spark):
    rng = random.Random(2)
    first, index = names(rng, 30), SegmentIndex(spark, scratch_path(spark, "t-index"))
    sorted_names = lambda xs: spark.createDataFrame([(x,) for x in xs], "r string").select(token_sort_key(F.col("r")).alias("rs"))
    assert index.update(sorted_names(first)) == 30 and index.update(sorted_names(first)) == 0
    one = index.paths()
    assert index.update(sorted_names(first + ["brand newname"])) == 1 and index.paths()[:-1] == one
    delta = spark.read.parquet(index.paths()[-1])
    assert [r[0] for r in delta.select("rs").distinct().collect()] == ["brand newname"]


def test_half_written_deltas_do_not_count(spark):
    index = SegmentIndex(spark, scratch_path(spark, "t-index"))
    assert index.segments().count() == 0 and index.paths() == []
    df = spark.createDataFrame([("anna berg",)], "rs string")
    index.update(df)
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{index.paths()[0]}/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    assert index.paths() == [] and index.update(df) == 1 and index.paths()[0].endswith("v=1")


def test_thresholds(spark):
    with pytest.raises(ValueError):
        SegmentIndex(spark, "/tmp/x", 60)
    with pytest.raises(ValueError):
        match(spark, ["a b"], ["a c"], SegmentIndex(spark, scratch_path(spark, "t-index"), 90))

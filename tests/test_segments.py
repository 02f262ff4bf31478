"""Windows and scans over ranges of a hot key equal plain windows over the whole key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchforge.operators import segments
from pitchforge.plans import galaxy


def hot(spark, n=3000):
    """Half of the rows have one key, and one of the others is null."""
    rng = random.Random(2)
    rows = [("hot" if i % 2 else rng.choice([None, *"abcdefgh"]), i // 3, i, rng.randint(0, 99), rng.random() < 0.97) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, day int, id int, v int, ok boolean")


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_hot_key_is_split(spark):
    ranged = segments.by_range(hot(spark), "k", ["day", "id"])
    parts = {r[0]: r[1] for r in ranged.filter("k = 'hot'").groupBy(segments.RANGE).count().collect()}
    total = {r[0]: r[1] for r in ranged.groupBy(segments.RANGE).count().collect()}
    assert len(parts) > 1 and max(total.values()) < 3000 / 2


def test_look_back_equals_plain_windows(spark):
    df = hot(spark)
    w = Window.partitionBy("k").orderBy("day", "id")
    plain = df.withColumn("delta_from_previous", F.col("v") - F.lag("v").over(w))
    assert rows(galaxy.value_history(df, "k", ["day", "id"], "v")) == rows(plain)
    for n in (1, 5):
        f = w.rowsBetween(-(n - 1), 0)
        plain = df.withColumns({f"last_{n}": F.collect_list("v").over(f), f"mean_{n}": F.avg("v").over(f)})
        assert rows(galaxy.last_n(df, "k", ["day", "id"], "v", n)) == rows(plain)


def test_halo_reaches_over_ranges_with_fewer_rows(spark):
    """A frame of 40 rows over ranges of about 10."""
    df = spark.range(80).select(F.lit("k").alias("k"), "id", (F.col("id") * 7 % 13).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        w = Window.partitionBy("k").orderBy("id").rowsBetween(-40, 0)
        got = segments.look_back(df, "k", ["id"], 40, lambda d, x: d.withColumn("s", F.sum("v").over(x.rowsBetween(-40, 0))))
        assert rows(got) == rows(df.withColumn("s", F.sum("v").over(w)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_streaks_across_ranges(spark):
    df = hot(spark)
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.day, r.id)):
        best, run = want.get(r.k, (0, 0))
        run = run + 1 if r.ok else 0
        want[r.k] = (max(best, run), run)
    got = {r.k: r.longest_streak for r in galaxy.longest_streak(df, "k", ["day", "id"], F.col("ok")).collect()}
    assert got == {k: b for k, (b, _) in want.items()}
    always = galaxy.longest_streak(df, "k", ["day", "id"], F.lit(True)).filter("k = 'hot'").first().longest_streak
    assert always == 1500
    assert {r.longest_streak for r in galaxy.longest_streak(df, "k", ["day", "id"], F.lit(None).cast("boolean")).collect()} == {0}


def test_no_rows(spark):
    none = hot(spark, 0)
    assert galaxy.value_history(none, "k", ["day", "id"], "v").collect() == []
    assert galaxy.longest_streak(none, "k", ["day", "id"], F.col("ok")).collect() == []

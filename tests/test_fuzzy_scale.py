"""The blocking of the fuzzy join on varied names: nothing lost, few candidates."""

import random

import pytest
from pyspark.sql import functions as F

from pitchforge.functions.text import lcs_length
from pitchforge.operators.fuzzy import candidate_pairs, fuzzy_best_match


def names(rng, n):
    syllables = [c + v + e for c in "bcdfgklmnprstv" for v in "aeiou" for e in ("", "n", "r", "s")]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    return [f"{word()} {word()}" for _ in range(n)]


def edited(rng, name):
    s = list(name)
    for _ in range(rng.randint(0, 5)):
        at = rng.randrange(len(s))
        s[at:at + 1] = rng.choice([[], [s[at], rng.choice("aeiourst")], [rng.choice("aeioun")]]) or [""]
    return " ".join("".join(s).split()) or name


def test_blocking_equals_brute_force(spark):
    rng = random.Random(3)
    right = list(dict.fromkeys(names(rng, 2100)))[:2000]
    left = list(dict.fromkeys([edited(rng, rng.choice(right)) for _ in range(1400)] + names(rng, 800)))[:2000]
    assert len(right) == 2000 and len(left) == 2000
    ls, rs = ({" ".join(sorted(n.split())) for n in side} for side in (left, right))
    want = {(a, b) for a in ls for b in rs if 200 * min(len(a), len(b)) >= 85 * (len(a) + len(b))
            and 200 * lcs_length(a, b) >= 85 * (len(a) + len(b))}
    got = {(r.ls, r.rs) for r in candidate_pairs(
        spark.createDataFrame([(x,) for x in ls], "ls string"), spark.createDataFrame([(x,) for x in rs], "rs string"), 85).collect()}
    assert want <= got and len(got) < 0.02 * len(ls) * len(rs)
    best = fuzzy_best_match(spark.createDataFrame([(n,) for n in left], "l string"), "l",
                            spark.createDataFrame(list(enumerate(right)), "o int, r string"), "r", "o", ["r"])
    sort = lambda n: " ".join(sorted(n.split()))
    order = {}
    for i, n in enumerate(right):
        order.setdefault(sort(n), i)
    expect = {}
    for n in left:
        scores = [(-200 * lcs_length(sort(n), b) / (len(n) + len(b)), order[b]) for a, b in want if a == sort(n)]
        if scores:
            expect[n] = right[min(scores)[1]]
    assert {r["l"]: r["r"] for r in best.collect()} == expect


def test_low_thresholds_are_refused(spark):
    df = spark.createDataFrame([("a", 1)], "n string, o int")
    with pytest.raises(ValueError):
        fuzzy_best_match(df, "n", df, "n", "o", [], 60)
    assert fuzzy_best_match(df, "n", df.select(F.col("n").alias("m"), "o"), "m", "o", ["m"]).count() == 1

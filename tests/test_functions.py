"""Goldens for scalar functions (FIXTURES §3.2, §3.3, §3.5)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchforge.functions import positions as P
from pitchforge.functions import scalars as S
from pitchforge.functions.text import (camel_to_snake, normalize_text, normalize_text_udf,
                                       token_sort_key, token_sort_ratio, token_sort_ratio_py)

TOKEN_SORT = [("harry kane", "kane harry", 100.0), ("son heung-min", "heung-min son", 100.0),
              ("bruno fernandes", "bruno fernandez", 93.3333), ("heung min son", "heung-min son", 92.3077),
              ("vinicius junior", "vinicius jr", 84.6154), ("rodri", "rodrigo", 83.3333),
              ("erling haaland", "erling braut haaland", 82.3529),
              ("lamine yamal", "lamine yamal nasraoui", 72.7273), ("alisson", "alisson becker", 66.6667)]


@pytest.mark.parametrize("a,b,score", TOKEN_SORT)
def test_token_sort_python(a, b, score):
    assert round(token_sort_ratio_py(a, b), 4) == pytest.approx(score, abs=1e-4)


def test_token_sort_spark(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in TOKEN_SORT], "a string, b string")
    out = df.select(token_sort_ratio(token_sort_key("a"), token_sort_key("b")).alias("s")).collect()
    for row, (_, _, score) in zip(out, TOKEN_SORT):
        assert row.s == pytest.approx(score, abs=1e-4)
        assert (row.s >= 85) == (score >= 85)


def test_camel_to_snake():
    assert camel_to_snake("minutesPlayed") == "minutes_played"
    assert camel_to_snake("xGOT") == "x_g_o_t"
    assert camel_to_snake("GoalKick") == "goal_kick"
    assert camel_to_snake("accurateFinalThirdPasses") == "accurate_final_third_passes"


def test_normalize_text(spark):
    df = spark.createDataFrame([("  Martin Ødegård ",), ("José",), (None,), ("  ",), ("Straße",)],
                               "t string")
    got = [r.n for r in df.select(normalize_text("t").alias("n")).collect()]
    assert got == ["martin odegard", "jose", "", "", "strasse"]
    got_udf = [r.n for r in df.select(normalize_text_udf("t").alias("n")).collect()]
    assert got_udf == got


def test_season_label_and_bounds(spark):
    df = spark.createDataFrame([(dt.date(2025, 8, 1),), (dt.date(2026, 4, 13),),
                                (dt.date(2026, 7, 31),), (None,)], "d date")
    assert [r.s for r in df.select(S.season_label("d").alias("s")).collect()] == \
        ["2025-2026", "2025-2026", "2025-2026", None]
    start, end = S.season_bounds(F.lit("2025-2026"), F.lit(2030))
    bad_start, _ = S.season_bounds(F.lit("bad"), F.lit(2030))
    r = spark.range(1).select(start.alias("a"), end.alias("b"), bad_start.alias("c")).first()
    assert (r.a, r.b, r.c) == (dt.date(2025, 8, 1), dt.date(2026, 5, 31), dt.date(2030, 8, 1))


def test_positions(spark):
    names = ["Left Winger", "Midfielder", "Centre-Back", "Attack", "Wing-Back"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r.g for r in df.select(P.general_position("p").alias("g")).collect()] == \
        ["Attack", "Midfield", "Defender", "Unknown", "Attack"]
    groups = spark.createDataFrame([("Centre-Forward",), ("CF",), ("Left Winger",),
                                    ("Second Striker",), (None,)], "p string")
    assert [r.g for r in groups.select(P.scoring_group(F.col("p")).alias("g")).collect()] == \
        ["ST", "ST", "WING", "CM", "CM"]


def test_formats(spark):
    r = spark.range(1).select(
        S.goals_label(F.lit(10), F.lit(2)).alias("a"), S.goals_label(F.lit(3), F.lit(0)).alias("b"),
        S.signed_number(F.lit(5)).alias("c"), S.signed_number(F.lit(0)).alias("d"),
        S.signed_number(F.lit(-3)).alias("e"), S.radar_multiplier(F.lit(1.285)).alias("f"),
        S.radar_multiplier(F.lit(1.0)).alias("g")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("10 (2 pen)", "3", "+5", "0", "-3")
    assert r.f == pytest.approx(100.0) and r.g == 0.0

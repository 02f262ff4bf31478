"""Rating golden (FIXTURES §3.1): the 5-row mock, one league, 900 minutes."""
import pytest

from pitchforge.plans.rating import prepare_rating_input, rate

COLS = ["internal_player_id", "sub_position", "team_rank", "minutes_played", "base_rating", "goals",
        "xg", "shots_on_target", "goal_conversion_pct", "big_chances_created", "possession_lost",
        "big_chances_missed", "tackles", "interceptions", "ground_duels_won_pct",
        "accurate_passes_pct", "xa_key_pass", "aerial_duels_won_pct",
        "errors_lead_goal_dribbled_past"]
ROWS = [
    ("PLR_001", "ST", 1, 3000.0, 8.1, 30.0, 28.5, 60.0, 25.0, 10.0, 200.0, 20.0, 10.0, 5.0, 40.0, 75.0, 15.0, 50.0, 0.0),
    ("PLR_002", "ST", 20, 2500.0, 7.5, 15.0, 14.0, 30.0, 20.0, 5.0, 150.0, 10.0, 15.0, 10.0, 45.0, 70.0, 10.0, 40.0, 0.0),
    ("PLR_003", "ST", 1, 500.0, 6.0, 2.0, 1.5, 5.0, 10.0, 1.0, 50.0, 2.0, 2.0, 1.0, 30.0, 80.0, 2.0, 30.0, 0.0),
    ("PLR_004", "DM", 1, 3100.0, 8.0, 8.0, 5.0, 15.0, 15.0, 15.0, 180.0, 2.0, 80.0, 60.0, 65.0, 92.0, 40.0, 60.0, 5.0),
    ("PLR_005", "CB", 1, 2900.0, 7.4, 2.0, 1.0, 5.0, 5.0, 2.0, 100.0, 1.0, 50.0, 80.0, 60.0, 94.0, 5.0, 75.0, 2.0),
]
EXPECTED = {
    "PLR_001": (96.371761, 10.0, 1.0, 86.371761, "Active"),
    "PLR_002": (43.435961, 4.868421, 1.285, 49.559289, "Active"),
    "PLR_003": (None, None, None, None, "Small Sample"),
    "PLR_004": (90.117345, 4.0, 1.0, 86.117345, "Active"),
    "PLR_005": (59.377495, 2.0, 1.0, 57.377495, "Active"),
}


def test_rating_golden(spark):
    df = spark.createDataFrame(ROWS, COLS).withColumn("league", __import__(
        "pyspark.sql.functions", fromlist=["lit"]).lit("L1"))
    out = {r.internal_player_id: r for r in rate(prepare_rating_input(df)).collect()}
    for pid, (base, pen, mult, final, status) in EXPECTED.items():
        r = out[pid]
        assert r.status == status
        for got, want in ((r.base_score, base), (r.penalty, pen), (r.team_multiplier, mult),
                          (r.final_scout_score, final)):
            if want is None:
                assert got is None
            else:
                assert got == pytest.approx(want, abs=1e-6)


def test_scores_bounded(spark):
    df = spark.createDataFrame(ROWS, COLS).withColumn("league", __import__(
        "pyspark.sql.functions", fromlist=["lit"]).lit("L1"))
    for r in rate(prepare_rating_input(df)).collect():
        if r.final_scout_score is not None:
            assert 0.0 <= r.final_scout_score <= 100.0

"""Gold-stage queries: dimensions, fact, star joins
over the two-run SCD2 history of the analog and its rating."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.operators.aggregates import matched_counts
from pitchforge.plans import analytics, rating, star
from queries.silver import RUNS, history_after
from queries.store import stored

STAR_RUNS = 2
RUN_YEAR = 2026


DIMENSIONS = ("player", "team", "position", "tournament", "season")


def silver_history(spark: SparkSession, d: str) -> DataFrame:
    return history_after(spark, d, STAR_RUNS)


def gold_table(spark: SparkSession, d: str) -> DataFrame:
    return stored(spark, d, "gold-rating", lambda: rating.gold_rating(silver_history(spark, d)))


def star_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One table of the star schema; the fact reads the stored dimensions."""
    if name in DIM_BUILDERS:
        return stored(spark, d, f"dim-{name}", lambda: DIM_BUILDERS[name](silver_history(spark, d)))
    return stored(spark, d, "fact", lambda: star.build_fact(
        silver_history(spark, d), {n: star_table(spark, d, n) for n in DIMENSIONS}, gold_table(spark, d)))


def star_inputs(spark: SparkSession, d: str):
    """(history, rating, star) as stored tables."""
    return silver_history(spark, d), gold_table(spark, d), {
        n: star_table(spark, d, n) for n in (*DIMENSIONS, "fact")}


def _sql(body: str) -> str:
    ctes, _ = O.star_history_sql(STAR_RUNS, RUNS)
    return O.with_ctes(*ctes, body=body)


DIM_BUILDERS = {"player": star.dim_player, "team": star.dim_team,
                "position": star.dim_position, "tournament": star.dim_tournament,
                "season": lambda s: star.dim_season(s, RUN_YEAR)}


def q_dim(name):
    """One table of the star schema."""
    def run(spark, d):
        return star_table(spark, d, name)
    run.__name__ = f"q_dim_{name}"
    return run


def q_fact_keys(spark: SparkSession, d: str) -> DataFrame:
    """Matched / unmatched counts of each surrogate-key lookup."""
    silver, gold, st = star_inputs(spark, d)
    cur = silver.filter("is_current")
    lookups = (cur.join(st["team"].select(F.col("name").alias("team_sfs"), "team_key"),
                        "team_sfs", "left")
                  .join(st["tournament"].select(F.col("name").alias("league_sfs"),
                                                "tournament_key"), "league_sfs", "left")
                  .join(st["season"].select(F.col("name").alias("season_sfs"), "season_key"),
                        "season_sfs", "left"))
    return matched_counts(lookups, ["team_key", "tournament_key", "season_key"])


SQL_FACT_KEYS = _sql("""
SELECT COUNT(t.team_key) AS team_key_matched, COUNT(*) FILTER (WHERE t.team_key IS NULL) AS team_key_unmatched,
       COUNT(tr.tournament_key) AS tournament_key_matched,
       COUNT(*) FILTER (WHERE tr.tournament_key IS NULL) AS tournament_key_unmatched,
       COUNT(se.season_key) AS season_key_matched,
       COUNT(*) FILTER (WHERE se.season_key IS NULL) AS season_key_unmatched
FROM cur c LEFT JOIN dt t ON c.team_sfs = t.name LEFT JOIN dtour tr ON c.league_sfs = tr.name
LEFT JOIN dseas se ON c.season_sfs = se.name""")


def q_star_join(spark: SparkSession, d: str) -> DataFrame:
    return star.star_top(star_inputs(spark, d)[2], 15)


SQL_STAR_JOIN = _sql("""
SELECT f.player_key, p.name AS player_name, p.sub_position, t.name AS team, tour.name AS league,
       s.name AS season, f.goals, f.assists,
       round(f.final_scout_score, 2) AS scout_score
FROM fact f LEFT JOIN dp p ON f.player_key = p.player_key
LEFT JOIN dt t ON f.team_key = t.team_key
LEFT JOIN dtour tour ON f.tournament_key = tour.tournament_key
LEFT JOIN dseas s ON f.season_key = s.season_key
ORDER BY f.final_scout_score DESC NULLS LAST, f.player_key ASC
LIMIT 15""")


def dashboard(spark: SparkSession, d: str) -> DataFrame:
    silver, _, st = star_inputs(spark, d)
    return analytics.dashboard_frame(st, silver)


def q_star_join_versioned(spark: SparkSession, d: str) -> DataFrame:
    return dashboard(spark, d)


def dashboard_sql_cte() -> str:
    cols = []
    for dst, src in analytics.DASHBOARD_SILVER.items():
        present = src in _SILVER_COLS or src == "valid_from"
        if dst == "team_cl":
            cols.append(f"{'s.' + src if present else 'CAST(NULL AS VARCHAR)'} AS team_cl")
        elif dst == "valid_from":
            cols.append("s.valid_from AS valid_from")
        else:
            cols.append(f"{'s.' + src if present else 'CAST(NULL AS DOUBLE)'} AS {dst}")
    for dst, src in analytics.DASHBOARD_ZERO_DEFAULT.items():
        cols.append(f"coalesce({'s.' + src if src in _SILVER_COLS else 'NULL'}, 0.0) AS {dst}")
    return f"""
dash AS (
  SELECT p.internal_player_id, p.name AS player_name, p.sub_position AS position,
         p.current_market_value AS market_value, pos.name AS position_group, t.name AS team,
         tour.name AS league, f.goals, f.assists,
         round(f.final_scout_score, 2) AS scout_score,
         {', '.join(cols)}
  FROM fact f LEFT JOIN dp p ON f.player_key = p.player_key
  LEFT JOIN dt t ON f.team_key = t.team_key
  LEFT JOIN dpos pos ON f.position_key = pos.position_key
  LEFT JOIN dtour tour ON f.tournament_key = tour.tournament_key
  LEFT JOIN (SELECT * FROM h{STAR_RUNS - 1} WHERE is_current) s
         ON p.internal_player_id = s.internal_player_id)"""


# Columns of the analog silver table (plan-time knowledge for the oracle text).
_SILVER_COLS = {
    "team_rank_sfs", "xg_sfs", "xa_sfs", "key_passes_sfs", "successful_dribbles_sfs", "tackles_sfs",
    "interceptions_sfs", "clearances_sfs", "saves_sfs", "clean_sheet_sfs", "goals_prevented_sfs",
    "accurate_passes_pct_sfs", "aerial_duels_won_pct_sfs", "ground_duels_won_pct_sfs",
    "base_rating_cl_sfs", "team_cl_sfs", "penalty_goals_sfs", "goals_cl_sfs", "assists_cl_sfs",
    "penalty_goals_cl_sfs"}


def dashboard_sql(body: str, *extra_ctes: str) -> str:
    ctes, _ = O.star_history_sql(STAR_RUNS, RUNS)
    ctes.append(dashboard_sql_cte())
    ctes.extend(extra_ctes)
    return O.with_ctes(*ctes, body=body)


def q_constraint_audit(spark: SparkSession, d: str) -> DataFrame:
    """Primary keys unique, foreign keys present, (id, valid_from) unique, values in range."""
    from pitchforge.operators.contract import constraint_audit, duplicate_keys, orphan_keys, out_of_range
    st = star_inputs(spark, d)[2]
    f = st["fact"]
    checks = {"dim_player_pk_unique": duplicate_keys(st["player"], ["player_key"]),
              "dim_player_version_unique": duplicate_keys(st["player"],
                                                          ["internal_player_id", "valid_from"]),
              "dim_team_pk_unique": duplicate_keys(st["team"], ["team_key"]),
              "fact_player_fk": orphan_keys(f, st["player"], "player_key", "player_key"),
              "fact_team_fk": orphan_keys(f, st["team"], "team_key", "team_key"),
              "fact_position_fk": orphan_keys(f, st["position"], "position_key", "position_key"),
              "fact_tournament_fk": orphan_keys(f, st["tournament"], "tournament_key",
                                                "tournament_key"),
              "fact_season_fk": orphan_keys(f, st["season"], "season_key", "season_key"),
              "fact_null_team": f.filter(F.col("team_key").isNull()),
              "fact_score_range": out_of_range(f, "final_scout_score", 0.0, 100.0),
              "fact_goals_range": out_of_range(f, "goals", 0.0, 40.0)}
    return constraint_audit(spark, checks)


SQL_CONSTRAINT_AUDIT = _sql("""
SELECT 'dim_player_pk_unique' AS "check", (SELECT COUNT(*) FROM (SELECT player_key FROM dp
       GROUP BY player_key HAVING COUNT(*) > 1)) AS failures
UNION ALL SELECT 'dim_player_version_unique', (SELECT COUNT(*) FROM (SELECT 1 FROM dp
       GROUP BY internal_player_id, valid_from HAVING COUNT(*) > 1))
UNION ALL SELECT 'dim_team_pk_unique', (SELECT COUNT(*) FROM (SELECT 1 FROM dt GROUP BY team_key
       HAVING COUNT(*) > 1))
UNION ALL SELECT 'fact_player_fk', (SELECT COUNT(*) FROM fact WHERE player_key IS NOT NULL
       AND player_key NOT IN (SELECT player_key FROM dp))
UNION ALL SELECT 'fact_team_fk', (SELECT COUNT(*) FROM fact WHERE team_key IS NOT NULL
       AND team_key NOT IN (SELECT team_key FROM dt))
UNION ALL SELECT 'fact_position_fk', (SELECT COUNT(*) FROM fact WHERE position_key IS NOT NULL
       AND position_key NOT IN (SELECT position_key FROM dpos))
UNION ALL SELECT 'fact_tournament_fk', (SELECT COUNT(*) FROM fact WHERE tournament_key IS NOT NULL
       AND tournament_key NOT IN (SELECT tournament_key FROM dtour))
UNION ALL SELECT 'fact_season_fk', (SELECT COUNT(*) FROM fact WHERE season_key IS NOT NULL
       AND season_key NOT IN (SELECT season_key FROM dseas))
UNION ALL SELECT 'fact_null_team', (SELECT COUNT(*) FROM fact WHERE team_key IS NULL)
UNION ALL SELECT 'fact_score_range', (SELECT COUNT(*) FROM fact WHERE final_scout_score < 0 OR final_scout_score > 100)
UNION ALL SELECT 'fact_goals_range', (SELECT COUNT(*) FROM fact WHERE goals < 0 OR goals > 40)""")


QUERIES = {
    "constraint_audit": (q_constraint_audit, SQL_CONSTRAINT_AUDIT),
    "dim_player": (q_dim("player"), _sql("SELECT * FROM dp")),
    "dim_team": (q_dim("team"), _sql("SELECT * FROM dt")),
    "dim_position": (q_dim("position"), _sql("SELECT * FROM dpos")),
    "dim_tournament": (q_dim("tournament"), _sql("SELECT * FROM dtour")),
    "dim_season": (q_dim("season"), _sql("SELECT * FROM dseas")),
    "fact": (q_dim("fact"), _sql("SELECT * FROM fact")),
    "fact_keys": (q_fact_keys, SQL_FACT_KEYS),
    "star_join": (q_star_join, SQL_STAR_JOIN),
    "star_join_versioned": (q_star_join_versioned, dashboard_sql("SELECT * FROM dash")),
}

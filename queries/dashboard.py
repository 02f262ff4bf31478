"""Dashboard queries over the star-joined frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.operators.aggregates import distinct_sorted
from pitchforge.operators.columns import dashboard_filter
from pitchforge.plans import analytics
from pitchforge.plans.analogs import POSITIONS
from pitchforge.sources.tables import table
from queries.star import dashboard, dashboard_sql, star_inputs

LEAGUES = ["BUILDING", "MACHINERY"]
PICK_POSITIONS = ["Centre-Forward", "Left Winger", "Centre-Back", "Goalkeeper"]
MAX_VALUE = 300000.0
MIN_SCORE = 40.0
PLAYER_A = "Customer#000000001"
PLAYER_B = "Customer#000000010"
RADAR_METRICS = ["scout_score", "base_score", "team_multiplier", "goals", "assists", "xg",
                 "key_passes"]
COMPARE_METRICS = ["goals", "assists", "xg", "xa", "key_passes", "tackles", "scout_score"]
INVERTED = ["team_rank"]


def r6(col):
    return F.floor(col * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def r6_sql(x: str) -> str:
    return f"floor(({x}) * 1000000.0 + 0.5) / 1000000.0"


def _in(vals) -> str:
    return O.sql_in(vals)


# ----------------------------------------------------------------- B6 / B7
def q_dashboard_filter(spark, d):
    return dashboard_filter(dashboard(spark, d), leagues=LEAGUES, positions=PICK_POSITIONS,
                            max_value=MAX_VALUE, min_score=MIN_SCORE)


SQL_DASHBOARD_FILTER = dashboard_sql(f"""
SELECT * FROM dash WHERE league IN {_in(LEAGUES)} AND position IN {_in(PICK_POSITIONS)}
  AND coalesce(market_value, 0.0) <= {MAX_VALUE} AND scout_score >= {MIN_SCORE}""")


def q_latest_snapshot(spark, d):
    return dashboard_filter(dashboard(spark, d), latest_only=True, min_score=0.0)


SQL_LATEST_SNAPSHOT = dashboard_sql("""
SELECT * FROM dash WHERE valid_from = (SELECT max(valid_from) FROM dash) AND scout_score >= 0.0""")


# ------------------------------------------------------------- F1 / I24
def q_leaderboard(sort_by: str, mode: str):
    def run(spark, d):
        return analytics.leaderboard(dashboard(spark, d), sort_by, mode)
    run.__name__ = f"q_leaderboard_{mode}_{sort_by}"
    return run


def leaderboard_sql(sort_by: str, mode: str) -> str:
    src = "dash"
    if mode == "alt":
        src = ("(SELECT * REPLACE (goals_cl AS goals, penalty_goals_cl AS penalty_goals, "
               "assists_cl AS assists, rating_cl AS scout_score, coalesce(team_cl, team) AS team) "
               "FROM dash WHERE rating_cl IS NOT NULL OR goals_cl > 0 OR assists_cl > 0)")
    order = ", ".join(f"{c} {'DESC' if o == 'desc' else 'ASC'} NULLS LAST"
                      for c, o in analytics.SORTS[sort_by])
    return dashboard_sql(f"""
SELECT CAST(row_number() OVER (ORDER BY {order}, internal_player_id ASC) AS BIGINT) AS rank,
       internal_player_id, player_name, position, team, league, goals, penalty_goals, assists,
       scout_score, market_value
FROM (SELECT * REPLACE (CAST(coalesce(goals, 0) AS BIGINT) AS goals,
                        CAST(coalesce(penalty_goals, 0) AS BIGINT) AS penalty_goals) FROM {src})""")


# ------------------------------------------------------- D1-D9, I20-I23
def q_kpis(spark, d):
    k = analytics.kpis(dashboard_filter(dashboard(spark, d), min_score=0.0))
    return k.withColumn("mean_score", r6(F.col("mean_score")))


SQL_KPIS = dashboard_sql(f"""
SELECT COUNT(*) AS n_players, COUNT(DISTINCT team) AS n_teams, COUNT(DISTINCT league) AS n_leagues,
       {r6_sql('coalesce(avg(scout_score), 0.0)')} AS mean_score
FROM dash WHERE scout_score >= 0.0""")


def q_value_counts(spark, d):
    return analytics.club_distribution(dashboard(spark, d), 10)


SQL_VALUE_COUNTS = dashboard_sql("""
SELECT team, COUNT(*) AS n_players FROM dash WHERE team IS NOT NULL GROUP BY team
ORDER BY n_players DESC, team ASC LIMIT 10""")


def q_position_counts(spark, d):
    return analytics.position_distribution(dashboard(spark, d))


def abbr_sql(col: str) -> str:
    from pitchforge.functions.positions import POSITION_ABBR
    parts = " ".join(f"WHEN lower(trim({col})) = '{k}' THEN '{v}'" for k, v in POSITION_ABBR.items())
    return f"CASE {parts} ELSE {col} END"


SQL_POSITION_COUNTS = dashboard_sql(f"""
SELECT abbr, COUNT(*) AS n_players FROM (SELECT {abbr_sql('position')} AS abbr FROM dash)
WHERE abbr IS NOT NULL GROUP BY abbr""")


def q_distinct_options(spark, d):
    """Sorted team options that depend on the chosen leagues."""
    dash = dashboard(spark, d)
    return distinct_sorted(dash.filter(F.col("league").isin(LEAGUES)), "team")


SQL_DISTINCT_OPTIONS = dashboard_sql(f"""
SELECT DISTINCT team FROM dash WHERE league IN {_in(LEAGUES)} AND team IS NOT NULL""")


def q_global_max(spark, d):
    """Global extremes and means of the two quadrant axes."""
    dash = dashboard(spark, d)
    return dash.agg(F.max("valid_from").alias("max_valid_from"),
                    F.max("market_value").alias("max_market_value"),
                    F.min("market_value").alias("min_market_value"),
                    F.max("scout_score").alias("max_score"),
                    F.min("scout_score").alias("min_score"))


SQL_GLOBAL_MAX = dashboard_sql("""
SELECT max(valid_from) AS max_valid_from, max(market_value) AS max_market_value,
       min(market_value) AS min_market_value, max(scout_score) AS max_score,
       min(scout_score) AS min_score FROM dash""")


def q_quadrants(spark, d):
    q = analytics.quadrants(dashboard(spark, d), keep=("internal_player_id", "player_name"))
    return q.withColumns({"x_mean": r6(F.col("x_mean")), "y_mean": r6(F.col("y_mean"))})


SQL_QUADRANTS = dashboard_sql(f"""
SELECT internal_player_id, player_name, x, y, {r6_sql('xm')} AS x_mean, {r6_sql('ym')} AS y_mean,
       CASE WHEN x < xm AND y >= ym THEN 'Underrated' WHEN x >= xm AND y >= ym THEN 'World Class'
            WHEN x < xm AND y < ym THEN 'Rotation / Normal' ELSE 'Overrated' END AS quadrant
FROM b, m""", """
b AS (SELECT internal_player_id, player_name, market_value / 1000000.0 AS x,
             CAST(scout_score AS DOUBLE) AS y
      FROM dash WHERE market_value IS NOT NULL AND scout_score IS NOT NULL)""",
    "m AS (SELECT avg(x) AS xm, avg(y) AS ym FROM b)")


def q_history_order(spark, d):
    from queries.star import star_table
    return analytics.market_value_history(star_table(spark, d, "player"))


SQL_HISTORY_ORDER = dashboard_sql("""
SELECT name, valid_from, current_market_value / 1000000.0 AS value_millions
FROM dp WHERE current_market_value IS NOT NULL""")


# ------------------------------------------------------- I25 / I26 / I27
def q_radar(spark, d):
    silver, gold, st = star_inputs(spark, d)
    fdf = dashboard_filter(analytics.dashboard_frame(st, silver), min_score=0.0)
    return analytics.radar(gold, fdf, PLAYER_A, RADAR_METRICS).withColumn(
        "value", r6(F.col("value")))


def radar_sql() -> str:
    parts = []
    for m in RADAR_METRICS:
        if m in ("scout_score", "base_score", "team_multiplier"):
            col = {"scout_score": "final_scout_score"}.get(m, m)
            v = f"coalesce({col}, 0.0)"
            if m == "team_multiplier":
                v = O.clip_sql(f"({col} - 1.0) / 0.285 * 100.0", 0, 100)
                v = f"coalesce({v}, 0.0)"
            val = (f"(SELECT {v} FROM gold WHERE name = '{PLAYER_A}' "
                   f"ORDER BY internal_player_id LIMIT 1)")
        else:
            mx = f"(SELECT greatest(coalesce(CAST(max({m}) AS DOUBLE), 1.0), 1.0) FROM fdf)"
            val = (f"(SELECT coalesce(CAST({m} AS DOUBLE), 0.0) / {mx} * 100.0 FROM fdf "
                   f"WHERE player_name = '{PLAYER_A}' ORDER BY internal_player_id LIMIT 1)")
        found = f"(SELECT COUNT(*) FROM fdf WHERE player_name = '{PLAYER_A}') > 0"
        parts.append(f"SELECT '{m}' AS metric, {r6_sql(f'CASE WHEN {found} THEN coalesce({val}, 0.0) ELSE 0.0 END')} AS value")
    return dashboard_sql(" UNION ALL ".join(parts),
                         "fdf AS (SELECT * FROM dash WHERE scout_score >= 0.0)")


def q_compare_two(spark, d):
    dash = dashboard(spark, d)
    return analytics.compare_players(dash, PLAYER_A, PLAYER_B, COMPARE_METRICS, INVERTED)


def compare_sql() -> str:
    rows = []
    for m in COMPARE_METRICS:
        a = f"(SELECT CAST({m} AS DOUBLE) FROM dash WHERE player_name = '{PLAYER_A}' ORDER BY internal_player_id LIMIT 1)"
        b = f"(SELECT CAST({m} AS DOUBLE) FROM dash WHERE player_name = '{PLAYER_B}' ORDER BY internal_player_id LIMIT 1)"
        rows.append(f"SELECT '{m}' AS metric, {a} AS va, {b} AS vb")
    inv = _in(INVERTED)
    return dashboard_sql(f"""
SELECT metric, coalesce(va, 0.0) AS value_a, coalesce(vb, 0.0) AS value_b,
       coalesce(va, 0.0) - coalesce(vb, 0.0) AS diff,
       CASE WHEN coalesce(va, 0.0) = coalesce(vb, 0.0) THEN 'tie'
            WHEN (coalesce(va, 0.0) > coalesce(vb, 0.0)) <> (metric IN {inv}) THEN 'a' ELSE 'b' END
         AS better
FROM ({' UNION ALL '.join(rows)}) WHERE va IS NOT NULL OR vb IS NOT NULL""")


def q_auto_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metric list per pair of consecutive customers by position group."""
    c = table(spark, d, "customer").select("c_custkey")
    pos = F.array(*[F.lit(p) for p in POSITIONS])
    a = c.select(F.col("c_custkey").alias("a_key"),
                 F.get(pos, F.pmod("c_custkey", F.lit(9)).cast("int")).alias("pos_a"))
    b = c.select(F.col("c_custkey").alias("b_key"),
                 F.get(pos, F.pmod("c_custkey", F.lit(9)).cast("int")).alias("pos_b"))
    pairs = a.join(b, F.col("b_key") == F.col("a_key") + 1)
    return analytics.auto_metrics(pairs, "pos_a", "pos_b").withColumn(
        "slot", F.col("slot").cast("bigint"))


def auto_metrics_sql() -> str:
    from pitchforge.functions.positions import (COMPARISON_GROUPS, DEFAULT_METRICS,
                                                GROUP_METRICS)

    def grp(col):
        parts = " ".join(f"WHEN upper(trim(coalesce({col}, ''))) IN {_in(names)} THEN '{g}'"
                         for g, names in COMPARISON_GROUPS)
        return f"CASE {parts} ELSE 'UNKNOWN' END"

    lists = " ".join(f"WHEN '{g}' THEN {O.sql_list(ms)}" for g, ms in GROUP_METRICS.items())
    pos = O.sql_list(POSITIONS)
    return f"""
WITH p AS (
  SELECT a.c_custkey AS a_key, ({pos})[a.c_custkey % 9 + 1] AS pos_a,
         b.c_custkey AS b_key, ({pos})[b.c_custkey % 9 + 1] AS pos_b
  FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1),
g AS (SELECT *, CASE WHEN {grp('pos_a')} = {grp('pos_b')} AND {grp('pos_a')} <> 'UNKNOWN'
                     THEN {grp('pos_a')} END AS shared_group FROM p),
l AS (SELECT *, coalesce(CASE shared_group {lists} END, {O.sql_list(DEFAULT_METRICS)}) AS ms FROM g)
SELECT a_key, pos_a, b_key, pos_b, shared_group, CAST(i - 1 AS BIGINT) AS slot, ms[i] AS metric
FROM l, range(1, len(ms) + 1) t(i)"""


# ---------------------------------------------------------------- E4 / H31
def q_minmax_group(spark, d):
    from pitchforge.operators.scaling import scale_by_group
    from queries.silver import snapshot
    sp = snapshot(spark, d, None).select("internal_player_id", "league_sfs", "goals_sfs", "xg_sfs",
                                         "minutes_played_sfs")
    return scale_by_group(sp, "league_sfs", ["goals_sfs", "xg_sfs", "minutes_played_sfs"], materialize=False)


def minmax_sql() -> str:
    cols = []
    for m in ["goals_sfs", "xg_sfs", "minutes_played_sfs"]:
        lo = f"min({m}) OVER (PARTITION BY league_sfs)"
        hi = f"max({m}) OVER (PARTITION BY league_sfs)"
        raw = f"CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({m} - {lo}) / ({hi} - {lo}) * 100.0 END"
        cols.append(f"coalesce({O.clip_sql(raw, 0, 100)}, 0.0) AS {m}_scaled")
    return O.with_ctes(O.silver_ctes(), body=f"""
SELECT internal_player_id, league_sfs, goals_sfs, xg_sfs, minutes_played_sfs, {', '.join(cols)}
FROM sp""")


QUERIES = {
    "dashboard_filter": (q_dashboard_filter, SQL_DASHBOARD_FILTER),
    "latest_snapshot": (q_latest_snapshot, SQL_LATEST_SNAPSHOT),
    "kpis": (q_kpis, SQL_KPIS),
    "value_counts": (q_value_counts, SQL_VALUE_COUNTS),
    "position_counts": (q_position_counts, SQL_POSITION_COUNTS),
    "distinct_options": (q_distinct_options, SQL_DISTINCT_OPTIONS),
    "global_max": (q_global_max, SQL_GLOBAL_MAX),
    "quadrants": (q_quadrants, SQL_QUADRANTS),
    "history_order": (q_history_order, SQL_HISTORY_ORDER),
    "radar": (q_radar, radar_sql()),
    "compare_two": (q_compare_two, compare_sql()),
    "auto_metrics": (q_auto_metrics, auto_metrics_sql()),
    "minmax_group": (q_minmax_group, minmax_sql()),
}
for _mode in ("domestic", "alt"):
    for _sort in ("score", "goals", "assists", "value"):
        QUERIES[f"leaderboard_{_mode}_{_sort}"] = (q_leaderboard(_sort, _mode),
                                                   leaderboard_sql(_sort, _mode))

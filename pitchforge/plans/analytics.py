"""Dashboard analytics as parameterised DataFrame functions.

Global statistics (means, maxima) are uncorrelated scalar subqueries
(``df.agg(...).scalar()``): computed once by a partial + final aggregate and
used as values, so no single-partition window and no join is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchforge.functions.positions import (DEFAULT_COMPARISON_GROUP, DEFAULT_METRICS,
                                            GROUP_METRICS, comparison_group,
                                            position_abbreviation)
from pitchforge.functions.scalars import (millions, radar_multiplier, round_half_up,
                                          signed_number, url_from_id)
from pitchforge.operators.aggregates import axis_stats, value_counts
from pitchforge.operators.columns import column_or, mode_switch, name_matches, participation
from pitchforge.operators.dedupe import display_rank, keep_first
from pitchforge.operators.joins import attach_first, bounded_broadcast_join, shuffled

TEAM_LOGO = ("https://img.example.org/team/", "/image")

# Dashboard column -> silver column.
DASHBOARD_SILVER = {
    "team_rank": "team_rank_sfs", "xg": "xg_sfs", "xa": "xa_sfs", "key_passes": "key_passes_sfs",
    "successful_dribbles": "successful_dribbles_sfs", "tackles": "tackles_sfs",
    "interceptions": "interceptions_sfs", "clearances": "clearances_sfs", "saves": "saves_sfs",
    "clean_sheets": "clean_sheet_sfs", "goals_prevented": "goals_prevented_sfs",
    "accurate_passes_pct": "accurate_passes_pct_sfs",
    "aerial_duels_won_pct": "aerial_duels_won_pct_sfs",
    "ground_duels_won_pct": "ground_duels_won_pct_sfs",
    "rating_cl": "base_rating_cl_sfs", "xg_cl": "xg_cl_sfs", "xa_cl": "xa_cl_sfs",
    "key_passes_cl": "key_passes_cl_sfs", "successful_dribbles_cl": "successful_dribbles_cl_sfs",
    "tackles_cl": "tackles_cl_sfs", "interceptions_cl": "interceptions_cl_sfs",
    "clearances_cl": "clearances_cl_sfs", "saves_cl": "saves_cl_sfs",
    "clean_sheets_cl": "clean_sheet_cl_sfs", "accurate_passes_pct_cl": "accurate_passes_pct_cl_sfs",
    "aerial_duels_won_pct_cl": "aerial_duels_won_pct_cl_sfs",
    "ground_duels_won_pct_cl": "ground_duels_won_pct_cl_sfs", "team_cl": "team_cl_sfs",
    "valid_from": "valid_from",
}
DASHBOARD_ZERO_DEFAULT = {"penalty_goals": "penalty_goals_sfs", "goals_cl": "goals_cl_sfs",
                          "assists_cl": "assists_cl_sfs",
                          "penalty_goals_cl": "penalty_goals_cl_sfs"}
ALT_MODE = {"goals": "goals_cl", "penalty_goals": "penalty_goals_cl", "assists": "assists_cl",
            "scout_score": "rating_cl"}
SORTS = {"score": [("scout_score", "desc")],
         "goals": [("goals", "desc"), ("penalty_goals", "asc")],
         "assists": [("assists", "desc")],
         "value": [("market_value", "desc")]}


def dashboard_frame(star: Mapping[str, DataFrame], silver: DataFrame) -> DataFrame:
    """Fact + four dimensions + the *current* silver row per player
    (``is_current`` applied to the right side before the join)."""
    f = star["fact"]
    p = star["player"].select("player_key", "internal_player_id",
                              F.col("name").alias("player_name"),
                              F.col("sub_position").alias("position"),
                              F.col("current_market_value").alias("market_value"))
    pos = star["position"].select("position_key", F.col("name").alias("position_group"))
    t = star["team"].select("team_key", F.col("name").alias("team"))
    tour = star["tournament"].select("tournament_key", F.col("name").alias("league"))
    cur = silver.filter(F.col("is_current") == F.lit(True))
    s_cols = [column_or(cur, src, F.lit(None).cast("double")).alias(dst)
              for dst, src in DASHBOARD_SILVER.items() if dst not in ("team_cl", "valid_from")]
    s_cols += [column_or(cur, "team_cl_sfs", F.lit(None).cast("string")).alias("team_cl"),
               column_or(cur, "valid_from", F.lit(None).cast("date")).alias("valid_from")]
    s_cols += [F.coalesce(column_or(cur, src, F.lit(None).cast("double")), F.lit(0.0)).alias(dst)
               for dst, src in DASHBOARD_ZERO_DEFAULT.items()]
    s = cur.select(F.col("internal_player_id").alias("__sid"), *s_cols)
    out = f.join(shuffled(p), "player_key", "left")
    # a team or league may hold a third of the fact: small dimensions are broadcast after a size check
    for dim, key in ((t, "team_key"), (pos, "position_key"), (tour, "tournament_key")):
        out = bounded_broadcast_join(out, dim, key, "left", materialized=True)
    out = out.join(shuffled(s), F.col("internal_player_id") == F.col("__sid"), "left").drop("__sid")
    return out.withColumn("scout_score", round_half_up(F.col("final_scout_score"), 2)).drop(
        "player_key", "team_key", "position_key", "tournament_key", "season_key",
        "final_scout_score")


def league_standings(standings: DataFrame, league: str, aliases: Sequence[str] = ()) -> DataFrame:
    """One league's table (B8 name match), by position, display formats."""
    rows = standings.filter(name_matches("league_name", league, aliases))
    return rows.select(
        F.col("position").cast("bigint").alias("position"),
        url_from_id("team_id", *TEAM_LOGO).alias("logo"),
        "team_name", "matches", "wins", "draws", "losses",
        signed_number(F.coalesce(F.col("goal_diff"),
                                 F.col("goals_scored") - F.col("goals_conceded"))).alias("goal_diff"),
        "points").orderBy(F.col("position").asc_nulls_last())


def top_players(toplist: DataFrame, league: str, aliases: Sequence[str] = ()) -> DataFrame:
    """One league's top list by rating."""
    rows = toplist.filter(name_matches("league_name", league, aliases))
    return rows.select("player_name", "team_name", url_from_id("team_id", *TEAM_LOGO).alias("logo"),
                       F.col("rating").cast("double").alias("rating")) \
               .orderBy(F.col("rating").desc_nulls_last())


def kpis(df: DataFrame) -> DataFrame:
    """Rows, distinct teams, distinct leagues, mean score (0 when empty)."""
    return df.agg(F.count(F.lit(1)).alias("n_players"),
                  F.countDistinct("team").alias("n_teams"),
                  F.countDistinct("league").alias("n_leagues"),
                  F.coalesce(F.avg("scout_score"), F.lit(0.0)).alias("mean_score"))


def quadrants(df: DataFrame, value: str = "market_value", score: str = "scout_score",
              keep: Sequence[str] = ("player_name",)) -> DataFrame:
    """x = value in millions vs score; mean lines over rows with both;
    labels by side of each mean (>= mean counts as high)."""
    both = df.filter(F.col(value).isNotNull() & F.col(score).isNotNull()) \
             .withColumn("x", millions(value)).withColumn("y", F.col(score).cast("double"))
    x_mean = both.agg(F.avg("x")).scalar()
    y_mean = both.agg(F.avg("y")).scalar()
    hi_x, hi_y = F.col("x") >= x_mean, F.col("y") >= y_mean
    label = (F.when(~hi_x & hi_y, F.lit("Underrated")).when(hi_x & hi_y, F.lit("World Class"))
              .when(~hi_x & ~hi_y, F.lit("Rotation / Normal")).otherwise(F.lit("Overrated")))
    return both.select(*keep, "x", "y", x_mean.alias("x_mean"), y_mean.alias("y_mean"),
                       label.alias("quadrant"))


def quadrant_anchors(df: DataFrame, value: str = "market_value", score: str = "scout_score") -> DataFrame:
    """Where each quadrant's label goes, half way between the means and the extremes."""
    both = df.filter(F.col(value).isNotNull() & F.col(score).isNotNull()).select(
        millions(value).alias("x"), F.col(score).cast("double").alias("y"))
    one = axis_stats(both, "x", "y")
    left = F.col("x_min") + (F.col("x_mean") - F.col("x_min")) / 2
    right = F.col("x_mean") + (F.col("x_max") - F.col("x_mean")) / 2
    low = F.col("y_min") + (F.col("y_mean") - F.col("y_min")) / 2
    high = F.col("y_mean") + (F.col("y_max") - F.col("y_mean")) / 2
    rows = [F.struct(F.lit(name).alias("quadrant"), x.alias("x"), y.alias("y")) for name, x, y in (
        ("Underrated", left, high), ("World Class", right, high), ("Rotation / Normal", left, low), ("Overrated", right, low))]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def dashboard_rating(rating: DataFrame, dashboard: DataFrame) -> DataFrame:
    """The rating table with value, league and team from the player's
    first dashboard row; a rating that has a value keeps its own columns."""
    if "market_value" in rating.columns:
        return rating
    return attach_first(rating, dashboard, "internal_player_id", ["valid_from", "league", "team"], {
        "market_value": "market_value", "league": "dashboard_league", "team": "dashboard_team"})


def club_distribution(df: DataFrame, top: int | None = 10, team: str = "team") -> DataFrame:
    """Players per club, most first (name breaks ties), top ``n``."""
    vc = value_counts(df, team, "n_players")
    return vc if top is None else vc.limit(top)


def position_distribution(df: DataFrame, position: str = "position") -> DataFrame:
    """Players per position abbreviation."""
    return value_counts(df.withColumn("abbr", position_abbreviation(position)), "abbr", "n_players")


def market_value_history(dim_player: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Non-null values by player name and date, in millions."""
    return (dim_player.filter(F.col("current_market_value").isNotNull())
                      .select("name", "valid_from", *keep,
                              millions("current_market_value").alias("value_millions"))
                      .orderBy(F.col("valid_from").asc_nulls_last(), "name"))


def leaderboard(df: DataFrame, sort_by: str = "score", mode: str = "domestic",
                top: int | None = None) -> DataFrame:
    """Optional alternate-competition mode (B9 + B10), sort (F1), null goals
    -> 0, display rank 1..n (E7).  The player id is the final tiebreak."""
    rows = df
    if mode == "alt":
        rows = mode_switch(rows.filter(participation()), ALT_MODE)
    rows = rows.withColumns({"goals": F.coalesce(F.col("goals"), F.lit(0)).cast("bigint"),
                             "penalty_goals": F.coalesce(F.col("penalty_goals"), F.lit(0))
                             .cast("bigint")})
    order = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last()
             for c, d in SORTS[sort_by]] + [F.col("internal_player_id").asc()]
    if top is not None:
        rows = rows.orderBy(*order).limit(top)
    ranked = display_rank(rows, order, "rank")
    return ranked.select("rank", "internal_player_id", "player_name", "position", "team", "league",
                         "goals", "penalty_goals", "assists", "scout_score", "market_value")


def radar(rating: DataFrame, fdf: DataFrame, player: str, metrics: Sequence[str],
          name_col: str = "player_name") -> DataFrame:
    """One row per metric.  Score metrics come from the rating table
    (multiplier rescaled), others are value / max(max over the filtered set, 1)
    * 100; an unknown player gets zeros."""
    rating_metrics = {"scout_score": "final_scout_score", "base_score": "base_score",
                      "team_multiplier": "team_multiplier"}
    r = keep_first(rating.filter(F.col("name") == player), ["name"], ["internal_player_id"])
    p = keep_first(fdf.filter(F.col(name_col) == player), [name_col], ["internal_player_id"])
    plain = [m for m in metrics if m not in rating_metrics]
    # one pass over the filtered set: the player's value and the maximum of each metric
    p = p.select(*[F.col(m).cast("double").alias(f"own_{m}") for m in plain], F.lit(1).alias("found"))
    top = fdf.agg(*[F.greatest(F.coalesce(F.max(m).cast("double"), F.lit(1.0)), F.lit(1.0)).alias(f"max_{m}")
                    for m in plain], F.count(F.lit(1)).alias("rows"))
    scored = {}
    for m in metrics:
        if m in rating_metrics:
            v = F.col(rating_metrics[m]).cast("double")
            scored[f"score_{m}"] = radar_multiplier(v) if m == "team_multiplier" else v
    r = r.select(*[v.alias(c) for c, v in scored.items()], F.lit(1).alias("rated"))
    # one row on each side
    one = top.join(F.broadcast(p.agg(*[F.first(c).alias(c) for c in p.columns])), F.lit(True), "left").join(
        F.broadcast(r.agg(*[F.first(c).alias(c) for c in r.columns])), F.lit(True), "left")
    rows = [F.struct(F.lit(m).alias("metric"), F.when(F.col("found") == 1, F.coalesce(
        F.col(f"score_{m}") if m in rating_metrics else F.col(f"own_{m}") / F.col(f"max_{m}") * F.lit(100.0),
        F.lit(0.0))).otherwise(F.lit(0.0)).alias("value")) for m in metrics]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def compare_players(fdf: DataFrame, player_a: str, player_b: str, metrics: Sequence[str],
                    inverted: Sequence[str] = (), name_col: str = "player_name") -> DataFrame:
    """Unpivot both players' metrics, then A, B, A-B and the better side."""
    from pitchforge.operators.joins import compare_entities
    pair = fdf.filter(F.col(name_col).isin(player_a, player_b))
    pair = keep_first(pair, [name_col], ["internal_player_id"])
    long = pair.select(name_col, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [name_col], list(metrics), "metric", "value")
    return compare_entities(long, name_col, "metric", "value", player_a, player_b, inverted)


def auto_metrics(pairs: DataFrame, pos_a: str, pos_b: str) -> DataFrame:
    """When both positions fall in the same known group use that group's
    metric list, else the default list; one row per (pair, slot, metric)."""
    ga, gb = comparison_group(F.col(pos_a)), comparison_group(F.col(pos_b))
    group = F.when((ga == gb) & (ga != DEFAULT_COMPARISON_GROUP), ga)
    lists = F.create_map(*[x for g, ms in GROUP_METRICS.items()
                           for x in (F.lit(g), F.array(*[F.lit(m) for m in ms]))])
    chosen = F.coalesce(F.try_element_at(lists, group), F.array(*[F.lit(m) for m in DEFAULT_METRICS]))
    return pairs.select("*", group.alias("shared_group"),
                        F.posexplode(chosen).alias("slot", "metric"))


__all__ = ["dashboard_frame", "quadrant_anchors", "dashboard_rating", "league_standings", "top_players", "kpis", "quadrants",
           "club_distribution", "position_distribution", "market_value_history", "leaderboard",
           "radar", "compare_players", "auto_metrics"]

"""Per-position scoring (I8, I9) with the scoring matrix as configuration.

Plan: prepare defaults (pure column expressions) -> status -> per-90 ->
one ``groupBy(league)`` min/max aggregate over Active rows for every scaled
metric, joined back after a size check -> generated ``CASE group`` weighted
sums.  No Python runs on executors and no window is partitioned by league.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchforge.functions.positions import scoring_group
from pitchforge.functions.scalars import clip, per90, underdog_multiplier
from pitchforge.operators.columns import column_or, sample_status, with_default
from pitchforge.operators.dedupe import dense_key
from pitchforge.operators.joins import shuffled
from pitchforge.operators.scaling import scale_by_group
from pitchforge.session import cut_lineage

# ---------------------------------------------------------------------------
# Scoring matrix (group -> weights, penalties), config order.
POSITION_CONFIG: dict[str, dict[str, dict[str, float]]] = {
    "ST": {"weights": {"base_rating": 0.30, "goals_p90": 0.25, "xg_p90": 0.15,
                       "shots_on_target_p90": 0.10, "goal_conversion_pct": 0.10,
                       "big_chances_created_p90": 0.10},
           "penalties": {"possession_lost": 0.05, "big_chances_missed": 0.05}},
    "CF": {"weights": {"base_rating": 0.30, "goals_p90": 0.25, "xg_p90": 0.15,
                       "shots_on_target_p90": 0.10, "goal_conversion_pct": 0.10,
                       "big_chances_created_p90": 0.10},
           "penalties": {"possession_lost": 0.05, "big_chances_missed": 0.05}},
    "WING": {"weights": {"base_rating": 0.30, "successful_dribbles_p90": 0.20,
                         "assists_p90": 0.15, "xa_p90": 0.15, "goals_p90": 0.10,
                         "big_chances_created_p90": 0.10},
             "penalties": {"possession_lost": 0.05, "big_chances_missed": 0.05}},
    "AM": {"weights": {"base_rating": 0.30, "key_passes_p90": 0.20, "xa_p90": 0.15,
                       "assists_p90": 0.15, "big_chances_created_p90": 0.10,
                       "accurate_passes_pct": 0.10},
           "penalties": {"possession_lost": 0.05}},
    "CM": {"weights": {"base_rating": 0.30, "accurate_passes_pct": 0.20, "key_passes_p90": 0.15,
                       "xa_p90": 0.15, "assists_p90": 0.10, "big_chances_created_p90": 0.10},
           "penalties": {"possession_lost": 0.05}},
    "DM": {"weights": {"base_rating": 0.30, "tackles_p90": 0.20, "interceptions_p90": 0.15,
                       "ground_duels_won_pct": 0.15, "accurate_passes_pct": 0.10,
                       "xa_key_pass_p90": 0.10},
           "penalties": {"possession_lost": 0.05}},
    "CB": {"weights": {"base_rating": 0.30, "interceptions_p90": 0.20, "tackles_p90": 0.20,
                       "aerial_duels_won_pct": 0.15, "ground_duels_won_pct": 0.15},
           "penalties": {"errors_lead_goal_dribbled_past": 0.05}},
    "FB": {"weights": {"base_rating": 0.30, "tackles_p90": 0.20, "ground_duels_won_pct": 0.20,
                       "interceptions_p90": 0.15, "assists_xa_p90": 0.15},
           "penalties": {"possession_lost": 0.05}},
    "GK": {"weights": {"base_rating": 0.30, "saves_p90": 0.30, "clean_sheets_pct": 0.20,
                       "aerial_duels_won_pct": 0.20},
           "penalties": {}},
}

# Rating input name -> silver column.
SILVER_METRIC_MAP = {
    "goals": "goals_sfs", "assists": "assists_sfs", "xg": "xg_sfs", "xa": "xa_sfs",
    "shots_on_target": "shots_on_target_sfs", "goal_conversion_pct": "goal_conversion_pct_sfs",
    "big_chances_created": "big_chances_created_sfs", "possession_lost": "possession_lost_sfs",
    "big_chances_missed": "big_chances_missed_sfs",
    "successful_dribbles": "successful_dribbles_sfs", "key_passes": "key_passes_sfs",
    "accurate_passes_pct": "accurate_passes_pct_sfs", "tackles": "tackles_sfs",
    "interceptions": "interceptions_sfs", "clearances": "clearances_sfs",
    "ground_duels_won_pct": "ground_duels_won_pct_sfs",
    "aerial_duels_won_pct": "aerial_duels_won_pct_sfs", "saves": "saves_sfs",
}
DEFAULT_MINUTES = 1000
DEFAULT_LEAGUE = "Unknown"
DEFAULT_RANK = 10
FALLBACK_RATING_BASE = 6.5
FALLBACK_RATING_STEP = 0.15
GOLD_COLUMNS = ["internal_player_id", "name", "sub_position", "league", "team_name",
                "team_rank", "minutes_played", "base_score", "penalty", "team_multiplier",
                "final_scout_score", "status"]
# ---------------------------------------------------------------------------


def required_metrics(config: Mapping = POSITION_CONFIG) -> tuple[list[str], list[str]]:
    """(raw metrics needing a per-90 column, every metric that is scaled),
    in first-seen config order."""
    p90, scale = [], []
    for cfg in config.values():
        for m in list(cfg["weights"]) + list(cfg["penalties"]):
            if m.endswith("_p90") and m[:-4] not in p90:
                p90.append(m[:-4])
            if m not in scale:
                scale.append(m)
    return p90, scale


def prepare_rating_input(silver: DataFrame, order_key: str = "internal_player_id",
                         config: Mapping = POSITION_CONFIG) -> DataFrame:
    """Current rows, defaults, team ladder, metric mapping and composites."""
    df = silver
    if "is_current" in df.columns:
        df = df.filter(F.col("is_current") == F.lit(True))
    cols: dict[str, Column] = {
        "minutes_played": with_default(df, "minutes_played", DEFAULT_MINUTES, "minutes_played_sfs"),
        "league": with_default(df, "league", DEFAULT_LEAGUE, "league_sfs"),
        "team_rank": with_default(df, "team_rank", DEFAULT_RANK, "team_rank_sfs"),
    }
    if "name" not in df.columns and "name_sfs_raw" in df.columns:
        cols["name"] = F.col("name_sfs_raw")
    if "sub_position" not in df.columns and "sub_position_tm" in df.columns:
        cols["sub_position"] = F.col("sub_position_tm")
    if "team_name" not in df.columns:
        teams = [F.col(c) for c in ("team_sfs", "team_tm") if c in df.columns]
        if teams:
            cols["team_name"] = F.coalesce(*teams)
    for raw, src in SILVER_METRIC_MAP.items():
        if raw in df.columns:
            cols[raw] = F.coalesce(F.col(raw), column_or(df, src, 0.0))
        else:
            cols[raw] = column_or(df, src, 0.0)
    zero = F.lit(0.0)
    if "xa_key_pass" not in df.columns:
        cols["xa_key_pass"] = (F.coalesce(column_or(df, "xa_sfs", zero), zero) +
                               F.coalesce(column_or(df, "key_passes_sfs", zero), zero)) / F.lit(2.0)
    if "errors_lead_goal_dribbled_past" not in df.columns:
        cols["errors_lead_goal_dribbled_past"] = (
            F.coalesce(column_or(df, "error_lead_to_goal_sfs", zero), zero) +
            F.coalesce(column_or(df, "dribbled_past_sfs", zero), zero))
    if "assists_xa" not in df.columns:
        cols["assists_xa"] = (F.coalesce(column_or(df, "assists_sfs", zero), zero) +
                              F.coalesce(column_or(df, "xa_sfs", zero), zero))
    if "clean_sheets_pct" not in df.columns:
        if "clean_sheet_sfs" in df.columns:
            apps = F.coalesce(column_or(df, "appearances_sfs", 1.0).cast("double"), F.lit(1.0))
            apps = F.when(apps == 0, F.lit(1.0)).otherwise(apps)
            cols["clean_sheets_pct"] = F.coalesce(F.col("clean_sheet_sfs"), zero) / apps * F.lit(100.0)
        else:
            cols["clean_sheets_pct"] = zero
    df = df.withColumns(cols)
    # Fallback rating 6.5 + (i % 10) * 0.15, i = zero-based position by id.
    # The prepared rows are stored once: the league statistics and the scoring pass
    # read them again.  Ids are numbered only if a rating is missing, and alone.
    src = [c for c in ("base_rating", "base_rating_sfs") if c in df.columns]
    df = cut_lineage(df, "rating-input")
    known = F.coalesce(*[F.col(c) for c in src], F.lit(None).cast("double"))
    if df.filter(known.isNull()).isEmpty():
        df = df.withColumn("base_rating", known)
    else:
        df = df.withColumn("__rid", F.monotonically_increasing_id())
        numbered = dense_key(df.select(order_key, "__rid"), [F.col(order_key).asc_nulls_last(), "__rid"], "__row", start=0)
        missing = df.filter(known.isNull()).join(shuffled(numbered.select("__rid", "__row")), "__rid")
        fallback = F.lit(FALLBACK_RATING_BASE) + \
            F.pmod(F.col("__row"), F.lit(10)).cast("double") * F.lit(FALLBACK_RATING_STEP)
        df = df.filter(known.isNotNull()).withColumn("base_rating", known).unionByName(
            missing.withColumn("base_rating", fallback).drop("__row")).drop("__rid")
    p90, scale = required_metrics(config)
    missing = {c: F.lit(0.0) for c in dict.fromkeys(p90 + scale)
               if c not in df.columns and f"{c}_p90" not in df.columns}
    return df.withColumns(missing) if missing else df


def _weighted_sum(parts: list[tuple[str, float]], penalty: bool, present: set[str]) -> Column:
    expr: Column = F.lit(0.0)
    for metric, weight in parts:
        sc = f"{metric}_scaled"
        if sc not in present:
            continue
        if penalty:
            expr = expr + (F.col(sc) / F.lit(100.0)) * F.lit(weight * 100)
        else:
            expr = expr + F.col(sc) * F.lit(weight)
    return expr


def rate(df: DataFrame, config: Mapping = POSITION_CONFIG, min_minutes: float = 900.0,
         league_col: str = "league", position_col: str = "sub_position",
         rank_col: str = "team_rank", minutes_col: str = "minutes_played") -> DataFrame:
    """I8: status, per-90, league min-max over Active rows, weighted sums,
    penalty, underdog multiplier, clamp.  Small-sample rows keep null scores;
    a null team rank yields a null final score."""
    active = F.col("status") == "Active"
    df = df.withColumn("status", sample_status(minutes_col, min_minutes))
    p90, scale = required_metrics(config)
    df = df.withColumns({f"{m}_p90": per90(m, minutes_col) for m in p90 if m in df.columns})
    to_scale = [m for m in scale if m in df.columns]
    df = scale_by_group(df, league_col, to_scale, where=active, materialize=False)
    present = {f"{m}_scaled" for m in to_scale}
    group = scoring_group(F.col(position_col)) if position_col in df.columns else F.lit("CM")
    base_expr = penalty_expr = None
    for g, cfg in config.items():
        b = _weighted_sum(list(cfg["weights"].items()), False, present)
        p = _weighted_sum(list(cfg["penalties"].items()), True, present)
        base_expr = F.when(group == g, b) if base_expr is None else base_expr.when(group == g, b)
        penalty_expr = F.when(group == g, p) if penalty_expr is None else penalty_expr.when(group == g, p)
    fallback = config.get("CM", next(iter(config.values())))
    base_expr = base_expr.otherwise(_weighted_sum(list(fallback["weights"].items()), False, present))
    penalty_expr = penalty_expr.otherwise(
        _weighted_sum(list(fallback["penalties"].items()), True, present))
    mult = underdog_multiplier(F.col(rank_col)) if rank_col in df.columns else F.lit(1.0)
    df = df.withColumns({
        "base_score": F.when(active, base_expr),
        "penalty": F.when(active, penalty_expr),
        "team_multiplier": F.when(active, mult)})
    final = clip((F.col("base_score") - F.col("penalty")) * F.col("team_multiplier"), 0.0, 100.0)
    return df.withColumn("final_scout_score", F.when(active, final)).drop(
        *[f"{m}_scaled" for m in to_scale])


def gold_rating(silver: DataFrame, config: Mapping = POSITION_CONFIG,
                min_minutes: float = 900.0) -> DataFrame:
    """I9 -> I8 -> 12-column projection (columns that exist)."""
    rated = rate(prepare_rating_input(silver, config=config), config, min_minutes)
    return rated.select(*[c for c in GOLD_COLUMNS if c in rated.columns])


__all__ = ["POSITION_CONFIG", "required_metrics", "prepare_rating_input", "rate", "gold_rating",
           "GOLD_COLUMNS", "SILVER_METRIC_MAP"]

"""The contract of the merged player table (B19), checked before it enters the history."""

from __future__ import annotations

from pitchforge.operators.contract import Rule

# Texts that must be there, texts that may be null, and numbers
# (which may come as other numeric types), in the order of the table.
REQUIRED_TEXT = ("id_sfs", "name_sfs_raw", "name_sfs_norm", "updated_at_sfs")
TEXT = ("internal_player_id", "position_sfs", "id_tm", "dob_tm", "position_tm", "sub_position_tm", "league_sfs",
        "season_sfs", "updated_at_tm")
NUMBERS = (
    "goals_sfs", "assists_sfs", "minutes_played_sfs", "base_rating_sfs", "team_rank_sfs", "tackles_sfs",
    "interceptions_sfs", "clearances_sfs", "aerial_duels_won_pct_sfs", "ground_duels_won_pct_sfs",
    "accurate_passes_pct_sfs", "key_passes_sfs", "xg_sfs", "xa_sfs", "big_chances_created_sfs",
    "successful_dribbles_sfs", "possession_lost_sfs", "big_chances_missed_sfs", "error_lead_to_goal_sfs",
    "dribbled_past_sfs", "shots_on_target_sfs", "goal_conversion_pct_sfs", "saves_sfs", "clean_sheet_sfs",
    "penalties_taken_sfs", "penalty_goals_sfs", "penalty_won_sfs", "penalty_conceded_sfs", "yellow_cards_sfs",
    "red_cards_sfs", "direct_red_cards_sfs", "yellow_red_cards_sfs")
#: The value in euros has to be a double already.
EXACT_NUMBERS = ("market_value_tm",)

MERGED_CONTRACT = ([Rule(c, "string", nullable=False) for c in REQUIRED_TEXT] + [Rule(c, "string") for c in TEXT]
                   + [Rule(c, "double", coerce=True) for c in NUMBERS] + [Rule(c, "double") for c in EXACT_NUMBERS])

__all__ = ["MERGED_CONTRACT", "REQUIRED_TEXT", "TEXT", "NUMBERS", "EXACT_NUMBERS"]

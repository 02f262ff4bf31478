"""Raw zone -> normalised tables of the two sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchforge.functions.scalars import iso_date_string, lenient_date, season_label
from pitchforge.functions.text import normalize_text
from pitchforge.operators.columns import (drop_null_key, flatten, keep_existing, metric_rename_map,
                                          select_rename)
from pitchforge.operators.dedupe import keep_last
from pitchforge.operators.joins import latest_join, left_lookup
from pitchforge.sources.documents import explode_payload

# Item paths and metric names of the statistics source, and their columns.
STATS_COLUMNS = {
    "core_info_raw.id": "id_sfs",
    "core_info_raw.name": "name_sfs_raw",
    "core_info_raw.position": "position_sfs",
    "league_context": "league_sfs",
    "team_rank_context": "team_rank_sfs",
    "statistics_raw.domestic_league.team.name": "team_sfs",
    "statistics_raw.champions_league.team.name": "team_cl_sfs",
}
METRIC_NAMES = {
    "rating": "base_rating",
    "aerialDuelsWonPercentage": "aerial_duels_won_pct",
    "groundDuelsWonPercentage": "ground_duels_won_pct",
    "accuratePassesPercentage": "accurate_passes_pct",
    "goalConversionPercentage": "goal_conversion_pct",
    "expectedGoals": "xg",
    "expectedAssists": "xa",
    "id": "statistics_id",
}
#: Prefix of a competition's metrics -> suffix of their columns.
COMPETITIONS = {"statistics_raw.domestic_league.statistics.": "_sfs",
                "statistics_raw.champions_league.statistics.": "_cl_sfs"}
# Columns of the valuation source.
VALUATION_COLUMNS = {
    "player_id": "id_tm",
    "name": "name_tm_raw",
    "date_of_birth": "dob_tm",
    "position": "position_tm",
    "sub_position": "sub_position_tm",
    "club_name": "team_tm",
    "market_value_eur": "market_value_tm",
}


def normalize_stats(documents: DataFrame, run_date: Column, payload: str = "data", item_id: str = "core_info_raw.id",
                    columns: Mapping[str, str] = STATS_COLUMNS) -> DataFrame:
    """Documents (with ``__file``) -> one row per player, columns by rule.

    Items are flattened; of an id that comes several times the last one by
    (file, place) stays; metrics are renamed by rule, names normalised, the
    season taken from the day of extraction, rows without an id dropped.
    """
    items = explode_payload(documents, payload)
    flat = flatten(items.select("__file", "__idx", "item.*"))
    last = keep_last(flat.withColumn("__id", F.col(f"`{item_id}`")), ["__id"], ["__file", "__idx"])
    mapping = dict(columns)
    for prefix, suffix in COMPETITIONS.items():
        mapping.update(metric_rename_map(flat.columns, prefix, suffix, {k: v + suffix for k, v in METRIC_NAMES.items()}))
    day = run_date.cast("date")
    out = drop_null_key(select_rename(last, mapping), "id_sfs")
    return out.withColumns({"name_sfs_norm": normalize_text("name_sfs_raw"), "season_sfs": season_label(day),
                            "id_sfs": F.col("id_sfs").cast("string"), "updated_at_sfs": iso_date_string(day)})


def normalize_valuations(players: DataFrame, valuations: DataFrame, clubs: DataFrame, run_date: Column,
                         order: str | None = None) -> DataFrame:
    """Three all-string tables -> one row per player with the latest value and the club.

    Dates and numbers that can't be read are null, and a null date counts as
    latest; ``order`` (a column of ``valuations``) decides between equal dates.
    """
    valued = valuations.withColumns({"date": lenient_date("date"),
                                     "market_value_in_eur": F.col("market_value_in_eur").try_cast("double")})
    tie = [F.col(order).try_cast("bigint").desc_nulls_last()] if order else [F.col("market_value_in_eur").desc_nulls_last()]
    out = latest_join(players, valued, "player_id", "date", {"market_value_in_eur": "market_value_eur"}, tie)
    out = left_lookup(out, clubs, "current_club_id", "club_id", {"name": "club_name"})
    out = select_rename(keep_existing(out, list(VALUATION_COLUMNS)), VALUATION_COLUMNS)
    out = out.withColumns({"name_tm_norm": normalize_text("name_tm_raw"),
                           "updated_at_tm": iso_date_string(run_date.cast("date"))})
    return out.withColumn("dob_tm", iso_date_string(lenient_date("dob_tm"))) if "dob_tm" in out.columns else out


__all__ = ["normalize_stats", "normalize_valuations", "STATS_COLUMNS", "METRIC_NAMES", "COMPETITIONS",
           "VALUATION_COLUMNS"]

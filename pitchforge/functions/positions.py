"""Position, league and abbreviation lookups.

All lookups are Column expressions (``when`` chains / literal maps) so they stay
inside generated code; none needs a join or Python on executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).

# H7: sub-position -> scoring group, checked in this order; anything else -> CM.
SCORING_GROUPS = [
    ("ST", ["ST", "CF", "Centre-Forward"]),
    ("WING", ["RW", "LW", "RM", "LM", "Right Winger", "Left Winger", "Right Midfield",
              "Left Midfield"]),
    ("AM", ["AM", "Attacking Midfield"]),
    ("CM", ["CM", "Central Midfield"]),
    ("DM", ["DM", "Defensive Midfield"]),
    ("CB", ["CB", "Centre-Back"]),
    ("FB", ["RB", "LB", "Right-Back", "Left-Back"]),
    ("GK", ["GK", "Goalkeeper"]),
]
DEFAULT_SCORING_GROUP = "CM"

# H6: general position by ordered substring rules on the lower-cased name.
GENERAL_POSITION_RULES = [
    ("Attack", ["forward", "wing", "striker"]),
    ("Midfield", ["midfield"]),
    ("Defender", ["back", "defender"]),
    ("Goalkeeper", ["goalkeeper"]),
]
DEFAULT_GENERAL_POSITION = "Unknown"

# H8: comparison group after upper() + trim().
COMPARISON_GROUPS = [
    ("ATT", ["ST", "CF", "LW", "RW", "LF", "RF", "CENTRE-FORWARD", "LEFT WINGER",
             "RIGHT WINGER", "SECOND STRIKER"]),
    ("MID", ["CAM", "CM", "CDM", "LM", "RM", "ATTACKING MIDFIELD", "CENTRAL MIDFIELD",
             "DEFENSIVE MIDFIELD", "RIGHT MIDFIELD", "LEFT MIDFIELD"]),
    ("DEF", ["CB", "LB", "RB", "LWB", "RWB", "CENTRE-BACK", "LEFT-BACK", "RIGHT-BACK"]),
    ("GK", ["GK", "GOALKEEPER"]),
]
DEFAULT_COMPARISON_GROUP = "UNKNOWN"

# H9: abbreviation of a lower-cased position name (display markup dropped).
POSITION_ABBR = {
    "goalkeeper": "GK",
    "centre back": "CB",
    "centre-back": "CB",
    "right back": "RB",
    "right-back": "RB",
    "left back": "LB",
    "left-back": "LB",
    "defensive midfield": "CDM",
    "central midfield": "CM",
    "attacking midfield": "CAM",
    "right winger": "RW",
    "left winger": "LW",
    "right midfield": "RM",
    "left midfield": "LM",
    "second striker": "CF",
    "centre forward": "ST",
    "centre-forward": "ST",
}

# League -> country.
LEAGUE_COUNTRY = {
    "Premier League": "England",
    "La Liga": "Spain",
    "Serie A": "Italy",
    "Bundesliga": "Germany",
    "Ligue 1": "France",
    "Champions League": "Europe",
    "Europa League": "Europe",
}
FALLBACK_LEAGUES = ["Premier League", "La Liga", "Serie A", "Bundesliga", "Ligue 1"]

# Single-letter source position code -> name.
POSITION_CODE_NAMES = [("G", "Goalkeeper"), ("D", "Defender"), ("M", "Midfielder"),
                       ("F", "Forward")]

# Radar metrics per comparison group (metric column names).
GROUP_METRICS = {
    "ATT": ["goals", "assists", "xg", "key_passes", "successful_dribbles"],
    "MID": ["assists", "key_passes", "accurate_passes_pct", "interceptions",
            "successful_dribbles"],
    "DEF": ["tackles", "interceptions", "clearances", "aerial_duels_won_pct",
            "ground_duels_won_pct"],
    "GK": ["saves", "clean_sheets", "accurate_passes_pct", "aerial_duels_won_pct"],
}
DEFAULT_METRICS = ["scout_score", "goals", "assists", "key_passes", "successful_dribbles"]
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_match(pairs, test, default) -> Column:
    expr = None
    for label, cond in pairs:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def scoring_group(col) -> Column:
    """H7 (null and unknown -> CM)."""
    c = _col(col)
    return _first_match([(g, c.isin(names)) for g, names in SCORING_GROUPS], None,
                        DEFAULT_SCORING_GROUP)


def general_position(col) -> Column:
    """H6: first rule whose substring occurs in lower(name)."""
    low = F.lower(F.coalesce(_col(col).cast("string"), F.lit("none")))
    pairs = [(label, reduce(lambda a, b: a | b, [low.contains(s) for s in subs]))
             for label, subs in GENERAL_POSITION_RULES]
    return _first_match(pairs, None, DEFAULT_GENERAL_POSITION)


def comparison_group(col) -> Column:
    """H8 on upper(trim(position))."""
    up = F.upper(F.trim(F.coalesce(_col(col), F.lit(""))))
    return _first_match([(g, up.isin(names)) for g, names in COMPARISON_GROUPS], None,
                        DEFAULT_COMPARISON_GROUP)


def position_abbreviation(col) -> Column:
    """H9: map lower(trim(name)); unknown names map to themselves."""
    c = _col(col)
    mapping = F.create_map(*[F.lit(x) for kv in POSITION_ABBR.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, F.lower(F.trim(c))), c)


def league_country(col) -> Column:
    """H17 with default 'Unknown'."""
    mapping = F.create_map(*[F.lit(x) for kv in LEAGUE_COUNTRY.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, _col(col)), F.lit("Unknown"))


def position_category(sub_position, position, code) -> Column:
    """COALESCE(sub_position, position, CASE code ... ELSE 'Unknown')."""
    code_c = _col(code)
    by_code = _first_match([(name, code_c == letter) for letter, name in POSITION_CODE_NAMES],
                           None, "Unknown")
    return F.coalesce(_col(sub_position), _col(position), by_code)


__all__ = [n for n in dir() if n.isupper() or n in {
    "scoring_group", "general_position", "comparison_group", "position_abbreviation",
    "league_country", "position_category"}]

"""DuckDB SQL texts used as correctness oracles for ``__spark_entry__``.

Each string runs on the driver's pre-registered views (region nation customer
supplier part orders lineitem events documents embeddings pages benchmark
labels conversations).  Shared pieces are CTE builders so the analog tables
are defined once.  Numeric constants are written as DOUBLE so arithmetic
matches Spark's double arithmetic operation for operation.
"""

from __future__ import annotations

from pitchforge.functions.positions import SCORING_GROUPS
from pitchforge.plans.analogs import ALT_PRIORITY, POSITION_CODES, POSITION_GROUPS, POSITIONS
from pitchforge.plans.rating import POSITION_CONFIG, SILVER_METRIC_MAP, required_metrics


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def norm_sql(col: str) -> str:
    """H1 in DuckDB: accents stripped, lower, ß -> ss, whitespace trimmed."""
    inner = f"replace(strip_accents(lower({col})), 'ß', 'ss')"
    return (f"CASE WHEN {col} IS NULL THEN '' ELSE "
            f"regexp_replace({inner}, '^\\s+|\\s+$', '', 'g') END")


def season_sql(d: str) -> str:
    y = f"year({d})"
    start = f"(CASE WHEN month({d}) >= 8 THEN {y} ELSE {y} - 1 END)"
    return (f"CASE WHEN {d} IS NULL THEN NULL ELSE concat(CAST({start} AS VARCHAR), '-', "
            f"CAST({start} + 1 AS VARCHAR)) END")


def clip_sql(x: str, lo: float, hi: float) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest({dbl(lo)}, least({dbl(hi)}, {x})) END"


LINE_COUNTS = {
    "goals": "l_returnflag = 'R'",
    "assists": "l_returnflag = 'A'",
    "penalty_goals": "l_returnflag = 'R' AND l_linenumber = 1",
    "shots_on_target": "l_linestatus = 'F'",
    "possession_lost": "l_linestatus = 'O'",
    "big_chances_created": "l_linenumber = 2",
    "big_chances_missed": "l_linenumber = 3",
    "successful_dribbles": "l_linenumber = 4",
    "key_passes": "l_linenumber = 5",
    "tackles": "l_linenumber = 6",
    "interceptions": "l_linenumber = 7",
    "clearances": "l_linenumber = 1",
    "saves": "l_discount >= 0.05",
    "error_lead_to_goal": "l_returnflag = 'R' AND l_linestatus = 'O'",
    "dribbled_past": "l_returnflag = 'A' AND l_linestatus = 'O'",
    "low_discount": "l_discount < 0.05",
    "low_tax": "l_tax < 0.04",
    "returned_n": "l_returnflag = 'N'",
}
ALT_COUNTS = ["goals", "assists", "penalty_goals", "shots_on_target"]
SFS_COUNTS = ["goals", "assists", "penalty_goals", "shots_on_target", "possession_lost",
              "big_chances_created", "big_chances_missed", "successful_dribbles", "key_passes",
              "tackles", "interceptions", "clearances", "saves", "error_lead_to_goal",
              "dribbled_past"]


def orders_src(as_of: str | None) -> str:
    if as_of is None:
        return "orders"
    return f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{as_of} 00:00:00')"


def standings_ctes(sfx: str = "", as_of: str | None = None) -> str:
    return f"""
pn{sfx} AS (
  SELECT c_nationkey, COUNT(*) AS matches,
         COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS wins,
         COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS draws,
         COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS losses
  FROM {orders_src(as_of)} o JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
st0{sfx} AS (
  SELECT r_name AS league_name, CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name,
         coalesce(matches, 0) AS matches, coalesce(wins, 0) AS wins,
         coalesce(draws, 0) AS draws, coalesce(losses, 0) AS losses
  FROM nation JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN pn{sfx} pn ON n_nationkey = pn.c_nationkey),
st1{sfx} AS (
  SELECT *, wins * 2 + draws AS goals_scored, losses * 2 + draws AS goals_conceded,
         wins * 3 + draws AS points,
         (wins * 2 + draws) - (losses * 2 + draws) AS goal_diff FROM st0{sfx}),
standings{sfx} AS (
  SELECT league_name, team_id, team_name,
         CAST(row_number() OVER (PARTITION BY league_name ORDER BY points DESC, team_id ASC)
              AS BIGINT) AS position,
         matches, wins, draws, losses, goals_scored, goals_conceded, goal_diff, points
  FROM st1{sfx})"""


def silver_ctes(sfx: str = "", as_of: str | None = None) -> str:
    """CTEs ending in ``sp<sfx>``: the player snapshot analog (one row per
    customer) from orders before ``as_of``."""
    ol_counts = ",\n         ".join(
        f"COUNT(*) FILTER (WHERE {cond}) AS {name}" for name, cond in LINE_COUNTS.items())
    cm_sums = ",\n         ".join(f"CAST(SUM({n}) AS BIGINT) AS {n}" for n in LINE_COUNTS)
    alt = f"o_orderpriority = '{ALT_PRIORITY}'"
    cm_alt = ",\n         ".join(
        f"CAST(SUM(CASE WHEN {alt} THEN {n} ELSE 0 END) AS BIGINT) AS {n}_alt"
        for n in ALT_COUNTS)
    sfs = ",\n         ".join(f"CAST({n} AS DOUBLE) AS {n}_sfs" for n in SFS_COUNTS)

    def ratio(num):
        return f"{dbl(100.0)} * {num} / n_li"

    return f"""
ol{sfx} AS (
  SELECT l_orderkey, COUNT(*) AS n_li, SUM(l_quantity) AS qty,
         SUM(round(l_discount * 100)) AS disc_pts, SUM(round(l_tax * 100)) AS tax_pts,
         {ol_counts}
  FROM lineitem GROUP BY l_orderkey),
cm{sfx} AS (
  SELECT o_custkey AS custkey, CAST(SUM(n_li) AS BIGINT) AS n_li, SUM(qty) AS qty,
         SUM(disc_pts) AS disc_pts, SUM(tax_pts) AS tax_pts,
         COUNT(*) AS appearances,
         COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS clean_sheet,
         CAST(SUM(CASE WHEN {alt} THEN n_li ELSE 0 END) AS BIGINT) AS n_li_alt,
         {cm_sums},
         {cm_alt}
  FROM ol{sfx} JOIN {orders_src(as_of)} o ON l_orderkey = o_orderkey GROUP BY o_custkey),
lo{sfx} AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
           row_number() OVER (PARTITION BY o_custkey
                              ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
    FROM {orders_src(as_of)} o) WHERE rn = 1),
{standings_ctes(sfx, as_of)},
sp{sfx} AS (
  SELECT printf('PLR_%05d', c_custkey + 1) AS internal_player_id,
         CAST(c_custkey AS VARCHAR) AS id_sfs,
         c_name AS name_sfs_raw,
         {norm_sql('c_name')} AS name_sfs_norm,
         ({sql_list(POSITION_CODES)})[c_custkey % 9 + 1] AS position_sfs,
         c_mktsegment AS league_sfs,
         st.position AS team_rank_sfs,
         n_name AS team_sfs, n_name AS team_tm, r_name AS tournament,
         ({sql_list(POSITIONS)})[c_custkey % 9 + 1] AS sub_position_tm,
         ({sql_list(POSITION_GROUPS)})[c_custkey % 9 + 1] AS position_tm,
         lo.o_totalprice AS market_value_tm,
         {season_sql('CAST(lo.o_orderdate AS DATE)')} AS season_sfs,
         qty AS minutes_played_sfs,
         {sfs},
         disc_pts / {dbl(10.0)} AS xg_sfs,
         tax_pts / {dbl(10.0)} AS xa_sfs,
         (tax_pts - disc_pts) / {dbl(10.0)} AS goals_prevented_sfs,
         {ratio('low_discount')} AS accurate_passes_pct_sfs,
         {ratio('low_tax')} AS ground_duels_won_pct_sfs,
         {ratio('returned_n')} AS aerial_duels_won_pct_sfs,
         {ratio('goals')} AS goal_conversion_pct_sfs,
         {dbl(6.0)} + {dbl(2.0)} * shots_on_target / n_li AS base_rating_sfs,
         CAST(appearances AS DOUBLE) AS appearances_sfs,
         CAST(clean_sheet AS DOUBLE) AS clean_sheet_sfs,
         CAST(goals_alt AS DOUBLE) AS goals_cl_sfs,
         CAST(assists_alt AS DOUBLE) AS assists_cl_sfs,
         CAST(penalty_goals_alt AS DOUBLE) AS penalty_goals_cl_sfs,
         CASE WHEN n_li_alt > 0 THEN {dbl(6.0)} + {dbl(2.0)} * shots_on_target_alt / n_li_alt
         END AS base_rating_cl_sfs,
         CASE WHEN n_li_alt > 0 THEN r_name END AS team_cl_sfs
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN cm{sfx} cm ON c_custkey = cm.custkey
  LEFT JOIN lo{sfx} lo ON c_custkey = lo.o_custkey
  LEFT JOIN standings{sfx} st ON CAST(c_nationkey AS BIGINT) = st.team_id)"""


def group_sql(col: str) -> str:
    parts = " ".join(f"WHEN {col} IN {sql_in(names)} THEN '{g}'" for g, names in SCORING_GROUPS)
    return f"CASE {parts} ELSE 'CM' END"


def weighted_sql(items, penalty: bool) -> str:
    expr = dbl(0.0)
    for metric, w in items:
        if penalty:
            expr = f"({expr} + ({metric}_s / {dbl(100.0)}) * {dbl(w * 100)})"
        else:
            expr = f"({expr} + {metric}_s * {dbl(w)})"
    return expr


def rating_ctes(source: str = "sp", min_minutes: float = 900.0) -> str:
    """CTEs ending in ``gold``: I9 + I8 over ``source`` (12 gold columns)."""
    p90, scale = required_metrics()
    metric_cols = ",\n         ".join(f"{src} AS {raw}" for raw, src in SILVER_METRIC_MAP.items())
    p90_cols = ",\n         ".join(
        f"coalesce(CASE WHEN minutes_played > 0 THEN {m} / minutes_played * {dbl(90.0)} "
        f"ELSE {dbl(0.0)} END, {dbl(0.0)}) AS {m}_p90" for m in p90)
    stats = ",\n         ".join(f"min({m}) AS {m}_lo, max({m}) AS {m}_hi" for m in scale)
    scaled = ",\n         ".join(
        "coalesce(" + clip_sql(f"CASE WHEN {m}_hi = {m}_lo THEN {dbl(0.0)} ELSE "
                               f"({m} - {m}_lo) / ({m}_hi - {m}_lo) * {dbl(100.0)} END", 0, 100)
        + f", {dbl(0.0)}) AS {m}_s" for m in scale)
    grp = group_sql("sub_position")
    base_case = " ".join(f"WHEN grp = '{g}' THEN {weighted_sql(cfg['weights'].items(), False)}"
                         for g, cfg in POSITION_CONFIG.items())
    pen_case = " ".join(f"WHEN grp = '{g}' THEN {weighted_sql(cfg['penalties'].items(), True)}"
                        for g, cfg in POSITION_CONFIG.items())
    cm = POSITION_CONFIG["CM"]
    mult = (f"{dbl(1.0)} + {dbl(0.015)} * ("
            + clip_sql("CAST(team_rank AS DOUBLE)", 1, 20) + f" - {dbl(1.0)})")
    return f"""
ri0 AS (
  SELECT internal_player_id, name_sfs_raw AS name, sub_position_tm AS sub_position,
         coalesce(league_sfs, 'Unknown') AS league,
         coalesce(team_sfs, team_tm) AS team_name,
         coalesce(team_rank_sfs, 10) AS team_rank,
         coalesce(minutes_played_sfs, 1000) AS minutes_played,
         {metric_cols},
         (coalesce(xa_sfs, 0.0) + coalesce(key_passes_sfs, 0.0)) / {dbl(2.0)} AS xa_key_pass,
         coalesce(error_lead_to_goal_sfs, 0.0) + coalesce(dribbled_past_sfs, 0.0)
           AS errors_lead_goal_dribbled_past,
         coalesce(assists_sfs, 0.0) + coalesce(xa_sfs, 0.0) AS assists_xa,
         coalesce(clean_sheet_sfs, 0.0) / (CASE WHEN coalesce(appearances_sfs, 1.0) = 0
           THEN {dbl(1.0)} ELSE coalesce(appearances_sfs, 1.0) END) * {dbl(100.0)}
           AS clean_sheets_pct,
         coalesce(base_rating_sfs, {dbl(6.5)} + CAST((row_number() OVER
           (ORDER BY internal_player_id ASC NULLS LAST) - 1) % 10 AS DOUBLE) * {dbl(0.15)})
           AS base_rating
  FROM {source}),
ri AS (
  SELECT *, CASE WHEN minutes_played < {dbl(min_minutes)} THEN 'Small Sample'
                 ELSE 'Active' END AS status,
         {p90_cols}
  FROM ri0),
lg AS (
  SELECT league, {stats} FROM ri WHERE status = 'Active' GROUP BY league),
sc AS (
  SELECT ri.*, {grp} AS grp, {scaled}
  FROM ri LEFT JOIN lg USING (league)),
scored AS (
  SELECT *,
    CASE WHEN status = 'Active' THEN CASE {base_case}
         ELSE {weighted_sql(cm['weights'].items(), False)} END END AS base_score,
    CASE WHEN status = 'Active' THEN CASE {pen_case}
         ELSE {weighted_sql(cm['penalties'].items(), True)} END END AS penalty,
    CASE WHEN status = 'Active' THEN {mult} END AS team_multiplier
  FROM sc),
gold AS (
  SELECT internal_player_id, name, sub_position, league, team_name, team_rank, minutes_played,
         base_score, penalty, team_multiplier,
         CASE WHEN status = 'Active' THEN
           {clip_sql('(base_score - penalty) * team_multiplier', 0, 100)} END
           AS final_scout_score,
         status
  FROM scored)"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(p.strip("\n").rstrip(",") for p in parts) + "\n" + body


# ----------------------------------------------------------------- SCD2
TRACKED = ["goals_sfs", "assists_sfs", "market_value_tm", "team_sfs", "team_tm"]
NUMERIC_TRACKED = {"goals_sfs", "assists_sfs", "market_value_tm"}


def scd2_step_ctes(prev: str | None, snap: str, run_date: str, out: str,
                   key: str = "internal_player_id", tracked=TRACKED) -> str:
    """CTE ``out``: the history after loading snapshot ``snap`` on ``run_date``."""
    if prev is None:
        return f"""
{out} AS (
  SELECT *, TRUE AS is_current, DATE '{run_date}' AS valid_from, CAST(NULL AS DATE) AS valid_to
  FROM {snap} WHERE {key} IS NOT NULL)"""
    diffs = []
    for c in tracked:
        if c in NUMERIC_TRACKED:
            diffs.append(f"coalesce(CAST(s.{c} AS DOUBLE), -1.0) <> coalesce(CAST(c.{c} AS DOUBLE), -1.0)")
        else:
            diffs.append(f"coalesce(s.{c}, '') <> coalesce(c.{c}, '')")
    any_diff = " OR ".join(diffs)
    return f"""
{out}_tag AS (
  SELECT s.*, CASE WHEN k.{key} IS NULL THEN 'new'
                   WHEN c.{key} IS NOT NULL AND ({any_diff}) THEN 'changed'
                   ELSE 'unchanged' END AS __status
  FROM {snap} s
  LEFT JOIN (SELECT DISTINCT {key} FROM {prev}) k ON s.{key} = k.{key}
  LEFT JOIN (SELECT * FROM {prev} WHERE is_current) c ON s.{key} = c.{key}
  WHERE s.{key} IS NOT NULL),
{out}_cur AS (
  SELECT p.*, p.{key} IN (SELECT {key} FROM {out}_tag WHERE __status = 'changed') AS __chg
  FROM {prev} p WHERE is_current),
{out} AS (
  SELECT * FROM {prev} WHERE NOT is_current
  UNION ALL BY NAME
  SELECT * EXCLUDE (__chg) REPLACE (
           CASE WHEN __chg THEN DATE '{run_date}' ELSE valid_to END AS valid_to,
           CASE WHEN __chg THEN FALSE ELSE is_current END AS is_current)
  FROM {out}_cur WHERE NOT (__chg AND valid_from = DATE '{run_date}')
  UNION ALL BY NAME
  SELECT * EXCLUDE (__status), TRUE AS is_current, DATE '{run_date}' AS valid_from,
         CAST(NULL AS DATE) AS valid_to
  FROM {out}_tag WHERE __status IN ('new', 'changed'))"""


# ------------------------------------------------------------------ star
def ladder_sql(p: str = "") -> str:
    return (f"COALESCE({p}sub_position_tm, {p}position_tm, CASE {p}position_sfs "
            "WHEN 'G' THEN 'Goalkeeper' WHEN 'D' THEN 'Defender' WHEN 'M' THEN 'Midfielder' "
            "WHEN 'F' THEN 'Forward' ELSE 'Unknown' END)")


def general_position_sql(col: str) -> str:
    low = f"lower(coalesce({col}, 'none'))"
    return (f"CASE WHEN {low} LIKE '%forward%' OR {low} LIKE '%wing%' OR {low} LIKE '%striker%' "
            f"THEN 'Attack' WHEN {low} LIKE '%midfield%' THEN 'Midfield' "
            f"WHEN {low} LIKE '%back%' OR {low} LIKE '%defender%' THEN 'Defender' "
            f"WHEN {low} LIKE '%goalkeeper%' THEN 'Goalkeeper' ELSE 'Unknown' END")


def country_sql(col: str) -> str:
    from pitchforge.functions.positions import LEAGUE_COUNTRY
    parts = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in LEAGUE_COUNTRY.items())
    return f"CASE {parts} ELSE 'Unknown' END"


def star_ctes(h: str) -> str:
    """dims dp, dt, dpos, dtour, dseas and fact over history ``h``; needs ``gold``."""
    return f"""
dp AS (
  SELECT CAST(row_number() OVER (ORDER BY internal_player_id ASC NULLS LAST,
                                 valid_from ASC NULLS LAST) AS BIGINT) AS player_key,
         internal_player_id, name_sfs_raw AS name, CAST(NULL AS VARCHAR) AS dob,
         {ladder_sql()} AS sub_position, CAST(market_value_tm AS DOUBLE) AS current_market_value,
         is_current, valid_from, valid_to
  FROM {h}),
dt AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS team_key, name,
         upper(substr(name, 1, 3)) AS short_name, '#000000' AS primary_color,
         '#FFFFFF' AS secondary_color
  FROM (SELECT team_sfs AS name FROM {h} WHERE team_sfs IS NOT NULL
        UNION SELECT team_tm AS name FROM {h} WHERE team_tm IS NOT NULL)),
dpos AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS position_key, name,
         {general_position_sql('name')} AS general_position, '{{}}' AS role_weights
  FROM (SELECT DISTINCT {ladder_sql()} AS name FROM {h}
        WHERE sub_position_tm IS NOT NULL OR position_tm IS NOT NULL OR position_sfs IS NOT NULL)),
dtour AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS tournament_key, name,
         {country_sql('name')} AS country
  FROM (SELECT DISTINCT league_sfs AS name FROM {h} WHERE league_sfs IS NOT NULL AND is_current)),
dseas AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS season_key, name,
         make_date(CAST(split_part(name, '-', 1) AS INTEGER), 8, 1) AS start_date,
         make_date(CAST(split_part(name, '-', 2) AS INTEGER), 5, 31) AS end_date
  FROM (SELECT DISTINCT season_sfs AS name FROM {h} WHERE season_sfs IS NOT NULL AND is_current)),
fact AS (
  SELECT p.player_key, t.team_key, coalesce(tr.tournament_key, 1) AS tournament_key,
         coalesce(se.season_key, 1) AS season_key, pos.position_key,
         CAST(c.goals_sfs AS DOUBLE) AS goals, CAST(c.assists_sfs AS DOUBLE) AS assists,
         g.final_scout_score
  FROM (SELECT * FROM {h} WHERE is_current) c
  LEFT JOIN (SELECT internal_player_id, player_key FROM dp WHERE is_current) p
         ON c.internal_player_id = p.internal_player_id
  LEFT JOIN dt t ON coalesce(c.team_sfs, c.team_tm) = t.name
  LEFT JOIN dpos pos ON {ladder_sql('c.')} = pos.name
  LEFT JOIN dtour tr ON c.league_sfs = tr.name
  LEFT JOIN dseas se ON c.season_sfs = se.name
  LEFT JOIN gold g ON c.internal_player_id = g.internal_player_id
  WHERE p.player_key IS NOT NULL)"""


def star_history_sql(n_runs: int, runs) -> tuple[list[str], str]:
    ctes, prev = [], None
    for i, (run_date, as_of) in enumerate(runs[:n_runs]):
        ctes.append(silver_ctes(f"_{i}", as_of))
        ctes.append(scd2_step_ctes(prev, f"sp_{i}", run_date, f"h{i}"))
        prev = f"h{i}"
    ctes.append(f"cur AS (SELECT * FROM {prev} WHERE is_current)")
    ctes.append(rating_ctes("cur"))
    ctes.append(star_ctes(prev))
    return ctes, prev

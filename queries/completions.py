"""Loads of the whole star, quadrant anchors, distributions of every size, the
rating table of the dashboard, ordered outputs and helpers of the raw zone
(A12 A17 A18 B3 B4 D14 E8 F1 F3 F5 F6 H23 H39 I17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.functions import scalars as S
from pitchforge.operators.columns import drop_null_key, keep_existing
from pitchforge.operators.dedupe import best_per_key, dense_key, removed_duplicates
from pitchforge.plans import analytics
from pitchforge.session import scratch_path
from pitchforge.sources import files
from pitchforge.sources.tables import has_columns, resolve_source, table
from queries.dashboard import r6, r6_sql
from queries.silver import snapshot
from queries.star import _sql, dashboard, dashboard_sql, gold_table, star_inputs

# ------------------------------------------------------------------ A12
STAR_FILES = {"dim_player": "player", "dim_team": "team", "dim_position": "position", "dim_tournament": "tournament",
              "dim_season": "season", "fact_performance": "fact"}


def q_load_star(spark: SparkSession, d: str) -> DataFrame:
    """Replace-load of all star tables and the rating, then the row count of each."""
    _, gold, star = star_inputs(spark, d)
    base = scratch_path(spark, "warehouse-star")
    names = files.load_tables({**{t: star[n] for t, n in STAR_FILES.items()}, "gold_player_rating": gold, "absent": None}, base)
    loaded = None
    for name in names:
        one = spark.read.parquet(f"{base}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        loaded = one if loaded is None else loaded.unionByName(one)
    return loaded


SQL_LOAD_STAR = _sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {cte}" for t, cte in
    (("dim_player", "dp"), ("dim_team", "dt"), ("dim_position", "dpos"), ("dim_tournament", "dtour"), ("dim_season", "dseas"),
     ("fact_performance", "fact"), ("gold_player_rating", "gold"))))


# ------------------------------------------------------------------ H39
def q_quadrant_anchors(spark, d):
    found = analytics.quadrant_anchors(dashboard(spark, d))
    return found.select("quadrant", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"))


def anchors_sql() -> str:
    left, right = "min(x) + (avg(x) - min(x)) / 2.0::DOUBLE", "avg(x) + (max(x) - avg(x)) / 2.0::DOUBLE"
    low, high = "min(y) + (avg(y) - min(y)) / 2.0::DOUBLE", "avg(y) + (max(y) - avg(y)) / 2.0::DOUBLE"
    places = {"Underrated": (left, high), "World Class": (right, high), "Rotation / Normal": (left, low), "Overrated": (right, low)}
    return dashboard_sql(" UNION ALL ".join(
        f"SELECT '{q}' AS quadrant, {r6_sql(x)} AS x, {r6_sql(y)} AS y FROM b" for q, (x, y) in places.items()), """
b AS (SELECT market_value / 1000000.0::DOUBLE AS x, CAST(scout_score AS DOUBLE) AS y
      FROM dash WHERE market_value IS NOT NULL AND scout_score IS NOT NULL)""")


# ------------------------------------------------------------------ F3
def q_club_distribution(top: int | None):
    def run(spark, d):
        return analytics.club_distribution(dashboard(spark, d), top)
    run.__name__ = f"q_club_distribution_{top or 'all'}"
    return run


def club_sql(top: int | None) -> str:
    return dashboard_sql("SELECT team, COUNT(*) AS n_players FROM dash WHERE team IS NOT NULL GROUP BY team "
                         "ORDER BY n_players DESC, team ASC" + (f" LIMIT {top}" if top else ""))


# ------------------------------------------------------------------ I17
def q_dashboard_rating(spark, d):
    """The rating table with value, league and team of the player's first dashboard row."""
    return analytics.dashboard_rating(gold_table(spark, d), dashboard(spark, d))


SQL_DASHBOARD_RATING = dashboard_sql("""
SELECT gold.*, m.market_value, m.league AS dashboard_league, m.team AS dashboard_team
FROM gold LEFT JOIN (SELECT * FROM dash QUALIFY row_number() OVER (
    PARTITION BY internal_player_id ORDER BY valid_from, league, team) = 1) m USING (internal_player_id)""")


# --------------------------------------------------------- F1 / F5 / F6
def q_ordered_history(spark, d):
    """the value history with its place in the order."""
    from queries.star import star_table
    rows = analytics.market_value_history(star_table(spark, d, "player").withColumn("k", F.col("player_key")), keep=("k",))
    return dense_key(rows, [F.col("valid_from").asc_nulls_last(), "name", "k"], "place").drop("k")


SQL_ORDERED_HISTORY = dashboard_sql("""
SELECT name, valid_from, current_market_value / 1000000.0::DOUBLE AS value_millions,
       CAST(row_number() OVER (ORDER BY valid_from ASC NULLS LAST, name, player_key) AS BIGINT) AS place
FROM dp WHERE current_market_value IS NOT NULL""")


def q_ordered_top(spark, d):
    """one league's top list with its place by rating."""
    sp = snapshot(spark, d, None).where("league_sfs = 'BUILDING'")
    rows = sp.select("id_sfs", F.col("name_sfs_raw").alias("player_name"), F.col("base_rating_sfs").alias("rating"))
    return dense_key(rows, [F.col("rating").desc_nulls_last(), "id_sfs"], "place")


SQL_ORDERED_TOP = O.with_ctes(O.silver_ctes(), body="""
SELECT id_sfs, name_sfs_raw AS player_name, base_rating_sfs AS rating,
       CAST(row_number() OVER (ORDER BY base_rating_sfs DESC NULLS LAST, id_sfs) AS BIGINT) AS place
FROM sp WHERE league_sfs = 'BUILDING'""")


# ------------------------------------------------- A17 A18 B3 B4 D14 E8 H23
def q_source_probe(spark, d):
    """The first source that exists, and which of the wanted columns it has."""
    path = resolve_source(spark, [f"{d.rstrip('/')}/{n}.parquet" for n in ("customers_v2", "customer", "nation")])
    there = has_columns(spark.read.parquet(path), ["c_custkey", "c_name", "c_phone"])
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(ok).alias("present"), "n_rows") for c, ok in there.items()])).alias("r")).select("r.*")


SQL_SOURCE_PROBE = """
SELECT column_name, present, n_rows FROM (VALUES ('c_custkey', true), ('c_name', true), ('c_phone', false)) v(column_name, present),
     (SELECT COUNT(*) AS n_rows FROM customer)"""


def q_first_clean_part(spark, d):
    """Parts of a named size, the existing columns alone, the dearest of each brand and type."""
    p = table(spark, d, "part").withColumn("p_size", F.when(F.col("p_size") % 3 != 0, F.col("p_size")))
    rows = keep_existing(drop_null_key(p, "p_size"), ["p_partkey", "p_colour", "p_brand", "p_type", "p_size", "p_retailprice"])
    return best_per_key(rows, ["p_brand", "p_type"], "p_retailprice", ["p_partkey"])


SQL_FIRST_CLEAN_PART = """
SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_size % 3 <> 0
QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC NULLS LAST, p_partkey) = 1"""


def q_removed_duplicates(spark, d):
    """D14 and the run stamp of H23."""
    return removed_duplicates(table(spark, d, "events").select("user_id"), "user_id").select(
        "removed_duplicates", S.run_stamp("2026-05-04 09:07:33").alias("run_stamp"))


SQL_REMOVED = """
SELECT COUNT(*) - COUNT(DISTINCT user_id) AS removed_duplicates,
       strftime(TIMESTAMP '2026-05-04 09:07:33', '%Y%m%d_%H%M') AS run_stamp FROM events"""

QUERIES = {
    "load_star": (q_load_star, SQL_LOAD_STAR),
    "quadrant_anchors": (q_quadrant_anchors, anchors_sql()),
    "club_distribution_5": (q_club_distribution(5), club_sql(5)),
    "club_distribution_all": (q_club_distribution(None), club_sql(None)),
    "dashboard_rating": (q_dashboard_rating, SQL_DASHBOARD_RATING),
    "ordered_history": (q_ordered_history, SQL_ORDERED_HISTORY),
    "ordered_top": (q_ordered_top, SQL_ORDERED_TOP),
    "source_probe": (q_source_probe, SQL_SOURCE_PROBE),
    "first_clean_part": (q_first_clean_part, SQL_FIRST_CLEAN_PART),
    "removed_duplicates": (q_removed_duplicates, SQL_REMOVED),
}


# ---------------------------------------------- B12 C10 C11 H17: rare branches
def q_fact_defaults(spark, d):
    """A fact whose rows miss leagues, seasons and positions of the dimensions, without a rating."""
    from pitchforge.plans import star
    silver, _, dims = star_inputs(spark, d)
    k = F.col("id_sfs").cast("bigint")
    silver = silver.withColumns({
        "league_sfs": F.when(k % 7 != 0, F.col("league_sfs")).otherwise("Nowhere"),
        "season_sfs": F.when(k % 5 != 0, F.col("season_sfs")),
        "sub_position_tm": F.when(k % 3 != 0, F.col("sub_position_tm")),
        "position_tm": F.when(k % 3 != 0, F.col("position_tm"))})
    return star.build_fact(silver, dims, None)


SQL_FACT_DEFAULTS = _sql("""
SELECT p.player_key, t.team_key,
       CAST(coalesce(CASE WHEN k % 7 <> 0 THEN tr.tournament_key END, 1) AS BIGINT) AS tournament_key,
       CAST(coalesce(CASE WHEN k % 5 <> 0 THEN se.season_key END, 1) AS BIGINT) AS season_key,
       po.position_key, c.goals_sfs AS goals, c.assists_sfs AS assists, 0.0::DOUBLE AS final_scout_score
FROM (SELECT *, CAST(id_sfs AS BIGINT) AS k,
             CASE WHEN CAST(id_sfs AS BIGINT) % 3 <> 0 THEN sub_position_tm
                  ELSE CASE position_sfs WHEN 'G' THEN 'Goalkeeper' WHEN 'D' THEN 'Defender' WHEN 'M' THEN 'Midfielder'
                                         WHEN 'F' THEN 'Forward' END END AS pos FROM cur) c
JOIN dp p ON p.internal_player_id = c.internal_player_id AND p.is_current
LEFT JOIN dt t ON t.name = c.team_sfs LEFT JOIN dtour tr ON tr.name = c.league_sfs
LEFT JOIN dseas se ON se.name = c.season_sfs LEFT JOIN dpos po ON po.name = c.pos""")

# Market segments as leagues that have a country, and one that has none.
LEAGUES = {"AUTOMOBILE": "La Liga", "BUILDING": "Serie A", "FURNITURE": "Premier League", "HOUSEHOLD": "Champions League",
           "MACHINERY": "Somewhere"}


def q_league_countries(spark, d):
    """Tournaments with the countries of known leagues."""
    from pitchforge.plans import star
    from queries.star import silver_history
    names = F.create_map(*[F.lit(x) for kv in LEAGUES.items() for x in kv])
    silver = silver_history(spark, d)
    return star.dim_tournament(silver.withColumn("league_sfs", names[F.col("league_sfs")]))


SQL_LEAGUE_COUNTRIES = _sql(f"""
SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS tournament_key, name,
       CASE name WHEN 'La Liga' THEN 'Spain' WHEN 'Serie A' THEN 'Italy' WHEN 'Premier League' THEN 'England'
                 WHEN 'Champions League' THEN 'Europe' ELSE 'Unknown' END AS country
FROM (SELECT DISTINCT CASE league_sfs {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LEAGUES.items())} END AS name
      FROM cur WHERE league_sfs IN {O.sql_in(list(LEAGUES))})""")

QUERIES |= {
    "fact_defaults": (q_fact_defaults, SQL_FACT_DEFAULTS),
    "league_countries": (q_league_countries, SQL_LEAGUE_COUNTRIES),
}

"""Star schema: five dimensions with dense surrogate keys and one fact.

Keys are rebuilt per run in a documented total order (the reference leaves
team / position order undefined; we order by name).  Dimension joins into the
fact go through ``bounded_broadcast_join``: a dimension is broadcast only after
its row count is checked, so a team holding a third of all players never
concentrates in one shuffle partition; ``dim_player`` (one row per version)
is joined by a regular shuffle join on a unique key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchforge.functions.positions import (FALLBACK_LEAGUES, general_position, league_country,
                                            position_category)
from pitchforge.functions.scalars import round_half_up, season_bounds, short_name
from pitchforge.operators.columns import column_or
from pitchforge.operators.dedupe import dense_key, small_dense_key
from pitchforge.operators.joins import bounded_broadcast_join, shuffled
from pitchforge.operators.setops import union_domains

FALLBACK_SEASONS = ["2025-2026"]
PRIMARY_COLOR = "#000000"
SECONDARY_COLOR = "#FFFFFF"
EMPTY_ROLE_WEIGHTS = "{}"
DEFAULT_DIM_KEY = 1


def _ladder(silver: DataFrame) -> Column:
    return position_category(column_or(silver, "sub_position_tm", F.lit(None).cast("string")),
                             column_or(silver, "position_tm", F.lit(None).cast("string")),
                             column_or(silver, "position_sfs", F.lit(None).cast("string")))


def _current(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("is_current") == F.lit(True))


def dim_player(silver: DataFrame) -> DataFrame:
    """One row per version; key in (internal id, valid_from) order."""
    rows = silver.select(
        "internal_player_id", column_or(silver, "name_sfs_raw", None).cast("string").alias("name"),
        column_or(silver, "dob_tm", None).cast("string").alias("dob"),
        _ladder(silver).alias("sub_position"),
        column_or(silver, "market_value_tm", None).cast("double").alias("current_market_value"),
        "is_current", "valid_from", "valid_to")
    keyed = dense_key(rows, [F.col("internal_player_id").asc_nulls_last(),
                             F.col("valid_from").asc_nulls_last()], "player_key")
    return keyed.select("player_key", "internal_player_id", "name", "dob", "sub_position",
                        "current_market_value", "is_current", "valid_from", "valid_to")


def dim_team(silver: DataFrame) -> DataFrame:
    """UNION of both team columns' domains; key by name."""
    names = union_domains(silver, "team_sfs", silver, "team_tm", "name").filter(
        F.col("name").isNotNull())
    keyed = small_dense_key(names, [F.col("name").asc()], "team_key")
    return keyed.select("team_key", "name", short_name("name").alias("short_name"),
                        F.lit(PRIMARY_COLOR).alias("primary_color"),
                        F.lit(SECONDARY_COLOR).alias("secondary_color"))


def dim_position(silver: DataFrame) -> DataFrame:
    """Distinct position ladder over all versions with any source set."""
    any_src = F.lit(False)
    for c in ("sub_position_tm", "position_tm", "position_sfs"):
        if c in silver.columns:
            any_src = any_src | F.col(c).isNotNull()
    names = silver.filter(any_src).select(_ladder(silver).alias("name")).distinct()
    keyed = small_dense_key(names, [F.col("name").asc()], "position_key")
    return keyed.select("position_key", "name", general_position("name").alias("general_position"),
                        F.lit(EMPTY_ROLE_WEIGHTS).alias("role_weights"))


def _distinct_current(silver: DataFrame, col: str) -> DataFrame | None:
    if col not in silver.columns:
        return None
    names = _current(silver).select(F.col(col).alias("name")).filter(
        F.col("name").isNotNull()).distinct()
    return None if names.isEmpty() else names


def dim_tournament(silver: DataFrame) -> DataFrame:
    """Distinct current leagues (ordered); 5-row fallback when the column
    is missing or empty."""
    spark = silver.sparkSession
    names = _distinct_current(silver, "league_sfs")
    if names is None:
        # Fixed fallback list, keyed in list order.
        keyed = spark.createDataFrame([(i + 1, n) for i, n in enumerate(FALLBACK_LEAGUES)],
                                      "tournament_key bigint, name string")
    else:
        keyed = small_dense_key(names, [F.col("name").asc()], "tournament_key")
    return keyed.select("tournament_key", "name", league_country("name").alias("country"))


def dim_season(silver: DataFrame, run_year: int | None = None) -> DataFrame:
    """Distinct current seasons (ordered) with Aug 1 .. May 31 bounds."""
    spark = silver.sparkSession
    names = _distinct_current(silver, "season_sfs")
    if names is None:
        names = spark.createDataFrame([(n,) for n in FALLBACK_SEASONS], "name string")
    keyed = small_dense_key(names, [F.col("name").asc()], "season_key")
    start, end = season_bounds(F.col("name"), F.lit(run_year) if run_year else None)
    return keyed.select("season_key", "name", start.alias("start_date"), end.alias("end_date"))


def build_fact(silver: DataFrame, dims: dict[str, DataFrame],
               rating: DataFrame | None = None) -> DataFrame:
    """Current rows -> surrogate keys (tournament/season miss -> 1, team /
    position miss -> null, player miss -> row dropped) + goals, assists, score."""
    cur = _current(silver)
    base = cur.select(
        "internal_player_id",
        F.coalesce(column_or(cur, "team_sfs", F.lit(None).cast("string")),
                   column_or(cur, "team_tm", F.lit(None).cast("string"))).alias("__team"),
        _ladder(cur).alias("__pos"),
        column_or(cur, "league_sfs", F.lit(None).cast("string")).alias("__league"),
        column_or(cur, "season_sfs", F.lit(None).cast("string")).alias("__season"),
        column_or(cur, "goals_sfs", None).cast("double").alias("goals"),
        column_or(cur, "assists_sfs", None).cast("double").alias("assists"))
    players = _current(dims["player"]).select("internal_player_id", "player_key")
    fact = base.join(shuffled(players), "internal_player_id", "left")
    fact = bounded_broadcast_join(
        fact, dims["team"].select(F.col("name").alias("__team"), "team_key"), "__team", "left",
        name="dim-team", materialized=True)
    fact = bounded_broadcast_join(
        fact, dims["position"].select(F.col("name").alias("__pos"), "position_key"), "__pos",
        "left", name="dim-position", materialized=True)
    fact = bounded_broadcast_join(
        fact, dims["tournament"].select(F.col("name").alias("__league"), "tournament_key"),
        "__league", "left", name="dim-tournament", materialized=True)
    fact = bounded_broadcast_join(
        fact, dims["season"].select(F.col("name").alias("__season"), "season_key"),
        "__season", "left", name="dim-season", materialized=True)
    if rating is not None and "final_scout_score" in rating.columns:
        fact = fact.join(shuffled(rating.select("internal_player_id", "final_scout_score")),
                         "internal_player_id", "left")
    else:
        fact = fact.withColumn("final_scout_score", F.lit(0.0))
    return (fact.filter(F.col("player_key").isNotNull())
                .select("player_key", "team_key",
                        F.coalesce("tournament_key", F.lit(DEFAULT_DIM_KEY)).cast("bigint")
                        .alias("tournament_key"),
                        F.coalesce("season_key", F.lit(DEFAULT_DIM_KEY)).cast("bigint")
                        .alias("season_key"),
                        "position_key", "goals", "assists", "final_scout_score"))


def build_star(silver: DataFrame, rating: DataFrame | None = None,
               run_year: int | None = None) -> dict[str, DataFrame]:
    dims = {"player": dim_player(silver), "team": dim_team(silver),
            "position": dim_position(silver), "tournament": dim_tournament(silver),
            "season": dim_season(silver, run_year)}
    dims["fact"] = build_fact(silver, dims, rating)
    return dims


def star_top(star: dict[str, DataFrame], n: int = 15) -> DataFrame:
    """I16: fact with dimension names, best ``n`` by score (ties: player key)."""
    # keys are unique in their dimensions, so the best rows of the fact are known before any join
    order = [F.col("final_scout_score").desc_nulls_last(), F.col("player_key").asc()]
    f = star["fact"].orderBy(*order).limit(n)
    p = star["player"].select("player_key", F.col("name").alias("player_name"), "sub_position")
    t = star["team"].select("team_key", F.col("name").alias("team"))
    tour = star["tournament"].select("tournament_key", F.col("name").alias("league"))
    s = star["season"].select("season_key", F.col("name").alias("season"))
    out = (f.join(p, "player_key", "left").join(t, "team_key", "left")
            .join(tour, "tournament_key", "left").join(s, "season_key", "left"))
    return (out.select("player_key", "player_name", "sub_position", "team", "league", "season",
                       "goals", "assists",
                       round_half_up(F.col("final_scout_score"), 2).alias("scout_score"),
                       "final_scout_score")
               .orderBy(*order).drop("final_scout_score"))


def schema_report(tables: dict[str, DataFrame], with_stats: bool = True) -> DataFrame:
    """(table, column, type, role) with ``*_key`` tagged PK in ``dim_*``
    and FK in ``fact*`` tables; with ``with_stats`` each column also gets its
    row and non-null counts, one aggregate pass per table."""
    rows = []
    for tname, df in tables.items():
        for pos, fld in enumerate(df.schema.fields):
            role = ""
            if fld.name.endswith("_key"):
                if tname.startswith("dim_"):
                    role = "PK" if fld.name == f"{tname[4:]}_key" else "FK"
                elif tname.startswith("fact"):
                    role = "FK"
            rows.append((tname, pos, fld.name, fld.dataType.simpleString(), role))
    schema = T.StructType([T.StructField("table_name", T.StringType()),
                           T.StructField("ordinal", T.IntegerType()),
                           T.StructField("column_name", T.StringType()),
                           T.StructField("data_type", T.StringType()),
                           T.StructField("role", T.StringType())])
    spark: SparkSession = next(iter(tables.values())).sparkSession
    meta = spark.createDataFrame(rows, schema)
    if not with_stats:
        return meta
    stats = None
    for tname, df in tables.items():
        cols = df.columns
        wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                      *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
        pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', c{i}" for i, c in enumerate(cols))
        long = wide.selectExpr(f"'{tname}' AS table_name", "__rows AS n_rows",
                               f"stack({len(cols)}, {pairs}) AS (column_name, non_null)")
        stats = long if stats is None else stats.unionByName(long)
    return meta.join(stats, ["table_name", "column_name"], "left")


__all__ = ["dim_player", "dim_team", "dim_position", "dim_tournament", "dim_season",
           "build_fact", "build_star", "star_top", "schema_report"]

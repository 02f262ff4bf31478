"""Driver tables -> operator inputs.

Roles: player = ``customer`` (internal id ``PLR_%05d`` of ``c_custkey + 1``),
league = ``c_mktsegment``, team = ``nation``, tournament = ``region``,
valuation history = ``orders(o_custkey, o_orderdate, o_totalprice)``,
minutes = ``sum(l_quantity)``, metrics = counts of line items by flag /
line number, the alternate competition = orders of priority ``1-URGENT``.

Every metric is an integer count or a ratio of integer counts, so results
do not depend on summation order.

Plan: line items are dealt by order as narrow rows, aggregated there, joined to
orders on the order key, and aggregated per customer and period once for all
snapshots; a hot customer is combined on the map side and never lands whole in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchforge.functions.scalars import season_label, zero_padded_id
from pitchforge.functions.text import normalize_text
from pitchforge.operators.dedupe import latest_per_key
from pitchforge.operators.joins import bounded_broadcast_join, shuffled
from pitchforge.sources.tables import table

# The position list indexed by ``c_custkey % 9``.
POSITIONS = ["Centre-Forward", "Left Winger", "Attacking Midfield", "Central Midfield",
             "Defensive Midfield", "Centre-Back", "Right-Back", "Goalkeeper", "Second Striker"]
POSITION_GROUPS = ["Attack", "Attack", "Midfield", "Midfield", "Midfield", "Defender",
                   "Defender", "Goalkeeper", "Attack"]
POSITION_CODES = ["F", "F", "M", "M", "M", "D", "D", "G", "F"]
ALT_PRIORITY = "1-URGENT"

def _line_counts() -> dict[str, Column]:
    """Per-line indicator counts: name -> condition on lineitem columns."""
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return {
        "goals": rf == "R",
        "assists": rf == "A",
        "penalty_goals": (rf == "R") & (ln == 1),
        "shots_on_target": ls == "F",
        "possession_lost": ls == "O",
        "big_chances_created": ln == 2,
        "big_chances_missed": ln == 3,
        "successful_dribbles": ln == 4,
        "key_passes": ln == 5,
        "tackles": ln == 6,
        "interceptions": ln == 7,
        "clearances": ln == 1,
        "saves": F.col("l_discount") >= 0.05,
        "error_lead_to_goal": (rf == "R") & (ls == "O"),
        "dribbled_past": (rf == "A") & (ls == "O"),
        "low_discount": F.col("l_discount") < 0.05,
        "low_tax": F.col("l_tax") < 0.04,
        "returned_n": rf == "N",
    }


ALT_COUNTS = ["goals", "assists", "penalty_goals", "shots_on_target"]


def orders_as_of(spark: SparkSession, sf_dir: str, as_of: str | None = None) -> DataFrame:
    """Orders placed before ``as_of`` (a snapshot of the history); the date
    filter is pushed into the Parquet scan."""
    o = table(spark, sf_dir, "orders")
    return o if as_of is None else o.filter(F.col("o_orderdate") < F.to_timestamp(F.lit(as_of)))


#: Bits of discount points, tax points and quantity beside the conditions in one long.
WORD_BITS = {"disc": 12, "tax": 12, "qty": 20}


def _narrow_lines(li: DataFrame) -> DataFrame:
    """(l_orderkey, word, flags, disc, tax, qty): a line item as one long, or, where a number is not
    small and whole, with its conditions as bits and the numbers as they are."""
    conds = list(_line_counts().values())
    flags = F.lit(0)
    for i, cond in enumerate(conds):
        flags = flags + F.when(cond, F.lit(1 << i)).otherwise(F.lit(0))
    nums = {"disc": F.round(F.col("l_discount") * 100), "tax": F.round(F.col("l_tax") * 100), "qty": F.col("l_quantity").cast("double")}
    rows = li.filter(F.col("l_orderkey").isNotNull()).select("l_orderkey", flags.alias("flags"), *[c.alias(n) for n, c in nums.items()])
    word, at, fits = F.col("flags").cast("long"), len(conds), F.lit(True)
    for n, bits in WORD_BITS.items():
        c = F.col(n)
        fits = fits & F.coalesce((c >= 0) & (c < 2 ** bits) & (c == F.floor(c)), F.lit(False))
        word, at = word + F.shiftleft(c.cast("long"), at), at + bits
    rows = rows.withColumn("word", F.when(fits, word))
    return rows.select("l_orderkey", "word", *[F.when(F.col("word").isNull(), F.col(c)).alias(c) for c in ("flags", *nums)])


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the aggregate of its line items (lines without an order key left out).

    The lines of an order seldom lie together, so a map-side aggregate would hold
    and send nearly a wide row per line; narrow lines are dealt by order instead.
    """
    rows = _narrow_lines(table(spark, sf_dir, "lineitem")).repartition("l_orderkey")
    names, word = list(_line_counts()), F.col("word")
    cols, at = {"flags": F.coalesce(word.bitwiseAND(F.lit((1 << len(names)) - 1)), F.col("flags").cast("long"))}, len(names)
    for n, bits in WORD_BITS.items():
        part = F.shiftright(word, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("double")
        cols[n], at = F.when(word.isNotNull(), part).otherwise(F.col(n)), at + bits
    rows = rows.select("l_orderkey", *[c.alias(n) for n, c in cols.items()])
    aggs = [F.count(F.lit(1)).alias("n_li"), F.sum("qty").alias("qty"), F.sum("disc").alias("disc_pts"), F.sum("tax").alias("tax_pts")]
    aggs += [F.sum(F.shiftright("flags", i).bitwiseAND(F.lit(1))).alias(name) for i, name in enumerate(names)]
    return rows.groupBy("l_orderkey").agg(*aggs)


class Periods(NamedTuple):
    """The history cut at ascending dates: rows of period i lie before ``cutoffs[i]``, those of the last
    period at or after all of them (or have no date).  A snapshot as of a cutoff sums the periods up to its own."""

    cutoffs: Sequence[str]
    metrics: DataFrame
    latest: DataFrame

    def until(self, df: DataFrame, as_of: str | None) -> DataFrame:
        return df if as_of is None else df.filter(F.col("period") <= self.cutoffs.index(as_of))


def _with_period(orders: DataFrame, cutoffs: Sequence[str]) -> DataFrame:
    period = F.lit(len(cutoffs))
    for i in reversed(range(len(cutoffs))):
        period = F.when(F.col("o_orderdate") < F.to_timestamp(F.lit(cutoffs[i])), F.lit(i)).otherwise(period)
    return orders.withColumn("period", period)


STATUS_COUNTS = {"matches": None, "wins": "F", "draws": "O", "losses": "P"}


def period_metrics(spark: SparkSession, sf_dir: str, cutoffs: Sequence[str] = ()) -> DataFrame:
    """Raw counts per (custkey, period), including the alternate-competition subset: one pass over the
    line items for all snapshots.  ``appearances`` counts orders with lines, ``matches`` all orders."""
    per_order = order_lines(spark, sf_dir)
    orders = _with_period(table(spark, sf_dir, "orders"), cutoffs).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "period")
    j = orders.join(shuffled(per_order), orders.o_orderkey == per_order.l_orderkey, "left")
    alt = F.col("o_orderpriority") == ALT_PRIORITY
    has_lines = F.col("n_li").isNotNull()
    names = list(_line_counts())
    aggs = [F.sum("n_li").alias("n_li"), F.sum("qty").alias("qty"),
            F.sum("disc_pts").alias("disc_pts"), F.sum("tax_pts").alias("tax_pts"),
            F.count_if(has_lines).alias("appearances"),
            F.count_if(has_lines & (F.col("o_orderstatus") == "F")).alias("clean_sheet"),
            F.sum(F.when(alt, F.col("n_li")).otherwise(F.lit(0))).alias("n_li_alt")]
    aggs += [F.sum(n).alias(n) for n in names]
    aggs += [F.sum(F.when(alt, F.col(n)).otherwise(F.lit(0))).alias(f"{n}_alt")
             for n in ALT_COUNTS]
    aggs += [(F.count(F.lit(1)) if status is None else F.count_if(F.col("o_orderstatus") == status)).alias(n)
             for n, status in STATUS_COUNTS.items()]
    return j.groupBy(F.col("o_custkey").alias("custkey"), *(["period"] if cutoffs else [])).agg(*aggs)


def customer_metrics(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                     periods: Periods | None = None) -> DataFrame:
    """Per-customer raw counts of customers whose orders have lines.

    Several snapshots can share one materialised copy of the ``periods``."""
    if periods is None and as_of is None:
        return period_metrics(spark, sf_dir).filter("appearances > 0").drop(*STATUS_COUNTS)
    if periods is None:
        periods = Periods([as_of], period_metrics(spark, sf_dir, [as_of]), None)
    rows = periods.until(periods.metrics, as_of)
    cols = [c for c in rows.columns if c not in ("custkey", "period", *STATUS_COUNTS)]
    return rows.groupBy("custkey").agg(*[F.sum(c).alias(c) for c in cols]).filter("appearances > 0")


def period_latest(spark: SparkSession, sf_dir: str, cutoffs: Sequence[str]) -> DataFrame:
    """E1 within each period: its latest order per customer."""
    o = _with_period(table(spark, sf_dir, "orders"), cutoffs).filter(F.col("o_custkey").isNotNull())
    o = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "period")
    return latest_per_key(o, ["o_custkey", "period"], "o_orderdate", [F.col("o_orderkey").desc()])


def latest_orders(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                  periods: Periods | None = None) -> DataFrame:
    """E1 on the valuation history: latest order per customer (ties: higher key)."""
    o = orders_as_of(spark, sf_dir, as_of) if periods is None else periods.until(periods.latest, as_of)
    o = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return latest_per_key(o, ["o_custkey"], "o_orderdate", [F.col("o_orderkey").desc()])


def standings(spark: SparkSession, sf_dir: str, as_of: str | None = None,
              periods: Periods | None = None) -> DataFrame:
    """League tables: league = region, team = nation; W/D/L = order status F/O/P
    of the nation's customers; position by points then team id."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    if periods is None:
        orders = orders_as_of(spark, sf_dir, as_of)
        counts = orders.groupBy("o_custkey").agg(*[
            (F.count(F.lit(1)) if status is None else F.count_if(F.col("o_orderstatus") == status)).alias(n)
            for n, status in STATUS_COUNTS.items()])
    else:
        counts = periods.until(periods.metrics, as_of).withColumnRenamed("custkey", "o_custkey")
    per_nation = counts.select("o_custkey", *STATUS_COUNTS).join(shuffled(cust), F.col("o_custkey") == cust.c_custkey).groupBy(
        "c_nationkey").agg(*[F.sum(n).alias(n) for n in STATUS_COUNTS])
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    teams = (nation.join(region, nation.n_regionkey == region.r_regionkey)
                   .join(per_nation, nation.n_nationkey == per_nation.c_nationkey, "left")
                   .select(F.col("r_name").alias("league_name"),
                           F.col("n_nationkey").cast("bigint").alias("team_id"),
                           F.col("n_name").alias("team_name"),
                           F.coalesce("matches", F.lit(0)).alias("matches"),
                           F.coalesce("wins", F.lit(0)).alias("wins"),
                           F.coalesce("draws", F.lit(0)).alias("draws"),
                           F.coalesce("losses", F.lit(0)).alias("losses")))
    teams = teams.withColumns({
        "goals_scored": F.col("wins") * 2 + F.col("draws"),
        "goals_conceded": F.col("losses") * 2 + F.col("draws"),
        "points": F.col("wins") * 3 + F.col("draws")})
    teams = teams.withColumn("goal_diff", F.col("goals_scored") - F.col("goals_conceded"))
    # One row per team (aggregated first) before the window.
    w = Window.partitionBy("league_name").orderBy(F.col("points").desc(), F.col("team_id").asc())
    return teams.withColumn("position", F.row_number().over(w).cast("bigint")).select(
        "league_name", "team_id", "team_name", "position", "matches", "wins", "draws",
        "losses", "goals_scored", "goals_conceded", "goal_diff", "points")


def _ratio(num: str, den: str = "n_li") -> Column:
    return F.lit(100.0) * F.col(num) / F.col(den)


def silver_players(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                   periods: Periods | None = None) -> DataFrame:
    """Snapshot analog of the merged player table (suffix lineage kept), from
    orders placed before ``as_of`` (all orders when None)."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region")
    m = customer_metrics(spark, sf_dir, as_of, periods)
    latest = latest_orders(spark, sf_dir, as_of, periods)
    ranks = standings(spark, sf_dir, as_of, periods).select(F.col("team_id").alias("__tid"),
                                            F.col("position").alias("__rank"))
    idx = F.pmod(F.col("c_custkey"), F.lit(9)).cast("int")
    pos_arr = F.array(*[F.lit(p) for p in POSITIONS])
    grp_arr = F.array(*[F.lit(p) for p in POSITION_GROUPS])
    code_arr = F.array(*[F.lit(p) for p in POSITION_CODES])
    base = (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
                .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
                .join(shuffled(m), cust.c_custkey == m.custkey, "left")
                .join(shuffled(latest), cust.c_custkey == latest.o_custkey, "left")
                .withColumn("__tid", F.col("c_nationkey").cast("bigint")))
    # a team may hold a third of all players: its row is broadcast once its table is counted
    base = bounded_broadcast_join(base, ranks, "__tid", "left", name="team-ranks")
    has_alt = F.col("n_li_alt") > 0
    return base.select(
        zero_padded_id(F.col("c_custkey") + 1).alias("internal_player_id"),
        F.col("c_custkey").cast("string").alias("id_sfs"),
        F.col("c_name").alias("name_sfs_raw"),
        normalize_text("c_name").alias("name_sfs_norm"),
        F.get(code_arr, idx).alias("position_sfs"),
        F.col("c_mktsegment").alias("league_sfs"),
        F.col("__rank").alias("team_rank_sfs"),
        F.col("n_name").alias("team_sfs"),
        F.col("n_name").alias("team_tm"),
        F.col("r_name").alias("tournament"),
        F.get(pos_arr, idx).alias("sub_position_tm"),
        F.get(grp_arr, idx).alias("position_tm"),
        F.col("o_totalprice").alias("market_value_tm"),
        season_label(F.to_date("o_orderdate")).alias("season_sfs"),
        F.col("qty").alias("minutes_played_sfs"),
        *[F.col(n).cast("double").alias(f"{n}_sfs") for n in
          ["goals", "assists", "penalty_goals", "shots_on_target", "possession_lost",
           "big_chances_created", "big_chances_missed", "successful_dribbles", "key_passes",
           "tackles", "interceptions", "clearances", "saves", "error_lead_to_goal",
           "dribbled_past"]],
        (F.col("disc_pts") / F.lit(10.0)).alias("xg_sfs"),
        (F.col("tax_pts") / F.lit(10.0)).alias("xa_sfs"),
        ((F.col("tax_pts") - F.col("disc_pts")) / F.lit(10.0)).alias("goals_prevented_sfs"),
        _ratio("low_discount").alias("accurate_passes_pct_sfs"),
        _ratio("low_tax").alias("ground_duels_won_pct_sfs"),
        _ratio("returned_n").alias("aerial_duels_won_pct_sfs"),
        _ratio("goals").alias("goal_conversion_pct_sfs"),
        (F.lit(6.0) + F.lit(2.0) * F.col("shots_on_target") / F.col("n_li")).alias("base_rating_sfs"),
        F.col("appearances").cast("double").alias("appearances_sfs"),
        F.col("clean_sheet").cast("double").alias("clean_sheet_sfs"),
        F.col("goals_alt").cast("double").alias("goals_cl_sfs"),
        F.col("assists_alt").cast("double").alias("assists_cl_sfs"),
        F.col("penalty_goals_alt").cast("double").alias("penalty_goals_cl_sfs"),
        F.when(has_alt, F.lit(6.0) + F.lit(2.0) * F.col("shots_on_target_alt") /
               F.col("n_li_alt")).alias("base_rating_cl_sfs"),
        F.when(has_alt, F.col("r_name")).alias("team_cl_sfs"),
    )


__all__ = ["POSITIONS", "Periods", "orders_as_of", "order_lines", "period_metrics", "period_latest", "customer_metrics", "latest_orders", "standings",
           "silver_players"]

"""Normalised sources, contract gate and registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sql_oracles as O
from pitchforge.functions.scalars import run_date_col
from pitchforge.operators import contract
from pitchforge.operators.fuzzy_index import SegmentIndex
from pitchforge.operators.joins import shuffled
from pitchforge.operators.scd2 import scd2_load
from pitchforge.plans import normalize
from pitchforge.plans.resolve import load_registry, resolve_entities, save_registry
from pitchforge.plans.silver_contract import MERGED_CONTRACT
from pitchforge.session import scratch_path
from pitchforge.sources import documents, files, landing
from pitchforge.sources.tables import table
from queries import misc
from queries.silver import KEY, QUERIES as SILVER, RUNS, TRACKED, history_after, snapshot

RUN_DATE = "2026-05-04"

# ------------------------------------------------------------------ I1
_STATS = {"rating": "base_rating_sfs", "goals": "goals_sfs", "bigChancesCreated": "big_chances_created_sfs",
          "aerialDuelsWonPercentage": "aerial_duels_won_pct_sfs", "expectedGoals": "xg_sfs"}
_ALT = {"rating": "base_rating_cl_sfs", "goals": "goals_cl_sfs"}


def _fields(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _competition(names) -> T.StructType:
    return T.StructType([T.StructField("team", T.StructType([T.StructField("name", T.StringType())])),
                         T.StructField("statistics", _fields(names))])


ITEM = T.StructType([
    T.StructField("core_info_raw", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                                                 T.StructField("position", T.StringType())])),
    T.StructField("league_context", T.StringType()), T.StructField("team_rank_context", T.LongType()),
    T.StructField("statistics_raw", T.StructType([T.StructField("domestic_league", _competition(_STATS)),
                                                  T.StructField("champions_league", _competition(_ALT))]))])
DOCUMENT = T.StructType([T.StructField("data", T.ArrayType(ITEM))])


def _land_stats(spark: SparkSession, d: str) -> str:
    """Documents of up to 500 players; each holds an older copy of every player, and rows without an id."""
    root = scratch_path(spark, "stats")
    sp = snapshot(spark, d, None)

    def competition(team, names, scale):
        return F.struct(F.struct(F.col(team).alias("name")).alias("team"),
                        F.struct(*[(F.col(c) * scale).alias(n) for n, c in names.items()]).alias("statistics"))

    def item(player_id, scale):
        return F.struct(
            F.struct(player_id.alias("id"), F.col("name_sfs_raw").alias("name"), F.col("position_sfs").alias("position")).alias("core_info_raw"),
            F.col("league_sfs").alias("league_context"), F.col("team_rank_sfs").cast("bigint").alias("team_rank_context"),
            F.struct(competition("team_sfs", _STATS, scale).alias("domestic_league"),
                     competition("team_cl_sfs", _ALT, scale).alias("champions_league")).alias("statistics_raw"))

    key = F.col("id_sfs").cast("bigint")
    stale = sp.select(key.alias("k"), F.lit(0).alias("n"), item(key, 2.0).alias("item"))
    good = sp.select(key.alias("k"), F.lit(1).alias("n"), item(key, 1.0).alias("item"))
    no_id = sp.where(key % 10 == 0).select(key.alias("k"), F.lit(2).alias("n"), item(F.lit(None).cast("bigint"), 1.0).alias("item"))
    every = stale.unionByName(good).unionByName(no_id).withColumn("chunk", F.floor(F.col("k") / 500))
    data = F.transform(F.array_sort(F.collect_list(F.struct("n", "k", "item"))), lambda x: x["item"])
    docs = every.groupBy("chunk").agg(data.alias("data")).select("data")
    for day in ("2026-04-01", RUN_DATE):
        docs.withColumn("dt", F.lit(day)).write.mode("append").partitionBy("dt").json(f"{root}/source=stats")
    return root


def q_normalize_stats(spark, d):
    """I1 from the latest landed day."""
    root = _land_stats(spark, d)
    days = landing.partition_values(spark, f"{root}/source=stats")
    docs = documents.read_documents(spark, f"{root}/source=stats/dt={days[-1]}", DOCUMENT, multi_line=False)
    return normalize.normalize_stats(documents.good_documents(docs, whole_files=True), run_date_col(days[-1]))


SQL_NORMALIZE_STATS = O.with_ctes(O.silver_ctes(), body=f"""
SELECT id_sfs, name_sfs_raw, position_sfs, league_sfs, team_rank_sfs, team_sfs, team_cl_sfs,
       {', '.join(dict.fromkeys([*_STATS.values(), *_ALT.values()]))}, name_sfs_norm,
       '2025-2026' AS season_sfs, '{RUN_DATE}' AS updated_at_sfs
FROM sp""")


# ------------------------------------------------------------------ I2
def q_normalize_valuations(spark, d):
    """I2 from CSV files: customers as players, orders as valuations with some bad dates and values."""
    base = scratch_path(spark, "valuations")
    c = table(spark, d, "customer")
    files.write_csv(c.select(
        F.col("c_custkey").cast("string").alias("player_id"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, "May 4, 1998").when(F.col("c_custkey") % 3 == 1, "1999-12-31T00:00:00")
        .otherwise("unknown").alias("date_of_birth"),
        F.col("c_mktsegment").alias("position"), F.col("c_nationkey").cast("string").alias("current_club_id")), f"{base}/players")
    o = table(spark, d, "orders")
    files.write_csv(o.select(
        F.col("o_custkey").cast("string").alias("player_id"), F.col("o_orderkey").cast("string").alias("valuation_id"),
        F.when(F.col("o_orderkey") % 97 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("market_value_in_eur")),
        f"{base}/valuations")
    n = table(spark, d, "nation")
    files.write_csv(n.where("n_nationkey <> 3").select(F.col("n_nationkey").cast("string").alias("club_id"),
                                                       F.col("n_name").alias("name")), f"{base}/clubs")
    read = lambda t: files.read_csv_strings(spark, f"{base}/{t}", multi_line=False)
    return normalize.normalize_valuations(read("players"), read("valuations"), read("clubs"), run_date_col(RUN_DATE),
                                          order="valuation_id")


SQL_NORMALIZE_VALUATIONS = f"""
WITH v AS (SELECT o_custkey, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, o_orderkey,
                  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS eur FROM orders),
l AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC NULLS FIRST, o_orderkey DESC) = 1)
SELECT CAST(c_custkey AS VARCHAR) AS id_tm, c_name AS name_tm_raw,
       CASE c_custkey % 3 WHEN 0 THEN '1998-05-04' WHEN 1 THEN '1999-12-31' END AS dob_tm,
       c_mktsegment AS position_tm, n_name AS team_tm, eur AS market_value_tm,
       {O.norm_sql('c_name')} AS name_tm_norm, '{RUN_DATE}' AS updated_at_tm
FROM customer LEFT JOIN l ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey <> 3"""


# ------------------------------------------------------------ I7 / B19
def _merged(spark, d, as_of):
    """A snapshot with the columns of the contract that the analog lacks."""
    snap = snapshot(spark, d, as_of)
    lacking = {r.column: F.lit("2026-05-04" if not r.nullable else None).cast(r.dtype)
               for r in MERGED_CONTRACT if r.column not in snap.columns}
    return snap.withColumns(lacking)


def q_scd2_duplicate_snapshot(spark, d):
    """A snapshot with every third player twice; the last row counts, the contract is checked first."""
    snap = _merged(spark, d, RUNS[1][1]).withColumn("__n", F.lit(1))
    doubled = snap.unionByName(snap.where(F.col("id_sfs").cast("bigint") % 3 == 0).withColumns(
        {"__n": F.lit(0), "goals_sfs": F.lit(-5.0)}))
    before = history_after(spark, d, 1)
    result = scd2_load(doubled, before, KEY, TRACKED, run_date_col(RUNS[1][0]), order=["__n"],
                       validate=lambda df: contract.validate(df, MERGED_CONTRACT))
    return result.select(*before.columns)


def _faulty(spark: SparkSession, d: str) -> DataFrame:
    """A merged snapshot with a missing column, missing names and counts that are no numbers."""
    return _merged(spark, d, RUNS[0][1]).drop("yellow_cards_sfs").withColumns({
        "name_sfs_norm": F.when(F.col("id_sfs").cast("bigint") % 4 != 0, F.col("name_sfs_norm")),
        "goals_sfs": F.when(F.col("id_sfs").cast("bigint") % 5 == 0, F.lit("many")).otherwise(F.col("goals_sfs").cast("string"))})


def q_contract_failures(spark, d):
    """Each failing value of the faulty snapshot with its row's id."""
    return contract.failing_rows(_faulty(spark, d), MERGED_CONTRACT, "id_sfs")


SQL_CONTRACT_FAILURES = """
SELECT CAST(c_custkey AS VARCHAR) AS id_sfs, 'name_sfs_norm' AS "column", 'not_null' AS "check", CAST(NULL AS VARCHAR) AS value
FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'goals_sfs', 'coercible', 'many' FROM customer WHERE c_custkey % 5 = 0"""


def q_contract_gate(spark, d):
    """What the gate reports on a snapshot with faults, and whether the load stopped."""
    snap = _faulty(spark, d)
    try:
        scd2_load(snap, None, KEY, TRACKED, run_date_col(RUNS[0][0]), order=["id_sfs"],
                  validate=lambda df: contract.validate(df, MERGED_CONTRACT))
        faults = [("", "passed", 0)]
    except contract.ContractError as e:
        faults = e.report_rows
    return spark.createDataFrame(faults, "column string, check string, failures bigint")


SQL_CONTRACT_GATE = """
SELECT 'yellow_cards_sfs' AS "column", 'missing' AS "check", CAST(1 AS BIGINT) AS failures
UNION ALL SELECT 'name_sfs_norm', 'not_null', (SELECT COUNT(*) FROM customer WHERE c_custkey % 4 = 0)
UNION ALL SELECT 'goals_sfs', 'coercible', (SELECT COUNT(*) FROM customer WHERE c_custkey % 5 = 0)"""


# ----------------------------------------------------------- A16 / I3
_NAMES = dict(left_id="left_id", left_norm="name_norm", left_raw="name_raw", left_order="left_order",
              right_id="right_id", right_norm="right_norm", right_raw="right_raw", right_order="right_order")


def q_resolve_second_run(spark: SparkSession, d: str) -> DataFrame:
    """Half of the parts in a first run, all in a second over the saved
    registry and name index: known ids stay, a placeholder isn't tried again, new
    ids go on, and only names that are new on the right side are indexed."""
    base = scratch_path(spark, "registry")
    index = SegmentIndex(spark, scratch_path(spark, "names"))
    left, right = misc._perturbed_parts(spark, d), misc._part_names(spark, d)
    nothing = right.where("right_id % 2 = 0")  # the first run knows half of the right side
    _, first = resolve_entities(left.where("left_order % 2 = 0"), nothing, None, index=index, **_NAMES)
    save_registry(first, base)
    merged, second = resolve_entities(left, right, load_registry(spark, base), index=index, **_NAMES)
    save_registry(second, base)
    known = load_registry(spark, base)
    return merged.select("left_id", "internal_id", "bridge_id", "right_raw").join(
        known.select("left_id", F.col("display_name").alias("registered_as")), "left_id", "left")


SQL_SECOND_RUN = "WITH " + misc.fuzzy_ctes("_even", "p_partkey % 2 = 0", "p_partkey % 2 = 0") + ", " + misc.fuzzy_ctes("_odd", "p_partkey % 2 = 1") + """,
first AS (SELECT p_partkey, name_raw, best_even.right_id, best_even.right_raw,
                 row_number() OVER (ORDER BY p_partkey) AS n FROM l_even LEFT JOIN best_even USING (name_norm)),
second AS (SELECT p_partkey, name_raw, best_odd.right_id, best_odd.right_raw,
                  (SELECT COUNT(*) FROM first) + row_number() OVER (ORDER BY p_partkey) AS n
           FROM l_odd LEFT JOIN best_odd USING (name_norm))
SELECT CAST(p_partkey AS VARCHAR) AS left_id, printf('PLR_%05d', n) AS internal_id,
       coalesce(CAST(right_id AS VARCHAR), 'unknown') AS bridge_id, right_raw,
       coalesce(right_raw, name_raw) AS registered_as
FROM (SELECT * FROM first UNION ALL SELECT * FROM second)"""


def _with_second_key(df: DataFrame, spark: SparkSession, d: str, on: str, born: str, team: str) -> DataFrame:
    """Birth date (null for some) and team of each part."""
    p = table(spark, d, "part").select(F.col("p_partkey").cast(df.schema[on].dataType).alias(on), F.when(
        F.col("p_partkey") % 13 != 0, F.date_add(F.to_date(F.lit("1990-01-01")), F.pmod("p_partkey", F.lit(20)).cast("int"))).alias(born),
        F.col("p_size").alias(team))
    return df.join(shuffled(p), on)


def q_resolve_second_key(spark: SparkSession, d: str) -> DataFrame:
    """I3 with X10: names cut to two, three or all words; birth date and team as second key."""
    left, right = misc._perturbed_parts(spark, d), misc._part_names(spark, d)
    words = F.split("name_norm", " ")
    short = F.when(F.col("left_order") % 5 < 2, F.array_join(F.slice(words, 1, F.when(F.col("left_order") % 5 == 0, 2).otherwise(3)), " "))
    left = left.withColumn("name_norm", F.coalesce(short, F.col("name_norm")))
    merged, registry = resolve_entities(
        _with_second_key(left, spark, d, "left_id", "born", "team"), _with_second_key(right, spark, d, "right_id", "dob", "club"), None,
        second_key={"born": "dob", "team": "club"}, **_NAMES)
    return merged.select("left_id", "internal_id", "bridge_id", "right_raw", "evidence").join(
        shuffled(registry.select("left_id", F.col("display_name").alias("registered_as"))), "left_id", "left")


def _sql_second_key() -> str:
    sort = lambda x: f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"
    return "WITH " + misc.fuzzy_ctes("_0") + f""",
x AS (SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_partkey % 20 END AS born, p_size AS team FROM part),
l AS (SELECT p_partkey, name_raw, array_to_string(CASE p_partkey % 5 WHEN 0 THEN string_split(name_norm, ' ')[1:2]
        WHEN 1 THEN string_split(name_norm, ' ')[1:3] ELSE string_split(name_norm, ' ') END, ' ') AS name FROM l_0),
la AS (SELECT l.*, {sort('name')} AS a, born, team FROM l JOIN x USING (p_partkey) WHERE name <> ''),
rb AS (SELECT p_partkey AS right_id, p_name AS right_raw, {sort(O.norm_sql('p_name'))} AS b, born, team FROM part JOIN x USING (p_partkey)),
pair AS (SELECT DISTINCT a, b, length(a) AS n, length(b) AS m, la.born IS NOT DISTINCT FROM rb.born AND la.team = rb.team AND la.born IS NOT NULL AS keyed
         FROM la, rb WHERE (CASE WHEN la.born = rb.born AND la.team = rb.team THEN 70 ELSE 85 END) * (length(a) + length(b)) <= 200 * least(length(a), length(b))),
sim AS (SELECT a, b, max(200.0::DOUBLE * {misc.LCS} / (n + m)) AS s FROM pair GROUP BY ALL),
cand AS (
  SELECT la.p_partkey, s AS score, right_id, right_raw, 'name' AS evidence FROM la JOIN sim USING (a) JOIN rb USING (b) WHERE s >= 85
  UNION ALL
  SELECT la.p_partkey, s + 20, right_id, right_raw, 'key+name' FROM la JOIN sim USING (a) JOIN rb USING (b, born, team) WHERE s >= 70
  UNION ALL
  SELECT k.p_partkey, 80, right_id, right_raw, 'key' FROM la JOIN (SELECT min(p_partkey) AS p_partkey, born, team FROM l JOIN x USING (p_partkey) WHERE born IS NOT NULL
         GROUP BY born, team HAVING COUNT(*) = 1) k USING (p_partkey)
       JOIN (SELECT min(right_id) AS right_id, min(right_raw) AS right_raw, born, team FROM rb WHERE born IS NOT NULL
         GROUP BY born, team HAVING COUNT(*) = 1) r ON k.born = r.born AND k.team = r.team),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, right_id, evidence) = 1)
SELECT CAST(la.p_partkey AS VARCHAR) AS left_id, printf('PLR_%05d', row_number() OVER (ORDER BY la.p_partkey)) AS internal_id,
       coalesce(CAST(right_id AS VARCHAR), 'unknown') AS bridge_id, right_raw, evidence, coalesce(right_raw, name_raw) AS registered_as
FROM la LEFT JOIN best USING (p_partkey)"""


QUERIES = {
    "normalize_stats": (q_normalize_stats, SQL_NORMALIZE_STATS),
    "normalize_valuations": (q_normalize_valuations, SQL_NORMALIZE_VALUATIONS),
    "scd2_duplicate_snapshot": (q_scd2_duplicate_snapshot, SILVER["scd2_run2"][1]),
    "contract_gate": (q_contract_gate, SQL_CONTRACT_GATE),
    "contract_failures": (q_contract_failures, SQL_CONTRACT_FAILURES),
    "resolve_second_run": (q_resolve_second_run, SQL_SECOND_RUN),
    "resolve_second_key": (q_resolve_second_key, _sql_second_key()),
}

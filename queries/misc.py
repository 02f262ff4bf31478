"""Scalar functions, keys, set operations, lookups, contract, resolution,
profiles and schema report (B18 B19 C3-C5 C14-C18 E2 E5-E7 G1 G2 H1-H35 I3
I18 I19 I28-I30)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.functions import scalars as S
from pitchforge.functions.text import normalize_text
from pitchforge.operators import contract, joins
from pitchforge.operators.dedupe import dense_key, display_rank, keep_last, mint_ids
from pitchforge.operators.fuzzy import fuzzy_best_match
from pitchforge.operators.setops import concat_union, union_domains
from pitchforge.plans import analogs, analytics, rating
from pitchforge.plans.profiles import assemble_profiles, first_items
from pitchforge.plans.resolve import resolve_entities
from pitchforge.plans.star import schema_report
from pitchforge.sources.tables import DRIVER_TABLES, table
from queries.silver import snapshot


def r6(c):
    return F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


# ---------------------------------------------------------------- H1 / H5-H18
def q_text_norm(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", normalize_text("text").alias("text_norm"))


SQL_TEXT_NORM = f"SELECT doc_id, {O.norm_sql('text')} AS text_norm FROM documents"


def q_string_formats(spark, d):
    sp = snapshot(spark, d, None)
    return sp.select(
        "internal_player_id",
        S.short_name("team_sfs").alias("team_short"),
        S.goals_label("goals_sfs", "penalty_goals_sfs").alias("goals_label"),
        S.money_millions("market_value_tm").alias("value_label"),
        S.remove_spaces("league_sfs").alias("league_compact"),
        S.count_or_zero("goals_cl_sfs").alias("goals_cl"),
        S.id_to_string("id_sfs").alias("source_id"),
        S.url_from_id("team_rank_sfs", "https://img.example.org/team/", "/image").alias("logo"))


SQL_STRING_FORMATS = O.with_ctes(O.silver_ctes(), body="""
SELECT internal_player_id, upper(substr(team_sfs, 1, 3)) AS team_short,
       CASE WHEN CAST(coalesce(penalty_goals_sfs, 0) AS BIGINT) > 0
            THEN printf('%d (%d pen)', CAST(coalesce(goals_sfs, 0) AS BIGINT),
                        CAST(coalesce(penalty_goals_sfs, 0) AS BIGINT))
            ELSE CAST(CAST(coalesce(goals_sfs, 0) AS BIGINT) AS VARCHAR) END AS goals_label,
       CASE WHEN market_value_tm IS NULL THEN 'N/A'
            ELSE printf('%.1f', market_value_tm / 1000000.0) || 'M€' END AS value_label,
       replace(league_sfs, ' ', '') AS league_compact,
       CAST(coalesce(goals_cl_sfs, 0) AS BIGINT) AS goals_cl,
       CAST(CAST(id_sfs AS BIGINT) AS VARCHAR) AS source_id,
       CASE WHEN team_rank_sfs IS NOT NULL
            THEN 'https://img.example.org/team/' || CAST(team_rank_sfs AS VARCHAR) || '/image' END
         AS logo
FROM sp""")


def q_season_label(spark, d):
    o = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    return o.select("o_orderkey", day.alias("order_date"),
                    S.season_label(day).alias("season"),
                    S.iso_date_string(day).alias("order_date_iso"))


SQL_SEASON_LABEL = f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       {O.season_sql('CAST(o_orderdate AS DATE)')} AS season,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_date_iso FROM orders"""


def q_season_bounds(spark, d):
    o = table(spark, d, "orders")
    seasons = o.select(S.season_label(F.to_date("o_orderdate")).alias("season")).distinct()
    start, end = S.season_bounds(F.col("season"), F.lit(2026))
    return seasons.select("season", start.alias("start_date"), end.alias("end_date"))


SQL_SEASON_BOUNDS = f"""
SELECT season, make_date(CAST(split_part(season, '-', 1) AS INTEGER), 8, 1) AS start_date,
       make_date(CAST(split_part(season, '-', 2) AS INTEGER), 5, 31) AS end_date
FROM (SELECT DISTINCT {O.season_sql('CAST(o_orderdate AS DATE)')} AS season FROM orders)"""


def q_scoring_components(spark, d):
    """Per-90, composites, underdog multiplier and clamp on the
    prepared rating input."""
    prep = rating.prepare_rating_input(snapshot(spark, d, None))
    return prep.select(
        "internal_player_id",
        S.per90("goals", "minutes_played").alias("goals_p90"),
        "xa_key_pass", "errors_lead_goal_dribbled_past", "assists_xa", "clean_sheets_pct",
        S.underdog_multiplier("team_rank").alias("team_multiplier"),
        S.clip(F.col("goals") * F.lit(5.0), 0.0, 100.0).alias("goals_clamped"))


SQL_SCORING_COMPONENTS = O.with_ctes(O.silver_ctes(), O.rating_ctes(), body=f"""
SELECT internal_player_id, goals_p90, xa_key_pass, errors_lead_goal_dribbled_past, assists_xa,
       clean_sheets_pct,
       1.0 + 0.015 * ({O.clip_sql('CAST(team_rank AS DOUBLE)', 1, 20)} - 1.0) AS team_multiplier,
       {O.clip_sql('goals * 5.0', 0, 100)} AS goals_clamped
FROM ri""")


# ------------------------------------------------------------ E2 / E5-E7
def q_dedupe_keep_last(spark, d):
    ev = table(spark, d, "events")
    return keep_last(ev, ["user_id", "event_type"], ["ts", "event_id"])


SQL_DEDUPE = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                     ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def q_dense_key(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return dense_key(c, [F.col("c_mktsegment").asc(), F.col("c_name").asc()], "customer_key")


SQL_DENSE_KEY = """
SELECT c_custkey, c_name, c_mktsegment,
       CAST(row_number() OVER (ORDER BY c_mktsegment, c_name) AS BIGINT) AS customer_key
FROM customer"""


def q_minted_ids(spark, d):
    """Supplier ids continue after the largest customer-based id."""
    issued = table(spark, d, "customer").agg(F.max(F.col("c_custkey") + 1)).first()[0] or 0
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    return mint_ids(s, [F.col("s_suppkey").asc()], "internal_id", start_after=int(issued))


SQL_MINTED = """
SELECT s_suppkey, s_name,
       printf('PLR_%05d', (SELECT max(c_custkey + 1) FROM customer)
                          + row_number() OVER (ORDER BY s_suppkey)) AS internal_id
FROM supplier"""


def q_display_rank(spark, d):
    """E7 ranks all rows."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return display_rank(c, [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc()], "rank")


SQL_DISPLAY_RANK = """
SELECT c_custkey, c_name, c_acctbal,
       CAST(row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS BIGINT) AS rank
FROM customer"""


# ---------------------------------------------------------------- G1 / G2
def q_union_domains(spark, d):
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    return union_domains(c, "c_nationkey", s, "s_nationkey", "nationkey")


SQL_UNION_DOMAINS = "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier"


def q_concat_schema(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"),
                                           F.col("c_name").alias("name"), "c_mktsegment")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"),
                                           F.col("s_name").alias("name"), "s_acctbal")
    return concat_union(c, s)


SQL_CONCAT = """
SELECT c_custkey AS key, c_name AS name, c_mktsegment FROM customer
UNION ALL BY NAME SELECT s_suppkey AS key, s_name AS name, s_acctbal FROM supplier"""


# -------------------------------------------------------- B18 C14 C15 C16
def q_membership_flag(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    urgent = table(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return joins.membership_flag(c, urgent, "c_custkey", "o_custkey", "has_urgent")


SQL_MEMBERSHIP = """
SELECT c_custkey, c_name, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                                  AND o_orderpriority = '1-URGENT') AS has_urgent FROM customer"""


def q_keep_first_attach(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey",
                                         "o_orderpriority")
    return joins.attach_first(c, o, "c_custkey", ["o_orderkey"],
                              {"o_orderkey": "first_order", "o_orderpriority": "first_priority"})


SQL_KEEP_FIRST = """
SELECT c_custkey, c_name, o_orderkey AS first_order, o_orderpriority AS first_priority
FROM customer LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
     ORDER BY o_orderkey) rn FROM orders) WHERE rn = 1) ON o_custkey = c_custkey"""


def q_rank_default(spark, d):
    """Supplier nation -> table position in the standings analog, default 20.

    Suppliers with a negative balance belong to no known team."""
    team = F.col("s_nationkey").cast("bigint") + F.when(F.col("s_acctbal") < 0, 1000).otherwise(0)
    s = table(spark, d, "supplier").select("s_suppkey", team.alias("team_id"))
    st = analogs.standings(spark, d)
    return joins.rank_lookup(s, st, "team_id", "team_id", "position", "team_rank", 20)


SQL_RANK_DEFAULT = O.with_ctes(O.standings_ctes(), body="""
SELECT s_suppkey, s.team_id, coalesce(st.position, 20) AS team_rank
FROM (SELECT s_suppkey, CAST(s_nationkey AS BIGINT) + CASE WHEN s_acctbal < 0 THEN 1000 ELSE 0 END AS team_id
      FROM supplier) s LEFT JOIN standings st USING (team_id)""")


def _team_mapping(spark, d) -> DataFrame:
    """Mapping team name -> url from suppliers: the first supplier of each
    nation gives a url, nations of suppliers with negative balance map to ''."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    return j.groupBy(F.col("n_name").alias("team")).agg(
        F.min("s_suppkey").alias("ord"),
        F.when(F.min("s_acctbal") < 0, F.lit("")).otherwise(
            F.concat(F.lit("/team/"), F.min("s_suppkey").cast("string"))).alias("url"))


def q_work_list(spark, d):
    teams = table(spark, d, "nation").select(F.col("n_name").alias("team"))
    return joins.work_list(teams, _team_mapping(spark, d), "team", "url")


MAPPING_SQL = """
m AS (SELECT n_name AS team, min(s_suppkey) AS ord,
             CASE WHEN min(s_acctbal) < 0 THEN '' ELSE '/team/' || CAST(min(s_suppkey) AS VARCHAR) END AS url
      FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name)"""
SQL_WORK_LIST = O.with_ctes(MAPPING_SQL, body="""
SELECT n_name AS team FROM nation WHERE n_name NOT IN (SELECT team FROM m WHERE url <> '')""")


def q_mapping_upsert(spark, d):
    """Found urls for the work list upserted into the mapping."""
    mapping = _team_mapping(spark, d)
    todo = q_work_list(spark, d)
    found = todo.select("team", F.concat(F.lit("/search/"), F.col("team")).alias("url"),
                        F.lit(1_000_000).cast("bigint").alias("ord"))
    return joins.upsert_mapping(mapping, found, "team", "ord").select("team", "url")


SQL_MAPPING_UPSERT = O.with_ctes(MAPPING_SQL, body="""
SELECT team, url FROM m WHERE url <> ''
UNION ALL
SELECT n_name AS team, '/search/' || n_name AS url FROM nation
WHERE n_name NOT IN (SELECT team FROM m WHERE url <> '')""")


# ----------------------------------------------------------------- C3 / C5
def _registry(spark, d) -> DataFrame:
    """Registry analog: customer -> the first supplier of the same nation."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name")
    first = table(spark, d, "supplier").groupBy("s_nationkey").agg(
        F.min("s_suppkey").alias("s_suppkey"))
    return c.join(first, c.c_nationkey == first.s_nationkey, "left").select(
        S.zero_padded_id(F.col("c_custkey") + 1).alias("internal_id"),
        F.col("c_custkey").cast("string").alias("left_id"),
        F.col("s_suppkey").cast("string").alias("right_id"),
        F.col("c_name").alias("display_name"))


def q_registry_lookup(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string")
                                         .alias("cust_id"))
    reg = _registry(spark, d).withColumn("__ord", F.col("internal_id"))
    return joins.registry_lookup(o, reg, "cust_id", "left_id", "internal_id", "__ord")


REGISTRY_SQL = """
reg AS (SELECT printf('PLR_%05d', c_custkey + 1) AS internal_id, CAST(c_custkey AS VARCHAR) AS left_id,
               CAST(fs.s_suppkey AS VARCHAR) AS right_id, c_name AS display_name
        FROM customer LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier
                                 GROUP BY s_nationkey) fs ON c_nationkey = fs.s_nationkey)"""
SQL_REGISTRY_LOOKUP = O.with_ctes(REGISTRY_SQL, body="""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust_id, internal_id
FROM orders LEFT JOIN reg ON CAST(o_custkey AS VARCHAR) = reg.left_id""")


def q_bridge_join(spark, d):
    c = table(spark, d, "customer").select(
        S.zero_padded_id(F.col("c_custkey") + 1).alias("internal_id"), "c_name", "c_acctbal")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("right_id"),
                                           "s_name", F.col("s_acctbal").alias("c_acctbal"))
    return joins.bridge_join(c, _registry(spark, d), s, "internal_id", "right_id", "right_id")


SQL_BRIDGE = O.with_ctes(REGISTRY_SQL, body="""
SELECT c.internal_id, c.c_name, c.c_acctbal, reg.right_id, s.s_name
FROM (SELECT printf('PLR_%05d', c_custkey + 1) AS internal_id, c_name, c_acctbal FROM customer) c
LEFT JOIN reg ON c.internal_id = reg.internal_id
LEFT JOIN supplier s ON reg.right_id = CAST(s.s_suppkey AS VARCHAR)""")


# ------------------------------------------------------------------ B19
CONTRACT = [contract.Rule("c_custkey", "double", nullable=False, coerce=True),
            contract.Rule("c_name", "string", nullable=False),
            contract.Rule("c_acctbal", "double", coerce=True),
            contract.Rule("c_mktsegment", "string"),
            contract.Rule("c_phone", "string")]


def q_contract_report(spark, d):
    """B19 on customer with injected faults: names blanked to null where the
    balance is negative, balances as text with 'n/a' for zero-cent values."""
    c = table(spark, d, "customer")
    faulty = c.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name"),
        F.when(F.round(F.col("c_acctbal") * 100) % 100 == 0, F.lit("n/a"))
         .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.col("c_nationkey").alias("c_mktsegment"))
    return contract.contract_report(faulty, CONTRACT)


SQL_CONTRACT = """
SELECT 'c_custkey' AS "column", 'type' AS "check", CAST(0 AS BIGINT) AS failures
UNION ALL SELECT 'c_name', 'type', 0
UNION ALL SELECT 'c_acctbal', 'type', 0
UNION ALL SELECT 'c_mktsegment', 'type', 1
UNION ALL SELECT 'c_phone', 'missing', 1
UNION ALL SELECT 'c_custkey', 'not_null', (SELECT COUNT(*) FILTER (WHERE c_custkey IS NULL) FROM customer)
UNION ALL SELECT 'c_name', 'not_null', (SELECT COUNT(*) FILTER (WHERE NOT (c_acctbal >= 0) OR c_acctbal IS NULL OR c_name IS NULL) FROM customer)
UNION ALL SELECT 'c_acctbal', 'coercible', (SELECT COUNT(*) FILTER (WHERE round(c_acctbal * 100) % 100 = 0) FROM customer)"""


# --------------------------------------------------------- C4 / E8 / H4 / I3
def _perturbed_parts(spark, d) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_name")
    swapped = F.when(F.col("p_partkey") % 2 == 0,
                     F.array_join(F.reverse(F.split("p_name", " ")), " ")).otherwise(F.col("p_name"))
    typo = F.when(F.col("p_partkey") % 3 == 0, F.regexp_replace(swapped, "e", "a")).otherwise(swapped)
    return p.select(F.col("p_partkey").cast("string").alias("left_id"),
                    typo.alias("name_raw"), normalize_text(typo).alias("name_norm"),
                    F.col("p_partkey").alias("left_order"))


def _part_names(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("right_id"), F.col("p_name").alias("right_raw"),
                    normalize_text("p_name").alias("right_norm"),
                    F.col("p_partkey").alias("right_order"))


def q_fuzzy_match(spark, d):
    left = _perturbed_parts(spark, d)
    return fuzzy_best_match(left, "name_norm", _part_names(spark, d), "right_norm", "right_order",
                            ["right_id", "right_raw"], 85)


def q_resolve_entities(spark, d):
    merged, _ = resolve_entities(
        _perturbed_parts(spark, d), _part_names(spark, d), None,
        left_id="left_id", left_norm="name_norm", left_raw="name_raw", left_order="left_order",
        right_id="right_id", right_norm="right_norm", right_raw="right_raw",
        right_order="right_order")
    return merged.withColumns({c: F.col(c).cast("string") for c in ("left_order", "right_id", "right_order")})


# ------------------------------------------------------------ C18 / F4 / I29
def q_profiles(spark, d):
    """Per customer core fields, season stats, the last 10 orders and the team
    rank as one profile; suppliers' nations beyond 20 have no table position."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("team_id"))
    stats = analogs.customer_metrics(spark, d).select(
        F.col("custkey").alias("c_custkey"), F.struct("n_li", "qty", "goals", "assists").alias("s"))
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    recent = first_items(o, "c_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
                         ["o_orderkey", "o_totalprice"], 10, "m")
    ranks = analogs.standings(spark, d).filter("team_id <= 20").select("team_id", F.col("position").alias("team_rank"))
    prof = assemble_profiles(c, "c_custkey", ["c_custkey", "c_name"], {"season_stats": stats, "recent_matches": recent},
                             ranks, "team_id")
    p = F.col("profile")
    return prof.select(
        "c_custkey", p["core_info"]["c_name"].alias("name"), p["season_stats"]["n_li"].alias("n_li"),
        p["season_stats"]["qty"].alias("qty"), p["season_stats"]["goals"].alias("goals"),
        p["season_stats"]["assists"].alias("assists"), p["team_rank"].alias("team_rank"),
        F.array_join(F.transform(p["recent_matches"], lambda x: x["o_orderkey"].cast("string")), ",").alias("recent_orders"))


SQL_PROFILES = O.with_ctes(O.silver_ctes(), body="""
SELECT c_custkey, c_name AS name, n_li, qty, goals, assists,
       coalesce(CASE WHEN c_nationkey <= 20 THEN st.position END, 20) AS team_rank, r.recent_orders
FROM customer LEFT JOIN cm ON c_custkey = cm.custkey
LEFT JOIN standings st ON st.team_id = c_nationkey
LEFT JOIN (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY n) AS recent_orders
           FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
                 ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n <= 10 GROUP BY 1) r
  ON c_custkey = r.o_custkey""")


def q_schema_report(spark, d):
    """Schema of every driver table with the star-style role tag."""
    return schema_report({t: table(spark, d, t) for t in DRIVER_TABLES})


# Columns of the driver tables.
DRIVER_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def schema_sql() -> str:
    rows = [(t, i, *c.split(" ")) for t, cols in DRIVER_SCHEMA.items() for i, c in enumerate(cols.split(", "))]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, '{kind}' AS data_type, "
        f"'' AS role, COUNT(*) AS n_rows, COUNT({c}) AS non_null FROM {t}" for t, i, c, kind in rows)


# ------------------------------------------------------------- I18 / I19
def q_standings_view(spark, d):
    return analytics.league_standings(analogs.standings(spark, d), "EUROPE",
                                      aliases=["European League"])


SQL_STANDINGS_VIEW = O.with_ctes(O.standings_ctes(), body="""
SELECT position, CASE WHEN team_id IS NOT NULL THEN 'https://img.example.org/team/' ||
       CAST(team_id AS VARCHAR) || '/image' END AS logo, team_name, matches, wins, draws, losses,
       CASE WHEN goal_diff > 0 THEN '+' || CAST(goal_diff AS VARCHAR) ELSE CAST(goal_diff AS VARCHAR) END
         AS goal_diff, points
FROM standings WHERE league_name = 'EUROPE' OR replace(league_name, ' ', '') = 'EUROPE'
   OR league_name IN ('European League')""")


def q_top_view(spark, d):
    sp = snapshot(spark, d, None)
    top = sp.select(F.col("league_sfs").alias("league_name"),
                    F.col("name_sfs_raw").alias("player_name"),
                    F.col("team_sfs").alias("team_name"), F.col("team_rank_sfs").alias("team_id"),
                    F.col("base_rating_sfs").alias("rating"))
    return analytics.top_players(top, "AUTO MOBILE", aliases=["AUTOMOBILE"])


SQL_TOP_VIEW = O.with_ctes(O.silver_ctes(), body="""
SELECT name_sfs_raw AS player_name, team_sfs AS team_name,
       CASE WHEN team_rank_sfs IS NOT NULL THEN 'https://img.example.org/team/' ||
       CAST(team_rank_sfs AS VARCHAR) || '/image' END AS logo, base_rating_sfs AS rating
FROM sp WHERE league_sfs = 'AUTO MOBILE' OR replace(league_sfs, ' ', '') = 'AUTOMOBILE'
   OR league_sfs IN ('AUTOMOBILE')""")


# ------------------------------------------------- SQL of C4 / H4 / E8 / I3
#: Longest common subsequence of a and b (lengths n and m) by its table, row after row.
LCS = """list_reduce(
    list_prepend([0 FOR j IN range(m + 1)], [[ord(substr(a, i, 1))] FOR i IN range(1, n + 1)]),
    lambda prev, ch: list_reduce(list_prepend([0], [[j] FOR j IN range(1, m + 1)]),
      lambda row, j: list_append(row, CASE WHEN ord(substr(b, j[1], 1)) = ch[1] THEN prev[j[1]] + 1
                                           ELSE greatest(row[j[1]], prev[j[1] + 1]) END)))[m + 1]"""


def fuzzy_ctes(sfx: str = "", left: str = "TRUE", right: str = "TRUE") -> str:
    """CTEs l (left rows) and best (name -> best part): the longest common
    subsequence by its table, row after row, of every pair of distinct sorted names."""
    sort = lambda x: f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"
    return f"""
l0{sfx} AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0
            THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ') ELSE p_name END AS s FROM part WHERE {left}),
l1{sfx} AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN replace(s, 'e', 'a') ELSE s END AS name_raw FROM l0{sfx}),
l{sfx} AS (SELECT p_partkey, name_raw, {O.norm_sql('name_raw')} AS name_norm FROM l1{sfx}),
r{sfx} AS (SELECT p_partkey, p_name, {sort(O.norm_sql('p_name'))} AS b FROM part WHERE {right}
           QUALIFY row_number() OVER (PARTITION BY b ORDER BY p_partkey) = 1),
a{sfx} AS (SELECT DISTINCT {sort('name_norm')} AS a FROM l{sfx} WHERE name_norm <> ''),
pair{sfx} AS (SELECT a, b, p_partkey, p_name, length(a) AS n, length(b) AS m FROM a{sfx}, r{sfx}
              WHERE 85 * (length(a) + length(b)) <= 200 * least(length(a), length(b))),
lcs{sfx} AS (SELECT *, {LCS} AS lcs FROM pair{sfx}),
top{sfx} AS (SELECT a, 200.0::DOUBLE * lcs / (n + m) AS score, p_partkey AS right_id, p_name AS right_raw FROM lcs{sfx}
             WHERE 200 * lcs >= 85 * (n + m)
             QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, p_partkey) = 1),
best{sfx} AS (SELECT name_norm, score, right_id, right_raw FROM (SELECT DISTINCT name_norm FROM l{sfx}) x
              JOIN top{sfx} ON {sort('name_norm')} = a)"""


SQL_FUZZY = "WITH " + fuzzy_ctes() + " SELECT * FROM best"
SQL_RESOLVE = "WITH " + fuzzy_ctes() + f"""
SELECT CAST(l.p_partkey AS VARCHAR) AS left_id, l.name_raw, l.name_norm, l.p_partkey AS left_order,
       printf('PLR_%05d', row_number() OVER (ORDER BY l.p_partkey)) AS internal_id,
       coalesce(CAST(best.right_id AS VARCHAR), 'unknown') AS bridge_id,
       best.right_id, best.right_raw, {O.norm_sql('best.right_raw')} AS right_norm0, best.right_id AS right_order
FROM l LEFT JOIN best USING (name_norm)"""
SQL_RESOLVE = f"SELECT * EXCLUDE (right_norm0) REPLACE (CAST(left_order AS VARCHAR) AS left_order, CAST(right_id AS VARCHAR) AS right_id, CAST(right_order AS VARCHAR) AS right_order), CASE WHEN right_id IS NOT NULL THEN right_norm0 END AS right_norm FROM ({SQL_RESOLVE})"


QUERIES = {
    "text_norm": (q_text_norm, SQL_TEXT_NORM),
    "string_formats": (q_string_formats, SQL_STRING_FORMATS),
    "season_label": (q_season_label, SQL_SEASON_LABEL),
    "season_bounds": (q_season_bounds, SQL_SEASON_BOUNDS),
    "scoring_components": (q_scoring_components, SQL_SCORING_COMPONENTS),
    "dedupe_keep_last": (q_dedupe_keep_last, SQL_DEDUPE),
    "dense_key": (q_dense_key, SQL_DENSE_KEY),
    "minted_ids": (q_minted_ids, SQL_MINTED),
    "display_rank": (q_display_rank, SQL_DISPLAY_RANK),
    "union_domains": (q_union_domains, SQL_UNION_DOMAINS),
    "concat_schema": (q_concat_schema, SQL_CONCAT),
    "membership_flag": (q_membership_flag, SQL_MEMBERSHIP),
    "keep_first_attach": (q_keep_first_attach, SQL_KEEP_FIRST),
    "rank_default": (q_rank_default, SQL_RANK_DEFAULT),
    "work_list": (q_work_list, SQL_WORK_LIST),
    "mapping_upsert": (q_mapping_upsert, SQL_MAPPING_UPSERT),
    "registry_lookup": (q_registry_lookup, SQL_REGISTRY_LOOKUP),
    "bridge_join": (q_bridge_join, SQL_BRIDGE),
    "contract_report": (q_contract_report, SQL_CONTRACT),
    "fuzzy_match": (q_fuzzy_match, SQL_FUZZY),
    "resolve_entities": (q_resolve_entities, SQL_RESOLVE),
    "profiles": (q_profiles, SQL_PROFILES),
    "schema_report": (q_schema_report, schema_sql()),
    "standings_view": (q_standings_view, SQL_STANDINGS_VIEW),
    "top_view": (q_top_view, SQL_TOP_VIEW),
}

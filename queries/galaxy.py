"""Match-grain and time-series analytics over orders as matches."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.functions.positions import scoring_group
from pitchforge.plans import galaxy
from pitchforge.plans.rating import POSITION_CONFIG
from pitchforge.sources.tables import table
from queries.dashboard import r6, r6_sql
from queries.silver import snapshot


def _orders(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderdate",
                                            "o_totalprice", "o_orderstatus")


ORDER = ["o_orderdate", "o_orderkey"]


def q_dim_date(spark, d):
    o = _orders(spark, d).agg(F.min("day"), F.max("day")).first()
    return galaxy.dim_date(spark, F.lit(o[0]), F.lit(o[1]))


SQL_DIM_DATE = """
SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_key, CAST(x AS DATE) AS full_date, CAST(day(x) AS INTEGER) AS day,
       CAST(month(x) AS INTEGER) AS month, CAST(quarter(x) AS INTEGER) AS quarter, CAST(year(x) AS INTEGER) AS year,
       CAST(isodow(x) AS INTEGER) AS day_of_week, isodow(x) > 5 AS is_weekend
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS x FROM orders)"""


def q_match_fact(spark, d):
    """Every match of each player, numbered from the latest on."""
    chunks = galaxy.match_chunks(_orders(spark, d), "o_custkey", [F.col(c).desc() for c in ORDER], ["o_orderkey", "o_totalprice"], "matches")
    return galaxy.match_fact(chunks, "o_custkey", F.col("matches"), F.col("chunk") * galaxy.CHUNK_MATCHES)


SQL_MATCH_FACT = """
SELECT o_custkey, row_number() OVER w AS match_no, o_orderkey, o_totalprice FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)"""


def q_value_delta(spark, d):
    out = galaxy.value_history(_orders(spark, d), "o_custkey", ORDER, "o_totalprice")
    return out.select("o_custkey", "o_orderkey", "o_totalprice", r6(F.col("delta_from_previous")).alias("delta"))


SQL_VALUE_DELTA = f"""
SELECT o_custkey, o_orderkey, o_totalprice, {r6_sql('o_totalprice - lag(o_totalprice) OVER w')} AS delta
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""


def q_last_five(spark, d):
    cents = _orders(spark, d).withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    out = galaxy.last_n(cents, "o_custkey", ORDER, "cents", 5)
    return out.select("o_custkey", "o_orderkey", "mean_5", F.size("last_5").alias("n"),
                      F.element_at("last_5", 1).alias("oldest"))


SQL_LAST_FIVE = """
SELECT o_custkey, o_orderkey, CAST(sum(cents) OVER w AS DOUBLE) / COUNT(*) OVER w AS mean_5, CAST(COUNT(*) OVER w AS INTEGER) AS n,
       first_value(cents) OVER w AS oldest
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""


def q_year_over_year(spark, d):
    monthly = table(spark, d, "orders").groupBy("o_orderpriority", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    out = galaxy.year_over_year(monthly, "o_orderpriority", "month", "n_orders")
    return out.withColumns({c: F.col(c).cast("double") for c in ("year_before", "change")})


SQL_YEAR_OVER_YEAR = """
WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders FROM orders GROUP BY ALL)
SELECT a.o_orderpriority, a.month, a.n_orders, CAST(b.n_orders AS DOUBLE) AS year_before, CAST(a.n_orders - b.n_orders AS DOUBLE) AS change
FROM m a LEFT JOIN m b ON a.o_orderpriority = b.o_orderpriority AND a.month = CAST(b.month + INTERVAL 12 MONTH AS DATE)"""


def q_consistency(spark, d):
    o = _orders(spark, d)
    streak = galaxy.longest_streak(o, "o_custkey", ORDER, F.col("o_orderstatus") == "F")
    score = galaxy.consistency(o, "o_custkey", "o_totalprice").withColumn("consistency", F.round("consistency", 4))
    return score.join(streak, "o_custkey")


SQL_CONSISTENCY = """
WITH i AS (SELECT o_custkey, o_orderstatus, sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) OVER (
               PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS island FROM orders),
s AS (SELECT o_custkey, max(n) AS longest_streak FROM (SELECT o_custkey, island, COUNT(*) FILTER (o_orderstatus = 'F') AS n
      FROM i GROUP BY ALL) GROUP BY 1)
SELECT o_custkey, COUNT(o_totalprice) AS n, CASE WHEN COUNT(o_totalprice) > 1 THEN
       round(greatest(0.0::DOUBLE, 100.0::DOUBLE - 100.0::DOUBLE * stddev_pop(o_totalprice) / avg(o_totalprice)), 4) END AS consistency,
       any_value(longest_streak) AS longest_streak
FROM orders JOIN s USING (o_custkey) GROUP BY o_custkey"""


def q_percentile(spark, d):
    sp = snapshot(spark, d, None).select("internal_player_id", "position_tm", "goals_sfs")
    return galaxy.percentile_score(sp, "position_tm", "goals_sfs").withColumn("percentile", r6(F.col("percentile")))


SQL_PERCENTILE = O.with_ctes(O.silver_ctes(), body=f"""
SELECT internal_player_id, position_tm, goals_sfs, CASE WHEN goals_sfs IS NOT NULL THEN {r6_sql('p')} END AS percentile
FROM (SELECT *, 100.0::DOUBLE * percent_rank() OVER (PARTITION BY position_tm, goals_sfs IS NULL ORDER BY goals_sfs) AS p FROM sp)""")


def q_role_weights(spark, d):
    sp = snapshot(spark, d, None).select("internal_player_id", "sub_position_tm")
    return sp.withColumn("role_weights", galaxy.role_weights(POSITION_CONFIG, scoring_group(F.col("sub_position_tm"))))


def role_weights_sql() -> str:
    from pitchforge.functions.positions import SCORING_GROUPS
    groups = dict(SCORING_GROUPS)
    text = {g: json.dumps({m: float(w) for m, w in c["weights"].items()}, separators=(",", ":")) for g, c in POSITION_CONFIG.items()}
    cases = " ".join(f"WHEN upper(trim(sub_position_tm)) IN {O.sql_in([n.upper() for n in names])} THEN '{text[g]}'" for g, names in groups.items() if g in text)
    return O.with_ctes(O.silver_ctes(), body=f"""
SELECT internal_player_id, sub_position_tm, CASE {cases} ELSE '{text["CM"]}' END AS role_weights FROM sp""")


def _secondary_sides(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.date_add(F.to_date(F.lit("1990-01-01")), F.pmod("c_custkey", F.lit(40)).cast("int")).alias("dob"), "c_nationkey")
    s = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 9 != 0, F.date_add(
        F.to_date(F.lit("1990-01-01")), F.pmod("s_suppkey", F.lit(40)).cast("int"))).alias("born"), "s_nationkey")
    return c, s


ON = {"dob": "born", "c_nationkey": "s_nationkey"}


def q_secondary_key(spark, d):
    """Every candidate pair of each second key."""
    return galaxy.secondary_candidates(*_secondary_sides(spark, d), "c_custkey", "s_suppkey", ON)


SQL_SECONDARY_KEY = """
SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey % 40 = s_suppkey % 40 AND c_nationkey = s_nationkey
WHERE s_suppkey % 9 <> 0"""

QUERIES = {
    "dim_date": (q_dim_date, SQL_DIM_DATE),
    "match_fact": (q_match_fact, SQL_MATCH_FACT),
    "match_fact_all": (q_match_fact, SQL_MATCH_FACT),  # earlier name of the whole fact
    "value_delta": (q_value_delta, SQL_VALUE_DELTA),
    "last_five": (q_last_five, SQL_LAST_FIVE),
    "year_over_year": (q_year_over_year, SQL_YEAR_OVER_YEAR),
    "consistency": (q_consistency, SQL_CONSISTENCY),
    "percentile_score": (q_percentile, SQL_PERCENTILE),
    "role_weights": (q_role_weights, role_weights_sql()),
    "secondary_key": (q_secondary_key, SQL_SECONDARY_KEY),
    "secondary_key_all": (q_secondary_key, SQL_SECONDARY_KEY),  # earlier name of the whole join
}

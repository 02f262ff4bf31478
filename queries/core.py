"""Flagship and first-slice queries: rating (I8/I9), latest_join_topn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.operators.joins import latest_join, left_lookup
from pitchforge.plans import rating
from pitchforge.sources.tables import table
from queries.silver import snapshot


def q_rating(spark: SparkSession, d: str) -> DataFrame:
    """The rating of the stored snapshot of all orders."""
    return rating.gold_rating(snapshot(spark, d, None))


SQL_RATING = O.with_ctes(O.silver_ctes(), O.rating_ctes(), body="SELECT * FROM gold")


def q_latest_join_topn(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate", "o_totalprice")
    with_latest = latest_join(cust, orders, "c_custkey", "o_orderdate",
                              {"o_orderkey": "o_orderkey", "o_orderdate": "o_orderdate",
                               "o_totalprice": "o_totalprice"},
                              tiebreak=[F.col("o_orderkey").desc()])
    nation = table(spark, d, "nation")
    out = left_lookup(with_latest, nation, "c_nationkey", "n_nationkey", {"n_name": "team"})
    return (out.select("c_custkey", "c_name", "team", "o_orderkey",
                       F.to_date("o_orderdate").alias("latest_date"), "o_totalprice")
               .orderBy(F.col("o_totalprice").desc_nulls_last(), F.col("c_custkey").asc())
               .limit(15))


SQL_LATEST_JOIN_TOPN = """
WITH lo AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) rn
    FROM orders) WHERE rn = 1)
SELECT c_custkey, c_name, n_name AS team, lo.o_orderkey, CAST(lo.o_orderdate AS DATE) AS latest_date,
       lo.o_totalprice
FROM customer LEFT JOIN lo ON c_custkey = lo.o_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
ORDER BY o_totalprice DESC NULLS LAST, c_custkey ASC
LIMIT 15
"""

QUERIES = {
    "rating": (q_rating, SQL_RATING),
    "latest_join_topn": (q_latest_join_topn, SQL_LATEST_JOIN_TOPN),
}

"""Silver-stage queries: SCD2 runs (I4-I7), enrichment (C8/I6), change
detection (C6 C7 D13) and key sets (G3) over dated snapshots of the analog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sql_oracles as O
from pitchforge.functions.scalars import run_date_col
from pitchforge.operators.scd2 import change_summary, detect_changes, scd2_load
from pitchforge.operators.scd2_store import HistoryStore
from pitchforge.operators.setops import key_difference, key_intersection
from pitchforge.plans import analogs
from pitchforge.session import cut_lineage, scratch_path
from queries.store import history_store, stored

KEY = "internal_player_id"
TRACKED = O.TRACKED
# (run date, orders cut-off) per load; the third run repeats the second day.
RUNS = [("2026-05-01", "1998-01-01"), ("2026-05-04", "2000-01-01"), ("2026-05-04", None)]


def periods(spark: SparkSession, d: str) -> analogs.Periods:
    """What customers did between the cut-offs is the same for every snapshot."""
    cutoffs = sorted({as_of for _, as_of in RUNS if as_of})
    return analogs.Periods(cutoffs, stored(spark, d, "period-metrics", lambda: analogs.period_metrics(spark, d, cutoffs)),
                           stored(spark, d, "period-latest", lambda: analogs.period_latest(spark, d, cutoffs)))


def snapshot(spark: SparkSession, d: str, as_of: str | None) -> DataFrame:
    return stored(spark, d, f"snapshot-{as_of}",
                  lambda: analogs.silver_players(spark, d, as_of, periods(spark, d)))


def history_after(spark: SparkSession, d: str, n_runs: int) -> DataFrame:
    """History after the first ``n_runs`` loads, a version of the stored history;
    a load writes the buckets of changed keys and the rows it closes."""
    store = history_store(spark, d, "silver", KEY)
    done = store.version()
    for n in range(0 if done is None else done + 1, n_runs):
        run_date, as_of = RUNS[n]
        store.load(snapshot(spark, d, as_of), TRACKED, run_date_col(run_date), order=["id_sfs"])
    return store.history(n_runs - 1)


def _sql_history(n_runs: int) -> tuple[list[str], str]:
    ctes, prev = [], None
    for i, (run_date, as_of) in enumerate(RUNS[:n_runs]):
        ctes.append(O.silver_ctes(f"_{i}", as_of))
        ctes.append(O.scd2_step_ctes(prev, f"sp_{i}", run_date, f"h{i}"))
        prev = f"h{i}"
    return ctes, prev


def _sql_scd2(n_runs: int) -> str:
    ctes, last = _sql_history(n_runs)
    return O.with_ctes(*ctes, body=f"SELECT * FROM {last}")


def q_scd2_run1(spark, d):
    return history_after(spark, d, 1)


def q_scd2_run2(spark, d):
    return history_after(spark, d, 2)


def q_scd2_same_day(spark, d):
    return history_after(spark, d, 3)


def q_enrich_current(spark: SparkSession, d: str) -> DataFrame:
    """A column that first appears in a later snapshot is copied onto the
    current rows without opening new versions."""
    snap = snapshot(spark, d, "2000-01-01")
    first = cut_lineage(scd2_load(snap.drop("tournament"), None, KEY, TRACKED,
                                  run_date_col("2026-05-01")), "silver-version")
    return scd2_load(snap, first, KEY, TRACKED, run_date_col("2026-05-08"))


def _sql_enrich() -> str:
    return O.with_ctes(
        O.silver_ctes("_0", "2000-01-01"),
        O.scd2_step_ctes(None, "(SELECT * EXCLUDE (tournament) FROM sp_0)", "2026-05-01", "h0"),
        body="SELECT h0.*, CASE WHEN h0.is_current THEN s.tournament END AS tournament "
             "FROM h0 LEFT JOIN sp_0 s USING (internal_player_id)")


def q_scd2_delta(spark: SparkSession, d: str) -> DataFrame:
    """I7 on an adopted history: a snapshot of every 50th player with other goals, and one of new players."""
    store = HistoryStore(spark, scratch_path(spark, "delta-store"), KEY, buckets=16)
    store.adopt(history_after(spark, d, 2))
    part = snapshot(spark, d, None).filter(F.col("id_sfs").cast("bigint") % 50 == 0)
    store.load(part.withColumn("goals_sfs", F.col("goals_sfs") + 1), TRACKED, run_date_col("2026-06-01"), order=["id_sfs"])
    fresh = part.withColumn(KEY, F.concat(F.lit("N-"), KEY))
    store.load(fresh, TRACKED, run_date_col("2026-06-02"), order=["id_sfs"])
    return store.history()


def _sql_scd2_delta() -> str:
    ctes, last = _sql_history(2)
    part = "FROM sp_2 WHERE CAST(id_sfs AS BIGINT) % 50 = 0"
    ctes.append(O.silver_ctes("_2", None))
    ctes.append(O.scd2_step_ctes(last, f"(SELECT * REPLACE (goals_sfs + 1 AS goals_sfs) {part})", "2026-06-01", "h2"))
    ctes.append(O.scd2_step_ctes("h2", f"(SELECT * REPLACE ('N-' || {KEY} AS {KEY}) {part})", "2026-06-02", "h3"))
    return O.with_ctes(*ctes, body="SELECT * FROM h3")


def q_snapshot_compare(spark: SparkSession, d: str) -> DataFrame:
    """Classify the second snapshot against the history after run 1."""
    silver = history_after(spark, d, 1)
    snap = snapshot(spark, d, RUNS[1][1])
    tagged = detect_changes(snap, silver, KEY, TRACKED)
    return tagged.select(KEY, F.col("__status").alias("status"))


def _sql_snapshot_compare() -> str:
    ctes, _ = _sql_history(1)
    ctes.append(O.silver_ctes("_1", RUNS[1][1]))
    ctes.append(O.scd2_step_ctes("h0", "sp_1", RUNS[1][0], "h1"))
    return O.with_ctes(*ctes, body="SELECT internal_player_id, __status AS status FROM h1_tag")


def q_change_summary(spark: SparkSession, d: str) -> DataFrame:
    """Number of new / changed / unchanged keys in the second load."""
    silver = history_after(spark, d, 1)
    snap = snapshot(spark, d, RUNS[1][1])
    return change_summary(detect_changes(snap, silver, KEY, TRACKED))


def _sql_change_summary() -> str:
    ctes, _ = _sql_history(1)
    ctes.append(O.silver_ctes("_1", RUNS[1][1]))
    ctes.append(O.scd2_step_ctes("h0", "sp_1", RUNS[1][0], "h1"))
    return O.with_ctes(*ctes, body="SELECT __status AS status, COUNT(*) AS n FROM h1_tag GROUP BY 1")


def q_key_sets(spark: SparkSession, d: str) -> DataFrame:
    """Customers ordering only before, only after, or on both sides of a cut-off."""
    o = analogs.table(spark, d, "orders").select("o_custkey", "o_orderdate")
    cut = F.to_timestamp(F.lit("1998-01-01"))
    before = o.filter(F.col("o_orderdate") < cut).select("o_custkey")
    after = o.filter(F.col("o_orderdate") >= cut).select("o_custkey")
    return (key_difference(before, after, ["o_custkey"]).withColumn("side", F.lit("only_before"))
            .unionByName(key_difference(after, before, ["o_custkey"])
                         .withColumn("side", F.lit("only_after")))
            .unionByName(key_intersection(before, after, ["o_custkey"])
                         .withColumn("side", F.lit("both"))))


SQL_KEY_SETS = """
WITH b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
     a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT o_custkey, 'only_before' AS side FROM (SELECT o_custkey FROM b EXCEPT SELECT o_custkey FROM a)
UNION ALL
SELECT o_custkey, 'only_after' AS side FROM (SELECT o_custkey FROM a EXCEPT SELECT o_custkey FROM b)
UNION ALL
SELECT o_custkey, 'both' AS side FROM (SELECT o_custkey FROM b INTERSECT SELECT o_custkey FROM a)
"""

QUERIES = {
    "scd2_run1": (q_scd2_run1, _sql_scd2(1)),
    "scd2_run2": (q_scd2_run2, _sql_scd2(2)),
    "scd2_same_day": (q_scd2_same_day, _sql_scd2(3)),
    "scd2_delta": (q_scd2_delta, _sql_scd2_delta()),
    "enrich_current": (q_enrich_current, _sql_enrich()),
    "snapshot_compare": (q_snapshot_compare, _sql_snapshot_compare()),
    "change_summary": (q_change_summary, _sql_change_summary()),
    "key_sets": (q_key_sets, SQL_KEY_SETS),
}

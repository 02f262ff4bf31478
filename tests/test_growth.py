"""Steps whose memory, shuffles or files would grow faster than their input."""

import datetime
import glob

from pyspark.sql import functions as F

from pitchforge.operators.joins import bounded_broadcast_join
from pitchforge.operators.scd2 import detect_changes
from pitchforge.plans import analogs
from pitchforge.plans.resolve import resolve_entities


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_with_a_row_per_entity_are_not_broadcast(spark):
    """They would all pass through the driver."""
    rows = spark.createDataFrame([(f"p{i}", float(i), True) for i in range(20)], "k string, x double, is_current boolean")
    assert "Broadcast" not in plan(bounded_broadcast_join(rows, rows.select("k"), "k", "left", max_rows=0))
    assert "BroadcastHashJoin" not in plan(detect_changes(rows.drop("is_current"), rows, "k", ["x"]))


def test_resolution_joins_rows_by_shuffle(spark):
    left = spark.createDataFrame([(i, f"name {i} x", f"Name {i} X", i, i % 3) for i in range(9)],
                                 "lid int, ln string, lr string, lo int, k1 int")
    right = spark.createDataFrame([(f"r{i}", f"name {i} x", f"Name {i} X", i, i % 3) for i in range(9)],
                                  "rid string, rn string, rr string, ro int, k2 int")
    merged, _ = resolve_entities(left, right, None, left_id="lid", left_norm="ln", left_raw="lr", left_order="lo", right_id="rid",
                                 right_norm="rn", right_raw="rr", right_order="ro", second_key={"k1": "k2"})
    # only the offsets of the dense key, one row for each partition, are broadcast
    assert plan(merged).count("BroadcastHashJoin") <= 1
    assert sorted((r["lid"], r["bridge_id"], r["evidence"]) for r in merged.collect()) == [(i, f"r{i}", "key+name") for i in range(9)]


def tables(spark, tmp_path):
    """Lines with whole, fractional, negative, large and missing numbers; orders without lines, customer or date."""
    lines = [(1, 1, 3.0, 0.05, 0.02, "R", "O"), (1, 2, 0.5, 0.06, 0.08, "A", "F"), (2, 1, -4.0, 0.0, 0.0, "N", "F"),
             (2, 3, 7e7, 0.1, 0.01, "R", "F"), (3, 4, None, None, None, None, None), (3, None, 2.0, 0.07, None, "A", "O"),
             (None, 1, 9.0, 0.01, 0.01, "R", "O"), (9, 1, 5.0, 0.02, 0.03, "R", "F"), (5, 7, 40.0, 50.0, 0.5, "N", "O"), (5, 7, 40.0, 50.0, 0.5, "N", "O")]
    day = lambda y: datetime.datetime(y, 1, 1)
    orders = [(1, 1, "F", 10.0, day(1997), "1-URGENT"), (2, 1, "O", 11.0, day(1999), "5-LOW"), (3, 2, "P", 12.0, day(2001), "1-URGENT"),
              (4, 2, "F", 13.0, day(1997), "1-URGENT"), (5, 3, None, 14.0, None, None), (5, 3, "F", 15.0, day(1998), "1-URGENT"),
              (6, 4, "F", 16.0, day(1996), "5-LOW"), (9, None, "F", 17.0, day(1996), "5-LOW"), (None, 3, "F", 18.0, day(1996), "5-LOW")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string").repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def plain_metrics(spark, d, as_of):
    """Per customer, from every line joined to its orders."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    aggs = [F.count(F.lit(1)).alias("n_li"), F.sum("l_quantity").alias("qty"), F.sum(F.round(F.col("l_discount") * 100)).alias("disc_pts"),
            F.sum(F.round(F.col("l_tax") * 100)).alias("tax_pts")] + [F.count_if(c).alias(n) for n, c in analogs._line_counts().items()]
    o = analogs.orders_as_of(spark, d, as_of)
    j = li.groupBy("l_orderkey").agg(*aggs).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    alt = F.col("o_orderpriority") == analogs.ALT_PRIORITY
    out = [F.sum(c).alias(c) for c in ("n_li", "qty", "disc_pts", "tax_pts")]
    out += [F.count(F.lit(1)).alias("appearances"), F.count_if(F.col("o_orderstatus") == "F").alias("clean_sheet")]
    out += [F.sum(F.when(alt, F.col("n_li")).otherwise(0)).alias("n_li_alt")] + [F.sum(n).alias(n) for n in analogs._line_counts()]
    out += [F.sum(F.when(alt, F.col(n)).otherwise(0)).alias(f"{n}_alt") for n in analogs.ALT_COUNTS]
    return j.groupBy(F.col("o_custkey").alias("custkey")).agg(*out)


def test_metrics_of_all_snapshots_from_one_pass(spark, tmp_path):
    d, cutoffs = tables(spark, tmp_path), ["1998-01-01", "2000-01-01"]
    periods = analogs.Periods(cutoffs, analogs.period_metrics(spark, d, cutoffs), analogs.period_latest(spark, d, cutoffs))
    key = lambda r: str(r[0])
    for as_of in (*cutoffs, None):
        want = plain_metrics(spark, d, as_of)
        for got in (analogs.customer_metrics(spark, d, as_of, periods), analogs.customer_metrics(spark, d, as_of)):
            assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
        latest = lambda p: {tuple(r) for r in analogs.latest_orders(spark, d, as_of, p).filter("o_custkey is not null").collect()}  # noqa: E731, B023
        assert latest(periods) == latest(None)


def test_lines_are_dealt_before_they_are_aggregated(spark, tmp_path):
    """A map-side aggregate per order holds a wide row for nearly every line."""
    text = plan(analogs.order_lines(spark, tables(spark, tmp_path)))
    assert "HashAggregate" in text and "HashAggregate" not in text[text.index("Exchange"):]


def test_landed_json_is_compressed(spark, tmp_path, monkeypatch):
    from queries import sources
    monkeypatch.setattr(sources, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    d = tables(spark, tmp_path)
    spark.read.parquet(f"{d}/lineitem.parquet").withColumn("l_extendedprice", F.lit(1.0)).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    spark.read.parquet(f"{d}/orders.parquet").write.parquet(f"{tmp_path}/in/orders.parquet")
    assert sources.q_json_explode_flatten(spark, f"{tmp_path}/in").count() == 11
    assert glob.glob(f"{tmp_path}/documents/*.json.gz") and not glob.glob(f"{tmp_path}/documents/*.json")

"""Raw-zone queries: landing zone, nested documents, CSV, HTML, sinks.

Each query first lands data that Spark derives from a driver table in the
shared checkpoint folder, then reads it back through the operator under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sql_oracles as O
from pitchforge.functions.scalars import lenient_date, run_date_col
from pitchforge.operators.columns import flatten, metric_rename_map, prune_fields, select_rename
from pitchforge.plans import analogs
from pitchforge.session import scratch_path
from pitchforge.sources import documents, files, html, landing, quoted_csv
from pitchforge.sources.tables import table
from queries.silver import snapshot

TS_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("dt", T.StringType())])


def _land_events(spark: SparkSession, d: str) -> str:
    root = scratch_path(spark, "landing")
    ev = table(spark, d, "events").withColumns({
        "source": F.col("event_type"), "dt": F.date_format("ts", "yyyy-MM-dd")})
    landing.write_landing(ev, root, timestampNTZFormat=TS_FMT)
    return root


def q_latest_partition_scan(spark, d):
    root = _land_events(spark, d)
    df, _ = landing.latest_per_source(spark, root, EVENT_SCHEMA, timestampNTZFormat=TS_FMT)
    return df


SQL_LATEST_PARTITION = """
SELECT event_id, ts, user_id, event_type, value, props, event_type AS source,
       strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt
FROM events QUALIFY CAST(ts AS DATE) = max(CAST(ts AS DATE)) OVER (PARTITION BY event_type)"""


def q_aux_latest_partition(spark, d):
    """A2: the latest day of the whole landing zone, whichever sources have it."""
    df, _ = landing.latest_partition(spark, _land_events(spark, d), EVENT_SCHEMA, timestampNTZFormat=TS_FMT)
    return df


SQL_AUX_LATEST = """
SELECT event_id, ts, user_id, event_type, value, props, event_type AS source, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt
FROM events QUALIFY CAST(ts AS DATE) = max(CAST(ts AS DATE)) OVER ()"""


def q_landing_partitioned(spark, d):
    root = _land_events(spark, d)
    df = spark.read.schema(EVENT_SCHEMA).option("timestampNTZFormat", TS_FMT).json(root)
    return df.groupBy("source", "dt").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.sum("value").alias("__v")).drop("__v")


SQL_LANDING = """
SELECT event_type AS source, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt, COUNT(*) AS n_rows
FROM events GROUP BY ALL"""


def q_recursive_scan_prefix(spark, d):
    """Every partition, files by name prefix, distinct fallback names."""
    root = scratch_path(spark, "landing-nested")
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    docs = ev.select(
        F.struct(F.col("event_id").alias("id"),
                 F.struct(F.when(k % 2 == 0, F.concat(F.lit("team_"), (k % 7).cast("string")))
                          .alias("name")).alias("team")).alias("core"),
        F.struct(F.struct(F.struct(F.col("event_type").alias("name")).alias("team"))
                 .alias("domestic")).alias("detailed"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    docs.write.mode("append").partitionBy("dt").json(root)
    # files of another kind beside them, which the name filter leaves out
    ev.select(F.col("event_type").alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("dt")) \
      .write.mode("append").partitionBy("dt").text(root)
    scanned = landing.read_all_partitions(spark, root, docs.schema, name_glob="part-*.json")
    from pitchforge.operators.aggregates import distinct_fallback
    return distinct_fallback(scanned.select("core.team.name", "detailed.domestic.team.name")
                             .toDF("primary", "fallback"), ["primary", "fallback"], "team_name")


SQL_RECURSIVE = """
SELECT DISTINCT coalesce(CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0
       THEN 'team_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS VARCHAR) END,
       event_type) AS team_name FROM events"""


def _line_docs(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    rows = li.join(o, li.l_orderkey == o.o_orderkey)
    items = ["core_info", "stats", "flags"]
    rows = rows.select(
        "o_orderpriority",
        F.struct(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
                 F.struct(F.col("o_custkey").alias("id")).alias("customer")).alias("core_info"),
        F.struct(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
                 F.struct(F.lit("x").alias("en")).alias("fieldTranslations")).alias("stats"),
        F.struct(F.col("l_returnflag").alias("returnFlag"),
                 F.col("l_linestatus").alias("lineStatus")).alias("flags"))
    return documents.envelope(rows, ["o_orderpriority"], items, run_date_col("2026-05-27"))


def q_json_explode_flatten(spark, d):
    """A15 -> JSON landing -> A3 explode -> A5 flatten -> B17 prune."""
    root = scratch_path(spark, "documents")
    lines = _line_docs(spark, d).drop("o_orderpriority", "chunk")
    # field names come again in every item: as plain text the landing would be many times its input
    lines.write.mode("overwrite").option("compression", "gzip").json(root)
    docs = documents.good_documents(documents.read_documents(spark, root, lines.schema, multi_line=False))
    items = documents.explode_payload(docs, "data")
    flat = flatten(prune_fields(items.select("item.*"), ["fieldTranslations"]), sep="_")
    return flat


SQL_JSON_FLATTEN = """
SELECT l_orderkey AS core_info_order_key, l_linenumber AS core_info_line,
       o_custkey AS core_info_customer_id, l_quantity AS stats_quantity,
       l_extendedprice AS stats_price, l_returnflag AS flags_returnFlag,
       l_linestatus AS flags_lineStatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def q_envelope(spark, d):
    """Documents per group; per group the item totals add up."""
    env = _line_docs(spark, d)
    return env.groupBy(F.col("metadata.o_orderpriority").alias("league")).agg(
        F.sum("metadata.total").alias("total_items"),
        F.max("metadata.extracted_at").alias("extracted_at"))


SQL_ENVELOPE = """
SELECT o_orderpriority AS league, COUNT(*) AS total_items, DATE '2026-05-27' AS extracted_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""


def q_bad_file_skip(spark, d):
    """One unparseable file among the documents; the rest is read."""
    root = scratch_path(spark, "with-bad-file")
    ev = table(spark, d, "events")
    ev.write.mode("overwrite").option("timestampNTZFormat", TS_FMT).json(root + "/good")
    ev.select(F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                       F.lit(', "ts": ')).alias("value")).limit(1) \
      .write.mode("overwrite").text(root + "/bad")
    schema = T.StructType(EVENT_SCHEMA.fields[:6])
    docs = documents.read_documents(spark, root, schema, recursive=True, multi_line=False,
                                    timestampNTZFormat=TS_FMT)
    return documents.good_documents(docs, whole_files=True).drop("__file")


def q_csv_all_string_parse(spark, d):
    """A6 + H20/H36: orders through an all-string CSV with dates written in eight ways, then lenient parsing."""
    root = scratch_path(spark, "csv")
    o = table(spark, d, "orders")
    way, day = F.pmod("o_orderkey", F.lit(8)), F.col("o_orderdate")
    written = F.date_format(day, "yyyy-MM-dd")
    for n, pattern in enumerate(("M/d/yy", "dd-MMM-yy", "yyyy-MM-dd hh:mm a", "yyyyMMdd'T'HHmmss", "EEEE, MMMM d, yyyy", "d MMM yyyy",
                                 "M/d/yyyy HH:mm:ss")):
        written = F.when(way == n, F.date_format(day, pattern)).otherwise(written)
    files.write_csv(o.select(*[F.col(c).cast("string").alias(c) for c in
                               ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")],
                             written.alias("o_orderdate")), root)
    raw = files.read_csv_strings(spark, root)
    return raw.select("o_orderkey", "o_orderpriority",
                      F.col("o_totalprice").try_cast("double").alias("total_num"),
                      lenient_date("o_orderdate").alias("order_date"),
                      F.col("o_custkey").try_cast("bigint").alias("custkey"))


SQL_CSV = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, o_totalprice AS total_num,
       CAST(o_orderdate AS DATE) AS order_date, o_custkey AS custkey FROM orders"""


def q_csv_quoted_splits(spark, d):
    """Whole texts, newlines and all, through a CSV that is read in splits."""
    root = scratch_path(spark, "csv-quoted")
    files.write_csv(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source"), root)
    return quoted_csv.read_csv_quoted(spark, root)


SQL_CSV_QUOTED = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents"


def q_standings_extract(spark, d):
    """Standings analog -> nested documents -> extraction."""
    root = scratch_path(spark, "standings")
    st = analogs.standings(spark, d)
    row = F.struct(F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name"))
                   .alias("team"), "position", "matches", "wins", "draws", "losses",
                   F.col("goals_scored").alias("scoresFor"),
                   F.col("goals_conceded").alias("scoresAgainst"), "points")
    docs = st.groupBy("league_name").agg(F.collect_list(row).alias("rows")).select(
        F.col("league_name").alias("league"),
        F.struct(F.array(F.struct("rows")).alias("standings")).alias("data"))
    docs.write.mode("overwrite").json(root)
    read = documents.good_documents(documents.read_documents(spark, root, docs.schema, multi_line=False))
    return documents.standings_rows(read)


SQL_STANDINGS = O.with_ctes(O.standings_ctes(), body="SELECT * FROM standings")


def q_toplist_extract(spark, d):
    """Per league the 10 best base ratings -> documents -> extraction."""
    from pyspark.sql import Window
    root = scratch_path(spark, "toplist")
    sp = snapshot(spark, d, None)
    w = Window.partitionBy("league_sfs").orderBy(F.col("base_rating_sfs").desc_nulls_last(),
                                                 F.col("id_sfs").asc())
    top = sp.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= 10)
    item = F.struct(F.struct(F.col("id_sfs").cast("bigint").alias("id"),
                             F.col("name_sfs_raw").alias("name")).alias("player"),
                    F.struct(F.col("team_rank_sfs").alias("id"), F.col("team_sfs").alias("name"))
                    .alias("team"),
                    F.struct(F.col("base_rating_sfs").alias("rating")).alias("statistics"))
    docs = top.groupBy("league_sfs").agg(F.collect_list(item).alias("rating")).select(
        F.col("league_sfs").alias("league"),
        F.struct(F.struct("rating").alias("topPlayers")).alias("data"))
    docs.write.mode("overwrite").json(root)
    read = documents.read_documents(spark, root, docs.schema, multi_line=False)
    return documents.toplist_rows(documents.good_documents(read))


SQL_TOPLIST = O.with_ctes(O.silver_ctes(), body="""
SELECT league_sfs AS league_name, CAST(id_sfs AS BIGINT) AS player_id, name_sfs_raw AS player_name,
       team_rank_sfs AS team_id, team_sfs AS team_name, base_rating_sfs AS rating
FROM (SELECT *, row_number() OVER (PARTITION BY league_sfs
                                   ORDER BY base_rating_sfs DESC NULLS LAST, id_sfs ASC) AS r
      FROM sp) WHERE r <= 10""")


def q_parquet_roundtrip_stamp(spark, d):
    """Replace-table load with a load stamp, read back."""
    base = scratch_path(spark, "warehouse")
    files.load_tables({"customer": table(spark, d, "customer"), "missing": None}, base,
                      stamp=run_date_col("2026-05-27"))
    return spark.read.parquet(base + "/customer")


SQL_PARQUET_STAMP = "SELECT *, DATE '2026-05-27' AS synced_at FROM customer"


def q_load_verify(spark, d):
    """Total and conditional counts of the loaded table."""
    base = scratch_path(spark, "warehouse")
    files.load_tables({"customer": table(spark, d, "customer")}, base)
    return files.verify_load(spark.read.parquet(base + "/customer"),
                             F.col("c_mktsegment") == "BUILDING")


SQL_LOAD_VERIFY = """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS matched FROM customer"""

NAV = r"(?s)<nav>(.*?)</nav>"
LI = r"(?s)<li>(.*?)</li>"
LINK = r'(?s)<a href="([^"]*)"[^>]*>(.*?)</a>'


def q_html_rows(spark, d):
    pages = table(spark, d, "pages")
    return html.extract_rows(pages, "html", ["page_id"], row_start="<li>", link_pattern=LINK,
                             value_pattern=r"(?s)<a href=\"/([^\"]*)\"", scope=("nav", "<nav>"))


#: Entities that the pages hold, in the oracle's order (&amp; last).
SQL_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _html_text_sql(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in SQL_ENTITIES:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"


SQL_HTML_ROWS = f"""
WITH r AS (
  SELECT page_id, unnest(rows) AS row, unnest(generate_series(0, len(rows) - 1)) AS row_idx
  FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '{NAV}', 1), '{LI}', 1) AS rows
        FROM pages)),
x AS (
  SELECT page_id, row_idx, regexp_extract(row, '{LINK}', 1) AS href,
         {_html_text_sql(f"regexp_extract(row, '{LINK}', 2)")} AS name,
         regexp_extract(row, '{LINK}', 0) AS whole
  FROM r)
SELECT page_id, CAST(row_idx AS BIGINT) AS row_idx, name, href,
       CASE WHEN coalesce(string_split(href, '/')[-1], '') = '' THEN 'Unknown'
            ELSE string_split(href, '/')[-1] END AS item_id,
       substr(href, 2) AS value
FROM x WHERE whole <> ''"""


def q_html_first_link(spark, d):
    pages = table(spark, d, "pages")
    return html.first_link(pages, "html", "https://example.org", ["page_id"],
                           link_pattern=r'<a href="([^"]*)"', scope=("article", "<article>"))


SQL_HTML_FIRST = """
SELECT page_id, CASE WHEN h <> '' THEN 'https://example.org' || h END AS first_url
FROM (SELECT page_id, regexp_extract(regexp_extract(html, '(?s)<article>(.*?)</article>', 1),
                                     '<a href="([^"]*)"', 1) AS h FROM pages)"""


def q_rename_rules(spark, d):
    """Nested stats flattened, renamed by rule, projected."""
    li = table(spark, d, "lineitem")
    nested = li.select(F.col("l_orderkey").alias("id"), F.struct(
        F.col("l_quantity").alias("totalQuantity"), F.col("l_extendedprice").alias("extendedPrice"),
        F.col("l_discount").alias("discountRate"), F.col("l_tax").alias("taxRate"),
        F.col("l_linenumber").alias("lineNumber"),
        F.struct(F.col("l_returnflag").alias("returnFlag"),
                 F.col("l_linestatus").alias("lineStatus")).alias("flags")).alias("stats"))
    flat = flatten(nested)
    mapping = {"id": "id_sfs", "absentColumn": "never_sfs"}
    mapping.update(metric_rename_map(flat.columns, "stats.", "_sfs",
                                     {"discountRate": "disc_pct_sfs"}))
    return select_rename(flat, mapping)


SQL_RENAME = """
SELECT l_orderkey AS id_sfs, l_quantity AS total_quantity_sfs, l_extendedprice AS extended_price_sfs,
       l_discount AS disc_pct_sfs, l_tax AS tax_rate_sfs, l_linenumber AS line_number_sfs,
       l_returnflag AS flags_return_flag_sfs, l_linestatus AS flags_line_status_sfs
FROM lineitem"""


def q_prune_nested(spark, d):
    """A field pruned at every depth, including inside arrays of structs."""
    li = table(spark, d, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        "l_linenumber", "l_quantity",
        F.struct(F.col("l_returnflag").alias("en"), F.lit("x").alias("fr")).alias("translations"),
        F.struct(F.col("l_linestatus").alias("status"),
                 F.struct(F.lit("y").alias("de")).alias("translations")).alias("meta")))
        .alias("lines"))
    pruned = prune_fields(lines, ["translations"])
    return pruned.select("l_orderkey", F.explode("lines").alias("x")).select(
        "l_orderkey", "x.l_linenumber", "x.l_quantity", F.col("x.meta.status").alias("status"),
        F.size(F.array(F.col("x.meta"))).alias("meta_fields"))


SQL_PRUNE = """
SELECT l_orderkey, l_linenumber, l_quantity, l_linestatus AS status, 1 AS meta_fields FROM lineitem"""

QUERIES = {
    "latest_partition_scan": (q_latest_partition_scan, SQL_LATEST_PARTITION),
    "aux_latest_partition": (q_aux_latest_partition, SQL_AUX_LATEST),
    "landing_partitioned": (q_landing_partitioned, SQL_LANDING),
    "recursive_scan_prefix": (q_recursive_scan_prefix, SQL_RECURSIVE),
    "json_explode_flatten": (q_json_explode_flatten, SQL_JSON_FLATTEN),
    "envelope": (q_envelope, SQL_ENVELOPE),
    "bad_file_skip": (q_bad_file_skip, "SELECT * FROM events"),
    "csv_all_string_parse": (q_csv_all_string_parse, SQL_CSV),
    "csv_quoted_splits": (q_csv_quoted_splits, SQL_CSV_QUOTED),
    "standings_extract": (q_standings_extract, SQL_STANDINGS),
    "toplist_extract": (q_toplist_extract, SQL_TOPLIST),
    "parquet_roundtrip_stamp": (q_parquet_roundtrip_stamp, SQL_PARQUET_STAMP),
    "load_verify": (q_load_verify, SQL_LOAD_VERIFY),
    "html_rows": (q_html_rows, SQL_HTML_ROWS),
    "html_first_link": (q_html_first_link, SQL_HTML_FIRST),
    "rename_rules": (q_rename_rules, SQL_RENAME),
    "prune_nested": (q_prune_nested, SQL_PRUNE),
}

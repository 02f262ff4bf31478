"""Nested JSON documents.

Documents are read with ``multiLine`` and an explicit or inferred schema;
the payload array is exploded with its position so "keep last" has a total
order (file name, index) instead of depending on listing order.  A file that
fails to parse shows up in ``_corrupt_record`` (PERMISSIVE mode) and is
reported, while the rest of the batch continues.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchforge.operators.dedupe import keep_last

CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   name_glob: str | None = None, recursive: bool = False,
                   multi_line: bool = True, **options) -> DataFrame:
    """JSON documents with file name; ``multi_line`` for one (pretty-printed)
    document per file, else JSON lines.  Broken input is kept as a
    ``_corrupt_record`` row (A23) instead of failing the job."""
    reader = (spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", CORRUPT).options(**options))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        if CORRUPT not in schema.fieldNames():
            schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    df = reader.json(path)
    df = df.withColumn("__file", F.col("_metadata.file_name"))
    if CORRUPT not in df.columns:
        df = df.withColumn(CORRUPT, F.lit(None).cast("string"))
    return df


def good_documents(df: DataFrame, whole_files: bool = False) -> DataFrame:
    """Documents that parsed; with ``whole_files`` none of a file that failed anywhere."""
    if whole_files:
        df = df.join(bad_files(df), "__file", "left_anti")
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_files(df: DataFrame) -> DataFrame:
    """Files that failed to parse (one row per file)."""
    # Spark doesn't scan raw JSON for the corrupt text alone, so a data column goes with it
    data = next(c for c in df.columns if c not in (CORRUPT, "__file"))
    broken = F.concat(F.col(CORRUPT), F.coalesce(F.col(f"`{data}`").cast("string"), F.lit("")))
    return df.filter(broken.isNotNull()).select("__file").distinct()


def explode_payload(df: DataFrame, array_col: str, alias: str = "item") -> DataFrame:
    """A3: one row per payload element with (file, index); documents without
    the array contribute nothing."""
    return df.select("__file", F.posexplode(F.col(array_col)).alias("__idx", alias))


def standings_rows(df: DataFrame, league_default: str = "Unknown") -> DataFrame:
    """``data.standings[0].rows[]`` -> 12 columns, keep last per (league, team)."""
    rows = df.select("__file", F.coalesce(F.col("league"), F.lit(league_default)).alias("league_name"),
                     F.posexplode(F.get(F.col("data.standings"), 0).getField("rows"))
                      .alias("__idx", "r"))
    r = F.col("r")
    flat = rows.select(
        "__file", "__idx", "league_name",
        r["team"]["id"].alias("team_id"), r["team"]["name"].alias("team_name"),
        r["position"].alias("position"), r["matches"].alias("matches"),
        r["wins"].alias("wins"), r["draws"].alias("draws"), r["losses"].alias("losses"),
        r["scoresFor"].alias("goals_scored"), r["scoresAgainst"].alias("goals_conceded"),
        (F.coalesce(r["scoresFor"], F.lit(0)) - F.coalesce(r["scoresAgainst"], F.lit(0)))
        .alias("goal_diff"),
        r["points"].alias("points"))
    return keep_last(flat, ["league_name", "team_id"], ["__file", "__idx"]).drop("__file", "__idx")


def toplist_rows(df: DataFrame, league_default: str = "Unknown") -> DataFrame:
    """``data.topPlayers.rating[]`` -> 6 columns, keep last per (league, player)."""
    rows = df.select("__file", F.coalesce(F.col("league"), F.lit(league_default)).alias("league_name"),
                     F.posexplode(F.col("data.topPlayers.rating")).alias("__idx", "r"))
    r = F.col("r")
    flat = rows.select("__file", "__idx", "league_name",
                       r["player"]["id"].alias("player_id"), r["player"]["name"].alias("player_name"),
                       r["team"]["id"].alias("team_id"), r["team"]["name"].alias("team_name"),
                       r["statistics"]["rating"].alias("rating"))
    return keep_last(flat, ["league_name", "player_id"], ["__file", "__idx"]).drop("__file", "__idx")


#: Items of one envelope document.
ENVELOPE_ITEMS = 10_000


def envelope(df: DataFrame, group_cols: Sequence[str], item_cols: Sequence[str],
             extracted_at: Column, order_col: str | None = None, max_items: int = ENVELOPE_ITEMS) -> DataFrame:
    """Documents ``{metadata:{extracted_at, <group>, chunk, total}, data:[items]}``.

    A document holds about half of ``max_items`` items of one group, dealt by a
    hash of the item, so a group of any size becomes documents of bounded size,
    and the same ones in every run.  Group sizes come from a first pass whose
    sums combine before the shuffle.  Items are sorted by ``order_col`` when given.
    """
    item = F.struct(*[F.col(c) for c in item_cols])
    sizes = df.groupBy(*group_cols).agg(F.ceil(F.count(F.lit(1)) / F.lit(max(1, max_items // 2))).alias("__chunks"))
    same = [F.col(f"__g{i}").eqNullSafe(F.col(c)) for i, c in enumerate(group_cols)]
    sizes = sizes.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group_cols)], "__chunks")
    dealt = df.join(sizes, same) if same else df.crossJoin(F.broadcast(sizes))
    salt = F.xxhash64(item, *([F.col(order_col)] if order_col else []))
    chunked = dealt.withColumn("chunk", F.pmod(salt, F.col("__chunks")).cast("int"))
    if order_col:
        items = F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("__o"), item.alias("__v")))),
            lambda x: x["__v"])
    else:
        items = F.collect_list(item)
    agg = chunked.groupBy(*group_cols, "chunk").agg(items.alias("data"))
    meta = F.struct(extracted_at.alias("extracted_at"), *[F.col(c) for c in group_cols],
                    F.col("chunk"), F.size("data").cast("bigint").alias("total"))
    return agg.select(*group_cols, "chunk", meta.alias("metadata"), "data")


__all__ = ["read_documents", "good_documents", "bad_files", "explode_payload", "standings_rows",
           "toplist_rows", "envelope", "CORRUPT"]

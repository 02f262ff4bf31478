"""Entity resolution across two sources with a sticky identity registry.

Level 1: known left ids map through the registry (keep-last per left id).
Level 2: unresolved, non-empty normalised names get the lossless fuzzy best
match (``operators.fuzzy``) and, if given, matches by a second key (X10); accepted matches record the right id, others get
a placeholder right id ``"unknown"`` (and are never retried: the registry
entry makes them known).  New internal ids continue after the largest number
issued so far, in left-row order.  The merged output bridges left -> internal
id -> right id -> right row; right columns that collide with left ones are
dropped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchforge.functions.text import token_sort_key
from pitchforge.operators.dedupe import first_per_key, keep_last, mint_ids
from pitchforge.operators.fuzzy import LEAST_THRESHOLD, fuzzy_best_match, similar_pairs
from pitchforge.operators.fuzzy_index import SegmentIndex
from pitchforge.operators.joins import bounded_broadcast_join, shuffled
from pitchforge.session import cut_lineage
from pitchforge.sources.files import latest_version_path, next_version_path

PLACEHOLDER = "unknown"
#: What an equal second key adds to the similarity of names, and what it scores alone.
KEY_BONUS, KEY_SCORE = 20.0, 80.0
#: Matched names that may be broadcast.
NAME_ROWS = 50_000
REGISTRY_COLUMNS = ["internal_id", "left_id", "right_id", "display_name"]


def save_registry(registry: DataFrame, base: str) -> str:
    """Write the registry as the next version below ``base``; the one it was made from stays readable."""
    path = next_version_path(registry.sparkSession, base)
    registry.select(*REGISTRY_COLUMNS).write.parquet(path)
    return path


def load_registry(spark: SparkSession, base: str) -> DataFrame | None:
    """The latest saved registry; None before the first run."""
    path = latest_version_path(spark, base)
    return None if path is None else spark.read.parquet(path)


def second_key_candidates(todo: DataFrame, left: DataFrame, right: DataFrame, on: Mapping[str, str], *, left_id: str,
                          left_norm: str, right_id: str, right_norm: str, right_raw: str, right_order: str) -> DataFrame:
    """(left id, score, __rorder, __rid, __rraw, evidence) of unresolved rows whose second key equals a right row's.

    ``key+name``: names of the two are similar as well; only names that share a
    placed segment within a key are compared, so a frequent key gives no pairs of all its rows.
    ``key``: the key tells one left row and one right row apart from all others, whatever their names.
    """
    keys = [f"__key{i}" for i in range(len(on))]
    rows = todo.select(F.col(left_id), token_sort_key(left_norm).alias("ls"),
                       *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]).dropna(subset=keys)
    found = F.struct(F.col(right_order).alias("__rorder"), F.col(right_id).cast("string").alias("__rid"), F.col(right_raw).alias("__rraw"))
    others = right.select(F.coalesce(token_sort_key(right_norm), F.lit("")).alias("rs"), found.alias("__r"),
                          *[F.col(c).alias(k) for c, k in zip(on.values(), keys, strict=True)]).dropna(subset=keys)

    first = others.groupBy("rs", *keys).agg(F.min("__r").alias("__r"))
    lefts = rows.select("ls", *keys).distinct()
    pairs = similar_pairs(lefts, first.filter("rs <> ''").select("rs", *keys), LEAST_THRESHOLD, keys).join(shuffled(first), ["rs", *keys])
    best = first_per_key(pairs, ["ls", *keys], [F.col("score").desc(), F.col("__r").asc()])
    close = rows.join(shuffled(best), ["ls", *keys]).select(left_id, (F.col("score") + KEY_BONUS).alias("score"), "__r", F.lit("key+name").alias("evidence"))

    alone = left.select(F.col(left_id), *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]).dropna(subset=keys)
    alone = alone.groupBy(*keys).agg(F.min(left_id).alias(left_id), F.count(F.lit(1)).alias("__n")).filter("__n = 1").drop("__n")
    only = others.groupBy(*keys).agg(F.min("__r").alias("__r"), F.count(F.lit(1)).alias("__n")).filter("__n = 1").drop("__n")
    lone = alone.join(shuffled(only), keys).join(shuffled(todo.select(left_id)), left_id, "left_semi").select(
        left_id, F.lit(KEY_SCORE).alias("score"), "__r", F.lit("key").alias("evidence"))
    return close.unionByName(lone).select(left_id, "score", "__r.*", "evidence")


def resolve_entities(left: DataFrame, right: DataFrame, registry: DataFrame | None, *,
                     left_id: str, left_norm: str, left_raw: str, left_order: str,
                     right_id: str, right_norm: str, right_raw: str, right_order: str,
                     threshold: int = 85, prefix: str = "PLR_",
                     second_key: Mapping[str, str] | None = None,
                     index: SegmentIndex | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (merged, registry').

    With ``index`` the right names' segments are stored from run to run, and a run adds only new ones.
    With ``second_key`` (left column -> right column, such as birth date and team)
    new left rows get candidates from the name match and from the key, each with
    evidence and a score, and the best one is taken (ties go to the first right row):
    ``name`` scores its similarity (``threshold`` or more), ``key+name`` its similarity
    (70 or more) and ``KEY_BONUS``, ``key`` alone ``KEY_SCORE``.  So an equal name with another
    key (a transfer) stays ahead of a similar name with the same key, unless that is nearly equal.
    ``merged`` then has the column ``evidence`` (null for ids known before and placeholders).
    """
    spark = left.sparkSession
    if registry is None:
        registry = spark.createDataFrame([], "internal_id string, left_id string, "
                                             "right_id string, display_name string")
    reg = keep_last(registry.withColumn("__n", F.regexp_extract("internal_id", r"(\d+)$", 1)
                                        .cast("bigint")), ["left_id"], ["__n"])
    known = left.join(reg.select(F.col("left_id").alias(left_id), "internal_id").transform(shuffled), left_id, "left")
    todo = known.filter(F.col("internal_id").isNull() & F.col(left_norm).isNotNull() &
                        (F.col(left_norm) != ""))
    candidates = right.select(right_norm, right_order,
                              F.col(right_id).cast("string").alias("__rid"),
                              F.col(right_raw).alias("__rraw"))
    best = fuzzy_best_match(todo, left_norm, candidates, right_norm, right_order,
                            ["__rid", "__rraw"], threshold, index)
    entries = todo.select(left_id, left_norm, left_raw, left_order)
    if second_key is None:
        entries = entries.join(best, left_norm, "left")
    else:
        place = F.col(right_order).alias("__rorder")
        # several right rows with one id: the match's own is the first
        named = best.join(shuffled(candidates.groupBy("__rid").agg(F.min(right_order).alias(right_order))), "__rid")
        # a frequent name has many left rows: few matched names are broadcast once they are counted
        named = bounded_broadcast_join(todo.select(left_id, left_norm), named, left_norm, "inner", max_rows=NAME_ROWS, name="named").select(
            left_id, "score", place, "__rid", "__rraw", F.lit("name").alias("evidence"))
        keyed = second_key_candidates(todo, left, right, second_key, left_id=left_id, left_norm=left_norm,
                                      right_id=right_id, right_norm=right_norm, right_raw=right_raw, right_order=right_order)
        found = first_per_key(named.unionByName(keyed), [left_id], [F.col("score").desc(), F.col("__rorder").asc(), F.col("evidence").asc()])
        found = cut_lineage(found.select(F.col(left_id).alias("__found"), "__rid", "__rraw", "evidence"), "matches")
        entries = entries.join(shuffled(found), F.col(left_id) == F.col("__found"), "left")
    entries = entries.select(
        F.col(left_id).cast("string").alias("left_id"), left_order,
        F.coalesce(F.col("__rid"), F.lit(PLACEHOLDER)).alias("right_id"),
        F.when(F.col("__rid").isNotNull(), F.col("__rraw")).otherwise(F.col(left_raw))
         .alias("display_name"))
    issued = registry.agg(F.max(F.regexp_extract("internal_id", r"(\d+)$", 1).cast("bigint"))) \
                     .first()[0] or 0
    minted = mint_ids(entries, [F.col(left_order).asc()], "internal_id", start_after=int(issued),
                      prefix=prefix).select(*REGISTRY_COLUMNS)
    new_registry = registry.select(*REGISTRY_COLUMNS).unionByName(minted)
    # one entry for each left id (the last one), so no left row is doubled
    ids = reg.select(*REGISTRY_COLUMNS).unionByName(minted).select(
        F.col("left_id").alias("__lid"), "internal_id", F.col("right_id").alias("__bridge"))
    merged = left.join(shuffled(ids), F.col(left_id).cast("string") == F.col("__lid"), "left").drop("__lid")
    keep = [c for c in right.columns if c not in merged.columns]
    rside = right.select(F.col(right_id).cast("string").alias("__rk"), *keep)
    # the placeholder matches nothing: as null it isn't dealt to one task
    target = F.when(F.col("__bridge") != PLACEHOLDER, F.col("__bridge"))
    merged = merged.withColumn("__target", target).join(
        shuffled(rside), F.col("__target") == F.col("__rk"), "left").drop("__rk", "__target")
    if second_key is not None:
        merged = merged.join(shuffled(found.select(F.col("__found").alias(left_id), "evidence")), left_id, "left")
    return merged.withColumnRenamed("__bridge", "bridge_id"), new_registry


__all__ = ["resolve_entities", "second_key_candidates", "save_registry", "load_registry", "PLACEHOLDER", "REGISTRY_COLUMNS"]

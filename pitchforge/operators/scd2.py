"""Type-2 slowly changing dimension with same-day upsert.

Plan (one shuffle of the snapshot against the *current* rows only):

* ``detect_changes``: the snapshot is left-joined to one row per key of the
  history, with the tracked values of its current row; each snapshot row becomes
  ``new`` (key in no version), ``changed`` (a tracked column differs from the
  current row, null == -1 for numbers and null == '' for strings) or
  ``unchanged`` (including keys whose versions are all closed: they never
  reopen).
* ``apply_scd2``: closed history passes through untouched (no shuffle); only
  current rows are joined with the changed keys and either closed
  (``valid_to = run_date``) or, when opened on ``run_date`` itself, replaced.
  Inserts get ``[run_date, null)``.
* ``enrich_non_tracked``: columns absent from (or entirely null in) the result
  are copied from the snapshot onto current rows only.

The result is a new table version: callers write it to a new path rather
than over the one being read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchforge.operators.dedupe import first_per_key, keep_last
from pitchforge.operators.joins import shuffled
from pitchforge.session import cut_lineage

SCD_COLS = ("is_current", "valid_from", "valid_to")


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _differs(new_col: Column, cur_col: Column, dtype: T.DataType) -> Column:
    if _numeric(dtype):
        return F.coalesce(new_col.cast("double"), F.lit(-1.0)) != \
            F.coalesce(cur_col.cast("double"), F.lit(-1.0))
    if isinstance(dtype, T.StringType):
        return F.coalesce(new_col, F.lit("")) != F.coalesce(cur_col.cast("string"), F.lit(""))
    return ~new_col.eqNullSafe(cur_col)


def detect_changes(new: DataFrame, silver: DataFrame | None, key: str,
                   tracked: Sequence[str], status_col: str = "__status") -> DataFrame:
    """I4: tag each (resolved) snapshot row new / changed / unchanged."""
    resolved = new.filter(F.col(key).isNotNull())
    if silver is None or key not in silver.columns:
        return resolved.withColumn(status_col, F.lit("new"))
    present = [c for c in tracked if c in silver.columns]
    # one aggregate over the history: a key is known, and has the values of its current row or none
    active = F.col("is_current").eqNullSafe(F.lit(True))
    state = silver.groupBy(key).agg(F.lit(True).alias("__known"), F.max(F.when(active, F.struct(
        F.lit(True).alias("__has_cur"), *[F.col(c).alias(f"__cur_{c}") for c in present]))).alias("__s"))
    tagged = resolved.join(shuffled(state), key, "left").select(
        *resolved.columns, "__known", "__s.__has_cur", *[f"__s.__cur_{c}" for c in present])
    types = {f.name: f.dataType for f in resolved.schema.fields}
    diffs = [_differs(F.col(c) if c in resolved.columns else F.lit(None),
                      F.col(f"__cur_{c}") if c in present else F.lit(None),
                      types.get(c, T.StringType())) for c in tracked]
    any_diff = F.lit(False)
    for d in diffs:
        any_diff = any_diff | d
    status = (F.when(F.col("__known").isNull(), F.lit("new"))
               .when(F.col("__has_cur").isNotNull() & any_diff, F.lit("changed"))
               .otherwise(F.lit("unchanged")))
    return (tagged.withColumn(status_col, status)
                  .drop("__known", "__has_cur", *[f"__cur_{c}" for c in present]))


def apply_scd2(tagged: DataFrame, silver: DataFrame | None, key: str, run_date: Column,
               status_col: str = "__status") -> DataFrame:
    """Close or replace current rows of changed keys; insert new versions."""
    inserts = (tagged.filter(F.col(status_col).isin("new", "changed")).drop(status_col)
                     .withColumn("is_current", F.lit(True))
                     .withColumn("valid_from", run_date.cast("date"))
                     .withColumn("valid_to", F.lit(None).cast("date")))
    if silver is None or key not in silver.columns:
        return inserts
    changed = tagged.filter(F.col(status_col) == "changed").select(key).distinct() \
                    .withColumn("__chg", F.lit(True))
    # null flags count as not current and null dates as another day: no row may fall between
    active = F.col("is_current").eqNullSafe(F.lit(True))
    history = silver.filter(~active)
    current = silver.filter(active).join(shuffled(changed), key, "left")
    hit = F.col("__chg").isNotNull()
    same_day = hit & F.col("valid_from").eqNullSafe(run_date.cast("date"))
    current = (current.filter(~same_day)
                      .withColumn("valid_to", F.when(hit, run_date.cast("date"))
                                  .otherwise(F.col("valid_to")))
                      .withColumn("is_current", F.when(hit, F.lit(False))
                                  .otherwise(F.col("is_current")))
                      .drop("__chg"))
    return (history.unionByName(current)
                   .unionByName(inserts, allowMissingColumns=True))


def enrich_non_tracked(result: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Copy columns absent from, or entirely null in, ``result`` from the
    snapshot onto current rows (absent snapshot key -> null); history keeps
    what it had."""
    candidates = [c for c in new.columns if c not in SCD_COLS and c != key]
    existing = [c for c in candidates if c in result.columns]
    all_null: list[str] = []
    if existing:
        # One bounded plan-time fact: non-null count per candidate column.
        counts = result.agg(*[F.count(F.col(c)).alias(c) for c in existing]).first()
        all_null = [c for c in existing if counts[c] == 0]
    new_cols = [c for c in candidates if c not in result.columns] + all_null
    if not new_cols:
        return result
    src = new.filter(F.col(key).isNotNull()).select(
        key, *[F.col(c).alias(f"__new_{c}") for c in new_cols])
    out = result
    for c in new_cols:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(new.schema[c].dataType))
    out = out.join(shuffled(src), key, "left")
    active = F.col("is_current") == F.lit(True)
    out = out.withColumns({c: F.when(active, F.col(f"__new_{c}")).otherwise(F.col(c))
                           for c in new_cols})
    return out.drop(*[f"__new_{c}" for c in new_cols])


def scd2_load(new: DataFrame, silver: DataFrame | None, key: str, tracked: Sequence[str],
              run_date: Column, order: Sequence[str | Column] | None = None,
              validate: Callable[[DataFrame], None] | None = None,
              materialize_input: bool = True) -> DataFrame:
    """Dedupe (keep last) -> contract -> detect -> apply -> enrich.

    Without an ``order`` one row of each key stays, chosen by a hash of the row,
    so a key never gets two current versions; rows without a key are left to
    change detection.  The result is a stored table, evaluated once.

    The snapshot is read by the contract check, change detection and
    enrichment; with ``materialize_input`` it is written once to the shared
    checkpoint folder so an expensive upstream plan is not evaluated three
    times.
    """
    if order:
        snapshot = keep_last(new, [key], order)
    else:
        snapshot = first_per_key(new, [key], [F.xxhash64(*[F.col(f"`{c}`") for c in new.columns])])
    if materialize_input:
        snapshot = cut_lineage(snapshot, "scd2-snapshot")
    if validate is not None:
        validate(snapshot)
    tagged = detect_changes(snapshot, silver, key, tracked)
    result = cut_lineage(apply_scd2(tagged, silver, key, run_date), "scd2-applied")
    enriched = enrich_non_tracked(result, snapshot, key)
    return result if enriched is result else cut_lineage(enriched, "scd2-enriched")


def change_summary(tagged: DataFrame, status_col: str = "__status") -> DataFrame:
    """Rows per status."""
    return tagged.groupBy(status_col).agg(F.count(F.lit(1)).alias("n")) \
                 .withColumnRenamed(status_col, "status")


__all__ = ["detect_changes", "apply_scd2", "enrich_non_tracked", "scd2_load",
           "change_summary", "SCD_COLS"]

"""Projection, renaming, ladders, filters and nested pruning.

Renames are resolved at plan time against ``df.schema`` and applied in one
``select`` so Catalyst prunes unused columns down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchforge.functions.text import camel_to_snake


def _q(name: str) -> str:
    """Back-tick quote a (possibly dotted) column name."""
    return "`" + name.replace("`", "``") + "`"


# ---------------------------------------------------------------- B1 / B3
def select_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B1: keep and rename the mapped columns that exist; ignore absent ones.

    Two sources mapping to one target raise (the rename would be ambiguous).
    """
    present = {k: v for k, v in mapping.items() if k in df.columns}
    targets = list(present.values())
    dupes = {t for t in targets if targets.count(t) > 1}
    if dupes:
        raise ValueError(f"several source columns map to {sorted(dupes)}")
    return df.select([F.col(_q(k)).alias(v) for k, v in present.items()])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    return df.select([_q(c) for c in wanted if c in df.columns])


# --------------------------------------------------------------------- B2
def metric_rename_map(columns: Iterable[str], prefix: str, suffix: str,
                      overrides: Mapping[str, str]) -> dict[str, str]:
    """B2/H2/H3: for columns under ``prefix``: override, else '.'->'_' then
    camelCase->snake_case, then ``suffix`` appended.  Plan-time only."""
    out: dict[str, str] = {}
    for c in columns:
        if not c.startswith(prefix):
            continue
        rest = c[len(prefix):]
        if rest in overrides:
            out[c] = overrides[rest]
        else:
            out[c] = camel_to_snake(rest.replace(".", "_")) + suffix
    return out


def flatten_schema(schema: T.StructType, prefix: str = "") -> list[str]:
    """A5: dotted leaf names of nested structs; arrays and maps stay values."""
    names: list[str] = []
    for f in schema.fields:
        full = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            names.extend(flatten_schema(f.dataType, full + "."))
        else:
            names.append(full)
    return names


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """A5: nested-to-flat with dotted column names (``a.b.c``)."""
    leaves = flatten_schema(df.schema)
    return df.select([F.col(".".join(_q(p) for p in n.split("."))).alias(n.replace(".", sep))
                      for n in leaves])


# ---------------------------------------------------------------- B4 / B5
def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.dropna(subset=[key])


# ------------------------------------------------------------ B6 / B7 / B8
def dashboard_filter(df: DataFrame, *, leagues: Sequence[str] = (),
                     positions: Sequence[str] = (), teams: Sequence[str] = (),
                     max_value: float | None = None, min_score: float = 0.0,
                     latest_only: bool = False, league_col: str = "league",
                     position_col: str = "position", team_col: str = "team",
                     value_col: str = "market_value", score_col: str = "scout_score",
                     snapshot_col: str = "valid_from") -> DataFrame:
    """Composite sidebar filter.  Empty lists mean "no filter"; a null
    score never passes ``>= min_score`` (so unscored rows are dropped)."""
    out = df
    if latest_only and snapshot_col in df.columns:
        out = latest_snapshot(out, snapshot_col)
    if leagues:
        out = out.filter(F.col(league_col).isin(list(leagues)))
    if positions:
        out = out.filter(F.col(position_col).isin(list(positions)))
    if teams:
        out = out.filter(F.col(team_col).isin(list(teams)))
    if max_value is not None:
        out = out.filter(F.coalesce(F.col(value_col), F.lit(0.0)) <= F.lit(max_value))
    return out.filter(F.col(score_col) >= F.lit(min_score))


def latest_snapshot(df: DataFrame, snapshot_col: str = "valid_from") -> DataFrame:
    """Rows whose snapshot equals the global max (null max -> unfiltered).

    The max is an uncorrelated scalar subquery: computed once by a partial +
    final aggregate, then compared as a value (no join, no single-task window).
    """
    mx = df.agg(F.max(snapshot_col)).scalar()
    return df.filter(mx.isNull() | (F.col(snapshot_col) == mx))


def name_matches(col: str | Column, name: str, aliases: Sequence[str] = ()) -> Column:
    """Equal, or equal ignoring spaces, or one of the aliases (bound as literals)."""
    c = F.col(col) if isinstance(col, str) else col
    cond = (c == F.lit(name)) | (F.replace(c, F.lit(" "), F.lit("")) ==
                                 F.lit(name.replace(" ", "")))
    if aliases:
        cond = cond | c.isin(list(aliases))
    return cond


# ----------------------------------------------------------------- B9 / B10
def participation(rating_col: str = "rating_cl", goals_col: str = "goals_cl",
                  assists_col: str = "assists_cl") -> Column:
    """Rating present or any goal / assist in the alternate competition."""
    return (F.col(rating_col).isNotNull() | (F.col(goals_col) > 0) |
            (F.col(assists_col) > 0))


def mode_switch(df: DataFrame, overrides: Mapping[str, str], team_col: str = "team",
                alt_team_col: str = "team_cl") -> DataFrame:
    """Replace base metrics by alternate-competition ones; team falls back."""
    cols = {dst: F.col(src) for dst, src in overrides.items()}
    cols[team_col] = F.coalesce(F.col(alt_team_col), F.col(team_col))
    return df.withColumns(cols)


# -------------------------------------------------------------------- B11
def with_default(df: DataFrame, target: str, default, *sources: str) -> Column:
    """First non-null of the existing source columns, else ``default``;
    a source absent from the schema contributes nothing (plan-time choice)."""
    present = [F.col(_q(s)) for s in (target, *sources) if s in df.columns]
    lit = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(*present, lit) if present else lit


def column_or(df: DataFrame, name: str, default) -> Column:
    """The column when present, otherwise a literal."""
    if name in df.columns:
        return F.col(_q(name))
    return default if isinstance(default, Column) else F.lit(default)


# -------------------------------------------------------------------- B14
def sample_status(minutes: str, min_minutes: float = 900.0) -> Column:
    """B14: 'Small Sample' below the threshold, else 'Active' (null -> Active)."""
    return F.when(F.col(minutes) < F.lit(min_minutes), F.lit("Small Sample")).otherwise(
        F.lit("Active"))


# -------------------------------------------------------------------- B17
def prune_fields(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop every struct field whose name is in ``names`` at any depth,
    including inside arrays of structs; rebuilt from the schema at plan time."""
    drop = set(names)

    def rebuild(expr: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StructType):
            kept = [f for f in dtype.fields if f.name not in drop]
            if not kept:
                return F.lit(None).cast(T.StructType([]))
            return F.when(expr.isNull(), F.lit(None)).otherwise(
                F.struct(*[rebuild(expr.getField(f.name), f.dataType).alias(f.name)
                           for f in kept]))
        if isinstance(dtype, T.ArrayType) and _has_struct(dtype.elementType):
            return F.transform(expr, lambda x: rebuild(x, dtype.elementType))
        return expr

    return df.select([rebuild(F.col(_q(f.name)), f.dataType).alias(f.name)
                      for f in df.schema.fields if f.name not in drop])


def _has_struct(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_struct(dtype.elementType)
    return False


# -------------------------------------------------------------------- B19


__all__ = ["select_rename", "keep_existing", "metric_rename_map", "flatten_schema", "flatten",
           "drop_null_key", "dashboard_filter", "latest_snapshot",
           "name_matches", "participation", "mode_switch", "with_default", "column_or",
           "sample_status", "prune_fields"]

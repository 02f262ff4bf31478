"""Data contract (B19) and constraint audit.

A contract is a list of ``Rule``s.  Schema problems (missing column, wrong
type) are found from ``df.schema`` at plan time; value problems (nulls in a
non-nullable column, values that cannot be coerced) are counted in a single
aggregate over the data.  Every failure is reported before anything aborts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    column: str
    dtype: str            # "string" or "double"
    nullable: bool = True
    coerce: bool = False  # for "double": numeric / numeric-looking strings accepted


class ContractError(ValueError):
    def __init__(self, report_rows, rows=()):
        self.report_rows, self.rows = report_rows, list(rows)
        super().__init__("data contract violated: " + "; ".join(
            f"{c}:{k}={n}" for c, k, n in report_rows))


REPORT_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("failures", T.LongType()),
])


def _type_ok(rule: Rule, dt: T.DataType) -> bool:
    if rule.dtype == "string":
        return isinstance(dt, T.StringType)
    if rule.dtype == "double":
        if isinstance(dt, T.DoubleType):
            return True
        return rule.coerce and isinstance(dt, (T.NumericType, T.StringType))
    return True


def _value_checks(rules: list[Rule], schema: dict[str, T.DataType]) -> list[tuple[str, str, Column]]:
    """(column, check, condition that a failing row meets) of the checks that need the data."""
    out = []
    for r in rules:
        if r.column in schema:
            c = F.col(f"`{r.column}`")
            if not r.nullable:
                out.append((r.column, "not_null", c.isNull()))
            if r.dtype == "double" and r.coerce and isinstance(schema[r.column], T.StringType):
                out.append((r.column, "coercible", c.isNotNull() & c.try_cast("double").isNull()))
    return out


def contract_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per (column, check) with its failure count, checks that pass
    included (failures = 0).  Runs one aggregate over the data."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    static_rows = [(r.column, "type", 0 if _type_ok(r, schema[r.column]) else 1) if r.column in schema else (r.column, "missing", 1)
                   for r in rules]
    checks = _value_checks(rules, schema)
    aggs = [F.count_if(failing).cast("bigint") for _, _, failing in checks]
    labels = [(column, check) for column, check, _ in checks]
    spark = df.sparkSession
    static = spark.createDataFrame(static_rows, REPORT_SCHEMA)
    if not aggs:
        return static
    # One pass: all value checks as one row, then unpivoted to long form.
    wide = df.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)])
    stack = ", ".join(f"'{col}', '{chk}', c{i}" for i, (col, chk) in enumerate(labels))
    long = wide.selectExpr(f"stack({len(labels)}, {stack}) as (column, check, failures)")
    return static.unionByName(long)


def failing_rows(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """(key, column, check, value) of every value that breaks a rule, in one pass without a shuffle.

    Missing columns and wrong types concern no single row; ``contract_report`` has them.
    """
    found = [F.when(failing, F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"),
                                      F.col(f"`{column}`").cast("string").alias("value")))
             for column, check, failing in _value_checks(rules, {f.name: f.dataType for f in df.schema.fields})]
    none = F.lit(None).cast("struct<column:string,check:string,value:string>")
    each = F.filter(F.array(*found, none), lambda x: x.isNotNull())
    return df.select(F.col(f"`{key}`"), F.inline(each))


def validate(df: DataFrame, rules: list[Rule], key: str | None = None, shown: int = 20) -> None:
    """B19 gate: raise ``ContractError`` listing every failing check.

    With a ``key`` the error also has ``rows``, the ``shown`` failures of least key,
    so that what reaches the driver is bounded; ``failing_rows`` has all.
    """
    bad = [(r["column"], r["check"], r["failures"]) for r in
           contract_report(df, rules).filter(F.col("failures") > 0).collect()]
    if bad:
        rows = failing_rows(df, rules, key).orderBy(key, "column", "check").limit(shown).collect() if key else []
        raise ContractError(bad, [tuple(r) for r in rows])


def constraint_audit(spark: SparkSession, checks: dict[str, DataFrame]) -> DataFrame:
    """Each named check is a DataFrame of offending rows; report counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check"), F.col("failures")) for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (group-having)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphan_keys(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Non-null foreign keys with no dimension row."""
    return fact.filter(F.col(fk).isNotNull()).join(
        dim.select(F.col(pk).alias(fk)), fk, "left_anti")


def out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies outside [low, high]; null is no value."""
    return df.filter((F.col(col) < F.lit(low)) | (F.col(col) > F.lit(high)))


__all__ = ["out_of_range", "Rule", "ContractError", "contract_report", "failing_rows", "validate", "constraint_audit",
           "duplicate_keys", "orphan_keys"]
